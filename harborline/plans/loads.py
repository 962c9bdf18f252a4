"""Monthly trip loads: typed CSV to staging, row hash, insert-only merge; and backfills."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harborline.functions.exprs import numeric, period_start
from harborline.sinks.merge import merge_insert_only
from harborline.sinks.tables import add_row_id
from harborline.sources.files import read_csv

# The columns of the monthly trip files and their types.
YELLOW_SCHEMA = """
    VendorID string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int,
    trip_distance double, RatecodeID string, store_and_fwd_flag string, PULocationID string, DOLocationID string,
    payment_type int, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double,
    improvement_surcharge double, total_amount double, congestion_surcharge double
"""
GREEN_SCHEMA = """
    VendorID string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz,
    store_and_fwd_flag string, RatecodeID string, PULocationID string, DOLocationID string, passenger_count int,
    trip_distance double, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double,
    ehail_fee double, improvement_surcharge double, total_amount double, payment_type int, trip_type int,
    congestion_surcharge double
"""


@dataclass(frozen=True)
class Kind:
    """What differs between taxi types."""

    schema: str
    pickup: str
    dropoff: str

    @property
    def place_and_time(self) -> list[str]:
        """The five columns of the short row hash."""
        return ["VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID"]

    @property
    def hash_columns(self) -> list[str]:
        """The seven columns of the long row hash."""
        return [*self.place_and_time, "fare_amount", "trip_distance"]


KINDS = {
    "yellow": Kind(YELLOW_SCHEMA, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": Kind(GREEN_SCHEMA, "lpep_pickup_datetime", "lpep_dropoff_datetime"),
}


def month_file(kind: str, ym: str) -> str:
    return f"{kind}_tripdata_{ym}.csv"


def enrich(rows: DataFrame, kind: str, filename: str | Column) -> DataFrame:
    """Hex hash over seven columns, and the file name."""
    return add_row_id(rows, KINDS[kind].hash_columns, filename)


def month_table(rows: DataFrame, kind: str, filename: str | Column) -> DataFrame:
    """The warehouse variant: amounts as decimals, codes as text, raw hash bytes over five columns."""
    hashed = add_row_id(rows, KINDS[kind].place_and_time, filename, raw=True)
    text = {"VendorID", "RatecodeID", "PULocationID", "DOLocationID", "store_and_fwd_flag", "trip_type"}

    def typed(name: str, dtype: str) -> Column:
        if name in text:
            return F.col(name).cast("string").alias(name)
        return numeric(name).alias(name) if dtype == "double" else F.col(name)

    return hashed.select(*[typed(name, dtype) for name, dtype in hashed.dtypes])


#: How a staged month is hashed: hex over seven columns, or raw bytes over five in a typed month table.
VARIANTS = {"hex": enrich, "raw": month_table}


def load_month(
    spark: SparkSession, kind: str, ym: str, source: str, target: str, staging: str, grain: str = "D",
    variant: str = "hex",
) -> dict:
    """Load one month file into the target: stage it anew, then merge. Loading it again adds nothing.

    The target is laid out by pickup day, or by a coarser ``grain``. The row hash covers the pickup time,
    so a staged row can only meet target rows of its own period: the merge reads the periods that the
    file has rows for, so a few stray years in it cost a few stray partitions.
    """
    spec = KINDS[kind]
    name = month_file(kind, ym)
    rows = read_csv(spark, f"{source.rstrip('/')}/{name}", schema=spec.schema)
    staged = VARIANTS[variant](rows, kind, name).withColumn("pickup_period", period_start(spec.pickup, grain))
    seen = Observation()
    staged.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staging)
    inserted = merge_insert_only(spark.read.parquet(staging), target, "unique_row_id", partition="pickup_period")
    return {"file": name, "rows_in": seen.get["rows"], "rows_inserted": inserted}


def month_range(first: str, last: str) -> list[str]:
    """The months from ``first`` to ``last``, both as yyyy-MM and both included."""
    at, end = (int(ym[:4]) * 12 + int(ym[5:]) - 1 for ym in (first, last))
    if end < at:
        raise ValueError("the last month lies before the first month")
    return [f"{m // 12}-{m % 12 + 1:02d}" for m in range(at, end + 1)]


def backfill(
    spark: SparkSession, kinds: str | Sequence[str], months: Sequence[str], source: str, target: str, staging: str,
    grain: str = "D", variant: str = "hex",
) -> DataFrame:
    """Load months one after another; one audit row per month. Several kinds go to a folder of the target each."""
    several = [kinds] if isinstance(kinds, str) else list(kinds)
    audit = [
        load_month(
            spark, kind, ym, source, target if isinstance(kinds, str) else f"{target}/{kind}",
            f"{staging}/{kind}-{ym}", grain, variant,
        )
        for kind in several
        for ym in months
    ]
    return spark.createDataFrame(audit, "file string, rows_in long, rows_inserted long")
