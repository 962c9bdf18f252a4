"""Taxi trips: staging to one shared layout, dimensions and zone reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.exprs import hours_between, numeric, vendor_name

# Shared trip layout: column -> (raw column, type). Fixed values; the time columns carry a per-kind prefix.
LAYOUT = {
    "vendor_id": ("VendorID", "int"),
    "rate_code_id": ("RatecodeID", "int"),
    "pickup_location_id": ("PULocationID", "int"),
    "dropoff_location_id": ("DOLocationID", "int"),
    "pickup_datetime": ("{p}_pickup_datetime", "timestamp_ntz"),
    "dropoff_datetime": ("{p}_dropoff_datetime", "timestamp_ntz"),
    "store_and_fwd_flag": ("store_and_fwd_flag", "string"),
    "passenger_count": ("passenger_count", "int"),
    "trip_distance": ("trip_distance", "numeric"),
    "trip_type": ("trip_type", "int"),
    "fare_amount": ("fare_amount", "numeric"),
    "extra": ("extra", "numeric"),
    "mta_tax": ("mta_tax", "numeric"),
    "tip_amount": ("tip_amount", "numeric"),
    "tolls_amount": ("tolls_amount", "numeric"),
    "ehail_fee": ("ehail_fee", "numeric"),
    "improvement_surcharge": ("improvement_surcharge", "numeric"),
    "total_amount": ("total_amount", "numeric"),
    "congestion_surcharge": ("congestion_surcharge", "numeric"),
    "payment_type": ("payment_type", "int"),
}
PREFIX = {"yellow": "tpep", "green": "lpep"}


def _cast(c: Column, kind: str) -> Column:
    return numeric(c) if kind == "numeric" else c.cast(kind)


def stage(raw: DataFrame, kind: str, constants: dict[str, object] | None = None) -> DataFrame:
    """Raw trips of a kind in the shared layout, without trips that lack a vendor."""
    constants = constants or {}
    columns = []
    for name, (source, to) in LAYOUT.items():
        value = F.lit(constants[name]) if name in constants else F.col(source.format(p=PREFIX[kind]))
        columns.append(_cast(value, to).alias(name))
    return raw.where(F.col("VendorID").isNotNull()).select(*columns)


def stg_yellow(raw: DataFrame) -> DataFrame:
    """Yellow trips are street hails (type 1) and have no e-hail fee (0)."""
    return stage(raw, "yellow", {"trip_type": 1, "ehail_fee": 0})


def stg_green(raw: DataFrame) -> DataFrame:
    return stage(raw, "green")


def union_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    return green.unionByName(yellow)


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def dim_vendors(trips: DataFrame) -> DataFrame:
    """Distinct ids first: the name is then computed once per vendor, not once per trip."""
    return trips.select("vendor_id").distinct().withColumn("vendor_name", vendor_name("vendor_id"))


def by_zone(
    trips: DataFrame,
    zones: DataFrame,
    location: str,
    partial: Column,
    merge: Callable[[str], Column],
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """An aggregate of trips per zone *name* (several location ids may share one).

    ``partial`` aggregates per location and ``merge`` combines those (count -> sum, max -> max), so
    the zones are joined to a handful of rows per location rather than to every trip.
    """
    per_location = trips.groupBy(F.col(location).alias("location_id"), *keys).agg(partial.alias("_part"))
    return (
        per_location.join(zones.select("location_id", "zone"), "location_id")
        .groupBy("zone", *keys)
        .agg(merge("_part").alias("value"))
    )


def zone_revenue(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Revenue per pickup zone and month."""
    dated = trips.withColumn("month_start", F.date_trunc("month", "pickup_datetime").cast("date"))
    revenue = by_zone(dated, zones, "pickup_location_id", F.sum("total_amount"), F.sum, keys=("month_start",))
    return revenue.withColumnRenamed("value", "revenue")


def top_pickup_zone(trips: DataFrame, zones: DataFrame, n: int = 1) -> DataFrame:
    totals = by_zone(trips, zones, "pickup_location_id", F.sum("total_amount"), F.sum)
    return totals.withColumnRenamed("value", "total_amount_sum").orderBy(F.desc("total_amount_sum"), "zone").limit(n)


def rarest_pickup_zones(trips: DataFrame, zones: DataFrame, n: int = 5) -> DataFrame:
    counts = by_zone(trips, zones, "pickup_location_id", F.count(F.lit(1)), F.sum)
    return counts.withColumnRenamed("value", "trip_count").orderBy("trip_count", "zone").limit(n)


def largest_tip(trips: DataFrame, zones: DataFrame, pickup_zone: str) -> DataFrame:
    """Largest tip per drop-off zone for trips picked up in one named zone: the zones in two roles.

    The named pickup zone is a handful of location ids, a filter on the trips; the drop-off zone is
    joined after the trips have been reduced to one row per drop-off location.
    """
    pickups = zones.where(F.col("zone") == pickup_zone).select(F.col("location_id").alias("pickup_location_id"))
    from_zone = trips.join(pickups, "pickup_location_id", "left_semi")
    tips = by_zone(from_zone, zones, "dropoff_location_id", F.max("tip_amount"), F.max)
    return tips.select(F.col("zone").alias("dropoff_zone"), F.col("value").alias("largest_tip"))


def longest_trips(trips: DataFrame, below: float) -> DataFrame:
    """Pickup time and distance of every trip under a distance, longest first.

    The last sort key is a hash of the whole trip: trips equal in the other two may be cut between tasks.
    """
    return (
        trips.where(F.col("trip_distance") < below)
        .select("pickup_datetime", "trip_distance", F.xxhash64(*trips.columns).alias("_spread"))
        .orderBy(F.desc("trip_distance"), "pickup_datetime", "_spread")
        .drop("_spread")
    )


def longest_trip_day(trips: DataFrame, below: float) -> DataFrame:
    """The pickup day of the longest trip under a distance (the latest such day): no sort needed."""
    return trips.where(F.col("trip_distance") < below).agg(
        F.max(F.struct("trip_distance", F.to_date("pickup_datetime").alias("day"))).alias("top")
    ).select(F.col("top.day").alias("pickup_day"), F.col("top.trip_distance").alias("trip_distance"))


def longest_trip_hours(trips: DataFrame) -> DataFrame:
    return trips.agg(F.max(hours_between("pickup_datetime", "dropoff_datetime")).alias("longest_hours"))
