"""The driver's tables read as policy, invoice, claim, trip, zone, product and event frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.exprs import MONEY
from harborline.operators.joins import lookup


# Order and line number repeat in the test tables; with part, supplier and price a line has a key of its own.
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_policy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "o_orderkey AS policy_number",
        "o_custkey AS user_id",
        "o_orderkey AS application_id",
        "o_orderpriority AS product",
        "o_orderdate AS issue_date",
        "o_orderdate AS effective_date",
        "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS insured_gender",
        "add_months(to_date(o_orderdate), -240 - cast(o_custkey % 600 AS int)) AS insured_date_of_birth",
    )


def confirmed_policy(spark: SparkSession, sf: str) -> DataFrame:
    """The policies whose order is not pending: a key list that leaves real orphans behind."""
    return table(spark, sf, "orders").where("o_orderstatus <> 'P'").selectExpr("o_orderkey AS policy_number")


def raw_invoice(spark: SparkSession, sf: str) -> DataFrame:
    return invoices_of(table(spark, sf, "lineitem"))


def invoices_of(lines: DataFrame) -> DataFrame:
    """The raw invoices of these lines, one each."""
    price = f"cast(l_extendedprice AS {MONEY})"
    return lines.selectExpr(
        LINE_ID + " AS id",
        "l_linestatus AS invoice_type",
        "l_orderkey AS policy_number",
        "l_shipdate AS coverage_start_date",
        "l_shipdate + interval 30 days AS coverage_end_date",
        "l_shipdate AS due_date",
        "CASE l_returnflag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'open' ELSE 'refunded' END AS status",
        f"{price} AS pre_levy_amount",
        f"cast(round({price} * (1 + cast(l_tax AS decimal(4,2))), 2) AS {MONEY}) AS total_amount",
        "CASE WHEN l_returnflag = 'R' THEN to_date(l_shipdate) END AS refund_date",
        "CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS charge_date",
    )


def raw_claim(spark: SparkSession, sf: str) -> DataFrame:
    price = f"cast(l_extendedprice AS {MONEY})"
    return table(spark, sf, "lineitem").where("l_returnflag = 'R'").selectExpr(
        LINE_ID + " AS id",
        "concat('T', l_linenumber) AS type",
        "CASE l_linestatus WHEN 'F' THEN 'paid' ELSE 'open' END AS status",
        "l_orderkey AS policy_number",
        "l_shipdate AS submit_date",
        "CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS payment_date",
        "CASE WHEN l_linenumber <> 7 THEN to_date(l_shipdate) END AS admission_date",
        f"{price} AS total_billed_amount",
        f"cast(round({price} * (1 - cast(l_discount AS decimal(4,2))), 2) AS {MONEY}) AS total_base_payable_amount",
    )


def _trips(spark: SparkSession, sf: str, linestatus: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
    riders = lookup(orders, customers, "o_custkey", "inner").selectExpr(
        "o_orderkey AS l_orderkey", "o_orderdate", "c_nationkey"
    )
    placed = lookup(lines.where(F.col("l_linestatus") == linestatus), suppliers, "l_suppkey", "inner")
    return lookup(placed, riders, "l_orderkey", "inner")


def _trip_columns(prefix: str) -> list[str]:
    return [
        "l_linenumber AS VendorID",
        f"o_orderdate AS {prefix}_pickup_datetime",
        f"l_shipdate AS {prefix}_dropoff_datetime",
        "l_partkey % 6 AS passenger_count",
        "l_quantity AS trip_distance",
        "l_partkey % 5 + 1 AS RatecodeID",
        "'N' AS store_and_fwd_flag",
        "s_nationkey AS PULocationID",
        "c_nationkey AS DOLocationID",
        "l_suppkey % 4 + 1 AS payment_type",
        "l_extendedprice AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "l_extendedprice * l_discount AS tip_amount",
        "0.0D AS tolls_amount",
        "0.3D AS improvement_surcharge",
        "l_extendedprice * (1.0D + l_tax) AS total_amount",
        "2.5D AS congestion_surcharge",
    ]


def yellow_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _trips(spark, sf, "F").selectExpr(*_trip_columns("tpep"))


def green_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _trips(spark, sf, "O").selectExpr(
        *_trip_columns("lpep"), "cast(NULL AS double) AS ehail_fee", "l_partkey % 2 + 1 AS trip_type"
    )


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        "CASE WHEN r_regionkey < 2 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone",
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_brand AS brand", f"cast(p_retailprice AS {MONEY}) AS price")


def event_messages(events: DataFrame) -> DataFrame:
    """One JSON text per event, in the shape a policy event message has."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("user_id").cast("string").alias("policy_number"),
                F.col("event_type"),
                F.col("props").alias("payload"),
                F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"),
            )
        ).alias("value")
    )
