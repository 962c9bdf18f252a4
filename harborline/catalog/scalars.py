"""Scalar function queries, each over a whole table."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog.registry import query
from harborline.catalog.sqltext import dbl, div, dt, ts
from harborline.functions import exprs
from harborline.operators.joins import lookup
from harborline.sinks.tables import with_load_time
from harborline.streaming.events import parse_events

MONEY_SQL = "CAST(l_extendedprice AS DECIMAL(18,2))"


def lines(spark, sf):
    return domain.table(spark, sf, "lineitem")


def orders(spark, sf):
    return domain.table(spark, sf, "orders")


def events(spark, sf):
    return domain.table(spark, sf, "events")


@query("f1_text_casts", f"""
SELECT o_orderkey, {ts('o_orderdate - INTERVAL 8 HOUR')} AS at, {dt('o_orderdate')} AS on_day,
  {dbl('CAST(o_totalprice AS DECIMAL(18,2))')} AS amount FROM orders""")
def f1(spark, sf):
    text = orders(spark, sf).select(
        "o_orderkey",
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+08")).alias("at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("on_day"),
        F.col("o_totalprice").cast("string").alias("amount"),
    )
    return text.select(
        "o_orderkey", F.col("at").cast("timestamp").alias("at"), F.col("on_day").cast("date").alias("on_day"),
        exprs.money("amount").alias("amount"),
    )


@query("f2_number_casts", f"""
SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS whole, CAST(l_linenumber AS VARCHAR) AS txt,
  {dbl('CAST(l_extendedprice AS DECIMAL(38,9))')} AS exact FROM lineitem""")
def f2(spark, sf):
    return lines(spark, sf).select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("whole"), F.col("l_linenumber").cast("string").alias("txt"),
        exprs.numeric("l_extendedprice").alias("exact"),
    )


@query("f3_period_starts", f"""
SELECT l_orderkey, {dt("date_trunc('week', l_shipdate)")} AS week_start,
  {dt("date_trunc('month', l_shipdate)")} AS month_start, {dt("date_trunc('quarter', l_shipdate)")} AS quarter_start,
  {dt("date_trunc('year', l_shipdate)")} AS year_start FROM lineitem""")
def f3(spark, sf):
    names = {"W": "week_start", "M": "month_start", "Q": "quarter_start", "Y": "year_start"}
    return lines(spark, sf).select(
        "l_orderkey", *[exprs.period_start("l_shipdate", g).alias(name) for g, name in names.items()]
    )


@query("f4_day", f"SELECT event_id, {dt('ts')} AS day FROM events")
def f4(spark, sf):
    return events(spark, sf).select("event_id", exprs.day("ts").alias("day"))


@query("f5_year_shift", f"""
SELECT o_orderkey, {dt('CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR')} AS year_before,
  {dt('CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR')} AS year_after FROM orders""")
def f5(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey", exprs.shift_years("o_orderdate", -1).alias("year_before"),
        exprs.shift_years("o_orderdate", 1).alias("year_after"),
    )


@query("f6_hours", """
SELECT l_orderkey, (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 AS hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def f6(spark, sf):
    dated = orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lookup(lines(spark, sf), dated, "l_orderkey", "inner").select(
        "l_orderkey", exprs.hours_between("o_orderdate", "l_shipdate").alias("hours")
    )


@query("f7_rounding", f"""
SELECT l_orderkey, {dbl(f'round({MONEY_SQL} * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)')} AS two,
  {dbl('round(CAST(l_extendedprice * l_tax AS DECIMAL(18,6)), 4)')} AS four FROM lineitem""")
def f7(spark, sf):
    net = exprs.money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    tax = (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,6)")
    return lines(spark, sf).select("l_orderkey", F.round(net, 2).alias("two"), F.round(tax, 4).alias("four"))


@query("f8_coalesce", """
SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_custkey END, 0) AS number_or_zero,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '') AS text_or_empty,
  coalesce(CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus = 'F' END, false) AS flag_or_false FROM orders""")
def f8(spark, sf):
    even = F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey"))
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    flag = F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus") == "F")
    return orders(spark, sf).select(
        "o_orderkey", exprs.or_zero(even).alias("number_or_zero"), F.coalesce(status, F.lit("")).alias("text_or_empty"),
        F.coalesce(flag, F.lit(False)).alias("flag_or_false"),
    )


@query("f9_guarded_ratio", f"""
SELECT l_partkey, {div('sum(tip)', 'sum(price)', 4)} AS share, {div('sum(price)', 'sum(free)', 2, True)} AS per_free
FROM (SELECT l_partkey, {MONEY_SQL} AS price, CAST(l_extendedprice * l_discount AS DECIMAL(18,2)) AS tip,
  CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS free FROM lineitem) GROUP BY 1""")
def f9(spark, sf):
    rows = lines(spark, sf).select(
        "l_partkey", exprs.money("l_extendedprice").alias("price"),
        exprs.money(F.col("l_extendedprice") * F.col("l_discount")).alias("tip"),
        F.when(F.col("l_discount") == 0, 1).otherwise(0).alias("free"),
    )
    sums = rows.groupBy("l_partkey").agg(F.sum("tip").alias("t"), F.sum("price").alias("p"), F.sum("free").alias("f"))
    return sums.select(
        "l_partkey", exprs.ratio("t", "p", 4).alias("share"),
        exprs.ratio("p", "f", 2, need_positive_num=True).alias("per_free"),
    )


HASHED = "coalesce(CAST({} AS VARCHAR), '')"


@query("f10_row_hash", f"""
SELECT o_orderkey, md5({' || '.join(HASHED.format(c) for c in ('o_custkey', 'o_orderdate', 'o_totalprice'))}) AS hex_hash,
  md5({" || '|' || ".join(HASHED.format(c) for c in ('o_custkey', 'o_orderdate'))}) AS raw_hash FROM orders""")
def f10(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey", exprs.row_hash(["o_custkey", "o_orderdate", "o_totalprice"]).alias("hex_hash"),
        exprs.row_hash(["o_custkey", "o_orderdate"], raw=True, sep="|").alias("raw_hash"),
    )


# A nested payload is a JSON object, a missing one an empty object, a NULL one the word null.
PARSED_SQL = f"""SELECT CAST(user_id AS VARCHAR) AS policy_number, event_type,
  CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '{{"id":' || event_id || ',"tags":["' || event_type || '"]}}'
    WHEN 2 THEN '{{}}' ELSE 'null' END AS payload,
  {ts("date_trunc('millisecond', ts)")} AS event_time FROM events"""


@query("f11_json_parse", PARSED_SQL)
def f11(spark, sf):
    fields = "user_id AS policy_number, event_type, unix_millis(CAST(ts AS timestamp)) AS event_time_ms"
    nested = "named_struct('id', event_id, 'tags', array(event_type))"
    messages = events(spark, sf).selectExpr(f"""CASE event_id % 4
      WHEN 0 THEN to_json(struct({fields}, props AS payload)) WHEN 1 THEN to_json(struct({fields}, {nested} AS payload))
      WHEN 2 THEN to_json(struct({fields}))
      ELSE concat('{{"payload":null,', substring(to_json(struct({fields})), 2)) END AS value""")
    return parse_events(messages)


@query("f12_clip_text", "SELECT doc_id, substring(text, 1, 8000) AS clipped FROM documents")
def f12(spark, sf):
    return domain.table(spark, sf, "documents").select("doc_id", exprs.clip("text").alias("clipped"))


@query("f13_epoch_millis", f"SELECT event_id, {ts('make_timestamp(epoch_us(ts) // 1000 * 1000)')} AS at FROM events")
def f13(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events(spark, sf).select("event_id", exprs.from_millis(millis).alias("at"))


@query("f14_load_time", "SELECT count(*) AS stamped FROM region")
def f14(spark, sf):
    began = F.lit(datetime.now(UTC) - timedelta(minutes=1))
    stamped = with_load_time(domain.table(spark, sf, "region"))
    return stamped.agg(F.count_if(F.col("_loaded_at").between(began, F.now())).alias("stamped"))


@query("f15_month_label", """
SELECT strftime(l_shipdate, '%Y-%m') AS dashed, strftime(l_shipdate, '%Y_%m') AS underscored, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def f15(spark, sf):
    labels = (
        exprs.month_label("l_shipdate").alias("dashed"), exprs.month_label("l_shipdate", "_").alias("underscored")
    )
    return lines(spark, sf).groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


@query("f16_count_as_int", "SELECT l_linenumber, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY 1")
def f16(spark, sf):
    return lines(spark, sf).groupBy("l_linenumber").agg(F.count(F.lit(1)).cast("int").alias("n"))
