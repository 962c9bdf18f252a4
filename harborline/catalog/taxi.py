"""Trip queries: staging, filters, zone reports, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog.registry import query
from harborline.catalog.sqltext import dbl, dt, sql, ts
from harborline.functions import exprs
from harborline.plans import trips

AMOUNTS = [
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
]
STAGED_SQL = f"""* REPLACE ({ts('pickup_datetime')} AS pickup_datetime, {ts('dropoff_datetime')} AS dropoff_datetime,
  {', '.join(f'{dbl(a)} AS {a}' for a in AMOUNTS)})"""
ZONE = "NATION_3"


def yellow(spark, sf):
    return trips.stg_yellow(domain.yellow_trips(spark, sf))


def green(spark, sf):
    return trips.stg_green(domain.green_trips(spark, sf))


def all_trips(spark, sf):
    return trips.union_trips(green(spark, sf), yellow(spark, sf))


def zones(spark, sf):
    return trips.dim_zones(domain.zones(spark, sf))


def cents(e: str) -> str:
    return f"CAST(CAST(round({e}, 2) AS DECIMAL(18,2)) AS DOUBLE)"


def in_cents(column: str):
    return F.round(column, 2).cast(exprs.MONEY).alias(column)


@query("p1_stg_yellow", sql(f"SELECT {STAGED_SQL} FROM stg_yellow"))
def p1(spark, sf):
    return yellow(spark, sf)


@query("p2_stg_green", sql(f"SELECT {STAGED_SQL} FROM stg_green"))
def p2(spark, sf):
    return green(spark, sf)


@query("u1_trip_union", sql(f"SELECT {STAGED_SQL} FROM trips"))
def u1(spark, sf):
    return all_trips(spark, sf)


@query("p7_constant_columns", sql(f"SELECT trip_type, {dbl('ehail_fee')} AS ehail_fee, count(*) AS n FROM stg_yellow GROUP BY 1, 2"))
def p7(spark, sf):
    return yellow(spark, sf).groupBy("trip_type", "ehail_fee").agg(F.count(F.lit(1)).alias("n"))


@query("p8_dim_zones", sql("SELECT * FROM zones"))
def p8(spark, sf):
    return zones(spark, sf)


@query("p10_half_open_range", sql("""
SELECT count(*) AS n FROM stg_green
WHERE pickup_datetime >= '1998-11-01' AND pickup_datetime < '1998-12-01' AND trip_distance <= 10"""))
def p10(spark, sf):
    rows = green(spark, sf).where(exprs.within("pickup_datetime", "1998-11-01", "1998-12-01"))
    return rows.where(F.col("trip_distance") <= 10).agg(F.count(F.lit(1)).alias("n"))


@query("p11_on_a_day", sql("SELECT count(*) AS n FROM stg_yellow WHERE CAST(pickup_datetime AS DATE) = '1998-11-15'"))
def p11(spark, sf):
    return yellow(spark, sf).where(exprs.on_day("pickup_datetime", "1998-11-15")).agg(F.count(F.lit(1)).alias("n"))


@query("p12_between_dates", """
SELECT DISTINCT l_linenumber AS vendor_id FROM lineitem WHERE l_shipdate BETWEEN '1999-03-01' AND '1999-03-15'""")
def p12(spark, sf):
    rows = domain.table(spark, sf, "lineitem").where(exprs.between_as_written("l_shipdate", "1999-03-01", "1999-03-15"))
    return rows.select(F.col("l_linenumber").alias("vendor_id")).distinct()


@query("p13_comparisons", """
SELECT count(*) FILTER (l_quantity <= 1) AS short_trips, count(*) FILTER (l_discount = 0) AS free_tips,
  count(*) FILTER (l_extendedprice < 1000) AS cheap, count(*) FILTER (l_linenumber = 1) AS vendor_one FROM lineitem""")
def p13(spark, sf):
    c = F.col
    return domain.table(spark, sf, "lineitem").agg(
        F.count_if(c("l_quantity") <= 1).alias("short_trips"), F.count_if(c("l_discount") == 0).alias("free_tips"),
        F.count_if(c("l_extendedprice") < 1000).alias("cheap"), F.count_if(c("l_linenumber") == 1).alias("vendor_one"),
    )


@query("p14_in_list", "SELECT l_linestatus, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1")
def p14(spark, sf):
    rows = domain.table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    return rows.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


NAMES_SQL = "CASE vendor_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in exprs.VENDOR_NAMES.items()) + " END"


@query("p16_vendor_names", sql(f"""
SELECT vendor_id, {NAMES_SQL} AS vendor_name, count(*) AS n FROM trips GROUP BY 1, 2"""))
def p16(spark, sf):
    counts = all_trips(spark, sf).groupBy("vendor_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("vendor_id", exprs.vendor_name("vendor_id").alias("vendor_name"), "n")


@query("g7_macro_expression", f"""
SELECT l_orderkey, vendor_id, {NAMES_SQL} AS vendor_name
FROM (SELECT l_orderkey, l_linenumber AS vendor_id FROM lineitem)""")
def g7(spark, sf):
    return domain.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("vendor_id"), exprs.vendor_name("l_linenumber").alias("vendor_name")
    )


@query("j1_trips_to_zone", sql(f"""
SELECT zone, borough, {cents('sum(fare_amount)')} AS fare FROM stg_yellow
JOIN zones ON pickup_location_id = location_id GROUP BY 1, 2"""))
def j1(spark, sf):
    joined = yellow(spark, sf).join(zones(spark, sf), F.col("pickup_location_id") == F.col("location_id"))
    return joined.groupBy("zone", "borough").agg(F.sum("fare_amount").alias("fare")).select(
        "zone", "borough", in_cents("fare")
    )


@query("j2_zone_in_two_roles", sql("""
SELECT p.zone AS pickup_zone, d.zone AS dropoff_zone, count(*) AS n FROM stg_yellow
JOIN zones p ON pickup_location_id = p.location_id JOIN zones d ON dropoff_location_id = d.location_id GROUP BY 1, 2"""))
def j2(spark, sf):
    # trips are counted per pair of locations first; the two zone joins then see few rows
    pairs = yellow(spark, sf).groupBy("pickup_location_id", "dropoff_location_id").agg(F.count(F.lit(1)).alias("n"))
    z = zones(spark, sf)
    pickup = z.select(F.col("location_id").alias("pickup_location_id"), F.col("zone").alias("pickup_zone"))
    dropoff = z.select(F.col("location_id").alias("dropoff_location_id"), F.col("zone").alias("dropoff_zone"))
    named = pairs.join(pickup, "pickup_location_id").join(dropoff, "dropoff_location_id")
    return named.groupBy("pickup_zone", "dropoff_zone").agg(F.sum("n").alias("n"))


@query("a11_sum_by_zone", sql(f"""
SELECT zone, {cents('sum(total_amount)')} AS value FROM stg_green JOIN zones ON pickup_location_id = location_id
GROUP BY 1"""))
def a11(spark, sf):
    by = trips.by_zone(green(spark, sf), zones(spark, sf), "pickup_location_id", F.sum("total_amount"), F.sum)
    return by.select("zone", in_cents("value"))


@query("a12_max_by_zone", sql(f"""
SELECT d.zone AS dropoff_zone, {cents('max(tip_amount)')} AS largest_tip
FROM stg_green JOIN zones p ON pickup_location_id = p.location_id JOIN zones d ON dropoff_location_id = d.location_id
WHERE p.zone = '{ZONE}' GROUP BY 1"""))
def a12(spark, sf):
    tips = trips.largest_tip(green(spark, sf), zones(spark, sf), ZONE)
    return tips.select("dropoff_zone", in_cents("largest_tip"))


@query("a13_average_by_group", sql("""
SELECT brand, CAST((2 * CAST(sum(price) * 100 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_price
FROM products GROUP BY 1"""))
def a13(spark, sf):
    average = (F.sum("price").cast(exprs.AMOUNT) / F.count("price")).cast(exprs.QUOTIENT)
    rows = domain.products(spark, sf).groupBy("brand").agg(F.round(average, 2).alias("avg_price"))
    return rows.orderBy(F.desc("avg_price"), "brand")


@query("a14_longest_trip_hours", sql("""
SELECT max(epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0 AS longest_hours FROM trips"""))
def a14(spark, sf):
    return trips.longest_trip_hours(all_trips(spark, sf))


@query("a24_distinct_values", sql("SELECT DISTINCT vendor_id, payment_type FROM trips"))
def a24(spark, sf):
    return all_trips(spark, sf).select("vendor_id", "payment_type").distinct()


@query("a25_dim_vendors", sql(f"SELECT DISTINCT vendor_id, {NAMES_SQL} AS vendor_name FROM trips"))
def a25(spark, sf):
    return trips.dim_vendors(all_trips(spark, sf))


@query("a27_zone_revenue", sql(f"""
SELECT zone, {dt("date_trunc('month', pickup_datetime)")} AS month_start, {cents('sum(total_amount)')} AS revenue
FROM trips JOIN zones ON pickup_location_id = location_id GROUP BY 1, 2"""))
def a27(spark, sf):
    revenue = trips.zone_revenue(all_trips(spark, sf), zones(spark, sf))
    return revenue.select("zone", "month_start", in_cents("revenue"))


@query("t1k_top_zone", sql(f"""
SELECT zone, {cents('sum(total_amount)')} AS total_amount_sum FROM stg_green
JOIN zones ON pickup_location_id = location_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""))
def t1k(spark, sf):
    return trips.top_pickup_zone(green(spark, sf), zones(spark, sf)).select("zone", in_cents("total_amount_sum"))


@query("t2k_rarest_zones", sql("""
SELECT zone, CAST(count(*) AS BIGINT) AS trip_count FROM stg_yellow JOIN zones ON pickup_location_id = location_id
GROUP BY 1 ORDER BY 2, 1 LIMIT 5"""))
def t2k(spark, sf):
    return trips.rarest_pickup_zones(yellow(spark, sf), zones(spark, sf))


@query("t3k_longest_trips", sql(f"""
SELECT {ts('pickup_datetime')} AS pickup_datetime, {dbl('trip_distance')} AS trip_distance FROM stg_green
WHERE trip_distance < 40"""))
def t3k(spark, sf):
    return trips.longest_trips(green(spark, sf), 40)


@query("t3k_longest_trip_day", sql(f"""
SELECT {dt('pickup_datetime')} AS pickup_day, {dbl('trip_distance')} AS trip_distance FROM stg_green
WHERE trip_distance < 40 ORDER BY stg_green.trip_distance DESC, pickup_datetime DESC LIMIT 1"""))
def t3k_day(spark, sf):
    return trips.longest_trip_day(green(spark, sf), 40)


@query("t4k_multi_key_sort", sql(f"""
SELECT zone, {dt("date_trunc('month', pickup_datetime)")} AS month_start, count(*) AS n
FROM stg_green JOIN zones ON pickup_location_id = location_id GROUP BY 1, 2"""))
def t4k(spark, sf):
    dated = green(spark, sf).withColumn("month_start", exprs.period_start("pickup_datetime", "M"))
    counts = trips.by_zone(
        dated, zones(spark, sf), "pickup_location_id", F.count(F.lit(1)), F.sum, keys=("month_start",)
    )
    return counts.withColumnRenamed("value", "n").orderBy("month_start", "zone")


@query("t5k_boolean_sort", sql("""
SELECT trip_type = 1 AS is_hail, count(*) AS n FROM stg_green GROUP BY 1"""))
def t5k(spark, sf):
    hails = green(spark, sf).groupBy((F.col("trip_type") == 1).alias("is_hail")).agg(F.count(F.lit(1)).alias("n"))
    return hails.orderBy(F.desc("is_hail"))
