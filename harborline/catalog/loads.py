"""Sources, sinks and incremental loads. Each query writes to a path of its own and reads it back."""

from __future__ import annotations

import functools
import uuid
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog import insurance
from harborline.catalog.registry import query
from harborline.catalog.sqltext import VALUES, dbl, dt, sql, ts
from harborline.operators import profile
from harborline.plans import build, loads, marts
from harborline.session import scratch
from harborline.sinks import merge, tables, versions
from harborline.sources import drift, files


def n_rows():
    return F.count(F.lit(1))

SPLIT = "1998-07-01"
OVERLAP = "1998-01-01"


def lines(spark, sf):
    return domain.table(spark, sf, "lineitem")


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


# Sources


def _as_text(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.000')"


POLICY_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in ("id", "policy_number", "user_id", "application_id")} | {
    "product": "product", "issue_date": _iso("issue_date"), "effective_date": _iso("effective_date"),
    "insured_gender": "insured_gender", "insured_date_of_birth": dt("insured_date_of_birth"),
}


@query("s1_raw_csv", sql(f"SELECT {_as_text(POLICY_TEXT)} FROM raw_policy"))
def s1(spark, sf):
    base = scratch(spark, "s1")
    domain.raw_policy(spark, sf).write.option("header", True).csv(f"{base}/policy.csv")
    return files.read_raw_csv(spark, base, "policy.csv")


@query("s1_raw_landing", sql("""
SELECT 'raw_policy' AS name, count(*) AS n, count(*) AS stamped, CAST(sum(policy_number) AS BIGINT) AS keys FROM raw_policy
UNION ALL SELECT 'raw_claim', count(*), count(*), CAST(sum(policy_number) AS BIGINT) FROM raw_claim"""))
def s1_landing(spark, sf):
    # the invoice file is missing: it is skipped, and its table is not made
    source, base = scratch(spark, "s1-files"), scratch(spark, "s1-raw")
    for name, rows in (("policy", domain.raw_policy(spark, sf)), ("claim", domain.raw_claim(spark, sf))):
        rows.write.option("header", True).csv(f"{source}/{name}.csv")
    began = datetime.now(UTC) - timedelta(minutes=1)
    done = build.land_raw(spark, source, base)
    in_time = F.col("_loaded_at").between(F.lit(began), F.lit(datetime.now(UTC) + timedelta(minutes=1)))
    return profile.stack({
        name: spark.read.parquet(f"{base}/raw/{name}").agg(
            n_rows().alias("n"), F.count_if(in_time).alias("stamped"),
            F.sum(F.col("policy_number").cast("bigint")).alias("keys"))
        for name in done
    }, "name")


_TEXT_CODES = ("VendorID", "RatecodeID", "PULocationID", "DOLocationID")
_TRIP_TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def _whole_trip(number: str = "{0}") -> str:
    """All columns of a yellow trip as they are compared; ``number`` renders the amounts."""
    out = []
    for line in loads.YELLOW_SCHEMA.replace("\n", " ").split(","):
        c, kind = line.split()
        if c in _TRIP_TIMES:
            out.append(f"{ts(c)} AS {c}")
        elif c in _TEXT_CODES:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        else:
            out.append(f"{'CAST({0} AS INTEGER)' if kind == 'int' else number if kind == 'double' else '{0}'} AS {c}".format(c))
    return ", ".join(out)


@query("s2_typed_csv_gz", sql(f"SELECT {_whole_trip()} FROM yellow"))
def s2(spark, sf):
    path = scratch(spark, "s2")
    domain.yellow_trips(spark, sf).write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv(spark, path, schema=loads.YELLOW_SCHEMA)


@query("s3_inferred_csv", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s3(spark, sf):
    path = scratch(spark, "s3")
    domain.table(spark, sf, "customer").write.option("header", True).csv(path)
    return files.read_csv(spark, path, infer=True)


@query("s4_lenient_csv", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS c_acctbal
FROM customer""")
def s4(spark, sf):
    # every third line is short: it lacks the last column
    path = scratch(spark, "s4")
    text = F.when(F.col("c_custkey") % 3 > 0, F.concat_ws(",", "c_custkey", "c_name", "c_acctbal")).otherwise(
        F.concat_ws(",", "c_custkey", "c_name"))
    domain.table(spark, sf, "customer").select(text.alias("value")).write.text(path)
    return files.read_csv(spark, path, schema="c_custkey int, c_name string, c_acctbal double", lenient=True, header=False)


@query("s4_line_breaks", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name || chr(10) || c_mktsegment AS note, c_acctbal FROM customer""")
def s4_breaks(spark, sf):
    path = scratch(spark, "s4-breaks")
    domain.table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("note"), "c_acctbal"
    ).write.option("header", True).option("escape", '"').csv(path)
    return files.read_csv(spark, path, lenient=True, multi_line=True)


LINES_SQL = f"SELECT * REPLACE ({ts('l_shipdate')} AS l_shipdate) FROM lineitem"


@query("s5_parquet", LINES_SQL)
def s5(spark, sf):
    return files.read_parquet(spark, f"{sf}/lineitem.parquet")


def _product_documents(spark, sf, label):
    """JSON documents with an array of products, one product to each."""
    path = scratch(spark, label)
    product = "struct(p_brand AS brand, p_retailprice AS price, CASE WHEN p_size > 25 THEN p_type END AS kind)"
    domain.table(spark, sf, "part").selectExpr(f"array({product}) AS products").write.json(path)
    return path


@query("s6_nested_json", "SELECT p_brand AS brand, p_retailprice AS price FROM part")
def s6(spark, sf):
    return files.read_json_records(
        spark, _product_documents(spark, sf, "s6"), "products", ["brand", "price"], multi_line=False
    )


@query("p9_keep_columns", """
SELECT p_brand AS brand, CASE WHEN p_size > 25 THEN p_type ELSE 'N/A' END AS kind, 'N/A' AS rating FROM part""")
def p9(spark, sf):
    return files.read_json_records(
        spark, _product_documents(spark, sf, "p9"), "products", ["brand", "kind", "rating"], multi_line=False
    )


@query("s7_json_rows", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def s7(spark, sf):
    path = scratch(spark, "s7")
    domain.table(spark, sf, "part").write.json(path)
    rows = files.read_json_rows(spark, path, multi_line=False)
    return rows.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("s8_warehouse_table", "SELECT * FROM customer")
def s8(spark, sf):
    name = _name("customer_ext")
    tables.external_table(spark, name, f"{sf}/customer.parquet")
    return files.read_table(spark, name)


@query("s9_seed", sql("SELECT CAST(location_id AS INTEGER) AS location_id, borough, zone, service_zone FROM zones"))
def s9(spark, sf):
    path = scratch(spark, "s9")
    domain.zones(spark, sf).write.option("header", True).csv(path)
    seed = files.read_seed(spark, path, "LocationID int, Borough string, Zone string, service_zone string")
    return seed.select(F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"),
                       F.col("Zone").alias("zone"), "service_zone")


@query("s10_file_range", """
SELECT o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys
FROM orders GROUP BY 1, 2""")
def s10(spark, sf):
    # a folder per status and month, over the months that the table spans
    base = scratch(spark, "s10")
    orders = domain.table(spark, sf, "orders").withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    orders.withColumn("status", F.col("o_orderstatus")).repartition("status", "ym").write.partitionBy("status", "ym").parquet(base)
    span = orders.agg(F.min("ym"), F.max("ym")).first()
    there = {tuple(r) for r in orders.select("o_orderstatus", "ym").distinct().collect()}  # one row per folder
    parts = [
        drift.read_months(spark, base, kind, months=[m for m in loads.month_range(*span) if (kind, m) in there],
                          pattern="status={kind}/ym={ym}")
        for kind in sorted({k for k, _ in there})
    ]
    rows = functools.reduce(lambda a, b: a.unionByName(b), parts)
    return rows.groupBy(F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(
        n_rows().alias("n"), F.sum("o_custkey").alias("keys"))


@query("s11_external_and_managed", """
SELECT 'external' AS kind, * FROM supplier UNION ALL SELECT 'managed', * FROM supplier""")
def s11(spark, sf):
    external, layer = _name("supplier_ext"), _name("layer")
    tables.create_layer(spark, layer, scratch(spark, "s11"))
    rows = tables.external_table(spark, external, f"{sf}/supplier.parquet")
    tables.write_table(rows, f"{layer}.supplier")
    return rows.select(F.lit("external").alias("kind"), "*").unionByName(
        spark.table(f"{layer}.supplier").select(F.lit("managed").alias("kind"), "*"))


@query("s11_external_partitioned", f"""
SELECT * REPLACE ({ts('ts')} AS ts), {dt('ts')} AS ts_day FROM events""")
def s11_partitioned(spark, sf):
    # the table is there before the later days are
    name, path = _name("events_ext"), scratch(spark, "s11-days")
    events, middle = domain.table(spark, sf, "events"), F.lit("2024-01-15").cast("timestamp_ntz")
    tables.write_table(events.where(F.col("ts") < middle), path, partition_ts="ts")
    tables.external_table(spark, name, path)
    tables.write_table(events.where(F.col("ts") >= middle), path, mode="append", partition_ts="ts")
    return tables.external_table(spark, name, path)


@query("s12_schema_drift", """
SELECT l_orderkey, l_linenumber, l_quantity, CASE l_returnflag WHEN 'N' THEN l_tax END AS airport_fee,
  CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag FROM lineitem""")
def s12(spark, sf):
    base = scratch(spark, "s12")
    parts = {
        "A": [F.col("l_quantity").cast("int"), F.col("l_returnflag").alias("flag")],
        "N": [F.col("l_quantity"), F.col("l_tax").alias("Airport_fee"), F.col("l_returnflag").alias("flag")],
        "R": [F.col("l_quantity").cast("long")],
    }
    for flag, columns in parts.items():
        rows = lines(spark, sf).where(F.col("l_returnflag") == flag)
        rows.select("l_orderkey", "l_linenumber", *columns).write.mode("append").parquet(base)
    read = drift.read_drifting(spark, [base])  # one folder, three schemas
    # names meet without regard to case; which spelling is kept depends on the order of the files
    return read.toDF(*[c.lower() for c in read.columns])


@query("s12_evolving_append", """
SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, CASE WHEN ts >= '2024-01-15' THEN event_type END AS event_type,
  strftime(ts, '%Y-%m-%d') AS ts_day FROM events""")
def s12_append(spark, sf):
    # the second batch adds a column and turns a whole number into a real one
    target = scratch(spark, "s12-append")
    events = domain.table(spark, sf, "events")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    drift.append_evolving(spark, events.where(F.col("ts") < middle).select("event_id", "user_id", "ts"), target, "ts")
    later = events.where(F.col("ts") >= middle)
    drift.append_evolving(
        spark, later.select("event_id", F.col("user_id").cast("double").alias("user_id"), "event_type", "ts"), target, "ts")
    return drift.read_drifting(spark, [target]).select("event_id", "user_id", "event_type", "ts_day")


# Sinks

@query("k1_full_refresh", LINES_SQL)
def k1(spark, sf):
    path = scratch(spark, "k1")
    for _ in range(2):
        tables.write_table(lines(spark, sf), path)
    return spark.read.parquet(path)


@query("k2_shell_then_append", LINES_SQL)
def k2(spark, sf):
    path = scratch(spark, "k2")
    rows = lines(spark, sf)
    tables.create_shell(rows, path)
    for status in ("F", "O"):
        tables.write_table(rows.where(F.col("l_linestatus") == status), path, mode="append")
    return spark.read.parquet(path)


@query("k3_fixed_file_count", "SELECT 4 AS files, count(*) AS row_count FROM lineitem")
def k3(spark, sf):
    path = scratch(spark, "k3")
    tables.write_table(lines(spark, sf), path, files=4)
    named = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(n_rows().alias("n"))
    return named.agg(n_rows().cast("int").alias("files"), F.sum("n").alias("row_count"))


@query("k4_run_day_output", LINES_SQL)
def k4(spark, sf):
    path = tables.write_day(lines(spark, sf), scratch(spark, "k4"), "2024-01-15")
    return spark.read.parquet(path)


@query("k5_day_partitions", f"""
SELECT {dt('ts')} AS ts_day, count(*) AS n FROM events WHERE ts >= '2024-01-03' AND ts < '2024-01-11' GROUP BY 1""")
def k5(spark, sf):
    path = scratch(spark, "k5")
    tables.write_table(domain.table(spark, sf, "events"), path, mode="append", partition_ts="ts")
    rows = tables.on_days(spark.read.parquet(path), "ts", F.lit(True), "2024-01-03", "2024-01-10")
    return rows.groupBy("ts_day").agg(n_rows().alias("n"))


@query("k6_clustered", """
SELECT DISTINCT event_type FROM events WHERE ts BETWEEN '2024-01-03' AND '2024-01-15'""")
def k6(spark, sf):
    path = scratch(spark, "k6")
    tables.write_clustered(domain.table(spark, sf, "events"), path, "ts", ["event_type"])
    written = F.col("ts").between(F.lit("2024-01-03").cast("timestamp_ntz"), F.lit("2024-01-15").cast("timestamp_ntz"))
    rows = tables.on_days(spark.read.parquet(path), "ts", written, "2024-01-03", "2024-01-15")
    return rows.select("event_type").distinct()


@query("k6_bucketed_join", f"""
SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_orderkey) AS orders, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
  min({dt('o_orderdate')}) AS first_order
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def k6_bucketed(spark, sf):
    layer = _name("layer")
    tables.create_layer(spark, layer, scratch(spark, "k6-buckets"))
    items, orders = lines(spark, sf), domain.table(spark, sf, "orders")
    buckets = tables.bucket_count(items, orders, at_least=8)
    tables.write_bucketed(items, f"{layer}.lineitem", "l_orderkey", buckets)
    tables.write_bucketed(orders, f"{layer}.orders", "o_orderkey", buckets)
    met = spark.table(f"{layer}.lineitem").join(spark.table(f"{layer}.orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    # per order first, which needs no exchange either
    per_order = met.groupBy("o_orderkey", "o_orderpriority").agg(
        n_rows().alias("n"), F.sum("l_quantity").alias("quantity"), F.min("o_orderdate").alias("first_order"))
    return per_order.groupBy("o_orderpriority").agg(
        F.sum("n").alias("n"), F.count("o_orderkey").alias("orders"), F.sum("quantity").alias("quantity"),
        F.date_format(F.min("first_order"), "yyyy-MM-dd").alias("first_order"))


@query("k7_truncate_and_load", LINES_SQL + " WHERE l_linestatus = 'O'")
def k7(spark, sf):
    path = scratch(spark, "k7")
    for status in ("F", "O"):
        tables.write_table(lines(spark, sf).where(F.col("l_linestatus") == status), path)
    return spark.read.parquet(path)


def _hash(columns: list[str]) -> str:
    return "md5(" + " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


LONG_HASH = _hash(loads.KINDS["yellow"].hash_columns)
NINE_PLACES = _whole_trip(dbl("CAST({0} AS DECIMAL(38,9))"))
SHORT_HASH = _hash(loads.KINDS["yellow"].place_and_time)
TYPED = "SELECT * REPLACE (CAST(VendorID AS VARCHAR) AS VendorID) FROM yellow"


def _file_rows(spark, sf):
    """Yellow trips in the types of the trip files."""
    typed = {"VendorID": "string", "RatecodeID": "string", "PULocationID": "string", "DOLocationID": "string",
             "passenger_count": "int", "payment_type": "int"}
    rows = domain.yellow_trips(spark, sf)
    return rows.select(*[F.col(c).cast(typed[c]).alias(c) if c in typed else F.col(c) for c in rows.columns])


@query("k8_row_hash_and_file", sql(f"""
SELECT {LONG_HASH} AS unique_row_id, 'yellow_tripdata_1998-01.csv' AS filename, {_whole_trip()} FROM yellow"""))
def k8(spark, sf):
    return loads.enrich(_file_rows(spark, sf), "yellow", loads.month_file("yellow", "1998-01"))


@query("k9_month_table", sql(f"""
SELECT {SHORT_HASH} AS unique_row_id, 'yellow_tripdata_1998-01.csv' AS filename, {NINE_PLACES} FROM yellow"""))
def k9(spark, sf):
    path = scratch(spark, "k9")
    rows = loads.month_table(_file_rows(spark, sf), "yellow", loads.month_file("yellow", "1998-01"))
    tables.write_table(rows, path)
    return spark.read.parquet(path)


def _merged(columns: str, first: str = "'batch-0'", second: str = "'batch-1'") -> str:
    """Both batches without the rows of the second that the first had; ``first`` and ``second`` are their names."""
    return f"""
SELECT id AS unique_row_id, {first} AS filename, {columns} FROM hashed WHERE tpep_pickup_datetime < '{SPLIT}'
UNION ALL
SELECT id, {second}, {columns} FROM hashed WHERE tpep_pickup_datetime >= '{OVERLAP}'
  AND id NOT IN (SELECT id FROM hashed WHERE tpep_pickup_datetime < '{SPLIT}')"""


HASHED = f"SELECT {LONG_HASH} AS id, * FROM yellow"
MONTH_FILES = [f"'{loads.month_file('yellow', ym)}'" for ym in ("1998-01", "1998-07")]


def _batch_bounds():
    """What tells the rows of the two batches, which share half a year."""
    pickup = F.col("tpep_pickup_datetime")
    split, overlap = (F.lit(d).cast("timestamp_ntz") for d in (SPLIT, OVERLAP))
    return pickup < split, pickup >= overlap


def _batches(spark, sf):
    """All yellow trips in two batches that share half a year. Trips are joined once, and stored."""
    path = scratch(spark, "trips")
    _file_rows(spark, sf).write.parquet(path)
    rows = spark.read.parquet(path)
    return tuple(rows.where(bound) for bound in _batch_bounds())


@query("k10_insert_only_merge", sql(_merged(_whole_trip()), hashed=HASHED))
def k10(spark, sf):
    target, staging = scratch(spark, "k10"), scratch(spark, "k10-staging")
    # trips are joined once and go to one batch or both
    rows, (first, second) = _file_rows(spark, sf), _batch_bounds()
    numbers = F.array_compact(F.array(F.when(first, 0), F.when(second, 1)))
    staged = loads.enrich(rows.withColumn("_batch", F.explode(numbers)), "yellow", F.concat(F.lit("batch-"), "_batch"))
    staged.withColumn("year", F.year("tpep_pickup_datetime")).write.partitionBy("_batch").parquet(staging)
    for number in (0, 1, 0, 1):  # the second round inserts nothing
        batch = spark.read.parquet(f"{staging}/_batch={number}").drop("_batch")
        merge.merge_insert_only(batch, target, "unique_row_id", partition="year")
    return spark.read.parquet(target).drop("year")


@query("k11_create_if_missing", "SELECT * FROM supplier")
def k11(spark, sf):
    layer = _name("layer")
    tables.create_layer(spark, layer, scratch(spark, "k11"))
    for _ in range(2):
        declared = ", ".join(f"{c} {kind}" for c, kind in domain.table(spark, sf, "supplier").dtypes)
        tables.create_table(spark, f"{layer}.supplier", declared)
    domain.table(spark, sf, "supplier").write.insertInto(f"{layer}.supplier")
    return spark.table(f"{layer}.supplier")


@query("k12_drop_before_load", "SELECT * FROM supplier")
def k12(spark, sf):
    layer = _name("layer")
    tables.create_layer(spark, layer, scratch(spark, "k12"))
    for _ in range(2):
        tables.drop_table(spark, f"{layer}.supplier")
        tables.write_table(domain.table(spark, sf, "supplier"), f"{layer}.supplier", mode="append")
    return spark.table(f"{layer}.supplier")


@query("k13_promote_column", f"""
SELECT * REPLACE (CAST(o_custkey AS DOUBLE) AS o_custkey, {ts('o_orderdate')} AS o_orderdate) FROM orders""")
def k13(spark, sf):
    before, after = scratch(spark, "k13"), scratch(spark, "k13-promoted")
    domain.table(spark, sf, "orders").write.parquet(before)
    tables.promote_column(spark, before, after, "o_custkey")
    return spark.read.parquet(after)


@query("k13_promote_in_place", f"""
SELECT * REPLACE (CAST(o_custkey AS DOUBLE) AS o_custkey, {ts('o_orderdate')} AS o_orderdate) FROM orders""")
def k13_in_place(spark, sf):
    base = scratch(spark, "k13-table")
    versions.replace_table(domain.table(spark, sf, "orders"), base)
    versions.promote_in_place(spark, base, "o_custkey")
    return versions.read_current(spark, base)


@query("k14_view_or_table", sql(f"""
SELECT 'staging' AS layer, count(*) AS n FROM raw_claim UNION ALL SELECT 'marts', count(*) FROM monthly"""))
def k14(spark, sf):
    staging, mart = _name("staging"), _name("marts")
    tables.create_layer(spark, mart, scratch(spark, "k14"))
    claims = insurance.claims(spark, sf)
    monthly = marts.monthly(insurance.policies(spark, sf), insurance.invoices(spark, sf), claims)
    tables.materialise(claims, f"{staging}.stg_claim", as_table=False)
    tables.materialise(monthly, f"{mart}.mart_dashboard_monthly", as_table=True)
    return profile.stack(
        {
            "staging": spark.table(f"{staging}_stg_claim").agg(n_rows().alias("n")),
            "marts": spark.table(f"{mart}.mart_dashboard_monthly").agg(n_rows().alias("n")),
        },
        "layer",
    )


@query("k15_load_metadata", "SELECT count(*) AS stamped, 'events.parquet' AS filename FROM events")
def k15(spark, sf):
    rows = domain.table(spark, sf, "events").select("event_id", F.col("_metadata.file_name").alias("filename"))
    in_time = F.col("_loaded_at").between(F.lit(datetime.now(UTC) - timedelta(minutes=1)), F.now())
    return tables.with_load_time(rows).groupBy("filename").agg(F.count_if(in_time).alias("stamped"))


@query("k16_file_profile", "SELECT 4 AS files, true AS sized, true AS adds_up, count(*) AS row_count FROM lineitem")
def k16(spark, sf):
    # sizes depend on the writer; what holds for any is compared: so many files, each of a size, adding up to the total
    path = scratch(spark, "k16")
    tables.write_table(lines(spark, sf), path, files=4)
    each = tables.file_sizes(spark, path).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.bool_and(F.col("bytes") > 0).alias("sized"), F.sum("bytes").alias("b"))
    total = tables.file_profile(spark, path)
    rows = spark.read.parquet(path).agg(n_rows().alias("row_count"))
    one = F.lit(1).alias("k")
    return each.select("*", one).join(total.select("bytes_total", one), "k").join(rows.select("*", one), "k").select(
        "files", "sized", (F.col("b") == F.col("bytes_total")).alias("adds_up"), "row_count")


@query("k17_export_csv", sql(f"""
SELECT {dt('k')} AS month_start, {VALUES} FROM monthly"""))
def k17(spark, sf):
    path = scratch(spark, "k17")
    tables.export_csv(marts.monthly(*insurance.inputs(spark, sf)), path)
    schema = """month_start date, premium_received double, policies_issued int, claims_paid double, claim_count int,
      loss_ratio double, avg_premium_per_policy double, avg_claim_amount double"""
    return files.read_csv(spark, path, schema=schema)


@query("k19_load_audit", """
SELECT count(*) FILTER (o_orderstatus = 'P') AS before, count(*) FILTER (o_orderstatus <> 'P') AS incoming,
  count(*) AS after FROM orders""")
def k19(spark, sf):
    path = scratch(spark, "k19")
    orders = domain.table(spark, sf, "orders")
    tables.write_table(orders.where(F.col("o_orderstatus") == "P"), path)
    return tables.audited_append(orders.where(F.col("o_orderstatus") != "P"), path)


# Incremental loads


def _month_sources(spark, sf, label):
    """The two overlapping batches as monthly CSV files. They span years, so targets are laid out by year."""
    base = scratch(spark, label)
    for ym, batch in zip(("1998-01", "1998-07"), _batches(spark, sf)):
        batch.write.option("header", True).csv(f"{base}/{loads.month_file('yellow', ym)}")
    return base


def _loaded(spark, sf, variant):
    source, target = _month_sources(spark, sf, f"g2-{variant}"), scratch(spark, "g2-target")
    for ym in ("1998-01", "1998-07"):
        loads.load_month(spark, "yellow", ym, source, target, scratch(spark, "g2-staging"), grain="Y", variant=variant)
    return spark.read.parquet(target).drop("pickup_period")


@query("g2_month_load", sql(_merged(_whole_trip(), *MONTH_FILES), hashed=HASHED))
def g2(spark, sf):
    return _loaded(spark, sf, "hex")


@query("g2_month_load_typed", sql(_merged(NINE_PLACES, *MONTH_FILES), hashed=f"SELECT {SHORT_HASH} AS id, * FROM yellow"))
def g2_typed(spark, sf):
    return _loaded(spark, sf, "raw")


@query("g3_backfill", sql(f"""
SELECT 'yellow_tripdata_1998-01.csv' AS file, count(*) AS rows_in, count(*) AS rows_inserted FROM hashed
WHERE tpep_pickup_datetime < '{SPLIT}'
UNION ALL
SELECT 'yellow_tripdata_1998-07.csv', count(*),
  count(*) FILTER (id NOT IN (SELECT id FROM hashed WHERE tpep_pickup_datetime < '{SPLIT}'))
FROM hashed WHERE tpep_pickup_datetime >= '{OVERLAP}'""", hashed=HASHED))
def g3(spark, sf):
    source = _month_sources(spark, sf, "g3")
    return loads.backfill(
        spark, "yellow", ["1998-01", "1998-07"], source, scratch(spark, "g3-target"), scratch(spark, "g3-staging"),
        grain="Y",
    )
