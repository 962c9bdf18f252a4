import gzip
import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.plans import loads
from harborline.sinks import merge, tables
from harborline.sources import drift, files

HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,store_and_fwd_flag,"
    "PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,"
    "total_amount,congestion_surcharge\n"
)


def trip(vendor, pickup, fare, dropoff="2024-01-01 01:00:00", place="7"):
    return f"{vendor},{pickup},{dropoff},1,2.5,1,N,{place},8,1,{fare},0,0.5,1.0,0,0.3,{fare},0\n"


@pytest.fixture
def months(tmp_path):
    """Two month files: the second repeats one trip of the first, and holds one trip twice."""
    january = [trip(1, "2024-01-05 10:00:00", "10.0"), trip(2, "2024-01-06 10:00:00", "11.5"), trip(1, "", "4.0")]
    february = [january[1], *[trip(2, "2024-02-06 10:00:00", "9.0")] * 2]
    (tmp_path / "yellow_tripdata_2024-01.csv").write_text(HEADER + "".join(january))
    (tmp_path / "yellow_tripdata_2024-02.csv").write_text(HEADER + "".join(february))
    return tmp_path


def test_backfill_is_idempotent(spark, months, tmp_path):
    source, target, staging = str(months), str(tmp_path / "target"), str(tmp_path / "staging")
    first = loads.backfill(spark, "yellow", ["2024-01", "2024-02"], source, target, staging)
    assert [tuple(r) for r in first.orderBy("file").collect()] == [
        ("yellow_tripdata_2024-01.csv", 3, 3), ("yellow_tripdata_2024-02.csv", 3, 2)
    ]  # equal trips within a batch are both inserted
    again = loads.backfill(spark, "yellow", ["2024-01", "2024-02"], source, target, staging)
    assert {r["rows_inserted"] for r in again.collect()} == {0}
    assert spark.read.parquet(target).count() == 5
    files_of = {r["filename"] for r in spark.read.parquet(target).collect()}
    assert files_of == {"yellow_tripdata_2024-01.csv", "yellow_tripdata_2024-02.csv"}


def test_merge_of_heavy_copies(spark, tmp_path):
    batch = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 1)], "id string, v int")
    target = str(tmp_path / "t")
    assert merge.merge_insert_only(batch.where("id = 'b'"), target, "id") == 1
    assert merge.merge_insert_only(batch, target, "id") == 51
    assert merge.merge_insert_only(batch, target, "id") == 0


def test_month_table_types(spark, months):
    rows = files.read_csv(spark, str(months / "yellow_tripdata_2024-01.csv"), schema=loads.YELLOW_SCHEMA)
    typed = dict(loads.month_table(rows, "yellow", "f").dtypes)
    assert typed["unique_row_id"] == "binary" and typed["fare_amount"] == "decimal(38,9)"
    assert typed["VendorID"] == "string" and typed["payment_type"] == "int"


def test_raw_csv_null_tokens(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('"LocationID","Borough","Zone"\n264,"Unknown","N/A"\n265,NA,"a ""b"""\n1,,x\n')
    got = files.read_raw_csv(spark, str(tmp_path), "zones.csv")
    assert {dtype for _, dtype in got.dtypes} == {"string"}
    assert [tuple(r) for r in got.collect()] == [("264", "Unknown", None), ("265", None, 'a "b"'), ("1", None, "x")]
    kept = files.read_raw_csv(spark, str(tmp_path), "zones.csv", null_tokens=[])
    assert kept.first()["Zone"] == "N/A"
    assert files.read_raw_csv(spark, str(tmp_path), "missing.csv") is None


def test_typed_csv_reads_gzip_and_stops_at_bad_rows(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write("a,b\n1,2.5\n")
    assert files.read_csv(spark, str(tmp_path / "a.csv.gz"), schema="a int, b double").first() == (1, 2.5)
    Path(tmp_path / "b.csv").write_text("a,b\nx,2.5\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_csv(spark, str(tmp_path / "b.csv"), schema="a int, b double").collect()


def test_lenient_csv_takes_short_rows_and_line_breaks(spark, tmp_path):
    Path(tmp_path / "c.csv").write_text('a,b,c\n1,"two\nlines",3\n4,five\n')
    got = files.read_csv(spark, str(tmp_path / "c.csv"), lenient=True, multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines", 3), (4, "five", None)]


def test_json_records(spark, tmp_path):
    doc = {"products": [{"brand": "x", "price": 1.5}, {"price": 2.0}], "total": 2}
    (tmp_path / "p.json").write_text(json.dumps(doc, indent=2))
    got = files.read_json_records(spark, str(tmp_path / "p.json"), "products", ["brand", "price", "rating"], multi_line=True)
    assert [tuple(r) for r in got.collect()] == [("x", 1.5, "N/A"), ("N/A", 2.0, "N/A")]


def test_drifting_files(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "id int, airport_fee int").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2, 2.5)], "id long, Airport_fee double").write.parquet(str(tmp_path / "b"))
    spark.createDataFrame([(3, "x")], "id int, extra string").write.parquet(str(tmp_path / "c"))
    df = drift.read_drifting(spark, [str(tmp_path / n) for n in "abc"])
    assert df.dtypes == [("id", "bigint"), ("airport_fee", "double"), ("extra", "string")]
    assert sorted((tuple(r) for r in df.collect()), key=str) == [(1, 2.0, None), (2, 2.5, None), (3, None, "x")]
    spark.createDataFrame([("z",)], "id string").write.parquet(str(tmp_path / "d"))
    with pytest.raises(drift.SchemaConflict):
        drift.read_drifting(spark, [str(tmp_path / n) for n in "ad"])


def test_drift_inside_one_folder(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "id int").write.parquet(folder)
    spark.createDataFrame([(2, "x")], "id long, extra string").write.mode("append").parquet(folder)
    got = drift.read_drifting(spark, [folder])
    assert got.dtypes == [("id", "bigint"), ("extra", "string")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, None), (2, "x")]


def test_evolving_append(spark, tmp_path):
    target = str(tmp_path / "t")
    day = "timestamp_ntz'2024-01-0{} 10:00:00' AS at"
    drift.append_evolving(spark, spark.sql(f"SELECT 1 AS id, 5 AS fee, {day.format(1)}"), target, "at")
    schema = drift.append_evolving(
        spark, spark.sql(f"SELECT 2 AS id, 2.5D AS fee, 'x' AS extra, {day.format(2)}"), target, "at")
    assert {f.name: f.dataType.simpleString() for f in schema}["fee"] == "double"
    drift.append_evolving(spark, spark.sql(f"SELECT 3 AS id, {day.format(2)}"), target, "at")
    got = drift.read_drifting(spark, [target])
    rows = sorted((r.id, r.fee, r.extra, str(r.at_day)) for r in got.collect())
    assert rows == [(1, 5.0, None, "2024-01-01"), (2, 2.5, "x", "2024-01-02"), (3, None, None, "2024-01-02")]
    with pytest.raises(drift.SchemaConflict):
        drift.append_evolving(spark, spark.sql(f"SELECT 'a' AS id, {day.format(3)}"), target, "at")
    drift.append_evolving(spark, spark.sql(f"SELECT 'a' AS id, {day.format(3)}"), target, "at", replace=True)
    assert drift.read_drifting(spark, [target]).count() == 1


def test_month_lists():
    assert loads.month_range("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]
    with pytest.raises(ValueError):
        loads.month_range("2020-02", "2020-01")
    assert files.months_between(2019, 2020)[0] == "2019-01" and len(files.months_between(2019, 2020)) == 24
    with pytest.raises(ValueError):
        files.months_between(2020, 2019)


def test_day_partitions_are_pruned(spark, tmp_path):
    rows = spark.range(48).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS at")
    tables.write_clustered(rows, str(tmp_path / "t"), "at", ["id"])
    picked = tables.on_days(spark.read.parquet(str(tmp_path / "t")), "at", F.lit(True), "2024-01-02", "2024-01-02")
    assert picked.count() == 24
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(at_day" in plan
    assert len(picked.inputFiles()) > 0


def test_promote_needs_a_new_path(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "old"))
    tables.promote_column(spark, str(tmp_path / "old"), str(tmp_path / "new"), "a")
    assert spark.read.parquet(str(tmp_path / "new")).dtypes == [("a", "double")]
    with pytest.raises(PySparkException):
        tables.promote_column(spark, str(tmp_path / "old"), str(tmp_path / "new"), "a")


def test_layers():
    assert tables.layer_name(" staging ") == "staging" and tables.layer_name(None) == "marts"


def test_count_can_come_from_file_footers(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "csv"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        counted = spark.read.parquet(str(tmp_path / "t")).groupBy().count()
        assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
        assert counted.first()[0] == 100
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
