"""Merges that prune, external and bucketed tables, versions that replace each other at once."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.operators.quality import ChecksFailed
from harborline.plans import build
from harborline.sinks import merge, tables, versions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def days(spark, first, last, keys=""):
    return spark.range(first, last).selectExpr("concat('k', id) AS key", "date_add(date'2024-01-01', cast(id % 10 AS int)) AS day")


def test_merge_reads_only_the_partitions_of_its_batch(spark, tmp_path):
    target = str(tmp_path / "t")
    assert merge.merge_insert_only(days(spark, 0, 100), target, "key", "day") == 100
    batch = days(spark, 0, 200).where("day = date'2024-01-03'")
    held = spark.read.schema(batch.schema).parquet(target).where(merge.touched(batch, "day"))
    assert "2024-01-03" in plan(held).split("PartitionFilters: ")[1].split("]")[0]
    held.collect()
    scan = held._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    there = [f for f in spark.read.parquet(target).inputFiles() if "2024-01-03" in f]
    assert scan.metrics().apply("numFiles").value() == len(there) < len(spark.read.parquet(target).inputFiles())
    assert merge.merge_insert_only(batch, target, "key", "day") == 10
    assert merge.merge_insert_only(batch, target, "key", "day") == 0
    assert spark.read.parquet(target).count() == 110


def test_merge_keeps_the_null_partition_apart(spark, tmp_path):
    target = str(tmp_path / "t")
    undated = days(spark, 0, 5).withColumn("day", F.lit(None).cast("date"))
    assert merge.merge_insert_only(days(spark, 10, 20).unionByName(undated), target, "key", "day") == 15
    more = days(spark, 3, 8).withColumn("day", F.lit(None).cast("date"))
    assert merge.merge_insert_only(more, target, "key", "day") == 3
    assert merge.merge_insert_only(more.limit(0), target, "key", "day") == 0
    dated = days(spark, 10, 12)
    assert "isnull" not in plan(spark.read.parquet(target).where(merge.touched(dated, "day"))).split("PartitionFilters")[1][:60]


def test_merge_with_many_partitions_uses_their_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "NAMED_PARTITIONS", 3)
    target = str(tmp_path / "t")
    assert merge.merge_insert_only(days(spark, 0, 50), target, "key", "day") == 50
    undated = days(spark, 100, 102).withColumn("day", F.lit(None).cast("date"))
    batch = days(spark, 40, 60).where("day <= date'2024-01-06'").unionByName(undated)
    assert merge.merge_insert_only(batch, target, "key", "day") == 8
    assert merge.merge_insert_only(batch, target, "key", "day") == 0


def test_merge_without_partitions(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = days(spark, 0, 20)
    twice = rows.unionByName(rows)
    assert merge.merge_insert_only(twice, target, "key") == 40  # only the target is consulted
    assert merge.merge_insert_only(twice, target, "key") == 0


def test_external_table_sees_its_partitions(spark, tmp_path):
    name, path = f"ext_{uuid.uuid4().hex[:8]}", str(tmp_path / "days")
    rows = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS at")
    tables.write_table(rows.where("id < 500"), path, partition_ts="at")
    assert tables.external_table(spark, name, path).count() == 500
    tables.write_table(rows.where("id >= 500"), path, mode="append", partition_ts="at")
    again = tables.external_table(spark, name, path)
    assert again.count() == 1000
    one = again.where("at_day = date'2024-01-20'")
    assert one.count() == 24 and "at_day" in plan(one).split("PartitionFilters")[1][:80]
    tables.drop_table(spark, name)
    assert spark.read.parquet(path).count() == 1000


def test_bucketed_tables_join_without_exchange(spark):
    left, right = (f"b_{uuid.uuid4().hex[:8]}" for _ in range(2))
    tables.write_bucketed(spark.range(3000).selectExpr("id % 700 AS k", "id"), left, "k", 4)
    tables.write_bucketed(spark.range(700).selectExpr("id AS k", "id * 2 AS v"), right, "k", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = spark.table(left).join(spark.table(right), "k").groupBy("k").agg(F.sum("v").alias("s"))
        assert "Exchange" not in plan(met)
        assert met.agg(F.sum("s")).first()[0] == sum(2 * (i % 700) for i in range(3000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in (left, right):
            tables.drop_table(spark, name)


def broken(df):
    return df.withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("disk full")).cast("bigint")))


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, base)
    versions.replace_table(spark.range(5).selectExpr("id", "id AS v"), base)
    opened = versions.read_current(spark, base)
    with pytest.raises(PySparkException, match="disk full"):
        versions.replace_table(broken(opened), base)
    assert versions.read_current(spark, base).count() == 5 and len(versions.versions(spark, base)) == 1
    versions.replace_table(opened.where("id < 3"), base)  # from the table itself
    assert versions.read_current(spark, base).count() == 3 and opened.count() == 5


def test_promotion_in_place(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.replace_table(spark.range(5).selectExpr("id", "cast(id AS int) AS v"), base)
    versions.promote_in_place(spark, base, "v")
    assert versions.read_current(spark, base).dtypes == [("id", "bigint"), ("v", "double")]
    with pytest.raises(PySparkException):
        versions.promote_in_place(spark, base, "missing")
    assert versions.read_current(spark, base).count() == 5


def test_old_versions_go(spark, tmp_path):
    base = str(tmp_path / "t")
    folders = [versions.replace_table(spark.range(n), base) for n in range(1, 5)]
    assert versions.drop_old(spark, base, keep=2) == [f.rpartition("/")[2] for f in folders[:2]]
    assert versions.read_current(spark, base).count() == 4 and spark.read.parquet(folders[2]).count() == 3
    assert not (tmp_path / "t" / folders[0].rpartition("/")[2]).exists()
    assert versions.drop_old(spark, base, keep=2) == []


def test_a_failed_build_leaves_the_published_one(spark, tmp_path, monkeypatch):
    from harborline import domain

    base, sf = str(tmp_path / "warehouse"), "/root/testdata/sf0.001"
    raw = {n: getattr(domain, n)(spark, sf) for n in ("raw_policy", "raw_invoice", "raw_claim")}
    build.publish(spark, raw, base, check=False)
    before = {n: df.count() for n, df in build.published(spark, base).items()}
    assert set(before) == {n for n, layer in build.LAYERS.items() if layer != "intermediate"}
    fewer = raw | {"raw_policy": raw["raw_policy"].limit(3)}
    with monkeypatch.context() as patch:
        patch.setattr(build.marts, "rollups", lambda days: days.select(F.raise_error(F.lit("disk full")).alias("x")))
        with pytest.raises(PySparkException, match="disk full"):
            build.publish(spark, fewer, base, check=False)
    with pytest.raises(ChecksFailed):
        build.publish(spark, raw | {"raw_policy": raw["raw_policy"].unionByName(raw["raw_policy"])}, base)
    assert {n: df.count() for n, df in build.published(spark, base).items()} == before
    build.publish(spark, fewer, base, check=False)
    assert build.published(spark, base)["stg_policy"].count() == 3
