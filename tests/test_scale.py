"""What moves between tasks: rows as narrow as they come, and no more of them than the job needs."""

import pytest
from pyspark.sql import functions as F

from harborline.catalog import insurance
from harborline.operators import joins, quality
from harborline.plans import staging
from harborline.sinks import merge, tables


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def settings(spark):
    """Sets settings of the session and puts the old ones back."""
    before = {}

    def put(**values):
        for name, value in ((n.replace("__", "."), v) for n, v in values.items()):
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize(("parts", "moved"), [(9, False), (1, True)])
def test_a_fixed_number_of_files_reads_files_not_rows(spark, tmp_path, settings, parts, moved):
    settings(spark__sql__files__maxPartitionBytes="4m")
    rows = spark.range(0, 900, 1, parts).withColumn("t", F.concat(F.lit("t"), "id"))
    assert ("Repartition 4, true" in optimized(tables._in_files(rows, 4))) == moved
    path = str(tmp_path / "t")
    tables.write_table(rows, path, files=4)
    assert len(spark.read.parquet(path).inputFiles()) == 4
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 900


def test_orphan_invoices_go_before_invoices_are_typed(spark, tmp_path, rows):
    line = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,
      l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""
    at = F.lit("1998-01-02").cast("timestamp_ntz").alias("l_shipdate")
    lines = spark.createDataFrame(
        [(k, 1, 1, n, 1.0, 10.5, 0.1, 0.02, "A", "O") for k in (1, 2, 3, None) for n in (1, 1)], line.rsplit(",", 1)[0])
    lines.select("*", at).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(1, "F"), (2, "P"), (3, "O"), (3, "O")], "o_orderkey long, o_orderstatus string")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = insurance.confirmed_invoices(spark, str(tmp_path))
    plain = staging.stg_invoice(insurance.domain.raw_invoice(spark, str(tmp_path)),
                                insurance.domain.confirmed_policy(spark, str(tmp_path)))
    assert rows(found) == rows(plain) and found.count() == 4
    plan = optimized(found)
    assert plan.index("Join LeftSemi") > plan.rindex("decimal(38,9)")


@pytest.mark.parametrize("few", [100, 1, 0])
def test_keys_are_looked_up_before_rows_move(spark, rows, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW_MISSING", few)
    keys = spark.createDataFrame([(k,) for k in (1, 2, 2, None)], "k long")
    all_there = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    assert rows(joins.known_mostly(all_there, keys, "k")) == rows(all_there)
    assert "Join" not in optimized(joins.known_mostly(all_there, keys, "k"))
    some = all_there.unionByName(spark.createDataFrame([(3, "c"), (4, "d"), (None, "e")], "k long, v string"))
    assert rows(joins.known_mostly(some, keys, "k")) == rows(joins.known(some, keys, "k")) == rows(all_there)


def test_a_part_of_a_model_is_checked_with_it(spark, rows):
    invoices = spark.createDataFrame(
        [("a", 1, "paid"), ("a", 1, "open"), ("b", 2, "paid"), ("b", None, "paid"), (None, 3, "paid"), (None, 3, "open"),
         (None, None, None), ("c", 4, "open"), ("d", 5, None)], "id string, policy_number long, status string")
    models = {"stg_invoice": invoices, "int_invoice_paid": staging.paid(invoices)}
    shared = quality.run_declared(models, quality.PART_OF)
    assert rows(shared) == rows(quality.run_declared(models))
    assert optimized(shared).count("Aggregate [id") < optimized(quality.run_declared(models)).count("Aggregate [id")
    assert rows(quality.run_declared({"int_invoice_paid": models["int_invoice_paid"]}, quality.PART_OF)) == rows(
        quality.run_declared({"int_invoice_paid": models["int_invoice_paid"]}))


def days(spark, first, last, day):
    return spark.range(first, last).selectExpr("concat('k', id) AS key", f"cast({day} AS date) AS day", "id AS v")


def test_a_merge_compares_keys_of_partitions_that_are_there(spark, rows, tmp_path, monkeypatch):
    target, compared = str(tmp_path / "t"), []

    def orphans(df, keys, on):
        compared.append((df.columns, df.count()))
        return joins.orphans(df, keys, on)

    monkeypatch.setattr(merge, "orphans", orphans)
    old, undated = days(spark, 0, 10, "'2024-01-01'"), days(spark, 20, 23, "NULL")
    assert merge.merge_insert_only(old.unionByName(undated), target, "key", "day") == 13 and not compared
    # ten rows of the old day, all there; the other day is appended as it is, with a key that is there twice
    later = days(spark, 50, 54, "'2024-01-02'").unionByName(days(spark, 50, 51, "'2024-01-02'"))
    assert merge.merge_insert_only(old.unionByName(later), target, "key", "day") == 5
    assert compared == [(["key"], 10)]
    compared.clear()
    assert merge.merge_insert_only(old.unionByName(later).unionByName(undated), target, "key", "day") == 0
    assert compared == [(["key"], 18)]
    mixed = days(spark, 5, 15, "'2024-01-01'").unionByName(days(spark, 22, 25, "NULL"))
    assert merge.merge_insert_only(mixed, target, "key", "day") == 7
    nothing_old = days(spark, 90, 92, "'2024-01-01'").unionByName(spark.createDataFrame([(None,)], "key string").selectExpr(
        "key", "date'2024-01-01' AS day", "7L AS v"))
    assert merge.merge_insert_only(nothing_old, target, "key", "day") == 3  # a NULL key is never there
    stored = spark.read.parquet(target)
    assert stored.count() == 28 and stored.where("day IS NULL").count() == 5


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    assert tables.bucket_count(spark.range(1000), spark.range(10), at_least=8) == 8
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    assert tables.bucket_count(spark.range(10), spark.range(80), at_least=8) == 8
    assert tables.bucket_count(spark.range(10), spark.range(1000), at_least=8) == 128
