"""The skew-safe joins must equal the plain ones for any threshold."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from harborline.operators.joins import known, lookup, on_spine, orphans, with_last_year


@pytest.fixture(scope="module")
def left(spark):
    hot = [(i, "a") for i in range(60)] + [(i, None) for i in range(60, 90)]
    cold = [(90 + i, k) for i, k in enumerate(["b", "c", "c", "d", None])]
    return spark.createDataFrame(hot + cold, "id int, k string")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_equals_plain_join(left, right, rows, how):
    expected = left.join(right, "k", how).select("id", "k", *(["v"] if how in ("left", "inner") else []))
    got = lookup(left, right, "k", how)
    assert rows(got) == rows(expected)


def test_null_keys_can_match(left, right):
    got = lookup(left, right, "k", "left", nulls_match=True)
    assert {r["v"] for r in got.where(F.col("k").isNull()).collect()} == {4}
    assert got.count() == left.count()


def test_known_and_orphans_split_all_rows(left, right, rows):
    keys = right.union(right).select("k")  # repeated keys must not repeat rows
    inside, outside = known(left, keys, "k"), orphans(left, keys, "k")
    assert rows(inside.union(outside)) == rows(left)
    assert inside.where("k IS NULL").count() == 0 and outside.where("k = 'd'").count() == 1


def test_spine_keeps_null_key_without_measures(spark, rows):
    a = spark.createDataFrame([("x", 1), (None, 5)], "k string, a int")
    b = spark.createDataFrame([("y", 2), (None, 6)], "k string, b int")
    assert rows(on_spine(["k"], a, b)) == sorted([("x", 1, None), ("y", None, 2), (None, None, None)], key=str)


def test_year_ago_needs_the_very_month(spark):
    df = spark.createDataFrame(
        [(date(2023, 1, 1), "p", 1), (date(2024, 1, 1), "p", 2), (date(2024, 2, 1), "p", 3), (None, "p", 9),
         (date(2025, 1, 1), None, 7), (date(2024, 1, 1), None, 8)],
        "m date, g string, v int",
    )
    got = {(r["m"], r["g"]): (r["v"], r["m_ly"], r["v_ly"]) for r in with_last_year(df, "m", ["g"], ["v"]).collect()}
    assert got[(date(2024, 1, 1), "p")] == (2, date(2023, 1, 1), 1)
    assert got[(date(2024, 2, 1), "p")] == (3, None, None)
    assert got[(date(2025, 1, 1), None)] == (7, None, None)
    assert got[(None, "p")] == (9, None, None)
    assert len(got) == 6
    dated = with_last_year(df, "m", ["g"], ["v"], always_dated=True)
    assert dated.where("m = DATE '2024-02-01'").first()["m_ly"] == date(2023, 2, 1)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_hot_key_is_split_while_the_query_runs(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = spark.range(40_000, numPartitions=8).selectExpr("IF(id % 3 = 0, id, 7) AS k", "id AS v")
        right = spark.range(0, 40_000, 2, numPartitions=4).selectExpr("id + 1 AS k", "id AS w")
        df = lookup(left, right, "k", how)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isSkew=true" in plan or "skew=true" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
