"""Exact distinct counts in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from harborline.operators import profile


def rows(spark, values):
    return spark.createDataFrame(values, "a bigint, b int, c string").repartition(3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("low,high,bitmaps", [(-40_000, 90_000, True), (0, 10, True), (-(2**62), 2**62, False)])
def test_counts_of_whole_numbers(spark, low, high, bitmaps):
    rng = random.Random(high)
    values = [(rng.choice([None, rng.randint(low, high)]), rng.randint(-5, 70_000), "x") for _ in range(3000)]
    values += [(low, 0, None), (high, None, "y"), (None, None, None)]
    df = rows(spark, values)
    got = profile.profile_counts(df, one="a", two="b")
    assert ("bitmap" in plan(got)) == bitmaps and ("Expand" in plan(got)) != bitmaps
    want = (len(values), len({a for a, _, _ in values} - {None}), len({b for _, b, _ in values} - {None}))
    assert tuple(got.first()) == want and got.columns == ["total_rows", "one", "two"]


def test_counts_of_other_types_and_of_nothing(spark):
    df = rows(spark, [(1, 2, "x"), (1, 3, "y"), (None, None, None)])
    assert tuple(profile.profile_counts(df, a="a", c="c").first()) == (3, 1, 2)
    assert tuple(profile.profile_counts(df, a="a").first()) == (3, 1)
    assert tuple(profile.profile_counts(df.where("false"), a="a", b="b").first()) == (0, 0, 0)
    nulls = df.where(F.col("a").isNull())
    assert tuple(profile.profile_counts(nulls, a="a", b="b").first()) == (1, 0, 0)
