from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.functions import exprs


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value if not isinstance(value, (str, int, float)) else F.lit(value))
    return df.select(column).first()[0]


def test_money_keeps_cents(spark):
    assert one(spark, exprs.money("a"), a="12.345") == Decimal("12.35")


def test_unreadable_money_stops_or_becomes_null(spark):
    with pytest.raises(PySparkException):
        one(spark, exprs.money("a"), a="")
    assert one(spark, exprs.money("a", strict=False), a="") is None


def test_week_starts_on_monday(spark):
    assert one(spark, exprs.period_start("d", "W"), d=F.lit(date(2024, 3, 10))) == date(2024, 3, 4)
    assert one(spark, exprs.period_start("d", "Q"), d=F.lit(date(2024, 3, 10))) == date(2024, 1, 1)


def test_year_before_leap_day(spark):
    assert one(spark, exprs.shift_years("d", -1), d=F.lit(date(2020, 2, 29))) == date(2019, 2, 28)


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 3), (0, 3), (1, 0), (1, None), (None, 2)], "n int, d int")
    plain = [r[0] for r in df.select(exprs.ratio("n", "d", 4)).collect()]
    assert plain == [Decimal("0.3333"), Decimal("0.0000"), None, None, None]
    strict = [r[0] for r in df.select(exprs.ratio("n", "d", 4, need_positive_num=True)).collect()]
    assert strict[1] is None and strict[0] == Decimal("0.3333")


def test_ratio_rounds_exact_ties_up(spark):
    df = spark.createDataFrame([(Decimal("9534571.79"), 2)], "n decimal(38,2), d int")
    assert df.select(exprs.ratio("n", "d", 2)).first()[0] == Decimal("4767285.90")


def test_row_hash_runs_values_together_unless_separated(spark):
    df = spark.createDataFrame([("1", "23", None), ("12", "3", None)], "a string, b string, c string")
    assert df.select(exprs.row_hash(["a", "b", "c"])).distinct().count() == 1
    assert df.select(exprs.row_hash(["a", "b", "c"], sep="|")).distinct().count() == 2
    raw = df.select(exprs.row_hash(["a", "b"], raw=True)).first()[0]
    assert len(raw) == 16


def test_unknown_vendor_has_no_name(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    names = [r[0] for r in df.select(exprs.vendor_name("v")).collect()]
    assert names == ["Creative Mobile Technologies, LLC", "VeriFone Inc.", None, None]


def test_between_stops_at_midnight_and_half_open_does_not(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 3, 1),), (datetime(2024, 3, 15),), (datetime(2024, 3, 15, 9),)], "t timestamp_ntz"
    )
    assert df.where(exprs.between_as_written("t", "2024-03-01", "2024-03-15")).count() == 2
    assert df.where(exprs.within("t", "2024-03-01", "2024-03-16")).count() == 3
    assert df.where(exprs.on_day("t", "2024-03-15")).count() == 2


def test_labels_clip_and_millis(spark):
    assert one(spark, exprs.month_label("d", "_"), d=F.lit(date(2024, 3, 1))) == "2024_03"
    assert len(one(spark, exprs.clip("t"), t="x" * 9000)) == 8000
    assert one(spark, exprs.label("f", "new", "returning"), f=F.lit(None).cast("boolean")) == "returning"
    at = one(spark, exprs.from_millis("m").cast("timestamp_ntz"), m=F.lit(1700000000123))
    assert at == datetime(2023, 11, 14, 22, 13, 20, 123000)
