"""Joins to a unique key, and joins of measures by period.

All are plain joins: a key that holds a large share of the rows is split by adaptive skew handling, which
``harborline.session`` switches on. It works for every kind of join used here, since the side that is split
is the left one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.session import scratch

#: So many missing keys are sent to every task by ``known_mostly``.
FEW_MISSING = 100_000


def _same(on: Sequence[str], nulls_match: bool) -> Column:
    def one(c: str) -> Column:
        a, b = F.col(f"l.{c}"), F.col(f"r.{c}")
        return a.eqNullSafe(b) if nulls_match else a == b

    return reduce(lambda x, y: x & y, [one(c) for c in on])


def lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "left", nulls_match: bool = False
) -> DataFrame:
    """``left`` with the further columns of ``right`` (none for semi and anti joins); ``nulls_match`` joins NULL to NULL."""
    on = [on] if isinstance(on, str) else list(on)
    semi = how in ("left_semi", "left_anti")
    right = right.select(*on) if semi else right
    joined = left.alias("l").join(right.alias("r"), _same(on, nulls_match), how)
    if semi:
        return joined
    extra = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def known(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """The rows whose key exists in ``keys``; repeated keys there do not repeat rows."""
    return lookup(df, keys, on, "left_semi")


def known_mostly(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``known`` for rows whose keys mostly exist, run at once as far as the keys go.

    The distinct keys of ``df`` that are missing from ``keys`` are written aside first. Without any, the rows stay
    where they are; up to ``FEW_MISSING`` are sent to the rows; only beyond that do the rows move. ``df`` is read
    twice, the first time for its key alone.
    """
    aside = scratch(df.sparkSession, "missing")
    orphans(df.select(on).where(F.col(on).isNotNull()).distinct(), keys, on).write.parquet(aside)
    missing = df.sparkSession.read.parquet(aside)
    n = missing.count()
    if n > FEW_MISSING:
        return known(df, keys, on)
    there = df.where(F.col(on).isNotNull())
    return orphans(there, F.broadcast(missing), on) if n else there


def orphans(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """The rows whose key is missing from ``keys``; a NULL key is an orphan."""
    return lookup(df, keys, on, "left_anti")


def on_spine(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """One row per key found in any frame, with all their measures side by side.

    Each frame has one row per key. The result equals a distinct union of the keys left-joined to every
    frame by plain equality, so a key with a NULL part keeps its row but no measures. It is computed as
    one union and one aggregation instead of a union, a distinct and a join per frame.
    """
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    masked = [
        f.select(*keys, *[F.when(complete, F.col(c)).alias(c) for c in f.columns if c not in keys]) for f in frames
    ]
    measures = [c for f in frames for c in f.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), masked)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def with_last_year(
    df: DataFrame,
    period: str,
    by: Sequence[str],
    measures: Sequence[str],
    only: Column | None = None,
    always_dated: bool = False,
) -> DataFrame:
    """Add ``*_ly`` columns holding the measures of the same period one year before.

    ``df`` has one row per (period, by). ``only`` restricts which rows serve as a year-ago value.
    ``<period>_ly`` is the matched period, or always the period less a year when ``always_dated``.

    Each row is sent to its own period and to the one a year later, and the two meet in one
    aggregation: no self-join, so whatever ``df`` costs is paid once. Rows with a NULL in the key keep
    to themselves, as they would under an equality join.
    """
    keys = [period, *by]
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    lends = complete if only is None else complete & only
    values = F.struct(F.col(period), *[F.col(m) for m in measures])
    here = F.struct(F.col(period).alias("at"), values.alias("cur"), F.when(F.lit(False), values).alias("ly"))
    later = F.struct(
        F.add_months(F.col(period), 12).alias("at"), F.when(F.lit(False), values).alias("cur"), values.alias("ly")
    )
    sent = df.select(*by, F.explode(F.when(lends, F.array(here, later)).otherwise(F.array(here))).alias("s"))
    met = (
        sent.groupBy(F.col("s.at").alias(period), *by)
        .agg(F.max("s.cur").alias("cur"), F.max("s.ly").alias("ly"))
        .where(F.col("cur").isNotNull())
    )
    dated = F.add_months(F.col(period), -12) if always_dated else F.col(f"ly.{period}")
    return met.select(
        *keys,
        *[F.col(f"cur.{m}").alias(m) for m in measures],
        dated.alias(f"{period}_ly"),
        *[F.col(f"ly.{m}").alias(f"{m}_ly") for m in measures],
    )
