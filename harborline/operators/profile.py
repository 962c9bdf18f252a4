"""Data profiling: counts, ranges, frequencies, nulls, coverage, orphans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from harborline.functions.exprs import EXACT, QUOTIENT


#: Values that one bitmap covers (fixed by Spark), and the rows there must be for each bitmap, so that bitmaps are smaller.
BITMAP_VALUES, ROWS_PER_BITMAP = 32768, 512


def profile_counts(df: DataFrame, **distinct: str) -> DataFrame:
    """total_rows and an exact distinct count per ``alias=column``; NULL is not counted.

    Several dense whole-number columns are counted by bitmaps: each value sets a bit in the bitmap of its range, which
    a task does before anything is shuffled, where several ``count_distinct`` would copy and shuffle each row once per
    column. Whether columns are dense is asked first (least, greatest, number of rows). Others are counted plainly.
    """
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)}
    if len(distinct) > 1 and set(distinct.values()) <= whole and _dense(df, list(distinct.values())):
        return _bitmap_counts(df, distinct)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(F.col(c)).alias(name) for name, c in distinct.items()],
    )


def _dense(df: DataFrame, columns: Sequence[str]) -> bool:
    ends = [end(c).cast("bigint") for c in columns for end in (F.min, F.max)]
    n, *found = df.agg(F.count(F.lit(1)), *ends).first()
    pairs = zip(found[::2], found[1::2], strict=True)
    bitmaps = sum((high - low) // BITMAP_VALUES + 2 for low, high in pairs if low is not None)
    return bitmaps <= max(64, n // ROWS_PER_BITMAP)


def _bitmap_counts(df: DataFrame, distinct: dict[str, str]) -> DataFrame:
    values = [F.struct(F.lit(i).alias("which"), F.col(c).cast("bigint").alias("v")) for i, c in enumerate(distinct.values())]
    marks = df.select(F.explode(F.array(*values)).alias("m")).select("m.which", F.bitmap_bucket_number("m.v").alias("bucket"), "m.v")
    bits = marks.groupBy("which", "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("v", F.lit(1)))).alias("bits"), F.count(F.lit(1)).alias("n"))

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    return bits.agg(
        total(F.col("n"), F.col("which") == 0).alias("total_rows"),
        *[total(F.bitmap_count("bits"), (F.col("which") == i) & F.col("bucket").isNotNull()).alias(name)
          for i, name in enumerate(distinct)],
    )


def amount_stats(df: DataFrame, columns: dict[str, str], places: int = 2) -> DataFrame:
    """Minimum, average and maximum of decimal columns, given as ``column -> short name``."""
    parts: list[Column] = []
    for c, name in columns.items():
        average = (F.sum(c).cast(EXACT) / F.count(c)).cast(QUOTIENT)
        parts += [
            F.round(F.min(c), places).alias(f"min_{name}"),
            F.round(average, places).alias(f"avg_{name}"),
            F.round(F.max(c), places).alias(f"max_{name}"),
        ]
    return df.agg(*parts)


def ranges(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Earliest and latest day of date columns, given as ``column -> short name``."""
    parts: list[Column] = []
    for c, name in columns.items():
        parts += [F.to_date(F.min(c)).alias(f"earliest_{name}"), F.to_date(F.max(c)).alias(f"latest_{name}")]
    return df.agg(*parts)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), column)


def histogram_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key"))
    return per_key.groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("key_count")).orderBy("rows_per_key")


def bucketed_counts(df: DataFrame, key: str) -> DataFrame:
    """Keys with a single row against keys with several."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("n") == 1, "single_policy").otherwise("multi_policy")
    return per_key.groupBy(kind.alias("user_type")).agg(F.count(F.lit(1)).alias("user_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs, from one pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    return counted.select(F.explode(pairs).alias("p")).select("p.*")


def coverage(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """One row: the distinct keys in each frame, one column per frame.

    Distinct (frame, key) pairs are found by one aggregation over the stacked key columns.
    """
    stacked = stack({name: df.select(F.col(key).alias("k")) for name, df in frames.items()}, "source")
    pairs = stacked.where(F.col("k").isNotNull()).distinct()
    return pairs.agg(*[F.count_if(F.col("source") == name).alias(name) for name in frames])


def orphan_report(sources: dict[str, DataFrame], base: DataFrame, key: str) -> DataFrame:
    """Rows per source whose key is missing from ``base``; a NULL key counts.

    Rows are counted per key before the join, so a key with very many rows arrives there as one row.
    """
    keys = base.select(key)
    counts = []
    for name, df in sources.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        missing = per_key.join(keys, key, "left_anti")
        total = F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("orphan_count")
        counts.append(missing.agg(total).select(F.lit(name).alias("source"), "orphan_count"))
    return reduce(lambda a, b: a.unionByName(b), counts)


def stack(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL of frames, each row labelled with the name of its frame."""
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.select(F.lit(name).alias(label), *df.columns) for name, df in frames.items()],
    )


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct union of key frames."""
    return reduce(lambda a, b: a.union(b), frames).distinct()


def shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the row count of the frame."""
    described = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type")
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(described).alias("c"), "rows").select("c.*", "rows")


def ddl(df: DataFrame, name: str) -> str:
    """The CREATE TABLE text that would hold this frame."""
    columns = ",\n".join(f"  {f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return f"CREATE TABLE {name} (\n{columns}\n)"
