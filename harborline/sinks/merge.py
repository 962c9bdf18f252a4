"""Insert-only merge: append the staged rows whose key the target does not have yet.

Equal keys within one batch are all inserted, since only the target is consulted; running the same
batch again inserts nothing. One writer per target at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.joins import orphans

#: So many partition values are named one by one in the filter on the target; a batch with more gives a range.
NAMED_PARTITIONS = 2000


def touched(staged: DataFrame, partition: str) -> Column:
    """A filter on ``partition`` alone that keeps every partition a batch has rows for.

    Its literals are known before the target is planned, so the target's other partitions are not even listed
    for the scan. Up to ``NAMED_PARTITIONS`` values are named, more are covered by their range; the NULL
    partition, which neither can name, is kept when the batch has rows there.
    """
    column = F.col(f"`{partition}`")
    values = [r[0] for r in staged.select(column.alias("p")).distinct().limit(NAMED_PARTITIONS + 1).collect()]
    undated = column.isNull() if None in values else F.lit(False)
    values = [v for v in values if v is not None]
    if not values:
        return undated
    if len(values) < NAMED_PARTITIONS:
        return column.isin(values) | undated
    low, high, nulls = staged.agg(F.min(column), F.max(column), F.bool_or(column.isNull())).first()
    return column.between(F.lit(low), F.lit(high)) | (column.isNull() if nulls else F.lit(False))


def merge_insert_only(staged: DataFrame, target: str, key: str, partition: str | None = None) -> int:
    """Append the staged rows that are new to the Parquet table at ``target`` and return their number.

    With ``partition``, a row can only meet target rows of its own partition (the key must decide the
    partition). Then the merge reads just the partitions that the batch has rows for (see ``touched``), and only the
    batch's rows of partitions that are there are compared. The number is the difference of two counts over those
    partitions, which read file footers only. ``staged`` is read several times, so it should be stored.
    """
    spark = staged.sparkSession
    shell = staged.limit(0).write.mode("ignore")  # the table, if it is missing
    (shell.partitionBy(partition) if partition else shell).parquet(target)
    near = touched(staged, partition) if partition is not None else F.lit(True)

    def held() -> DataFrame:
        return spark.read.schema(staged.schema).parquet(target).where(near)

    before = held().count()
    fresh = staged
    if before and partition is not None:
        there = F.coalesce(touched(held(), partition), F.lit(False))
        fresh = _added(staged.where(~there), staged.where(there), held(), key)
    elif before:
        fresh = _added(None, staged, held(), key)
    if fresh is None:
        return 0
    # few files per partition, and a partition too big for one task is split
    fresh = fresh.hint("rebalance", F.col(partition)) if partition else fresh.hint("rebalance")
    writer = fresh.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(target)
    spark.catalog.refreshByPath(target)
    return held().count() - before


def _added(apart: DataFrame | None, met: DataFrame, held: DataFrame, key: str) -> DataFrame | None:
    """``apart`` and the rows of ``met`` whose key ``held`` lacks; None where ``met`` has none and there is nothing apart.

    Keys are compared alone first: a batch that is loaded again moves nothing else.
    """
    new = orphans(met.select(key), held.select(key), key).count()
    if new == 0:
        return apart if apart is not None and not apart.isEmpty() else None
    met = met if new == met.count() else orphans(met, held.select(key), key)
    return met if apart is None else apart.unionByName(met)
