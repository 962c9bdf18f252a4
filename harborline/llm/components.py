"""Connected components of a graph that no task and no driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import stored


def _toward_smaller(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step on edges (a > b): neighbours of a node are linked to the smallest of them and the node."""
    seen = edges
    if both_ways:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = seen.join(least, "a")
    if both_ways:
        moved = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def roots(edges: DataFrame, label: str = "links") -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``: bigint) but the roots: the component's least node.

    Alternates large-star and small-star steps until the edges are stars. Each step is two aggregations and a join on
    nodes; minima are combined before they are shuffled, and a hub's edges are split by adaptive skew handling.
    Every round is written to the shared folder.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(current)
    while before[0]:
        large = _toward_smaller(current, both_ways=True)
        current = stored(_toward_smaller(large, both_ways=False), label)
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
