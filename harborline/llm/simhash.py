"""SimHash near-dedup: fingerprints of word shingles, linked within a Hamming radius by BK-trees."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import fingerprint, stored, text_of, without
from harborline.llm.components import roots

BITS, SEED = 64, 42
ALL = (1 << BITS) - 1
FRONTIER = 2_000_000


def simhash(text: str, shingle: int = 4) -> int:
    """The fingerprint of a text: a bit is 1 if over half of the shingles' XXH64 have it."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = min(shingle, len(words)) - 1
    starts = np.concatenate(([0], ends[: len(words) - last - 1] + 1)).tolist()
    h, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([h(joined[i:j], seed) for i, j in zip(starts, ends[last:].tolist(), strict=True)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(shingle: int):
    @F.arrow_udf("bigint")
    def fingerprint(texts: pa.Array) -> pa.Array:
        found = [simhash(t.as_py(), shingle) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return fingerprint


def tables(radius: int, spare: int = 2) -> list[int]:
    """Bit masks such that two fingerprints within ``radius`` agree on all bits of at least one mask.

    64 bits are cut into ``radius + spare`` blocks; at most ``radius`` of them can differ, so ``spare`` agree. A mask
    for each choice of ``spare`` blocks keeps shards small at any corpus size without losing a pair.
    """
    cuts = [round(i * BITS / (radius + spare)) for i in range(radius + spare + 1)]
    blocks = [((1 << (j - i)) - 1) << i for i, j in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, spare)]


def bk_forest(fp: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over ``fp``, one for each value of ``tree``: their roots, and all edges as sorted keys with the child.

    An edge's key is parent * 65 + distance. A node's children have different distances to it. All trees grow one
    level at a time: of the nodes at the same distance from the same parent the first becomes the child, and the
    others go on below it.
    """
    n = len(fp)
    first = np.flatnonzero(np.concatenate(([True], tree[1:] != tree[:-1]))) if n else np.zeros(0, np.int64)
    roots_of = np.repeat(first, np.diff(np.append(first, n)))
    at, left = roots_of.copy(), np.setdiff1d(np.arange(n), first)
    keys, children = [], []
    while len(left):
        key = at[left] * 65 + np.bitwise_count(fp[left] ^ fp[at[left]]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        left, key = left[order], key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        child = left[new]
        keys.append(key[new])
        children.append(child)
        at[left] = np.repeat(child, np.diff(np.append(np.flatnonzero(new), len(left))))
        left = left[~new]
    if not keys:
        return first, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return first, key[order], child[order]


def within(fp, key, child, query, root, radius):
    """Pairs (index into ``query``, node) within ``radius``: follows only edges whose distance allows a hit."""
    q, v = np.arange(len(query)), root
    hits_q, hits_v = [], []
    while len(q):
        d = np.bitwise_count(query[q] ^ fp[v]).astype(np.int64)
        near = d <= radius
        hits_q.append(q[near])
        hits_v.append(v[near])
        low = np.searchsorted(key, v * 65 + np.maximum(d - radius, 0))
        high = np.searchsorted(key, v * 65 + np.minimum(d + radius, 64), side="right")
        n = high - low
        q = np.repeat(q, n)
        v = child[np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
    return np.concatenate(hits_q), np.concatenate(hits_v)


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked members one label, the smallest of their group."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label[:] = label[label]


def shard_links(radius: int):
    """Reads rows sorted by shard block; returns for each member of a linked group one link to its smallest member."""
    import pandas as pd

    def linked(frame: pd.DataFrame) -> pa.RecordBatch:
        fp = frame["fp"].to_numpy().view(np.uint64)
        block = frame["block"].to_numpy()
        label = np.arange(len(fp))
        member, asks = frame["member"].to_numpy(), frame["asks"].to_numpy()
        nodes, queries = np.flatnonzero(member), np.flatnonzero(asks)
        if len(nodes) and len(queries):
            tree_fp, tree_id = fp[nodes], block[nodes]
            first, key, child = bk_forest(tree_fp, tree_id)
            place = np.searchsorted(tree_id[first], block[queries])
            place = np.minimum(place, len(first) - 1)
            has = tree_id[first][place] == block[queries]
            queries, place = queries[has], place[has]
            size = np.diff(np.append(first, len(nodes)))[place]
            cut = np.cumsum(size) // FRONTIER
            for at in np.unique(cut):
                part = cut == at
                q, v = within(tree_fp, key, child, fp[queries[part]], first[place[part]], radius)
                _settle(label, queries[part][q], nodes[v])
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pa.record_batch(
            [pa.array(fp[own].view(np.int64)), pa.array(fp[label[own]].view(np.int64))], names=["a", "b"])

    def links(batches):
        rest: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            rest.append(batch)
            rows += batch.num_rows
            if rows < 20_000:
                continue
            frame = pa.Table.from_batches(rest).to_pandas()
            whole = frame["block"] != frame["block"].iloc[-1]
            n = int(whole.sum())
            if n:
                yield linked(frame[:n])
                rest = [pa.RecordBatch.from_pandas(frame[n:], schema=batch.schema, preserve_index=False)]
                rows = rest[0].num_rows
        if rows:
            yield linked(pa.Table.from_batches(rest).to_pandas())

    return links


def near_links(prints: DataFrame, radius: int, piece: int = 4096) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct fingerprints ``fp`` within ``radius`` bits.

    A shard holds the fingerprints that agree on a mask of ``tables``. Each shard's BK-tree is sent to the shard's
    queries. Shards over ``piece`` members are cut into pieces by hash: a tree for each piece meets the queries of
    each piece, every pair of pieces in a group of its own, so no task gets more than a few times ``piece`` rows.
    """
    key = F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64))).alias("k"))
        for i, m in enumerate(tables(radius))
    ]))
    shards = prints.select("fp", key.alias("shard")).select("fp", "shard.t", "shard.k")
    sizes = shards.groupBy("t", "k").count().where("count > 1")
    cut = shards.join(sizes, ["t", "k"]).withColumn("pieces", F.ceil(F.col("count") / piece).cast("int"))
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    dealt = cut.select(
        "fp", F.xxhash64("t", "k", low, high).alias("block"),
        (F.col("mine") == low).alias("member"), (F.col("mine") == high).alias("asks"),
    )
    dealt = dealt.repartition("block").sortWithinPartitions("block", "fp")
    return dealt.mapInArrow(shard_links(radius), "a bigint, b bigint")


def _classes(docs: DataFrame, text: str, doc: str, shingle: int, radius: int, rows: bool) -> tuple[DataFrame, DataFrame]:
    """(rows with their fingerprint ``__fp``; ``__of``, ``component_id`` and, with ``rows``, the ``first`` row of the component).

    With ``rows`` a row is (no id, id, 128-bit text hash), and the first one has the least id.
    """
    whole = text_of(docs, text)
    own = F.struct(F.col(f"`{doc}`").isNull().alias("none"), F.col(f"`{doc}`").alias("doc"), fingerprint(whole).alias("text"))
    prints = stored(docs.select(
        F.col(f"`{doc}`").alias(doc), *([own.alias("__row")] if rows else []), fingerprints(shingle)(whole).alias("__fp")), "simhash")
    firsts = [F.min("__row").alias("first")] if rows else []
    nodes = stored(prints.groupBy(F.col("__fp").alias("fp")).agg(F.min(doc).alias("least"), *firsts), "simhash-nodes")
    root = roots(near_links(nodes.select("fp"), radius), "simhash-links")
    classes = nodes.join(root, nodes["fp"] == root["node"], "left").select(
        "fp", "least", *(["first"] if rows else []), F.coalesce("root", "fp").alias("root"))
    firsts = [F.min("first").alias("first")] if rows else []
    every = classes.groupBy("root").agg(F.min("least").alias("component_id"), *firsts)
    known = classes.drop("least", "first").join(every, "root").select(
        F.col("fp").alias("__of"), "component_id", *(["first"] if rows else []))
    return prints, known


def near_duplicates(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", shingle: int = 4, radius: int = 4,
) -> DataFrame:
    """(``doc``, ``fingerprint``, ``component_id``) for each row of ``docs``.

    Fingerprints are 64-bit SimHashes over the XXH64 (seed 42) of ``shingle``-word shingles of the text with A-Z in
    lower case; a shorter text is one shingle, a text without words (or NULL) has fingerprint zero. Fingerprints
    within ``radius`` bits are linked; ``component_id`` is the smallest ``doc`` reachable. Copies share a fingerprint
    and are one node, so a group of copies of any size costs one row here. A hash collision between shard blocks only
    puts two blocks into one tree, which adds comparisons and no wrong link.

    NULL ``doc`` is ignored by the minimum; a component of nothing else has NULL. Repeated rows are returned as often
    as they occur. Other columns are not looked at. An empty table gives an empty table.
    """
    prints, known = _classes(docs, text, doc, shingle, radius, rows=False)
    return prints.join(known, prints["__fp"] == known["__of"]).select(
        doc, F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc: str = "doc_id", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` without near copies: of each component (see ``near_duplicates``) one row stays, the one of the least ``doc``.

    Rows are told apart by ``doc`` and text: different texts under one id, or without an id, are in components of their
    own unless they are near copies. An id counts before none, ties go to the lesser hash of the text, and of rows equal
    in both one stays. Other columns stay with their row. An empty table gives an empty table.
    """
    _, known = _classes(docs, text, doc, shingle, radius, rows=True)
    stay = known.select("first.doc", "first.text").distinct().select(F.col("doc").alias("__stay"), F.col("text").alias("__print"))
    keyed = docs.withColumn("__own", fingerprint(text_of(docs, text)))
    kept = keyed.join(
        stay, keyed[f"`{doc}`"].eqNullSafe(stay["__stay"]) & (keyed["__own"] == stay["__print"]), "left_semi")
    return kept.dropDuplicates([doc, "__own"]).drop("__own")
