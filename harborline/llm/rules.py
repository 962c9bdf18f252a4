"""Quality rules: base rules on the words of a text, and how much of it is boilerplate of its host."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import BLANK, fingerprint, halves, lists, stored, text_of, without
from harborline.llm.lines import line_key, line_keys, rebuilt

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = (*STATS, "base_failed", "n_boilerplate_words", "kept")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """How many words lie in a window of ``size`` (a power of two) words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    width, kinds, counts = 1, len(seen), None
    while width < size:
        pairs = rank[:-width] * kinds + rank[width:]
        _, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        kinds, width = len(counts), 2 * width
        if kinds == len(pairs):
            return 0
    starts = np.flatnonzero(counts[rank] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_stats():
    """A column function: the counts that the base rules need."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in STATS) + ">")
    def stats(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            text = text.as_py()
            raw = text.encode()
            words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip(BLANK)]
            rows.append((
                len(words), len(text) - sum(raw.count(BLANK[i : i + 1]) for i in range(len(BLANK))),
                sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))),
                len(lines) - len(set(lines)), repeated_words(words),
            ))
        columns = zip(*rows, strict=True) if rows else [[]] * len(STATS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(STATS))

    return stats


def line_words():
    """A column function: the distinct keys of a text's lines, hashed, with their words and those of the whole text."""

    @F.arrow_udf("array<struct<a:bigint,b:bigint,words:bigint,n_all:bigint>>")
    def lines(texts: pa.Array) -> pa.Array:
        offsets, digests, words = [0], [], []
        for text in texts:
            found: dict[bytes, int] = {}
            for line in text.as_py().encode().split(b"\n"):
                key = line_key(line)
                if key:
                    h = xxhash.xxh3_128_digest(key)
                    found[h] = found.get(h, 0) + len(key.split())
            digests += found
            words += found.values()
            offsets.append(len(digests))
        counts = np.array(words, np.int64)
        upto = np.concatenate(([0], np.cumsum(counts)))[offsets]
        every = np.repeat(np.diff(upto), np.diff(offsets))
        return lists(offsets, halves(digests) | {"words": pa.array(counts), "n_all": pa.array(every)})

    return lines


def _host_lines(docs: DataFrame, text: str, doc: str, host: str) -> DataFrame:
    whole = text_of(docs, text)
    return stored(
        docs.select(
            F.col(f"`{doc}`").alias("doc"), fingerprint(whole).alias("fp"),
            F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("host"), F.inline(line_words()(whole)),
        ),
        "host-lines",
    )


def _over(lines: DataFrame, min_docs: int, min_share: float | None) -> DataFrame:
    spread = lines.select("host", "a", "b", "fp").distinct().groupBy("host", "a", "b").agg(F.count("*").alias("n"))
    over = spread.where(F.col("n") >= min_docs)
    if min_share is not None:
        hosts = lines.select("host", "fp").distinct().groupBy("host").agg(F.count("*").alias("texts"))
        over = over.join(hosts, "host").where(F.col("n") > F.lit(min_share) * F.col("texts"))
    return over.select("host", "a", "b")


def over_limit(docs: DataFrame, text: str, doc: str, host: str, min_docs: int, min_share: float | None) -> DataFrame:
    """(``host``, ``a``, ``b``): the lines, by their hash, that are boilerplate of a host."""
    return _over(_host_lines(docs, text, doc, host), min_docs, min_share)


def boilerplate(docs: DataFrame, text: str, doc: str, host: str, min_docs: int, min_share: float | None) -> DataFrame:
    """(``__doc``, ``__fp``, ``__host``, ``n_boilerplate_words``, ``__all``) of the documents that hold a line over the limits of their host."""
    lines = _host_lines(docs, text, doc, host)
    return (
        lines.join(_over(lines, min_docs, min_share), ["host", "a", "b"], "left_semi")
        .dropDuplicates(["doc", "fp", "host", "a", "b"])
        .groupBy(F.col("doc").alias("__doc"), F.col("fp").alias("__fp"), F.col("host").alias("__host"))
        .agg(F.sum("words").alias("n_boilerplate_words"), F.max("n_all").alias("__all"))
    )


def _depleted(n: Column, gone: Column, min_left: float) -> Column:
    return 100 * (n - gone) < round(100 * min_left) * n


def _base_failed(n: Column, repeat: Column, min_words: int, max_repeat_share: float) -> Column:
    return (n < min_words) | (100 * repeat > round(100 * max_repeat_share) * n)


def judge(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", host: str = "source", min_words: int = 20,
    max_repeat_share: float = 0.3, min_docs: int = 10, min_share: float | None = None, min_left: float = 0.2,
) -> DataFrame:
    """``docs`` with the counts of ``STATS``, ``base_failed``, ``n_boilerplate_words`` and ``kept``.

    Base rules: a text fails with fewer than ``min_words`` words [^\\x20\\x09-\\x0D]+ or when more than
    ``max_repeat_share`` of its words lie in 8-word windows that it holds twice or more. Otherwise lines (blanks
    around them stripped, A-Z in lower case) that at least ``min_docs`` different texts of the same host hold are
    boilerplate of the host, however large it is; with ``min_share``, only those that more than this share of its
    texts hold, a limit that grows with the host. A document is depleted, and not kept, when less than ``min_left`` of
    its words remain without them. Copies of one text count once, so a copied document
    does not make its own lines boilerplate.

    NULL text is the empty text (no words, fails); a NULL host is the host ''. A text without a line that has a word
    counts nowhere. Repeated rows are judged alike, each row once. Other columns stay; input columns with the names
    of the results are replaced. An empty table gives an empty table.
    """
    docs = without(docs, *VERDICT)
    lost = boilerplate(docs, text, doc, host, min_docs, min_share)
    whole = text_of(docs, text)
    rated = docs.withColumns({
        "__stats": base_stats()(whole), "__own": fingerprint(whole),
        "__at": F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")),
    })
    met = rated.join(
        lost, rated[f"`{doc}`"].eqNullSafe(lost["__doc"]) & (rated["__own"] == lost["__fp"]) & (rated["__at"] == lost["__host"]),
        "left",
    )
    n, repeat = F.col("__stats.n_words"), F.col("__stats.n_repeat_words")
    failed = _base_failed(n, repeat, min_words, max_repeat_share)
    gone = F.coalesce(F.col("n_boilerplate_words"), F.lit(0).cast("bigint"))
    depleted = _depleted(n, gone, min_left)
    return met.select(
        *[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"__stats.{c}").alias(c) for c in STATS],
        failed.alias("base_failed"), gone.alias("n_boilerplate_words"), (~failed & ~depleted).alias("kept"),
    )


def keep_good(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", host: str = "source", min_words: int = 20,
    max_repeat_share: float = 0.3, min_docs: int = 10, min_share: float | None = None, min_left: float = 0.2,
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    Texts are not shuffled for it: base rules look at one row, and the depleted documents are written first, so
    that Spark knows their size when it chooses the join.
    """
    lost = boilerplate(docs, text, doc, host, min_docs, min_share)
    bad = stored(lost.where(_depleted(F.col("__all"), F.col("n_boilerplate_words"), min_left)), "depleted")
    whole = text_of(docs, text)
    rated = docs.withColumns({
        "__stats": base_stats()(whole), "__own": fingerprint(whole),
        "__at": F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")),
    })
    good = rated.where(~_base_failed(F.col("__stats.n_words"), F.col("__stats.n_repeat_words"), min_words, max_repeat_share))
    kept = good.join(
        bad, good[f"`{doc}`"].eqNullSafe(bad["__doc"]) & (good["__own"] == bad["__fp"]) & (good["__at"] == bad["__host"]),
        "left_anti",
    )
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_boilerplate(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", host: str = "source", min_docs: int = 10,
    min_share: float | None = None,
) -> DataFrame:
    """``docs`` with ``text`` rebuilt without the lines over the limit of their host (see ``judge``); other lines keep their order.

    A text that is boilerplate throughout becomes the empty text. Nothing is rejected here: ``keep_good`` before or after
    does that. NULL text becomes the empty text, a NULL host is the host ''. Rows with equal ``doc``, text and host are
    treated alike, each row once. Other columns stay. An empty table gives an empty table.
    """
    whole = text_of(docs, text)
    at = F.coalesce(F.col(f"`{host}`").cast("string"), F.lit(""))
    places = docs.select(
        F.col(f"`{doc}`").alias("__doc"), fingerprint(whole).alias("__fp"), at.alias("__host"), F.inline(line_keys(1)(whole)))
    over = over_limit(docs, text, doc, host, min_docs, min_share)
    gone = (
        places.join(over.withColumnRenamed("host", "__host"), ["__host", "a", "b"], "left_semi")
        .groupBy("__doc", "__fp", "__host").agg(F.collect_set("at").alias("__gone"))
    )
    keyed = docs.withColumns({"__text": whole, "__own": fingerprint(whole), "__at": at})
    met = keyed.join(
        gone, keyed[f"`{doc}`"].eqNullSafe(gone["__doc"]) & (keyed["__own"] == gone["__fp"]) & (keyed["__at"] == gone["__host"]),
        "left",
    ).withColumn("__kept", rebuilt()(F.col("__text"), F.col("__gone")))
    return met.select(*[F.col("__kept.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
