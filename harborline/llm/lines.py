"""Line dedup: lines that many documents share leave every document."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import BLANK, fingerprint, halves, lists, stored, text_of, without

KEYS = "array<struct<a:bigint,b:bigint,at:array<int>>>"
KEPT = "struct<text:string,n_lines:bigint,n_dropped:bigint>"


def line_key(line: bytes) -> bytes:
    """A line without the blanks around it, A-Z in lower case (``bytes.lower`` leaves other letters alone)."""
    return line.strip(BLANK).lower()


def line_keys(min_chars: int):
    """A column function: the distinct keys of a text, hashed, with the positions of their lines."""

    @F.arrow_udf(KEYS)
    def keys(texts: pa.Array) -> pa.Array:
        offsets, digests, at_offsets, at = [0], [], [0], []
        for text in texts:
            found: dict[bytes, list[int]] = {}
            for i, line in enumerate(text.as_py().encode().split(b"\n")):
                key = line_key(line)
                if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                    found.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
            digests += found
            for places in found.values():
                at += places
                at_offsets.append(len(at))
            offsets.append(len(digests))
        places = pa.ListArray.from_arrays(pa.array(at_offsets, pa.int32()), pa.array(at, pa.int32()))
        return lists(offsets, halves(digests) | {"at": places})

    return keys


def rebuilt():
    """A column function: a text without the lines at the given places, and how many there were and went."""

    @F.arrow_udf(KEPT)
    def without_lines(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        kept, n_lines, n_dropped = [], [], []
        for text, groups in zip(texts, dropped.to_pylist(), strict=True):
            text = text.as_py()
            lines = text.split("\n")
            gone = {i for group in groups or () for i in group}
            kept.append("\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else text)
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=["text", "n_lines", "n_dropped"],
        )

    return without_lines


def dedup_lines(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", min_docs: int = 10, min_chars: int = 1,
) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, and ``n_lines`` (before) and ``n_dropped``.

    A text is split at \\n. A line is known by its key: blanks [\\x20\\x09-\\x0D] stripped at both ends, A-Z in lower
    case. A key of at least ``min_chars`` code points that is found in at least ``min_docs`` documents loses all its
    lines, in every document; the other lines stay in their order.

    Keys leave a document once each, as 128-bit hashes with the positions of their lines; documents are counted per
    hash after (hash, document) pairs were made distinct, so a line that a third of all rows hold is counted in many
    tasks. Only hashes over the limit meet the lines again, and each document gets the positions it loses.

    NULL or empty text is one empty line and becomes the empty text. Rows with the same ``doc`` (NULL included) are
    one document when documents are counted; each row is rebuilt. Other columns stay; input columns called
    ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.
    """
    docs = without(docs, "n_lines", "n_dropped")
    whole = text_of(docs, text)
    lines = stored(
        docs.select(F.col(f"`{doc}`").alias("doc"), fingerprint(whole).alias("fp"), F.inline(line_keys(min_chars)(whole))),
        "lines",
    )
    common = lines.select("a", "b", "doc").distinct().groupBy("a", "b").count().where(F.col("count") >= min_docs)
    losses = (
        lines.join(common, ["a", "b"], "left_semi")
        .groupBy("doc", "fp").agg(F.collect_set("at").alias("gone"))
        .select(F.col("doc").alias("__doc"), F.col("fp").alias("__fp"), F.col("gone").alias("__gone"))
    )
    keyed = docs.withColumn("__text", whole).withColumn("__own", fingerprint(F.col("__text")))
    met = keyed.join(
        losses.hint("shuffle_hash"),
        keyed[f"`{doc}`"].eqNullSafe(losses["__doc"]) & (keyed["__own"] == losses["__fp"]), "left",
    )
    kept = met.withColumn("__kept", rebuilt()(F.col("__text"), F.col("__gone")))
    columns: list[Column] = [
        F.col("__kept.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
    ]
    return kept.select(*columns, F.col("__kept.n_lines").alias("n_lines"), F.col("__kept.n_dropped").alias("n_dropped"))
