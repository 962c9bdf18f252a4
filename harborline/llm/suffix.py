"""Suffix-array dedup: byte strings of a given length that start more than once, found by a logarithmic index family."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import stored, text_of, without

#: Bytes that an anchor is chosen by, and how many neighbouring places compete for one.
GRAM, REACH = 8, 128
#: Suffixes that one family holds before it is emptied into the shuffle.
FAMILY = 1_000_000
#: Documents, about, whose cores are counted to find hot ones: cores with over 1 in ``SHARE`` of all suffixes (fewer than
#: ``SHARE`` of them), and ``LEAST`` in the sample.
SAMPLE, SHARE, LEAST = 20_000, 1000, 64
MARK, ASK, REFERENCE = 0, 1, 2
RESULT = ("kept", "n_bytes", "n_removed", "n_spans")


class Family:
    """Sorted runs of suffix keys, each about twice as long as the next.

    A new batch is sorted, merge-scanned against every run for equal keys, and becomes the last run; the last two runs
    are merged for as long as they are of one size class. Equal keys are equal prefixes of the suffixes.
    """

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.hit = np.zeros(0, bool)

    def add(self, keys: np.ndarray) -> None:
        ids = np.arange(len(self.hit), len(self.hit) + len(keys))
        self.hit = np.append(self.hit, np.zeros(len(keys), bool))
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        same = keys[1:] == keys[:-1]
        self.hit[ids[1:][same]] = True
        self.hit[ids[:-1][same]] = True
        for old, old_ids in self.runs:
            self.hit[ids[self._held(keys, old)]] = True
            self.hit[old_ids[self._held(old, keys)]] = True
        self.runs.append((keys, ids))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            (a, a_ids), (b, b_ids) = self.runs.pop(), self.runs.pop()
            both = np.concatenate((b, a))
            order = np.argsort(both, kind="stable")
            self.runs.append((both[order], np.concatenate((b_ids, a_ids))[order]))

    @staticmethod
    def _held(keys: np.ndarray, by: np.ndarray) -> np.ndarray:
        if not len(by):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(by, keys), len(by) - 1)
        return by[at] == keys


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``length`` bytes, with how far before its anchor the first and last such string starts.

    A string's anchor is the leftmost smallest of the hashes of its first ``REACH`` runs of ``GRAM`` bytes. It depends
    on the string alone, so equal strings have their anchors at the same place. Neighbouring strings mostly share one.
    """
    n = len(raw) - length + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3
    reach = min(REACH, length - GRAM + 1)
    places = n + reach - 1
    data = np.frombuffer(raw, np.uint8)
    h = np.ascontiguousarray(np.lib.stride_tricks.as_strided(data, (places, GRAM), (1, 1))).view(np.uint64).ravel()
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h &= np.uint64(0xFFFFFFFF00000000)
    h |= np.arange(places, dtype=np.uint64)
    blocks = -(-places // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[:places] = h
    padded = padded.reshape(blocks, reach)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], n) - 1
    return at[first], at[first] - first, at[first] - last


ENTRY = "core bigint, whole bigint, hit boolean, doc {0}, uid bigint, at bigint, most int, least int"


def _schema(doc_type: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("core", pa.int64()), ("whole", pa.int64()), ("hit", pa.bool_()), ("doc", doc_type), ("uid", pa.int64()),
        ("at", pa.int64()), ("most", pa.int32()), ("least", pa.int32())])


class Task:
    """A family of what one task has met, with whose it is; emptied into entries and finished marks."""

    def __init__(self, doc_type: pa.DataType, length: int):
        self.doc_type, self.length, self.schema = doc_type, length, _schema(doc_type)
        self.clear()

    def clear(self) -> None:
        self.family = Family()
        self.cores, self.wholes, self.places, self.mosts, self.leasts, self.owners = [], [], [], [], [], []
        self.docs, self.uids = [], []

    def add(self, doc, uid, core, whole, at, most, least) -> None:
        self.cores.append(core)
        self.wholes.append(whole)
        self.places.append(at)
        self.mosts.append(most)
        self.leasts.append(least)
        self.owners.append(np.full(len(at), len(self.docs)))
        self.docs.append(doc)
        self.uids.append(uid)

    def scan(self, new: int) -> None:
        """Merge-scans what was added since ``new`` documents were held."""
        if len(self.cores) > new:
            self.family.add(np.concatenate(self.cores[new:]) ^ np.concatenate(self.wholes[new:]) * np.uint64(3))

    def emptied(self) -> Iterator[pa.RecordBatch]:
        if not self.cores:
            return
        core, whole = np.concatenate(self.cores), np.concatenate(self.wholes)
        at, most, least = np.concatenate(self.places), np.concatenate(self.mosts), np.concatenate(self.leasts)
        owner = np.concatenate(self.owners)
        _, first = np.unique(core ^ whole * np.uint64(3), return_index=True)
        hit = self.family.hit
        done = np.flatnonzero(hit)
        start, end = at[done] - most[done], at[done] - least[done] + self.length
        joined = (owner[done][1:] == owner[done][:-1]) & (start[1:] <= end[:-1]) if len(done) else np.zeros(0, bool)
        head = np.flatnonzero(np.concatenate(([True], ~joined))) if len(done) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(done)) - 1 if len(done) else head
        doc_list, uid_list = pa.array(self.docs, self.doc_type), pa.array(self.uids, pa.int64())
        own = pa.array(np.concatenate((owner[first], owner[done][head])))
        marks = len(head)
        yield pa.record_batch([
            pa.concat_arrays([pa.array(core[first].view(np.int64)), pa.nulls(marks, pa.int64())]),
            pa.concat_arrays([pa.array(whole[first].view(np.int64)), pa.nulls(marks, pa.int64())]),
            pa.array(np.append(hit[first], np.ones(marks, bool))),
            doc_list.take(own), uid_list.take(own),
            pa.array(np.append(at[first], start[head])),
            pa.array(np.append(most[first], np.zeros(marks)).astype(np.int32)),
            pa.array(np.append(least[first], start[head] + self.length - end[tail]).astype(np.int32)),
        ], schema=self.schema)
        self.clear()


def _entries(doc_type: pa.DataType, length: int):
    """Reads (doc, uid, text); returns a row per anchor whose surroundings are new to the task, and finished marks.

    ``core`` is the hash of the bytes that all strings of an anchor share behind it, ``whole`` of all their bytes. An
    anchor whose ``whole`` the task has met before is done: its strings are repeated, which one row (core NULL) tells
    for neighbouring anchors of a document.
    """
    shared = length - min(REACH, length - GRAM + 1) + 1
    digest = xxhash.xxh3_64_intdigest

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Task(doc_type, length)
        for batch in batches:
            new = len(task.cores)
            for doc, uid, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                at, most, least = anchors(raw, length)
                if not len(at):
                    continue
                where = list(zip(at.tolist(), most.tolist(), least.tolist(), strict=True))
                cores = np.array([digest(raw[a : a + shared]) for a, _, _ in where], np.uint64)
                wholes = np.array([digest(raw[a - m : a - e + length], m) for a, m, e in where], np.uint64)
                task.add(doc, uid, cores, wholes, at, most, least)
            task.scan(new)
            if len(task.family.hit) >= FAMILY:
                yield from task.emptied()
        yield from task.emptied()

    return entries


NEED = "kind int, core bigint, doc {0}, uid bigint, at bigint, most int, least int"


def _needs(doc_type: pa.DataType, hot: np.ndarray):
    """Reads entries sorted by (core, whole); returns what is decided (MARK) and one row per ``whole`` (ASK, REFERENCE).

    Anchors with equal ``whole`` are repeated with all their strings. One that is alone, among others with its core,
    may share some strings with them (ASK); one of each repeated kind is their reference. A core that has one ``whole``
    only leaves neither. All of a core come to one task but for the ``hot`` ones, whose rows all stay and are counted
    afterwards. Only one ``whole`` is held back, of which each task before has left one entry.
    """
    schema = pa.schema([
        ("kind", pa.int32()), ("core", pa.int64()), ("doc", doc_type), ("uid", pa.int64()), ("at", pa.int64()),
        ("most", pa.int32()), ("least", pa.int32())])

    def flat(table: pa.Table):
        finished = np.asarray(table["core"].is_null())
        return finished, table["core"].fill_null(0).to_numpy(), table["whole"].fill_null(0).to_numpy()

    def decided(table: pa.Table, before: list[int], after: list[int]) -> pa.RecordBatch:
        """``before`` and ``after``: the core of the entry on either side of the table, if there is one."""
        finished, core, whole = flat(table)
        live = np.flatnonzero(~finished)
        core, whole, hit = core[live], whole[live], table["hit"].to_numpy()[live]
        told, extra, kinds = live[:0], live[:0], np.zeros(0, np.int32)
        if len(live):
            new = np.concatenate(([True], (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])))
            run = np.cumsum(new) - 1
            repeated = (np.bincount(run) > 1) | (np.bincount(run, weights=hit) > 0)
            told = live[repeated[run] & ~hit]
            beside = np.concatenate((before or [~core[0]], core[new], after or [~core[-1]]))
            others = (beside[1:-1] == beside[:-2]) | (beside[1:-1] == beside[2:]) | np.isin(core[new], hot)
            extra, kinds = live[new][others], np.where(repeated, REFERENCE, ASK)[others]
        done = np.flatnonzero(finished)
        rows = np.concatenate((told, extra, done))
        kinds = np.concatenate((np.full(len(told), MARK), kinds, np.full(len(done), MARK)))
        picked = table.take(pa.array(rows))
        columns = [pa.array(kinds.astype(np.int32))] + [
            picked[c].combine_chunks() if c != "core" else picked[c].fill_null(0).combine_chunks()
            for c in schema.names[1:]]
        return pa.record_batch([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        before: list[int] = []
        rows = 0
        for batch in batches:
            rest.append(batch)
            rows += batch.num_rows
            if rows < 100_000:
                continue
            table = pa.Table.from_batches(rest)
            finished, core, whole = flat(table)
            last = ~finished & (core == core[-1]) & (whole == whole[-1]) if not finished[-1] else np.zeros(rows, bool)
            n = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if n:
                yield decided(table.slice(0, n), before, [core[-1]] if last.any() else [])
                live = np.flatnonzero(~finished[:n])
                before = [core[live[-1]]] if len(live) else before
                rest = table.slice(n).to_batches()
                rows = table.num_rows - n
        if rows:
            yield decided(pa.Table.from_batches(rest), before, [])

    return needs


def _strings(doc_type: pa.DataType, length: int):
    """Reads (doc, uid, first, bytes); returns the strings as entries, keyed by a 128-bit hash of their ``length`` bytes.

    Every batch's strings enter the task's family; a string that the task has met before leaves it as a finished mark.
    """
    digest = xxhash.xxh3_128_digest

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Task(doc_type, length)
        for batch in batches:
            new = len(task.cores)
            for doc, uid, first, raw in zip(
                    *(batch[c].to_pylist() for c in ("doc", "uid", "first", "bytes")), strict=True):
                n = len(raw) - length + 1
                keys = np.frombuffer(b"".join([digest(raw[i : i + length]) for i in range(n)]), np.uint64).reshape(n, 2)
                none = np.zeros(n, np.int64)
                task.add(doc, uid, keys[:, 0], keys[:, 1], np.arange(first, first + n), none, none)
            task.scan(new)
            if len(task.family.hit) >= FAMILY:
                yield from task.emptied()
        yield from task.emptied()

    return strings


def _without_spans():
    @F.arrow_udf("struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept, sizes, removed, runs = [], [], [], []
        for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            raw = text.encode()
            out, at, n, gone = [], 0, 0, 0
            for start, end in sorted((s["start"], s["end"]) for s in found or ()):
                if start > at or not n:
                    out.append(raw[at:start])
                    n += 1
                    gone += end - start
                else:
                    gone += max(0, end - at)
                at = max(at, end)
            out.append(raw[at:])
            kept.append(b"".join(out))
            sizes.append(len(raw))
            removed.append(gone)
            runs.append(n)
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs))], names=list(RESULT))

    return cut


def _hot_cores(rows: DataFrame, entries) -> list[int]:
    """Cores that many suffixes have, from a sample of about ``SAMPLE`` documents; fewer than ``SHARE`` of them."""
    every = max(1, rows.count() // SAMPLE)
    sample = rows.where(F.pmod("uid", F.lit(every)) == 0)
    counted = stored(entries(sample).where("core IS NOT NULL").groupBy("core").agg(F.count("*").alias("n")), "cores")
    limit = max(LEAST, (counted.agg(F.sum("n")).first()[0] or 0) // SHARE)
    return [r["core"] for r in counted.where(F.col("n") > limit).select("core").collect()]


def _met(entries: DataFrame, arrow: pa.DataType, ddl: str, hot: list[int]) -> DataFrame:
    """Entries of all tasks brought together by core, those of hot cores by (core, whole), finished marks anywhere, and decided."""
    spread = F.when(F.col("core").isNull(), F.xxhash64("uid", "at"))
    if hot:
        spread = spread.when(F.col("core").isin(hot), F.xxhash64("core", "whole"))
    dealt = entries.repartition(spread.otherwise(F.xxhash64("core"))).sortWithinPartitions("core", "whole")
    return dealt.mapInArrow(_needs(arrow, np.array(hot, np.int64)), NEED.format(ddl))


def drop_repeats(docs: DataFrame, text: str = "text", doc: str = "doc_id", length: int = 400) -> DataFrame:
    """``docs`` with ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).

    A text is its UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts anywhere else,
    in another document or at another place of its own, overlaps included; all strings are judged on the input.

    Suffixes are sampled at anchors, which every string of ``length`` bytes has at a place that depends on it alone,
    and ordered by the hash of the bytes behind the anchor instead of the bytes, which puts equal prefixes side by
    side as well. Each task keeps a logarithmic family of such arrays: new batches are merge-scanned against it, and
    what a task has met before leaves it as one finished row per stretch, so a third of all rows in copies is a few
    entries per task. The entries meet by core, and a core that is there once leaves nothing; cores that a sample shows
    to be hot meet by the hash of all their bytes and are counted with partial sums. Where
    the surroundings of a core differ, the bytes around the anchors are fetched, all their strings go through a second
    family per task and meet by the hash of the string. So one core in many surroundings is spread over all tasks.

    NULL text is empty and keeps nothing. Rows equal in ``doc`` and text are removed alike, and repeat each other.
    Other columns stay; input columns with the names of the results are replaced. An empty table gives an empty table.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    docs = without(docs, *RESULT)
    kind = docs.schema[doc].dataType
    ddl, arrow = kind.simpleString(), to_arrow_type(kind)
    raw = docs.withColumn("__text", text_of(docs, text))
    raw = raw.withColumn("__uid", F.xxhash64(F.col(f"`{doc}`"), F.col("__text")))
    rows = raw.select(F.col(f"`{doc}`").alias("doc"), F.col("__uid").alias("uid"), F.col("__text").alias("text"))

    def entries(some: DataFrame) -> DataFrame:
        return some.mapInArrow(_entries(arrow, length), ENTRY.format(ddl))

    rows = rows.where(F.octet_length("text") >= length)
    needs = stored(_met(entries(rows), arrow, ddl, _hot_cores(rows, entries)), "suffixes")
    first, end = (F.col("at") - F.col("most")).alias("start"), (F.col("at") - F.col("least") + length).alias("end")
    whole = needs.where(F.col("kind") == MARK).select("doc", "uid", first, end)
    single = needs.where(F.col("kind") != MARK)
    shared = single.groupBy("core").agg(F.count("*").alias("n"), F.min("kind").alias("least")).where(
        (F.col("n") > 1) & (F.col("least") == ASK)).select("core")
    asked = single.join(shared, "core", "left_semi").groupBy("doc", "uid").agg(
        F.collect_set(F.struct(first, end)).alias("__wanted")).select(
        F.col("doc").alias("__d"), F.col("uid").alias("__u"), "__wanted")
    met = raw.join(asked.hint("shuffle_hash"), raw[f"`{doc}`"].eqNullSafe(asked["__d"]) & (raw["__uid"] == asked["__u"]))
    pieces = met.select(
        F.col("__d").alias("doc"), F.col("__u").alias("uid"), F.col("__text").cast("binary").alias("__raw"),
        F.explode("__wanted").alias("w"),
    ).select(
        "doc", "uid", F.col("w.start").alias("first"),
        F.substring("__raw", F.col("w.start").cast("int") + 1, (F.col("w.end") - F.col("w.start")).cast("int")).alias("bytes"),
    )
    strings = pieces.mapInArrow(_strings(arrow, length), ENTRY.format(ddl))
    partly = _met(strings, arrow, ddl, []).where(F.col("kind") == MARK).select("doc", "uid", first, end)
    spans = whole.unionByName(partly).groupBy("doc", "uid").agg(
        F.collect_set(F.struct("start", "end")).alias("__spans")).select(
        F.col("doc").alias("__d"), F.col("uid").alias("__u"), "__spans")
    cut = raw.join(
        spans.hint("shuffle_hash"), raw[f"`{doc}`"].eqNullSafe(spans["__d"]) & (raw["__uid"] == spans["__u"]), "left"
    ).withColumn("__cut", _without_spans()(F.col("__text"), F.col("__spans")))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"__cut.{c}").alias(c) for c in RESULT])
