"""Cross-tokenizer alignment: where the tokens of two tokenizers begin and end together, and which overlap."""

from __future__ import annotations

import contextlib
import hashlib
import re
from array import array
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import stored, text_of

#: Characters of text in a shard, and words that are aligned at once.
SHARD, BATCH = 8_000_000, 2_000

#: A shard leaves its task as rows of these kinds, and comes back for its counts in this order: its id pairs, runs of its
#: words, its documents. No row holds a whole shard, which readers, writers and Arrow would hold many at a time of.
PAIR, WORDS, DOCUMENT, KINDS = 0, 1, 2, 3

#: Words in a row, most rows in a batch, and numbers in lists of a batch.
RUN, ROWS, AT_ONCE = 500, 1_000, 100_000

#: A word with the white space before it. Texts are cut before a space that follows a character other than white space.
CUT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:\s+\Z)?")

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_level(tokenizer) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary (fixed alphabet: printable Latin-1, the other bytes from U+0100)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    value = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    table = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        table[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
    return table


def piece_bytes(model) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, <0xHH> the byte HH."""
    pieces = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]


class Words(NamedTuple):
    """What the two tokenizers make of some words: a row per word in ``sizes``, all links in a row, groups as text."""

    sizes: np.ndarray  # columns: tokens of the first, of the second, groups, links
    links: np.ndarray  # first id << 32 | second id
    groups: list[str | None]  # None where either tokenizer's bytes are not those of the word


class Aligner:
    """Two tokenizers and the bytes of their vocabularies.

    Neither joins characters across the cuts of ``CUT``: the first one's pre-tokenizer starts a new part at white space,
    and no piece of the second has a space behind another character (checked; without that, texts stay whole). So a
    text's tokens are its words' tokens in a row, and both end at every cut.
    """

    def __init__(self, first: str, second: str):
        import sentencepiece
        import tokenizers

        self.a, self.b = tokenizers.Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
        self.a.encode_special_tokens = True  # strings of special tokens are ordinary text
        self.bytes_a, self.bytes_b = byte_level(self.a), piece_bytes(self.b)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        names = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.told = [np.array([f"{i}{mark}" for i in range(most)], object) for mark in ",|;"]

    def align(self, words: list[str]) -> Words:
        """Tokens, groups and links of words that begin with a space each.

        Words are encoded many in a row, which the cuts allow; where that does not come out even, half as many.
        """
        alone = [k for k, w in enumerate(words) if w[-1].isspace() or not self.cuts]  # the next word's space would join in
        rest = np.delete(np.arange(len(words)), alone)
        out, order = [], []
        stack = ([np.array([k]) for k in alone] + [rest[i : i + BATCH] for i in range(0, len(rest), BATCH)])[::-1]
        while stack:
            some = stack.pop()
            got = self._some([words[k] for k in some.tolist()])
            if got is None and len(some) > 1:
                stack += [some[len(some) // 2 :], some[: len(some) // 2]]
                continue
            out.append(got or Words(np.zeros((len(some), 4), np.int32), np.zeros(0, np.int64), [None] * len(some)))
            order.append(some)
        if not out:
            return Words(np.zeros((0, 4), np.int32), np.zeros(0, np.int64), [])
        return _ordered(out, np.concatenate(order))

    def _some(self, words: list[str]) -> Words | None:
        """Some words in a row; None where token bytes are not those of the words, or a token crosses a word's end."""
        text = "".join(words)
        raw = text.encode()
        first, pieces = self.a.encode(text, add_special_tokens=False), self.b.encode(text[1:], return_type="proto").pieces
        ids_a, ids_b = np.array(first.ids, np.int64), np.array([p.id for p in pieces], np.int64)
        for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            if b"".join([table[i] for i in ids.tolist()]) != raw:
                return None
        # inside a run of tokens decoded bytes say where each one ends; runs end where the spans say
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        offsets = np.fromiter(chain.from_iterable(first.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)
        closes = np.append(offsets[1:, 0] >= offsets[:-1, 1], True)  # no later token has a part of its characters
        char_end = np.arange(len(text) + 1)
        if len(raw) > len(text):
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            char_end[1:] = np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        spans = np.array([p.end for p in pieces], np.int64) + 1  # the space before the text
        owns = spans > np.append(1, spans[:-1])  # an added space and bytes of a character have empty spans
        word_ends = np.cumsum([len(w) if len(raw) == len(text) else len(w.encode()) for w in words])
        if (ends_a[closes] != char_end[offsets[closes, 1]]).any() or (ends_b[owns] != spans[owns]).any():
            return None
        marks = np.zeros((2, len(raw) + 1), bool)
        marks[0, ends_a] = marks[1, ends_b] = True
        shared = marks[0] & marks[1]
        if not shared[word_ends].all():
            return None

        both, cuts = np.flatnonzero(shared), np.flatnonzero(marks[0] | marks[1])  # every end of either one closes one link
        i, j = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        sizes = np.diff([np.searchsorted(x, word_ends, "right") for x in (ends_a, ends_b, both, cuts)], axis=1, prepend=0).T
        sizes = sizes.astype(np.int32)
        return Words(sizes, ids_a[i] << 32 | ids_b[j], self._told(shared, both, (ids_a, ends_a), (ids_b, ends_b), sizes))

    def _told(self, shared, both, first, second, sizes) -> list[str]:
        """Groups as text: each id with the mark behind it, in order of group, tokenizer and place."""
        parts, order = [], []
        for side, (ids, ends) in enumerate((first, second)):
            text, last = self.told[0][ids], shared[ends]
            text[last] = self.told[1 + side][ids[last]]
            parts.append(text)
            order.append(2 * np.searchsorted(both, ends) + side)
        text = np.concatenate(parts)[np.argsort(np.concatenate(order), kind="stable")].tolist()
        at = np.concatenate(([0], np.cumsum(sizes[:, 0] + sizes[:, 1]))).tolist()
        return ["".join(text[i:j])[:-1] for i, j in zip(at, at[1:])]


def _ordered(parts: list[Words], order: np.ndarray) -> Words:
    """Parts put together again; the k-th word of all parts was word ``order[k]``."""
    sizes, links = np.concatenate([p.sizes for p in parts]), np.concatenate([p.links for p in parts])
    groups = [g for p in parts for g in p.groups]
    if (order[1:] > order[:-1]).all():
        return Words(sizes, links, groups)
    back = np.argsort(order)
    start = np.concatenate(([0], np.cumsum(sizes[:, 3])))[:-1][back]
    sizes = sizes[back]
    place = np.repeat(start - np.concatenate(([0], np.cumsum(sizes[:, 3])))[:-1], sizes[:, 3])
    place += np.arange(len(links))
    return Words(sizes, links[place], [groups[k] for k in back.tolist()])


def aligner(first: str, second: str) -> Aligner:
    """The aligner of two vocabulary files; Python workers outlive tasks, so it is kept beside the library it uses."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_harborline_aligners", {})
    if (first, second) not in kept:
        kept[first, second] = Aligner(first, second)
    return kept[first, second]


class Shard:
    """Documents as indices into a list of words; each distinct word is cut and aligned once."""

    def __init__(self, own: Aligner):
        self.own, self.index, self.docs, self.at, self.words, self.chars = own, {}, [], [0], array("i"), 0
        self.texts: list[str] = []

    def add(self, doc, text: str) -> None:
        whole, words = " " + text, []
        if text:
            words = CUT.findall(whole) if self.own.cuts else [whole]
            if sum(map(len, words)) != len(whole):  # white space only
                words = [whole]
        index = self.index
        self.words.extend([index.setdefault(w, len(index)) for w in words])
        self.docs.append(doc)
        self.texts.append(whole)
        self.at.append(len(self.words))
        self.chars += len(whole)

    def _settled(self) -> Words:
        """The words, aligned; a document with a word whose bytes differ is tried whole, and loses its tokens if that differs too."""
        names, self.index = list(self.index), {}
        known = self.own.align(names)
        del names
        bad = {k for k, g in enumerate(known.groups) if g is None}
        if bad:
            words, at, wholes = [], [0], []
            for d, whole in enumerate(self.texts):
                own = self.words[self.at[d] : self.at[d + 1]]
                if not bad.isdisjoint(own):
                    own = [len(known.groups) + len(wholes)]
                    wholes.append(whole)
                words.append(own)
            more = self.own.align(wholes)
            known = Words(np.concatenate([known.sizes, more.sizes]), np.concatenate([known.links, more.links]), known.groups + more.groups)
            words = [[p for p in own if known.groups[p] is not None] for own in words]
            for own in words:
                at.append(at[-1] + len(own))
            self.words, self.at = array("i", chain.from_iterable(words)), at
        self.texts = []
        return known

    def rows(self, number: int, schema: pa.Schema):
        """The shard as batches of small rows, a row per document, run of words and id pair; what is sent is let go."""
        sizes, all_links, groups = self._settled()
        words, at = np.frombuffer(self.words, np.int32), self.at

        def batch(kind: int, n: int, **values) -> pa.RecordBatch:
            values |= {"shard": pa.repeat(pa.scalar(number, pa.int64()), n), "kind": pa.repeat(pa.scalar(kind, pa.int32()), n)}
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, f.type) if f.name not in values else _column(values[f.name], f.type) for f in schema], schema=schema)

        for i, j in _runs(np.diff(at), AT_ONCE):
            own, ends, digests = words[at[i] : at[j]], np.array(at[i : j + 1]) - at[i], []
            for start, end in zip(at[i:j], at[i + 1 : j + 1]):
                told = ";".join([groups[p] for p in self.words[start:end]])
                digests.append(hashlib.sha256(told.encode()).hexdigest() if end > start else "")
            sums = {}
            for k, c in enumerate(COUNTS):
                upto = np.concatenate(([0], np.cumsum(sizes[own, k])))
                sums[c] = upto[ends[1:]] - upto[ends[:-1]]
            yield batch(DOCUMENT, j - i, doc=self.docs[i:j], words=(ends, own), groups_sha256=digests, **sums)
        word_links, times = sizes[:, 3].astype(np.int32), np.bincount(words, minlength=len(sizes)).astype(float)
        del sizes, groups, words
        self.words, self.docs = array("i"), []

        pairs = np.unique(all_links)
        links = np.concatenate([np.zeros(0, np.int32)] + [
            np.searchsorted(pairs, all_links[i : i + AT_ONCE]).astype(np.int32) for i in range(0, len(all_links), AT_ONCE)])
        del all_links
        totals = np.bincount(links, np.repeat(times, word_links), len(pairs)).astype(np.int64)
        used = totals > 0  # a pair of documents that lost their tokens is no pair of the corpus
        links, pairs, totals = np.where(used, np.cumsum(used) - 1, 0).astype(np.int32)[links], pairs[used], totals[used]
        for i in range(0, len(pairs), ROWS):
            own = pairs[i : i + ROWS]
            yield batch(PAIR, len(own), place=np.arange(i, i + len(own)), pair=own, total=totals[i : i + ROWS])
        ends = np.concatenate(([0], np.cumsum(word_links, dtype=np.int64)))
        first = np.append(np.arange(0, len(word_links), RUN), len(word_links))  # words where a row begins
        for i, j in _runs(np.diff(ends[first]) + np.diff(first), AT_ONCE):
            begin, end = first[i], first[j]
            yield batch(
                WORDS, j - i, place=first[i:j], words=(first[i : j + 1] - begin, word_links[begin:end]),
                links=(ends[first[i : j + 1]] - ends[begin], links[ends[begin] : ends[end]]))


def _runs(sizes: np.ndarray, most: int):
    """Places (from, to) of rows that make a batch: up to ``ROWS``, of ``most`` in sum, or one row over that."""
    upto, i = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), 0
    while i < len(sizes):
        j = min(i + ROWS, max(i + 1, int(np.searchsorted(upto, upto[i] + most, "right")) - 1))
        yield i, j
        i = j


def _column(values, kind: pa.DataType) -> pa.Array:
    """A column; lists come as (offsets, values)."""
    if isinstance(values, tuple):
        return pa.ListArray.from_arrays(pa.array(values[0], pa.int32()), pa.array(values[1], kind.value_type))
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _sharded(first: str, second: str, schema: pa.Schema):
    def shards(batches):
        own, task, number, shard = aligner(first, second), TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                shard = shard or Shard(own)
                shard.add(doc, text.as_py())
                if shard.chars >= SHARD:
                    yield from shard.rows(task + number, schema)
                    number, shard = number + 1, None
                    _give_back()
        if shard:
            yield from shard.rows(task + number, schema)
            shard = None
            _give_back()

    return shards


def _give_back() -> None:
    """Freed memory goes back to the system where the C library can do that; workers live as long as their executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _totalled(schema: pa.Schema):
    """Documents with the corpus-wide counts of their links; of each shard come its pairs, then its words, then its documents."""

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The values of a column of lists, and where each row's begin (and the last ends)."""
        return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))

    def documents(batches):
        at, pairs, of_words, counts, of_word = None, [], [], None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                shard, kind = keys[:, i].tolist()
                some = dict(zip(batch.schema.names, batch.slice(i, j - i).columns, strict=True))
                if shard != at:
                    at, pairs, of_words, counts, of_word = shard, [], [], None, None
                if kind == PAIR:
                    pairs.append(np.stack([some[c].to_numpy() for c in ("place", "pair", "total")]))
                    continue
                if counts is None:  # all pairs have come
                    places, *values = np.concatenate(pairs, axis=1) if pairs else np.zeros((3, 0), np.int64)
                    counts, pairs = np.zeros((2, len(places)), np.int64), []
                    counts[:, places] = values
                if kind == WORDS:
                    (word_links, rows), (links, _) = flat(some["words"]), flat(some["links"])
                    ends = np.concatenate(([0], np.cumsum(word_links)))
                    sums = np.zeros((2, len(word_links)), np.int64)
                    for k, row in enumerate(counts):
                        upto = np.concatenate(([0], np.cumsum(row[links])))
                        sums[k] = upto[ends[1:]] - upto[ends[:-1]]
                    of_words += [(place, sums[:, a:b]) for place, a, b in zip(some["place"].to_pylist(), rows, rows[1:])]
                    continue
                if of_word is None:  # all words have come
                    of_words.sort(key=lambda x: x[0])
                    of_word = np.concatenate([np.zeros((2, 0), np.int64), *[x for _, x in of_words]], axis=1)
                    of_words = []
                words, ends = flat(some["words"])
                for name, row in zip(("count_sum", "n_best"), of_word, strict=True):
                    upto = np.concatenate(([0], np.cumsum(row[words])))
                    some[name] = pa.array(upto[ends[1:]] - upto[ends[:-1]])
                yield pa.RecordBatch.from_arrays([some[f.name].cast(f.type) for f in schema], schema=schema)

    return documents


def align(docs: DataFrame, first: str, second: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """One row per document: ``doc``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``first`` is the path of a byte-level vocabulary file, ``second`` of a sentencepiece model with byte fallback, both on
    every machine. The first encodes a space and the text, the second the text (it adds the space), both without special
    tokens. Character offsets of the one and byte spans of the other cut tokens into runs; inside a run (a character
    of several tokens, bytes of a character the model lacks) the bytes of decoded tokens tell where each token ends. Places
    where tokens of both end make groups (``a1,a2|b1;a3|b2``, of which the digest is returned); tokens that share a byte
    are linked. An id pair counts as often as it is linked in all documents; ``count_sum`` adds up these counts over the
    document's links, ``n_best`` counts the links whose pair is the most frequent one of its second id, ties included.

    Documents meet the counts by shard: a shard sends each of its id pairs once and gets each count back once, so a
    frequent pair is summed per shard first, and nothing is collected or broadcast. Shards move as small rows, so memory
    depends on the size of a shard and of a document only, not on how many shards a task or a file has.

    A NULL or empty text, or one whose joined token bytes differ from it, has no tokens: zeros and an empty digest.
    Equal ``doc`` values (NULL too) and repeated rows give a row each and all count. Other columns are not returned. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc}`").alias("doc"), text_of(docs, text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    counted = ", ".join(f"{c} bigint" for c in COUNTS)
    shape = f"shard bigint, kind int, place bigint, pair bigint, total bigint, words array<int>, links array<int>, doc {kind}, {counted}, groups_sha256 string"
    shards = stored(rows.mapInArrow(_sharded(first, second, _arrow(spark, shape)), shape), "alignment")
    told = shards.where(F.col("kind") == PAIR).select("shard", "place", "pair", "total")
    counts = told.groupBy("pair").agg(F.sum("total").alias("links")).withColumn("second", F.expr("pair & 4294967295"))
    most = counts.groupBy("second").agg(F.max("links").alias("most"))
    rated = counts.join(most, "second").select("pair", "links", (F.col("links") == F.col("most")).cast("bigint").alias("best"))
    # an answer is a pair's row with its count and mark in place of pair and total
    answers = told.join(rated, "pair").select(
        "shard", F.lit(PAIR).alias("kind"), "place", F.col("links").alias("pair"), F.col("best").alias("total"))
    met = shards.where(F.col("kind") != PAIR).unionByName(answers, allowMissingColumns=True)
    dealt = met.repartition("shard").sortWithinPartitions(F.expr(f"shard * {KINDS} + kind"))
    out = f"doc {kind}, {counted}, n_best bigint, count_sum bigint, groups_sha256 string"
    return dealt.mapInArrow(_totalled(_arrow(spark, out)), out).withColumnRenamed("doc", doc)


def _arrow(spark, shape: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(shape))
