"""LM scoring: a smoothed bigram model as a weighted backoff automaton, learned from the corpus that it scores.

The model is as large as the corpus and no machine holds it. Documents are put into shards once; each shard asks the
corpus for the counts of its own n-grams, builds the part of the automaton that its texts can reach, and walks it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import stored, text_of

SHARD_CHARS = 1 << 22
STEPS = 512
UNIT = np.uint64(1)


def lengthwise(values: np.ndarray) -> bytes:
    """Numbers as bytes, first all lowest bytes, then the next: small numbers then compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def numbers(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(dtype).ravel()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key for each ordered pair of keys."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0xD6E8FEB86659FD93))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ x >> np.uint64(32)


class Shard:
    """The tokens of some documents as indexes into their distinct words; '' is the end, one past the words the start."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, train: np.ndarray):
        self.words, self.tokens, self.sizes = words, tokens, sizes
        self.learned = np.repeat(train, sizes)
        self.first = np.cumsum(sizes) - sizes
        self.start = len(words)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.first] = self.start
        #: Distinct pairs of neighbours, as before * (words + 1) + word, and how often documents for learning hold them.
        pair = before.astype(np.int64) * (self.start + 1) + tokens
        order = np.argsort(pair)
        pair, learned = pair[order], self.learned[order]
        new = np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        self.pairs = pair[at]
        self.pair_counts = np.add.reduceat(learned.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        self.word_counts = np.bincount(tokens[self.learned], minlength=self.start)
        known = np.append(words, np.uint64(0x5851F42D4C957F2D))  # the key of the start
        before, word = np.divmod(self.pairs, self.start + 1)
        #: All n-grams as 64-bit keys, even for words and odd for pairs, in order.
        keys = np.concatenate((words & ~UNIT, mixed(known[before], known[word]) | UNIT))
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @property
    def counts(self) -> np.ndarray:
        return np.concatenate((self.word_counts, self.pair_counts))[self.order]

    def score(self, totals: np.ndarray, documents: int, n: int, v: int, weight: float) -> dict[str, np.ndarray]:
        """Per document its tokens, the known ones, the unigram score and the automaton's score, given corpus counts.

        The automaton: the state is the last word, state ``start`` begins a text, and a root stands behind all. From
        the root each word has an arc of weight p(w) = (c + 0.1) / (N + 0.1 (V + 1)). State h has an arc for each pair
        seen in learning, (c(h w) + k p(w)) / (c(h) + k), and a failure arc to the root, k / (c(h) + k); an unseen
        pair takes the failure arc and then the root's. All arcs leave a state with probability one in sum.
        """
        counts = np.empty(len(totals), np.int64)
        counts[self.order] = totals
        word, pair = counts[: self.start], counts[self.start :]
        p = (word + 0.1) / (n + 0.1 * (v + 1))
        root = np.log10(p)
        history = np.append(word, documents).astype(float)
        fail = np.log10(weight / (history + weight))
        seen = pair > 0
        arcs = self.pairs[seen]
        before, after = np.divmod(arcs, self.start + 1)
        arc_weight = np.log10((pair[seen] + weight * p[after]) / (history[before] + weight))
        sums = self.walk(arcs, arc_weight, fail, root)
        known = word[self.tokens] > 0
        per = lambda x: np.add.reduceat(x, self.first) if len(self.first) else x
        return {
            "n_tokens": self.sizes, "n_known": per(known.astype(np.int64)), "base_score": per(root[self.tokens]),
            "score": sums,
        }

    def walk(self, arcs, arc_weight, fail, root) -> np.ndarray:
        """Log-probabilities of all documents: one pass from left to right that carries each text's state.

        Texts advance together, a token at a step. A text over ``STEPS`` tokens is walked in parts at the same time:
        the state is the last word, so a part begins in the state that the part before ends in.
        """
        parts = -(-self.sizes // STEPS)
        of = np.repeat(np.arange(len(self.sizes)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = self.first[of] + nth * STEPS
        length = np.minimum(STEPS, self.sizes[of] - nth * STEPS)
        state = np.where(nth == 0, self.start, self.tokens[np.maximum(begin - 1, 0)]).astype(np.int64)
        order = np.argsort(-length, kind="stable")
        begin, length, state = begin[order], length[order], state[order]
        total = np.zeros(len(order))
        live = np.searchsorted(-length, -np.arange(STEPS), side="left")  # parts longer than each step
        arcs = np.append(arcs, np.iinfo(np.int64).max)
        arc_weight = np.append(arc_weight, 0.0)
        for step in range(int(length.max(initial=0))):
            k = int(live[step])
            word = self.tokens[begin[:k] + step]
            wanted = state[:k] * (self.start + 1) + word
            at = np.searchsorted(arcs, wanted)
            total[:k] += np.where(arcs[at] == wanted, arc_weight[at], fail[state[:k]] + root[word])
            state[:k] = word
        return np.bincount(of[order], weights=total, minlength=len(self.sizes))


def _sharded(doc_type: pa.DataType, chars: int):
    schema = pa.schema([
        ("shard", pa.string()), ("doc", pa.list_(doc_type)), ("train", pa.list_(pa.bool_())),
        ("n", pa.list_(pa.int32())), ("words", pa.binary()), ("tokens", pa.binary()),
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, train, sizes, tokens, held = [], [], [], [], 0
        index: dict[bytes, int] = {}

        def made() -> pa.RecordBatch:
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))
            row = [uuid.uuid4().hex, docs, train, sizes, lengthwise(words), lengthwise(np.concatenate(tokens))]
            return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for d, learn, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                said = text.encode().lower().split()
                said.append(b"")
                put, size = index.setdefault, len(index)
                ids = []
                for w in said:
                    i = put(w, size)
                    if i == size:
                        size += 1
                    ids.append(i)
                docs.append(d)
                train.append(learn)
                sizes.append(len(ids))
                tokens.append(np.array(ids, np.int32))
                held += len(text)
                if held >= chars:
                    yield made()
                    docs, train, sizes, tokens, held = [], [], [], [], 0
                    index = {}
        if docs:
            yield made()

    return shards


def _opened(row: dict) -> Shard:
    return Shard(
        numbers(row["words"], np.uint64), numbers(row["tokens"], np.int32), np.array(row["n"], np.int64),
        np.array(row["train"], bool))


def ranges(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``parts`` equal ranges of keys hold any of the ordered ``keys``, and where each one's keys begin."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    return part[begin], begin


def _asks(parts: int):
    """Each shard's n-grams, cut by key into ``parts`` ranges: (range, shard, keys as differences, counts).

    A range that holds none of a shard's n-grams gets no row from it, so there are never more rows than n-grams.
    """
    schema = pa.schema([("part", pa.int32()), ("shard", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = _opened(row)
                part, begin = ranges(shard.keys, parts)
                counts = np.split(shard.counts.astype(np.int32), begin[1:])
                told = [lengthwise(np.diff(k, prepend=np.uint64(0))) for k in np.split(shard.keys, begin[1:])]
                columns = [part, [row["shard"]] * len(part), told, [lengthwise(c) for c in counts]]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return asks


def _answers():
    """Sums the counts of a range of keys over all shards; each shard gets the sums in the order it asked.

    One row of each range also carries the number of distinct words learned and of tokens learned from.
    """
    schema = pa.schema([
        ("part", pa.int32()), ("shard", pa.string()), ("totals", pa.binary()), ("v", pa.int64()), ("n", pa.int64())])

    def answered(part: int, rows: list[tuple[str, bytes, bytes]]) -> pa.RecordBatch:
        sizes = [len(c) // 4 for _, _, c in rows]
        keys = np.concatenate([np.cumsum(numbers(k, np.uint64), dtype=np.uint64) for _, k, _ in rows])
        order = np.argsort(keys, kind="stable").astype(np.int32)
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        words = (keys[new] & UNIT) == 0
        del keys
        back = np.empty(len(order), np.int32)
        back[order] = np.cumsum(new, dtype=np.int32) - 1
        del order, new
        totals = np.zeros(len(words), np.int64)
        ends = np.cumsum(sizes)
        for (_, _, c), n, e in zip(rows, sizes, ends.tolist(), strict=True):
            np.add.at(totals, back[e - n : e], numbers(c, np.int32))
        told = [lengthwise(totals[back[e - n : e]]) for n, e in zip(sizes, ends.tolist(), strict=True)]
        first = [1] + [0] * (len(rows) - 1)
        v, n = int((totals[words] > 0).sum()), int(totals[words].sum())
        return pa.record_batch([
            pa.array([part] * len(rows), pa.int32()), pa.array([s for s, _, _ in rows], pa.string()),
            pa.array(told, pa.binary()), pa.array([v * x for x in first], pa.int64()),
            pa.array([n * x for x in first], pa.int64()),
        ], schema=schema)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = -1, []
        for batch in batches:
            for p, s, k, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if p != part and rows:
                    yield answered(part, rows)
                    rows = []
                part = p
                rows.append((s, k, c))
        if rows:
            yield answered(part, rows)

    return answers


def score(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", held_out: int = 10, weight: float = 16.0,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """(``doc``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``) per row of ``docs``.

    Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z in lower case, then one end. A document is held out when crc32 of
    ``doc`` as text is divisible by ``held_out``; all others are learned from. ``base_score`` is the log10 probability
    of the tokens one by one, p = (c + 0.1) / (N + 0.1 (V + 1)); ``score`` is that of the text in the bigram
    automaton (see ``Shard.score``; ``weight`` is its k).

    Every n-gram of the corpus counts, whatever its frequency. Shards hold about ``shard_chars`` characters (a longer
    text is a shard of its own), are written once, and send each n-gram once to the range of keys it belongs to, so a
    word that fills a third of the corpus is one row per shard. Keys are 64-bit hashes.

    NULL or empty text is the end alone; a NULL ``doc`` counts as the text ''. Rows that repeat a ``doc`` are separate
    documents on the same side. Other columns are not looked at. An empty table gives an empty table.
    """
    rest = F.crc32(F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit("")).cast("binary")) % held_out
    rows = docs.select(F.col(f"`{doc}`").alias("doc"), (rest != 0).alias("train"), text_of(docs, text).alias("text"))
    kind = docs.schema[doc].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    shards = stored(rows.mapInArrow(
        _sharded(to_arrow_type(kind), shard_chars),
        f"shard string, doc array<{kind.simpleString()}>, train array<boolean>, n array<int>, words binary, tokens binary",
    ), "lm-shards")
    told = shards.agg(F.count("*"), F.sum(F.size(F.filter("train", lambda t: t)))).first()
    parts, documents = max(8, told[0]), told[1] or 0
    asked = shards.mapInArrow(_asks(parts), "part int, shard string, keys binary, counts binary")
    answers = stored(
        asked.repartition("part").sortWithinPartitions("part").mapInArrow(
            _answers(), "part int, shard string, totals binary, v bigint, n bigint"),
        "lm-counts")
    sums = answers.agg(F.sum("v"), F.sum("n")).first()
    v, n = sums[0] or 0, sums[1] or 0
    mine = answers.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("part", "totals"))).alias("answers"))
    names = ("n_tokens", "n_known", "base_score", "score")
    schema = pa.schema([
        ("doc", to_arrow_type(kind)), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                totals = np.concatenate([numbers(a["totals"], np.int64) for a in row["answers"]])
                found = _opened(row).score(totals, documents, n, v, weight)
                columns = [row["doc"], row["train"], *(found[c] for c in names)]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    met = shards.join(mine.hint("shuffle_hash"), "shard").select("doc", "train", "n", "words", "tokens", "answers")
    done = met.mapInArrow(
        scored, f"doc {kind.simpleString()}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return done.select(
        F.col("doc").alias(doc), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
