"""Best-fit packing: documents as token sequences of a fixed size, planned on the histogram of piece lengths."""

from __future__ import annotations

import codecs
import string
from array import array
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import lists, stored, text_of, without

#: How many words and parts of words a Python worker remembers before the ones not met again are forgotten.
KNOWN = 400_000
PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids:binary>>"

#: The fixed split pattern of the vocabulary file word_bpe_49k.json.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def word_encoder(path: str):
    """``text -> ids as little-endian uint32 bytes`` for a word vocabulary; equal to encoding the whole text.

    The vocabulary's pre-tokenizer never joins characters across white space, so a text's ids are its words' ids in a
    row, and a word's ids are remembered, in lower case and beside those of the parts it was cut into: most new words
    are known words with a comma or a capital. A new word of letters below U+0250 (no other normal form, one-to-one
    lower case) is cut into parts here and only parts not met yet go through the model; any other word, and any text
    with special tokens or separators that Python and the vocabulary see differently, goes through the whole tokenizer.
    Python workers outlive tasks, so encoders are kept beside the library they use.
    """
    import regex
    import tokenizers

    kept = vars(tokenizers).setdefault("_harborline_encoders", {})
    if path in kept:
        return kept[path]
    whole = tokenizers.Tokenizer.from_file(path)
    tokenize, parts_of = whole.model.tokenize, regex.compile(WORD_PARTS).findall
    # in a text with one of these the words may not be what the vocabulary cuts
    odd = [*"\x1c\x1d\x1e\x1f", *(t.content for t in whole.get_added_tokens_decoder().values())]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    letters = "".join([letter[b] for b in range(256)])

    def packed(text: str) -> bytes:
        return array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()

    def word_ids(word: str) -> bytes:
        plain = word.isascii()
        if not plain and (max(word) >= "ɐ" or "İ" in word):
            return packed(word)
        low = word.lower()
        if low != word:
            return known[low]
        if not word.isalpha():
            body = word.rstrip(string.punctuation)
            if body != word and body.isalpha():  # the marks behind a word are one part
                return known[body] + known[word[len(body) :]]
            parts = parts_of(word)
            if parts != [word]:
                return b"".join([known[p] for p in parts])
        spelled = word if plain and word.isprintable() else codecs.charmap_decode(word.encode(), "strict", letters)[0]
        return array("I", [t.id for t in tokenize(spelled)]).tobytes()

    class Known(dict):
        """Ids by word or part; what is not asked for again while as many others are goes."""

        before: dict[str, bytes] = {}

        def __missing__(self, word: str) -> bytes:
            ids = self.before.get(word)
            if ids is None:
                ids = word_ids(word)
            self[word] = ids
            if len(self) >= KNOWN:
                self.before = dict(self)
                self.clear()
            return ids

    known = Known()

    def encode(text: str) -> bytes:
        for mark in odd:
            if mark in text:
                return packed(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            text = text.lower()
        return b"".join([known[w] for w in text.split()])

    kept[path] = encode
    return encode


def pieces(
    docs: DataFrame, tokenizer: str, text: str = "text", doc: str = "doc_id", size: int = 2048, end_id: int = 0,
) -> DataFrame:
    """(``doc``, ``piece``, ``start``, ``length``, ``ids``): each document's ids, then ``end_id``, cut every ``size`` ids.

    ``tokenizer`` is the path of a word vocabulary file on every machine. ``ids`` are little-endian uint32 bytes.
    """
    end = int(end_id).to_bytes(4, "little")

    @F.arrow_udf(PIECE)
    def cut(texts: pa.Array) -> pa.Array:
        encode, offsets, number, start, parts = word_encoder(tokenizer), [0], [], [], []
        for t in texts:
            ids = encode(t.as_py()) + end
            places = range(0, len(ids), 4 * size)
            number += range(len(places))
            start += places
            parts += [ids[at : at + 4 * size] for at in places]
            offsets.append(len(parts))
        return lists(offsets, {
            "piece": pa.array(number, pa.int32()), "start": pa.array(np.array(start, np.int64) // 4),
            "length": pa.array(np.array([len(p) for p in parts], np.int64) // 4), "ids": pa.array(parts, pa.binary())})

    return docs.select(F.col(f"`{doc}`").alias(doc), F.inline(cut(text_of(docs, text))))


@dataclass
class Plan:
    """Patterns (lengths, largest first) and how many sequences follow each."""

    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)
    from_columns: int = 0  # sequences that are columns of the program

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.patterns)

    def slots(self) -> np.ndarray:
        """Rows (length, first rank, end rank, copies in the pattern, first sequence, offset), sorted."""
        rows, used, base = [], Counter(), 0
        for pattern, n in self.patterns:
            offset = 0
            for length, copies in sorted(Counter(pattern).items(), reverse=True):
                rows.append((length, used[length], used[length] + copies * n, copies, base, offset))
                used[length] += copies * n
                offset += length * copies
            base += n
        return np.array(sorted(rows), np.int64).reshape(-1, 6)


def best_fit(counts: dict[int, int], size: int) -> Plan:
    """Best-fit decreasing on a histogram: equal sequences are filled together."""
    open_at: dict[int, list[list]] = defaultdict(list)  # free space -> [pattern, sequences]
    free = np.zeros(size + 1, bool)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = np.flatnonzero(free[length:])
            if len(room):
                space = int(room[0]) + length
                pattern, have = open_at[space].pop()
                taken = min(n, have)
                if have > taken:
                    open_at[space].append([pattern, have - taken])
                pattern = (*pattern, length)
            else:
                space, many = size, min(size // length, n)
                taken = n // many
                pattern, length_sum = (length,) * many, length * many
                n -= taken * (many - 1)
                space = size - length_sum + length
            open_at[space - length].append([pattern, taken])
            free[space - length] = True
            if not open_at[space]:
                free[space] = False
            n -= taken
    return Plan([(p, n) for groups in open_at.values() for p, n in groups if n])


def knapsack(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every capacity the best total price, and the index of the item to take first (-1: leave a token free)."""
    best, take = np.zeros(size + 1), np.full(size + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if fits[c]:
            gain = best[c - lengths[: fits[c]]] + prices[: fits[c]]
            i = int(gain.argmax())
            if gain[i] > best[c]:
                best[c], take[c] = gain[i], i
    return best, take


def fractional(counts: dict[int, int], size: int, rounds: int, rate: float, step: float) -> dict[tuple[int, ...], float]:
    """The configuration linear program, solved by multiplicative weights: pattern -> (fractional) sequences.

    Constraints are the lengths, a column is a pattern of lengths that fits a sequence. Weights start at the dual
    solution length / size and shrink exponentially with the share of a length that is covered. Each round prices
    columns by one knapsack over all capacities, which gives the best column through each length; the columns of the
    heaviest uncovered lengths are raised by a step that no length in them outgrows.
    """
    lengths = np.array(sorted(counts), np.int64)
    need = np.array([counts[int(x)] for x in lengths], float)
    place = {int(x): i for i, x in enumerate(lengths)}
    done, x = np.zeros(len(lengths)), defaultdict(float)
    for _ in range(rounds):
        weight = np.exp(-rate * done / need)
        prices = weight * lengths / size
        _, take = knapsack(lengths, prices, size)
        lacking = np.flatnonzero(done < need)
        if not len(lacking):
            break
        for i in lacking[np.argsort(-(prices * (need - done))[lacking])][:64].tolist():
            pattern, c = [int(lengths[i])], size - int(lengths[i])
            while c > 0:
                if take[c] < 0:
                    c -= 1
                else:
                    pattern.append(int(lengths[take[c]]))
                    c -= pattern[-1]
            use = Counter(pattern)
            amount = step * min(need[place[k]] / n for k, n in use.items())
            x[tuple(sorted(pattern, reverse=True))] += amount
            for k, n in use.items():
                done[place[k]] += n * amount
    return x


def _rounded(solution: dict[tuple[int, ...], float], left: dict[int, int], size: int, share: float) -> list[tuple[tuple[int, ...], int]]:
    """Whole sequences of the columns that fill one exactly, while their lengths last, taken out of ``left``.

    Amounts are rounded down, then columns get one more sequence in order of their remainders, down to ``share`` (1: none).
    """
    columns = [(p, x) for p, x in solution.items() if sum(p) == size]
    wanted = [(p, int(x)) for p, x in sorted(columns, key=lambda c: (-c[1], c[0]))]
    wanted += [(p, 1) for p, x in sorted(columns, key=lambda c: (-(c[1] % 1), c[0])) if x % 1 >= share]
    out = []
    for pattern, amount in wanted:
        use = Counter(pattern)
        n = min(amount, *(left[k] // c for k, c in use.items()))
        if n > 0:
            out.append((pattern, n))
            for k, c in use.items():
                left[k] -= c * n
    return out


def _finished(counts: dict[int, int], columns: list[tuple[tuple[int, ...], int]], size: int) -> Plan:
    left = Counter(counts)
    for pattern, n in columns:
        left.subtract({k: c * n for k, c in Counter(pattern).items()})
    return Plan(columns + best_fit({k: n for k, n in left.items() if n}, size).patterns, sum(n for _, n in columns))


def plan(
    counts: dict[int, int], size: int = 2048, rounds: int = 60, rate: float = 4.0, step: float = 0.25, passes: int = 3,
) -> Plan:
    """Sequences for a histogram of lengths: the program's solution rounded, solved again for what is left, best fit for the end.

    Only columns that fill a sequence exactly are rounded; a column that leaves room is left to the following passes. Two
    roundings (down; to the nearest by remainders) are followed for up to ``passes`` solutions each, and after each pass
    best fit packs what all columns so far, or the first three, two or one quarter of them, leave: the plan with the
    fewest sequences is taken, of several the one with the most from columns (``Plan.from_columns``). The histogram has
    at most ``size`` entries, whatever the corpus, so the plan is made on the driver.
    """
    best = best_fit(counts, size) if not counts else None
    for share in (0.25, 1.0):
        left, taken = dict(counts), []
        for _ in range(passes):
            rest = {k: n for k, n in left.items() if n}
            if not rest:
                break
            more = _rounded(fractional(rest, size, rounds, rate, step), left, size, share)
            taken += more
            for part in (4, 3, 2, 1):
                found = _finished(counts, taken[: -(-len(taken) * part // 4)], size)
                if best is None or (found.sequences, -found.from_columns) < (best.sequences, -best.from_columns):
                    best = found
            if not more:
                break
    return best


def pack(cut: DataFrame, size: int = 2048, bucket_rows: int = 20_000) -> DataFrame:
    """``cut`` (any rows with a ``length`` of 1 to ``size``) with ``sequence_id`` and ``offset``.

    The plan says for each length which ranks go where; a row's rank among its length is its place in a hash bucket
    plus the sizes of the buckets before, so a length that a third of all rows have is ranked in many tasks. Rows that
    are equal in every column may swap places, which changes nothing.
    """
    cut = stored(without(cut, "sequence_id", "offset"), "pieces")
    sizes = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(sizes, size).slots()
    key = slots[:, 0] << 44 | slots[:, 1]
    buckets = max(1, -(-sum(sizes.values()) // bucket_rows))
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in cut.columns])
    marked = cut.withColumn("__mark", mark).withColumn("__bucket", F.pmod("__mark", F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("length", "__bucket").agg(F.count("*").alias("n")).select(
        "length", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__bucket").orderBy("__mark")
    ranked = marked.withColumn("__rank", F.row_number().over(inside)).join(starts, ["length", "__bucket"])

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        at = slots[np.searchsorted(key, length << 44 | rank, side="right") - 1]
        nth = rank - at[:, 1]
        sequence, offset = at[:, 4] + nth // at[:, 3], at[:, 5] + nth % at[:, 3] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    rank = (F.col("__before") + F.col("__rank") - 1).cast("bigint")
    placed = ranked.withColumn("__at", place(F.col("length").cast("bigint"), rank))
    return placed.select(*[F.col(f"`{c}`") for c in cut.columns], "__at.sequence_id", "__at.offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, text: str = "text", doc: str = "doc_id", size: int = 2048, end_id: int = 0,
) -> DataFrame:
    """One row per piece of a document: ``doc``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    A document is its ids and ``end_id``; only documents over ``size`` ids are cut. NULL or empty text is one piece of
    ``end_id`` alone. Repeated rows are packed as often as they occur. Other columns are not looked at. An empty table
    gives an empty table.
    """
    return pack(pieces(docs, tokenizer, text, doc, size, end_id), size)
