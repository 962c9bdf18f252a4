"""Benchmark decontamination: benchmark passages in documents, within an edit budget, by the q-gram lemma."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import text_of

#: Characters searched at once, and characters of the benchmark indexed (and broadcast) at once.
SLICE, BLOCK_CHARS = 1 << 18, 400_000
FACTOR, MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
TABLE_BITS = 22
FOUND = "item_id:bigint,edits:int,at:bigint,until:bigint,item_at:int,item_until:int"
#: Places in an item at which its excerpts begin.
EXCERPTS = 4


def plain(text: str) -> str:
    """Lower case, runs of white space as one blank: what both sides are compared in."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(chars: np.ndarray, q: int) -> np.ndarray:
    """The table place of the q characters from each position on; different q-grams may share one."""
    n = max(0, len(chars) - q + 1)
    out = np.zeros(n, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(q if n else 0):
            out *= FACTOR
            out += chars[i : n + i]
        out ^= out >> np.uint32(15)
        out *= MIX
    return out >> np.uint32(32 - TABLE_BITS)


class Index:
    """The q-grams of some benchmark items by table place, and each item's edit budget and least number of hits.

    An item of m characters found with k edits keeps at least m - q + 1 - k * q of its q-grams, all on diagonals at
    most k apart (the q-gram lemma). k is ``share`` of m, less where the lemma would ask for none.
    Two q-grams at one place of the table count as equal, which can only add candidates. Of each item the q-grams most
    frequent in the benchmark are not indexed, half as many as the lemma could spare, and the limit falls by as many.

    Excerpts, if ``excerpt`` is under one, are runs of that part of an item, ``EXCERPTS`` of them evenly spaced, with
    budgets of their own, half as large for their length: less text has to be closer. Their q-grams are the item's, on
    its diagonals; an item's limit is the lower of its own and its excerpts'.
    Items whose excerpts would have under ``shortest`` characters have none.
    """

    def __init__(self, items: list[tuple[int, str]], q: int, share: float, excerpt: float = 1.0, shortest: int = 80):
        self.q, self.items = q, [(i, plain(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if len(t) >= q]
        self.chars = [codes(t) for _, t in self.items]
        self.size = np.array([len(t) for _, t in self.items], np.int64)
        self.budget = self._budgets(self.size, share)
        run = np.ceil(self.size * excerpt).astype(np.int64)
        self.run = np.where((run >= max(q, shortest)) & (run < self.size), run, self.size)
        self.run_budget = self._budgets(self.run, share / 2)
        self.least = np.minimum(self.size - self.budget * q, self.run - self.run_budget * q) - q + 1
        grams = [qgrams(c, q) for c in self.chars]
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        _, kind, often = np.unique(gram, return_inverse=True, return_counts=True)
        by_item = np.lexsort((-often[kind], item))
        first = np.concatenate(([0], np.cumsum(self.size - q + 1)[:-1])) if grams else np.zeros(0, np.int64)
        nth = np.arange(len(gram)) - first[item[by_item]]
        kept = by_item[nth >= (self.least // 2)[item[by_item]]]
        self.least -= self.least // 2
        gram, item, place = gram[kept], item[kept], place[kept]
        order = np.argsort(gram, kind="stable")
        self.item, self.at = item[order].astype(np.int32), place[order].astype(np.int32)
        self.start = np.searchsorted(gram[order], np.arange((1 << TABLE_BITS) + 1)).astype(np.int32)
        self.filled = np.diff(self.start) > 0
        self.shift = int(self.budget.max(initial=0)).bit_length()
        self.band = 1 << self.shift
        self.longest = int(self.size.max(initial=0))
        #: How far the region of a passage can reach beyond the first diagonal of its band.
        self.reach = self.longest + 2 * self.band + 2 * int(self.budget.max(initial=0))

    def _budgets(self, size: np.ndarray, share: float) -> np.ndarray:
        return np.maximum(0, np.minimum((size * share).astype(np.int64), (size - self.q) // self.q))

    def excerpts(self, i: int) -> list[int]:
        """Where the excerpts of an item begin; none for an item that is only found as a whole."""
        spare = int(self.size[i] - self.run[i])
        return sorted({spare * n // (EXCERPTS - 1) for n in range(EXCERPTS)}) if spare else []

    def place(self, i: int, text: str, low: int, high: int) -> tuple | None:
        """The item, else the best of its excerpts, in ``text`` on diagonals from ``low`` to ``high``.

        Returns (is an excerpt, edits, first, end, first in the item, end in the item).
        """
        found = []
        for begin, size, k in [(0, int(self.size[i]), int(self.budget[i]))] + [
                (b, int(self.run[i]), int(self.run_budget[i])) for b in self.excerpts(i)]:
            if size - k > len(text) or (found and not found[0][0]):
                continue
            a, b = low + begin, high + begin
            at = text.find(self.items[i][1][begin : begin + size], max(0, a - k), max(0, b + size + k))
            got = (0, at, at + size) if at >= 0 else banded(self.chars[i][begin : begin + size], codes(text), a, b, k)
            if got:
                found.append((size < self.size[i], *got, begin, begin + size))
        return min(found, default=None)

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, diagonal (document position less item position) and item position of every shared q-gram."""
        gram = qgrams(chars, self.q)
        at = np.flatnonzero(self.filled[gram]).astype(np.int32)
        gram = gram[at]
        low = self.start[gram]
        n = self.start[gram + np.uint32(1)] - low
        total = int(n.sum())
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(n[:-1]))), n) + np.arange(total) if total else np.zeros(0, int)
        place = self.at[entry]
        return self.item[entry], np.repeat(at, n) - place, place

    def regions(self, chars: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, end diagonal) of the overlapping diagonal bands with enough hits.

        A band is two cells of a power of two over the largest budget, every cell is in two bands, so some band
        holds any k + 1 neighbouring diagonals. In a band over the limit, k + 1 neighbouring diagonals must hold that
        many different q-grams of the item. Bands of an item that overlap are one region.
        """
        item, diagonal, place = self.hits(chars)
        if not len(item):
            return []
        shift = self.longest
        cells = (len(chars) + shift) // self.band + 2
        key = item * np.int64(cells) + ((diagonal + np.int32(shift)) >> self.shift)
        counts = np.bincount(key, minlength=len(self.items) * cells).astype(np.int32).reshape(len(self.items), cells)
        over = counts[:, :-1] + counts[:, 1:] >= self.least[:, None].astype(np.int32)
        if not over.any():
            return []
        wide = np.zeros_like(counts, bool)
        wide[:, :-1] |= over
        wide[:, 1:] |= over
        few = np.flatnonzero(wide.ravel()[key])
        few = few[np.argsort(key[few], kind="stable")]
        key, diagonal, place = key[few], diagonal[few], place[few]
        found: list[list[int]] = []
        for i, cell in np.argwhere(over).tolist():
            at = i * cells + cell
            own = slice(*np.searchsorted(key, (at, at + 2)))
            if not self._enough(diagonal[own], place[own], int(self.budget[i]), int(self.least[i])):
                continue
            low, high = cell * self.band - shift, (cell + 2) * self.band - shift
            if found and found[-1][0] == i and found[-1][2] > low:
                found[-1][2] = high
            else:
                found.append([i, low, high])
        return [tuple(f) for f in found]

    @staticmethod
    def _enough(diagonal: np.ndarray, place: np.ndarray, budget: int, least: int) -> bool:
        order = np.argsort(diagonal, kind="stable")
        diagonal, place = diagonal[order], place[order]
        until = np.searchsorted(diagonal, diagonal + budget, side="right")
        starts = np.flatnonzero(until - np.arange(len(diagonal)) >= least)
        return any(len(np.unique(place[i : until[i]])) >= least for i in starts.tolist())


def banded(item: np.ndarray, chars: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """The best alignment of the whole ``item`` inside ``chars`` on diagonals ``low`` - budget to ``high`` + budget.

    Returns (edits, first, end) with at most ``budget`` edits: fewest edits, then the earliest end. Row i of the
    table holds item characters 0..i against the diagonals; each cell carries edits and start in one number. It ends
    early when a whole row is over the budget.
    """
    low, width = low - budget, high - low + 2 * budget
    unit, never = 1 << 32, 1 << 60
    start = np.arange(low, low + width)
    row = np.where((start >= 0) & (start <= len(chars)), np.clip(start, 0, None), never)
    step = np.arange(width) * unit
    padded = np.full(width + len(item) + 1, 0xFFFFFFFF, np.uint32)
    real = np.arange(low, low + len(padded))
    held = (real >= 0) & (real < len(chars))
    padded[held] = chars[real[held]]
    edge = (real >= 0) & (real <= len(chars))
    for i in range(len(item)):
        across = row + np.where(padded[i : i + width] == item[i], 0, unit)
        across[~held[i : i + width]] = never
        skip = np.append(row[1:], never) + unit  # an item character that the document lacks
        row = np.minimum(across, skip)
        row = np.minimum.accumulate(row - step) + step  # document characters that the item lacks
        row[~edge[i + 1 : i + 1 + width]] = never
        if i % 8 == 7 and row.min() >= (budget + 1) * unit:
            return None
    edits = row // unit
    best = int(edits.min())
    if best > budget:
        return None
    j = int(np.flatnonzero(edits == best)[0])
    return best, int(row[j] % unit), int(start[j] + len(item))


def search(texts: list[str], index: Index) -> list[list[dict]]:
    """For each text the benchmark items that it holds within their budgets: edits, place in the plain text, part of the item.

    Texts are searched many at once, with a separator between them that no q-gram of the benchmark crosses; a long
    text is searched in slices that overlap by more than a region.
    """
    best: list[dict[int, tuple]] = [{} for _ in texts]
    group: list[tuple[int, int, str]] = []
    held = 0

    def flush() -> None:
        begin = np.concatenate(([0], np.cumsum([len(part) + 1 for _, _, part in group])))
        for i, low, high in index.regions(codes("\0".join(part for _, _, part in group))):
            k, m = int(index.budget[i]), int(index.size[i])
            first = max(0, int(np.searchsorted(begin, low - k, side="right")) - 1)
            for g in range(first, min(len(group), int(np.searchsorted(begin, high + m + k)))):
                doc, cut, part = group[g]
                a, b = low - int(begin[g]), high - int(begin[g])
                if max(0, a - k) > len(part):
                    continue
                got = index.place(i, part, a, b)
                if got:
                    partial, edits, at, until, *of = got
                    got = (partial, edits, cut + at, cut + until, *of)
                    best[doc][i] = min(got, best[doc].get(i, got))

    for n, text in enumerate(texts):
        text = plain(text)
        for cut in range(0, max(1, len(text)), SLICE):
            part = text[cut : cut + SLICE + index.reach]
            if len(part) >= index.q:
                group.append((n, cut, part))
                held += len(part)
            if held >= SLICE:
                flush()
                group, held = [], 0
    if group:
        flush()
    return [
        [
            {"item_id": index.items[i][0], "edits": e, "at": a, "until": u, "item_at": first, "item_until": end}
            for i, (_, e, a, u, first, end) in sorted(found.items())
        ]
        for found in best
    ]


def blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The benchmark in blocks of about ``BLOCK_CHARS`` characters, the bound of what is broadcast at once."""
    size = F.coalesce(F.sum(F.char_length(F.col(f"`{text}`"))), F.lit(0))
    n = max(1, -(-benchmark.agg(size).first()[0] // BLOCK_CHARS))
    return [benchmark.where(F.pmod(F.xxhash64(F.col(f"`{item}`")), F.lit(n)) == b) for b in range(n)]


def leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc: str = "doc_id", item: str = "item_id",
    passage: str = "text", q: int = 5, share: float = 0.125, excerpt: float = 0.75,
) -> DataFrame:
    """(``doc``, ``item_id``, ``edits``, ``at``, ``until``, ``item_at``, ``item_until``): benchmark items in documents.

    Both sides are compared in lower case with runs of white space as one blank. An item counts when the whole of it
    is in the document with at most ``share`` of its characters inserted, deleted or changed (its best place is
    given, in characters of the plain text). Candidates come from the q-gram lemma, without loss, and are verified by
    banded alignment. Documents are read once for each block of the benchmark; whole texts are searched, in
    overlapping slices.

    An item that is not there as a whole also counts when one of its excerpts is, with at most half of ``share`` of
    the excerpt's characters changed: four runs of ``excerpt`` of the item, evenly spaced, so that with 0.75 any run
    of five sixths of an item, and a character, holds one. ``item_at`` and ``item_until`` tell which characters of the plain item were found
    (all of them, or the excerpt with the fewest edits, then the earliest). Items under 106 characters, whose excerpts
    would have under 80, count as a whole only; so do all with ``excerpt=1``.

    NULL or empty texts hold nothing; NULL items, and items under ``q`` characters, are not searched. Repeated rows
    give their leaks as often as they occur; items with equal texts are all found. Other columns are not looked at.
    Empty tables give an empty table.
    """
    out = None
    for find in finders(docs, benchmark, item, passage, q, share, excerpt):
        found = docs.select(F.col(f"`{doc}`").alias(doc), F.inline(find(text_of(docs, text))))
        out = found if out is None else out.unionByName(found)
    return out


def finders(
    docs: DataFrame, benchmark: DataFrame, item: str, passage: str, q: int, share: float, excerpt: float,
) -> list:
    """A column function for each block of the benchmark: the items of the block that a text holds."""
    out = []
    for block in blocks(benchmark.where(F.col(f"`{passage}`").isNotNull()), item, passage):
        items = sorted((int(r[0]), r[1]) for r in block.select(F.col(f"`{item}`"), F.col(f"`{passage}`")).dropna().collect())
        out.append(_finder(docs.sparkSession.sparkContext.broadcast(items), q, share, excerpt))
    return out


def _finder(items, q: int, share: float, excerpt: float):
    @F.arrow_udf(f"array<struct<{FOUND}>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(items.value, q, share, excerpt)
        kind = pa.struct([
            ("item_id", pa.int64()), ("edits", pa.int32()), ("at", pa.int64()), ("until", pa.int64()),
            ("item_at", pa.int32()), ("item_until", pa.int32())])
        for texts in batches:
            yield pa.array(search(texts.to_pylist(), index), pa.list_(kind))

    return find


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", passage: str = "text", q: int = 5,
    share: float = 0.125, excerpt: float = 0.75,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item or excerpt of one (see ``leaks``), with their columns.

    A row is judged by its own text, so ids may be NULL or repeated, and nothing is shuffled. NULL and empty texts hold
    nothing and stay. An empty table gives an empty table; an empty benchmark leaves everything.
    """
    for find in finders(docs, benchmark, item, passage, q, share, excerpt):
        docs = docs.where(F.size(find(text_of(docs, text))) == 0)
    return docs
