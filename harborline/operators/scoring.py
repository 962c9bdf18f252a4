"""Vectors scored against the queries that a task holds. Python workers import this module, so it imports little."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Candidates that are measured at once.
AT_ONCE = 65_536

#: In the place of a vector's list: the row is a query. And the id of a vector whose id is NULL, first among equals.
QUERY, NO_ID = -1, np.iinfo(np.int64).min


class Search:
    """Some queries, the lists that each one probes, and the best k vectors so far of each."""

    def __init__(self, k: int, block_rows: int, query_rows: int):
        self.k, self.block_rows, self.query_rows = k, block_rows, query_rows
        self.asked: list[tuple] = []
        self.waiting: list[tuple] = []
        self.rows, self.of, self.probing = 0, QUERY, None

    def ask(self, ids: pa.Array, embeddings: pa.Array, lists: pa.Array) -> None:
        real, matrix, norms = _matrix(embeddings)
        sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
        kept = np.repeat(np.isin(np.arange(len(ids)), real), sizes)
        self.asked.append((_ids(ids)[real], matrix, norms, sizes[real], flat[kept]))

    def meet(self, of: int, ids: pa.Array, embeddings: pa.Array) -> None:
        """Vectors of one list; they are scored when there are ``block_rows`` of them, or another list begins."""
        if of != self.of:
            self._score()
            self.of = of
        for i in range(0, len(ids), self.block_rows):
            real, matrix, norms = _matrix(embeddings.slice(i, self.block_rows))
            self.waiting.append((_ids(ids.slice(i, self.block_rows))[real], matrix, norms))
            self.rows += len(norms)
            if self.rows >= self.block_rows:
                self._score()

    def _begin(self) -> None:
        self.ids, self.queries, self.norms, sizes, flat = map(np.concatenate, zip(*self.asked, strict=True))
        self.asked, self.units = [], _units(self.queries, self.norms)
        order = np.argsort(flat, kind="stable")
        lists, first = np.unique(flat[order], return_index=True)
        self.probing = dict(zip(lists.tolist(), np.split(np.repeat(np.arange(len(sizes)), sizes)[order], first[1:]), strict=bool(len(lists))))
        self.sims = np.full((len(self.ids), self.k), -np.inf)
        self.found = np.full((len(self.ids), self.k), NO_ID)

    def _score(self) -> None:
        waiting, self.waiting, self.rows = self.waiting, [], 0
        if not waiting or not self.asked and self.probing is None:
            return
        if self.probing is None:
            self._begin()
        ids, vectors, norms = map(np.concatenate, zip(*waiting, strict=True))
        units, probing = _units(vectors, norms), self.probing.get(self.of, ())
        if not len(ids):
            return
        # single precision tells who may be among the best; twice what it can be off is added, and they are measured again
        off = (vectors.shape[1] + 4) * 2.0**-22
        for i in range(0, len(probing), self.query_rows):
            some = probing[i : i + self.query_rows]
            rough = self.units[some] @ units.T
            least = self.sims[some, -1]
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and len(ids) > self.k:
                least[new] = np.partition(rough[new], len(ids) - self.k, axis=1)[:, len(ids) - self.k] - off
            hits = np.flatnonzero(rough >= (least - off).astype(np.float32)[:, None])
            for j in range(0, len(hits), AT_ONCE):
                q, v = np.divmod(hits[j : j + AT_ONCE], len(ids))
                q = some[q]
                sims = np.einsum("ij,ij->i", self.queries[q].astype(float), vectors[v].astype(float)) / (self.norms[q] * norms[v])
                better = sims >= self.sims[q, -1]
                self._keep(q[better], sims[better], ids[v[better]])

    def _keep(self, rows: np.ndarray, sims: np.ndarray, ids: np.ndarray) -> None:
        """The best k of what was there and what has come; ``rows`` rise."""
        touched = np.unique(rows)
        if not len(touched):
            return
        rows = np.concatenate((np.repeat(touched, self.k), rows))
        sims, ids = np.concatenate((self.sims[touched].ravel(), sims)), np.concatenate((self.found[touched].ravel(), ids))
        order = np.lexsort((ids, -sims, rows))
        best = order[np.searchsorted(rows[order], touched)[:, None] + np.arange(self.k)]
        self.sims[touched], self.found[touched] = sims[best], ids[best]

    def answers(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        self._score()
        if self.probing is None:
            return
        for i in range(0, len(self.ids), 1000):
            sims = self.sims[i : i + 1000]
            there = ~np.isneginf(sims)
            ids = np.repeat(self.ids[i : i + 1000], there.sum(axis=1)), self.found[i : i + 1000][there]
            columns = [pa.array(x, pa.int64(), mask=x == NO_ID) for x in ids] + [pa.array(sims[there])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _ids(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _matrix(embeddings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of vectors that have a direction, these as a matrix, and their lengths."""
    sizes = embeddings.value_lengths().fill_null(0).to_numpy()
    width = int(sizes.max(initial=0))
    whole = np.flatnonzero(sizes)  # an empty vector has no direction, as a NULL one
    matrix = embeddings.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), width)  # a NULL inside becomes NaN
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=float))
    real = np.isfinite(norms) & (norms > 0)
    return whole[real], matrix[real], norms[real]


def directions(embeddings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of vectors that have a direction (not NULL, zero, or with NULL or NaN in it), and these with length one."""
    real, matrix, _ = _matrix(embeddings)
    wide = matrix.astype(float)
    lengths = np.sqrt(np.cumsum(wide * wide, axis=1)[:, -1:]) if wide.size else np.ones((len(real), 1))  # squares added in order
    return real, wide / lengths


def _units(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (matrix / norms[:, None]).astype(np.float32)


def searched(k: int, block_rows: int, query_rows: int, schema: pa.Schema):
    """A function for ``mapInArrow``; rows come sorted by part, and inside by list, queries first."""

    def search_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, search = None, None
        for batch in batches:
            part, of = (batch.column(c).to_numpy() for c in ("part", "list"))
            cuts = [0, *(np.flatnonzero((part[1:] != part[:-1]) | (of[1:] != of[:-1])) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if part[i] != at:
                    if search:
                        yield from search.answers(schema)
                    at, search = part[i], Search(k, block_rows, query_rows)
                ids, embeddings, lists = (batch.column(c).slice(i, j - i) for c in ("vec_id", "embedding", "lists"))
                if of[i] == QUERY:
                    search.ask(ids, embeddings, lists)
                else:
                    search.meet(int(of[i]), ids, embeddings)
        if search:
            yield from search.answers(schema)

    return search_parts
