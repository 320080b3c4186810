"""Exact best integer scores by sequential reading of sorted lists, without random access.

Every task sorts the components of a block of candidates into one list each, in
descending order for queries with a positive weight there and in ascending order
for negative ones. Lists are read in bands from their heads. After each band a
candidate's score lies between two bounds: what has been read of it, plus the
least or the most that its unread components can add, given the end and the
current position of each list. Reading stops when no more than the candidates
that can still qualify are left, or the lists are at their end; then the scores of
those are resolved exactly. A query's bar, its ``top``-th lower bound so far, goes
on from block to block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import Heaps, search

#: Shares of the lists that have been read after each band.
BANDS = (0.05, 0.15, 0.3, 0.5, 0.75, 1.0)
#: Reading stops once this share of a block's scores is left open at most, on average over the queries.
OPEN = 0.05
#: Queries whose bounds are held at once.
QUERIES = 256
#: Largest magnitude of a score; beyond it scores would not fit a long.
LARGEST = (1 << 63) - 1


class SortedLists:
    """Lists of a block of candidates: a band's mask and frontier values for both directions."""

    def __init__(self, vectors: np.ndarray):
        order = np.argsort(-vectors, axis=0, kind="stable")
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(vectors))[:, None], axis=0)
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.vectors = vectors

    def read(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Masks of the entries between two positions from the top and from the bottom, and the values reached."""
        size = len(self.vectors)
        down = (self.rank >= begin) & (self.rank < end)
        back = size - 1 - self.rank
        up = (back >= begin) & (back < end)
        return down, up, self.sorted[end - 1], self.sorted[size - end]


class ListSearch:
    """The best candidates of some queries so far."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, top: int):
        self.rows, self.top = rows, top
        self.queries = np.floor(64 * vectors)
        self.heaps = Heaps(len(rows), top, np.int64)

    def read(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        values = np.floor(64 * vectors)
        most = np.abs(values).max(initial=0) * np.abs(self.queries).max(initial=0) * values.shape[1]
        # Whole numbers are exact in single precision below 2**24, in double below 2**53.
        kind = np.float32 if most < 1 << 22 else np.float64
        lists = SortedLists(values.astype(kind))
        for k in range(0, len(self.rows), QUERIES):
            part = np.arange(k, min(k + QUERIES, len(self.rows)))
            own = self.rows[part][:, None] == rows
            if most < 1 << 51:
                query, at = self._open(self.queries[part].astype(kind), part, own, lists)
            else:
                query, at = np.nonzero(~own)
            self._resolve(part[query], ids[at], values[at], exact=most < 1 << 51)

    def _open(self, q: np.ndarray, part: np.ndarray, own: np.ndarray, lists: SortedLists) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and candidate that can be among the best, by the bounds of as many bands as it takes."""
        size = own.shape[1]
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        seen = np.zeros((len(q), size), q.dtype)
        # What all unread components can add at least and at most.
        least = plus @ lists.sorted[-1] + minus @ lists.sorted[0]
        low_rest = np.repeat(least[:, None], size, axis=1)
        down_seen, up_seen = np.zeros(lists.rank.shape, bool), np.zeros(lists.rank.shape, bool)
        bar = self.heaps.bar[part].astype(q.dtype)
        begin = 0
        for share in BANDS:
            end = max(begin + 1, int(np.ceil(share * size)))
            if end > size:
                break
            down, up, at_down, at_up = lists.read(begin, end)
            seen += plus @ np.where(down, lists.vectors, 0).T + minus @ np.where(up, lists.vectors, 0).T
            low_rest -= (plus * lists.sorted[-1]) @ down.T.astype(q.dtype) + (minus * lists.sorted[0]) @ up.T.astype(q.dtype)
            down_seen |= down
            up_seen |= up
            most_down, most_up = plus * at_down, minus * at_up
            high = seen + (most_down.sum(axis=1) + most_up.sum(axis=1))[:, None]
            high -= most_down @ down_seen.T.astype(q.dtype) + most_up @ up_seen.T.astype(q.dtype)
            low = np.where(own, -np.inf, seen + low_rest)
            if size > self.top:
                bar = np.maximum(bar, np.partition(low, -self.top, axis=1)[:, -self.top])
            left = (high >= bar[:, None]) & ~own
            begin = end
            if left.mean() <= OPEN:
                break
        return np.nonzero(left)

    def _resolve(self, query: np.ndarray, ids: np.ndarray, values: np.ndarray, exact: bool) -> None:
        if exact:
            score = (self.queries[query].astype(np.int64) * values.astype(np.int64)).sum(axis=1)
        else:
            score = np.array(
                [
                    max(-LARGEST, min(LARGEST, sum(int(x) * int(y) for x, y in zip(self.queries[k], v, strict=True))))
                    for k, v in zip(query, values, strict=True)
                ],
                np.int64,
            )
        self.heaps.merge(query, ids, score)


def top_scores(table: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """``top`` highest integer scores for each row whose ``vec_id`` is divisible by ``every``.

    Each component x counts as floor(64 * x), a score is the inner product. ``table``
    needs ``vec_id`` and ``embedding``; other columns are ignored. Result:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; best first, ties to the
    smaller id. A row is no candidate of its own; with fewer candidates than
    ``top`` all are returned. Vectors of zeros take part; vectors that are null,
    empty or hold a null or non-finite component, and rows without an id, do not.
    Rows under one id, equal or not, are all candidates, also of each other, and
    each is a query with ranks of its own. Only vectors of equal length are
    compared. Scores beyond the range of a long become its ends.
    An empty table gives an empty table.
    """
    return search(table, zero=True, every=every, top=top, kind="long", method=ListSearch).withColumn(
        "score", F.col("score").cast("long")
    )
