"""Nearest neighbours by inner product: a block matrix join of eight-bit vectors with error bounds.

Vectors are quantised to eight bits, each with a scale of its own. A tile of
queries times candidates is one product of the small integers; what quantisation
can have changed is bounded by the scales and the sums of magnitudes. Pairs whose
upper bound reaches the query's current ``top``-th score survive, are computed in
double precision from the original vectors and merged into the query's heap. The
bounds hold always, so the result is exact and recall is 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .vectors import Heaps, search

#: Candidates of a tile.
TILE = 512


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eight-bit vectors, and the scale of each: the vector is ``scale`` times integers, each off by half at most."""
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = 1.0
    return np.rint(vectors / scale[:, None]).astype(np.int8), scale


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row in double precision, summed in order of the components."""
    return np.cumsum(a * b, axis=1)[:, -1]


class TileSearch:
    """The best candidates of some queries so far."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, top: int):
        self.rows, self.vectors, self.top = rows, vectors, top
        self.small, self.scale = quantise(vectors)
        self.weight = np.abs(vectors).sum(axis=1)
        # Products of eight-bit numbers are exact in single precision up to this dimension, else in double.
        self.kind = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.tile_side = self.small.astype(self.kind)
        self.heaps = Heaps(len(rows), top, np.float64)

    def read(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        small, scale = quantise(vectors)
        weight = np.abs(small.astype(np.int64)).sum(axis=1) * scale
        for k in range(0, len(ids), TILE):
            part = slice(k, k + TILE)
            self._tile(self.rows[:, None] == rows[part], ids[part], vectors[part], small[part], scale[part], weight[part])

    def _tile(
        self, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, small: np.ndarray, scale: np.ndarray, weight: np.ndarray
    ) -> None:
        product = (self.tile_side @ small.T.astype(self.kind)).astype(np.float64) * np.outer(self.scale, scale)
        # q.c - q'.c' = q.(c - c') + (q - q').c', with components off by half a scale at most.
        slack = 0.5 * (np.outer(self.weight, scale) + np.outer(self.scale, weight))
        slack += 1e-12 * np.outer(self.weight, weight + scale)  # rounding of these sums themselves
        low = np.where(own, -np.inf, product - slack)
        if len(ids) > self.top:
            bar = np.maximum(self.heaps.bar, np.partition(low, -self.top, axis=1)[:, -self.top])
        else:
            bar = self.heaps.bar
        query, at = np.nonzero((product + slack >= bar[:, None]) & ~own)
        self.heaps.merge(query, ids[at], exact_products(self.vectors[query], vectors[at]))


def nearest_neighbours(table: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """``top`` largest inner products for each row whose ``vec_id`` is divisible by ``every``.

    ``table`` needs ``vec_id`` and ``embedding``; other columns are ignored. Result:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; best first, ties to the
    smaller id. A row is no candidate of its own; with fewer candidates than
    ``top`` all are returned. Vectors that are null, empty, zero or hold a null or
    non-finite component take no part, nor do rows without an id. Rows under one
    id, equal or not, are all candidates, also of each other, and each is a query
    with ranks of its own. Only vectors of equal length are compared. An empty
    table gives an empty table.
    """
    return search(table, zero=False, every=every, top=top, kind="double", method=TileSearch)
