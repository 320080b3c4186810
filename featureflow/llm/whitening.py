"""Whitened embeddings: exact covariances by polarisation, components by a symmetric eigenproblem.

A vector's entries become whole numbers x = floor(256 * c). The fit list has each
distinct x vector once. Tasks sum the squares of the centred values of every
dimension, and of the sum of every two dimensions; as

    (a + b)^2 - a^2 - b^2 = 2ab,

the differences of these sums are the covariances. Values are centred on the
rounded mean m of their dimension, so they stay small; with T the sum of x - m,
n * (sum of squares) - T^2 is n times the sum of squares about the exact mean, in
whole numbers. Nothing is rounded before the finished covariance is divided by
n^2, so neither the order of rows nor a mean far from zero costs a digit.

Only sums come to the driver: one number for each two dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import stored
from .vectors import matrix

#: Whole numbers to one unit of an entry, components returned.
SCALE, COMPONENTS = 256, 4
#: Vectors a task squares at once.
ROWS = 512

_LONG = 1 << 63
#: Below this, sums in 64 bits are exact.
_SAFE = 1 << 62
#: Sums of squares travel in two parts, split at this bit.
_LOW = 60

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_wide decimal(38,0)"
)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * c) as 64-bit numbers; beyond their range the nearest one."""
    with np.errstate(over="ignore"):
        value = np.floor(SCALE * vectors)
    inside = np.abs(value) < _LONG
    edge = np.where(value > 0, _LONG - 1, -_LONG)
    return np.where(inside, np.where(inside, value, 0).astype(np.int64), edge)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length above 0, ``ROWS`` at a time."""
    length = np.diff(column.offsets.to_numpy())
    for n in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == n)
        for k in range(0, len(rows), ROWS):
            yield rows[k : k + ROWS], matrix(column.take(pa.array(rows[k : k + ROWS])))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes of the narrowest width that holds it: equal vectors give equal bytes."""
    for batch in batches:
        for _, vectors in _by_length(batch.column("vector")):
            x = whole_numbers(vectors)
            low, high = x.min(axis=1), x.max(axis=1)
            fits = [(low >= -(1 << b - 1)) & (high < 1 << b - 1) for b in (8, 16, 32)]
            width = np.select(fits, (1, 2, 4), 8)
            for w in np.unique(width):
                own = x[width == w].astype(f"<i{w}")
                packed = [row.tobytes() for row in own]
                dims = pa.array(np.full(len(own), x.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([dims, pa.array(packed, pa.binary())], names=["dims", "x"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Matrices of whole numbers, of one length each, ``ROWS`` rows at a time."""
    dims = batch.column("dims").to_numpy()
    column = batch.column("x").cast(pa.large_binary())
    width = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]) // dims
    for d, w in np.unique(np.stack([dims, width], axis=1), axis=0):
        rows = np.flatnonzero((dims == d) & (width == w))
        for k in range(0, len(rows), ROWS):
            own = column.take(pa.array(rows[k : k + ROWS]))
            yield np.frombuffer(own.buffers()[2], f"<i{w}", count=len(own) * d).reshape(-1, d).astype(np.int64)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length: number of vectors (at -1) and sum of every dimension."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for x in _unpacked(batch):
            exact = x if _largest(x) * len(x) < _SAFE else x.astype(object)
            own = np.concatenate([[len(x)], exact.sum(axis=0)]).astype(object)
            total[x.shape[1]] = total.get(x.shape[1], 0) + own
    for d, own in total.items():
        keys = [pa.array(np.full(d + 1, d, np.int32)), pa.array(np.arange(-1, d, dtype=np.int32))]
        yield pa.RecordBatch.from_arrays([*keys, _decimals(own.tolist())], names=["dims", "i", "s"])


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x - m: in 64 bits, or as Python's whole numbers where that could overflow."""
    if max(_largest(x), *map(abs, middle)) < _SAFE:
        return x - np.array(middle, np.int64)
    return x.astype(object) - np.array(middle, object)


def square_sums(y: np.ndarray) -> np.ndarray:
    """Upper triangle: sum of y_i^2 on the diagonal, of (y_i + y_j)^2 beside it."""
    if y.dtype != object and (2 * _largest(y)) ** 2 * len(y) >= _SAFE:
        y = y.astype(object)
    d = y.shape[1]
    out = np.zeros((d, d), y.dtype)
    for i in range(d):
        pair = y[:, i:] + y[:, i : i + 1]
        pair[:, 0] = y[:, i]
        out[i, i:] = (pair * pair).sum(axis=0)
    return out


def _squares(middles: dict[int, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in _unpacked(batch):
                d = x.shape[1]
                total[d] = total.get(d, 0) + square_sums(centred(x, middles[d])).astype(object)
        for d, sums in total.items():
            for i in range(d):  # one dimension's pairs at a time
                own = [int(q) for q in sums[i, i:]]
                columns = [np.full(d - i, d), np.full(d - i, i), np.arange(i, d)]
                low = pa.array([q & (1 << _LOW) - 1 for q in own], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.astype(np.int32)) for c in columns), _decimals([q >> _LOW for q in own]), low],
                    names=["dims", "i", "j", "high", "low"],
                )

    return run


class Whitening:
    """Means and leading components of the vectors of one length, from exact sums."""

    def __init__(self, n: int, sums: list[int], middle: list[int], squares: list[list[int]]):
        self.n, self.middle = n, middle
        self.rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
        d = len(sums)
        # n^2 times the variance of every dimension, and of every sum of two.
        own = [n * squares[i][i] - self.rest[i] ** 2 for i in range(d)]
        cov = np.zeros((d, d))
        for i in range(d):
            cov[i, i] = own[i] / (n * n)
            for j in range(i + 1, d):
                both = n * squares[i][j] - (self.rest[i] + self.rest[j]) ** 2
                cov[i, j] = cov[j, i] = (both - own[i] - own[j]) / (2 * n * n)
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        trace = float(sum(own)) / (n * n) if d else 0.0
        keep = min(COMPONENTS, int((values > d * np.finfo(float).eps * trace).sum()))
        vectors = vectors[:, :keep]
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)]) if keep else np.ones(0)
        self.project = vectors * sign / np.sqrt(values[:keep])
        self.explained = values[:keep] / trace if trace else np.zeros(0)
        self.shift = np.array([r / n for r in self.rest])

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Values of the components for centred rows."""
        return (y.astype(np.float64) - self.shift) @ self.project


def _moments(models: dict[int, Whitening]):
    """By length: sums of the whitened values (j = -1) and of their products over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in _unpacked(batch):
                d = x.shape[1]
                w = models[d].whiten(centred(x, models[d].middle))
                total[d] = total.get(d, 0) + np.concatenate([w.sum(axis=0)[:, None], w.T @ w], axis=1)
        for d, sums in total.items():
            i, j = np.indices(sums.shape).reshape(2, -1)
            columns = [np.full(i.size, d), i, j - 1]
            names = ["dims", "i", "j", "s"]
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), pa.array(sums.reshape(-1))], names=names)

    return run


def _identity_error(fit: DataFrame, models: dict[int, Whitening]) -> float:
    """Largest entry of the whitened values' covariance, less the identity."""
    sums = fit.mapInArrow(_moments(models), "dims int, i int, j int, s double")
    sums = {(r.dims, r.i, r.j): r.s for r in sums.groupBy("dims", "i", "j").agg(F.sum("s").alias("s")).collect()}
    worst = 0.0
    for d, i, j in sums:
        if j >= 0:
            n = models[d].n
            cov = sums[d, i, j] / n - sums[d, i, -1] / n * (sums[d, j, -1] / n)
            worst = max(worst, abs(cov - (i == j)))
    return worst


def _rows(models: dict[int, Whitening], error: float):
    def exact(y: np.ndarray, rest: list[int]) -> tuple[pa.Array, pa.Array]:
        """Sum of y^2 and of y * T of each row."""
        most = _largest(y)
        if y.dtype != object and y.shape[1] * most * max(most, *map(abs, rest)) < _SAFE:
            both = (y * y).sum(axis=1), y @ np.array(rest, np.int64)
            return tuple(pa.array(v).cast(pa.decimal128(38, 0)) for v in both)
        y = y.astype(object)
        both = (y * y).sum(axis=1), (y * np.array(rest, object)).sum(axis=1)
        return tuple(pa.array([Decimal(v) if abs(v) < 10**38 else None for v in map(int, one)], pa.decimal128(38, 0)) for one in both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _by_length(batch.column("vector")):
                model = models[vectors.shape[1]]
                y = centred(whole_numbers(vectors), model.middle)
                w = model.whiten(y)
                k = w.shape[1]
                again = pa.array(np.repeat(np.arange(len(rows)), k))
                square, cross = (c.take(again) for c in exact(y, model.rest))
                size = len(again)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)).take(again),
                        pa.array(np.full(size, vectors.shape[1], np.int32)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(size, model.n)),
                        pa.array(w.reshape(-1)),
                        pa.array(np.tile(model.explained, len(rows))),
                        pa.array(np.full(size, error)),
                        square,
                        cross,
                    ],
                    names=["vec_id", "dims", "component", "n", "whitened", "explained", "identity_error", "square", "cross"],
                )

    return run


def whiten(table: DataFrame) -> DataFrame:
    """Leading components of every vector, whitened: one row per row of ``table`` and component.

    ``table`` needs ``vec_id`` and ``embedding`` (an array of numbers); other columns
    are ignored. Rows whose vector is null, or holds null or non-finite entries,
    are left out. Result: ``RESULT``, with ``n`` the number of distinct x vectors,
    ``deviation`` the sum over dimensions of (n * x - sum)^2, exact, null where it
    is beyond a long; ``deviation_wide`` has it while the terms of the sum stay within 38 digits (else null).

    Repeated rows, rows without an id and equal vectors under several ids all
    get their own result rows, from a fit that has their vector once. Vectors
    of each length are a fit of their own; empty ones have no component.
    Components whose eigenvalue is not above zero (by rounding: dimensions times
    double precision times the trace) can't be whitened and have no rows, so a
    table of one distinct vector, and an empty table, give none. Each component's
    largest entry is positive. Entries that exceed a long as x count as its
    nearest value.
    """
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull()).where(~bad)
    fit = stored(rows.select("vector").mapInArrow(_pack, "dims int, x binary").distinct(), "fit-list")

    sums: dict[int, dict[int, int]] = {}
    for r in fit.mapInArrow(_sums, "dims int, i int, s decimal(38,0)").groupBy("dims", "i").agg(F.sum("s").alias("s")).collect():
        sums.setdefault(r.dims, {})[r.i] = int(r.s)
    if not sums:
        return spark.createDataFrame([], RESULT)
    middles = {d: [(2 * s[i] + s[-1]) // (2 * s[-1]) for i in range(d)] for d, s in sums.items()}

    squares = {d: [[0] * d for _ in range(d)] for d in sums}
    parts = fit.mapInArrow(_squares(middles), "dims int, i int, j int, high decimal(38,0), low long")
    parts = parts.groupBy("dims", "i", "j").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(19,0)")).alias("low"))
    for r in parts.collect():
        squares[r.dims][r.i][r.j] = (int(r.high) << _LOW) + int(r.low)
    models = {d: Whitening(s[-1], [s[i] for i in range(d)], middles[d], squares[d]) for d, s in sums.items()}
    error = _identity_error(fit, models)

    found = rows.mapInArrow(
        _rows(models, error),
        "vec_id long, dims int, component int, n long, whitened double, explained double, identity_error double, "
        "square decimal(38,0), cross decimal(38,0)",
    )

    # sum of (n * y - T)^2, by length, in decimals.
    def number(value: int) -> F.Column:
        return F.lit(Decimal(value)) if abs(value) < 10**38 else F.lit(None).cast("decimal(38,0)")

    constant = F.lit(None).cast("decimal(38,0)")
    for d, model in models.items():
        constant = F.when(F.col("dims") == d, number(sum(t * t for t in model.rest))).otherwise(constant)
    n = F.col("n").cast("decimal(38,0)")
    wide = F.try_subtract(F.try_multiply(F.try_multiply(n, n), "square"), F.try_multiply(F.try_multiply(F.lit(2), n), "cross"))
    wide = F.try_add(wide, constant).cast("decimal(38,0)")
    found = found.withColumn("deviation_wide", wide).withColumn("deviation", F.col("deviation_wide").try_cast("long"))
    return found.select([field.split()[0] for field in RESULT.split(", ")])
