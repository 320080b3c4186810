"""Product sums of hundreds or thousands of columns (AGG5, FEA9).

Stacking sends every row through the aggregation once per column. Here a task
turns its rows into blocks of numbers, multiplies each block with itself and
adds the products up, so a task yields one matrix whatever its rows. It is cut
into pieces of a row by ``TILE`` columns, which Spark adds up by their place: what
is shuffled grows with the tasks and the square of the width, and a task of the
second stage holds one piece at a time.

A task holds one matrix (four where values are missing): 8 MB for 1,000 columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 64
#: Products, sums and squares of the left column, and rows, over the rows that have both.
PRODUCTS, SUMS, SQUARES, ROWS = range(4)


def _numbers(batch: pa.RecordBatch, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shifted values by column with zeros for nulls, which are there, and the weights of the rows."""
    width = len(shifts)
    values = np.zeros((width, batch.num_rows))
    there = np.ones((width, batch.num_rows), bool)
    for k in range(width):
        column = batch.column(k)
        if column.null_count:
            there[k] = column.is_valid().to_numpy(zero_copy_only=False)
            column = column.fill_null(shifts[k])
        values[k] = column.to_numpy(zero_copy_only=False)
    values -= shifts[:, None]
    values[~there] = 0.0
    weights = batch.column(width).to_numpy(zero_copy_only=False) if batch.num_columns > width else np.ones(batch.num_rows)
    return values, there, weights


def _pieces(kind: int, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = len(matrix)
    padded = np.zeros((width, -(-width // TILE) * TILE))
    padded[:, :width] = matrix
    slots = pa.array(np.arange(width, dtype=np.int32))
    for block in range(padded.shape[1] // TILE):
        part = padded[:, block * TILE : (block + 1) * TILE]
        keys = [pa.array(np.full(width, v, np.int32)) for v in (kind, block)]
        yield pa.RecordBatch.from_arrays(
            [keys[0], slots, keys[1], *(pa.array(part[:, j].copy()) for j in range(TILE))],
            names=["kind", "slot", "block", *(f"p{j}" for j in range(TILE))],
        )


def pair_sums(df: DataFrame, columns: Sequence[str], shifts: Sequence[float], weight: str | None = None) -> list[np.ndarray]:
    """``PRODUCTS``, ``SUMS``, ``SQUARES`` and ``ROWS`` of every ordered pair of double columns, in one scan.

    Each is over the rows that have both columns, by ``weight``; values are taken
    less the column's shift. Without nulls the last three depend on one column
    only and are taken from sums: their matrices are not multiplied out. Null
    weights count as none. An empty table gives zeros.
    """
    shift = np.array(shifts, float)
    width = len(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((1, width, width))
        plain = np.zeros((2, width))
        rows, parted = 0.0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            values, there, weights = _numbers(batch, shift)
            weighed = values * weights
            if not parted and not there.all():
                # What was whole so far has the same sums for every partner.
                whole = [np.broadcast_to(v[:, None], (width, width)) for v in plain]
                totals = np.stack([totals[0], *whole, np.full((width, width), rows)])
                parted = True
            totals[PRODUCTS] += weighed @ values.T
            if parted:
                mask = there.astype(float)
                totals[SUMS] += weighed @ mask.T
                totals[SQUARES] += (weighed * values) @ mask.T
                totals[ROWS] += (mask * weights) @ mask.T
            else:
                plain[0] += weighed.sum(axis=1)
                plain[1] += (weighed * values).sum(axis=1)
                rows += float(weights.sum())
        yield from _pieces(PRODUCTS, totals[PRODUCTS])
        for kind in (SUMS, SQUARES, ROWS):
            if parted:
                yield from _pieces(kind, totals[kind])
            elif kind == ROWS:
                yield from _pieces(kind, np.full((width, width), rows))
            else:
                yield from _pieces(kind, np.repeat(plain[kind - 1][:, None], width, axis=1))

    names = [f"p{j}" for j in range(TILE)]
    form = "kind int, slot int, block int, " + ", ".join(f"{name} double" for name in names)
    extra = [] if weight is None else [F.coalesce(F.col(weight).cast("double"), F.lit(0.0)).alias("_weight")]
    wanted = df.select(*[F.col(name).cast("double").alias(f"c{k}") for k, name in enumerate(columns)], *extra)
    sums = wanted.mapInArrow(run, form).groupBy("kind", "slot", "block").agg(*[F.sum(name).alias(name) for name in names])
    out = [np.zeros((width, -(-width // TILE) * TILE)) for _ in range(4)]
    table = sums.toArrow()
    kind, slot, block = (table[name].to_numpy() for name in ("kind", "slot", "block"))
    values = np.stack([table[name].to_numpy() for name in names], axis=1) if len(table) else np.zeros((0, TILE))
    for k, s, b, v in zip(kind, slot, block, values, strict=True):
        out[k][s, b * TILE : (b + 1) * TILE] = v
    return [matrix[:, :width] for matrix in out]
