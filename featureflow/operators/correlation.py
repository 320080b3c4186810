"""Pearson correlations, strong pairs and column pruning (AGG5-AGG7, JOI4, SRT2, SET2-SET4, FEA9)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.columns import exceeds, ordered_pair
from ..sources.dimensions import dim_table
from .gramian import PRODUCTS, ROWS, SQUARES, SUMS, pair_sums
from .stacking import SLOT, VALUE

PAIRS_SCHEMA = "col_a string, col_b string, corr double"
SHIFT_ROWS = 1_000
# More columns than this are multiplied in blocks instead of stacked.
STACKED_COLUMNS = 160
COLUMNS_PER_SCAN = 80
SHIFT_TOLERANCE = 1e4
LAST_DIGIT = 4e-16
_TIMES = "_times"


def correlate(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of two columns."""
    return df.agg(F.corr(a, b).alias("corr"))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every unordered pair, smaller name first; rows null in either are left out.

    One scan yields the product sums of all pairs: each row is stacked by
    its left column inside the task and summed against all columns, so tasks
    shuffle one row per column. Columns with nulls, and more columns than
    ``STACKED_COLUMNS``, are multiplied in blocks of rows. A column that is constant
    where both are there has no correlation.
    """
    return dim_table(df.sparkSession, _pair_rows(df, columns), PAIRS_SCHEMA)


def _pair_rows(
    df: DataFrame, columns: Sequence[str], weight: str | None = None
) -> list[tuple[str, str, float | None]]:
    columns = list(columns)
    matrix = _matrix(df, columns, weight)
    index = {name: i for i, name in enumerate(columns)}
    return [(a, b, matrix[index[a]][index[b]]) for a, b in combinations(sorted(columns), 2)]


def _matrix(df: DataFrame, columns: list[str], weight: str | None = None) -> list[list[float | None]]:
    times = [] if weight is None else [F.col(weight).alias(_TIMES)]
    doubles = df.select(*[F.col(name).cast("double").alias(name) for name in columns], *times)
    if len(columns) > STACKED_COLUMNS:
        return _blocked_correlations(doubles, columns)
    matrix = _complete_correlations(doubles, columns)
    return _blocked_correlations(doubles, columns) if matrix is None else matrix


def _chunks(columns: Sequence[str]) -> list[list[str]]:
    return [list(columns[i : i + COLUMNS_PER_SCAN]) for i in range(0, len(columns), COLUMNS_PER_SCAN)]


def _stacked(df: DataFrame, columns: Sequence[str], others: Sequence[str]) -> GroupedData:
    left = F.posexplode(F.array(*[F.col(name) for name in columns])).alias(SLOT, VALUE)
    return df.select(left, *others).groupBy(SLOT)


def _complete_correlations(df: DataFrame, columns: list[str]) -> list[list[float | None]] | None:
    """All correlations from product sums, or None if the columns have nulls.

    Columns are shifted by the mean of the first rows so the sums keep their
    digits. If that turns out to be far from a column's real mean, the scan is
    repeated with the means it found.
    """
    # ``take`` stops at the first partitions; a ``limit`` under an aggregate would visit them all.
    first = df.take(SHIFT_ROWS)
    shifts = {name: _mean([row[name] for row in first]) for name in columns}
    for attempt in range(2):
        n, sums, products, complete = _product_sums(df, columns, shifts)
        if not complete or n == 0:
            return None
        offset = sums / n
        variance = np.diag(products) / n - offset**2
        far = offset**2 > SHIFT_TOLERANCE * np.maximum(variance, 0.0)
        if attempt or not np.any(far & (offset != 0)):
            break
        shifts = {name: shifts[name] + offset[i] for i, name in enumerate(columns)}
    covariance = products - np.outer(sums, sums) / n
    # A spread below the last digit of the values is the rounding of the shift.
    noise = n * (LAST_DIGIT * np.array([shifts[name] for name in columns])) ** 2
    constant = np.diag(covariance) <= noise
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.sqrt(np.diag(covariance))
        matrix = covariance / np.outer(scale, scale)
    undefined = constant[:, None] | constant[None, :]
    return np.where(undefined, None, matrix).tolist()


def _blocked_correlations(df: DataFrame, columns: list[str]) -> list[list[float | None]]:
    """All correlations, pairwise complete where there are nulls, from products of blocks of rows."""
    weight = _TIMES if _TIMES in df.columns else None
    first = df.take(SHIFT_ROWS)
    shifts = np.array([_mean(list(values)) for values in zip(*first)][: len(columns)] or np.zeros(len(columns)))
    for attempt in range(2):
        sums = pair_sums(df, columns, shifts, weight)
        n, offset = np.diag(sums[ROWS]), np.zeros(len(columns))
        np.divide(np.diag(sums[SUMS]), n, out=offset, where=n > 0)
        variance = np.zeros(len(columns))
        np.divide(np.diag(sums[SQUARES]), n, out=variance, where=n > 0)
        far = offset**2 > SHIFT_TOLERANCE * np.maximum(variance - offset**2, 0.0)
        if attempt or not np.any(far & (offset != 0)):
            break
        shifts = shifts + np.where(np.isfinite(offset), offset, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        n = sums[ROWS]
        covariance = sums[PRODUCTS] - sums[SUMS] * sums[SUMS].T / n
        spread = sums[SQUARES] - sums[SUMS] ** 2 / n
        matrix = covariance / np.sqrt(spread * spread.T)
        constant = ~(spread > n * (LAST_DIGIT * shifts[:, None]) ** 2) & ~np.isnan(spread) | (n <= 0)
    return np.where(constant | constant.T, None, matrix).tolist()


def _mean(values: list[float | None]) -> float:
    usable = [value for value in values if value is not None and math.isfinite(value)]
    return math.fsum(usable) / len(usable) if usable else 0.0


def _product_sums(df: DataFrame, columns: list[str], shifts: dict[str, float]):
    times = [_TIMES] if _TIMES in df.columns else []
    shifted = df.select(*[(F.col(name) - F.lit(shifts[name])).alias(name) for name in columns], *times)

    def total(value: Column) -> Column:
        return F.sum(value * F.col(_TIMES)) if times else F.sum(value)

    width = len(columns)
    sums, products = np.zeros(width), np.zeros((width, width))
    n, complete, done = 0, True, 0
    for chunk in _chunks(columns):
        rows = _stacked(shifted, columns, [*chunk, *times]).agg(
            (total(F.lit(1)) if times else F.count("*")).alias("n"),
            F.count_if(F.col(VALUE).isNull()).alias("missing"),
            total(F.col(VALUE)).alias("total"),
            *[total(F.col(VALUE) * F.col(name)).alias(f"p{j}") for j, name in enumerate(chunk)],
        )
        for row in rows.collect():
            n = row["n"]
            if row["missing"]:
                return n, sums, products, False
            sums[row[SLOT]] = row["total"]
            products[row[SLOT], done : done + len(chunk)] = [row[f"p{j}"] for j in range(len(chunk))]
        done += len(chunk)
    return n, sums, products, complete


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The whole matrix in long form, every ordered pair including a column with itself.

    From the same scan and with the same treatment of nulls as
    ``correlation_pairs``.
    """
    columns = list(columns)
    matrix = _matrix(df, columns)
    rows = [
        (a, b, 1.0 if i == j and matrix[i][j] is not None else matrix[i][j])
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return dim_table(df.sparkSession, rows, PAIRS_SCHEMA)


def assembled_correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``correlation_matrix``, by the library's row matrix: a second method; columns without nulls only."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    matrix = Correlation.corr(assembler.transform(df.select(*columns)), "features").first()[0]
    values = matrix.toArray()
    rows = [
        (a, b, float(values[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return dim_table(df.sparkSession, rows, PAIRS_SCHEMA)


def strong_pairs(pairs: DataFrame, threshold: float = 0.6, below: float | None = None) -> DataFrame:
    """Unordered pairs with \\|r\\| above ``threshold``, strongest first.

    ``below`` leaves out correlations that reach it (1.0 drops the diagonal).
    A NaN, which Spark sorts above every number, is not strong.
    """
    kept = pairs.filter(~F.isnan("corr") & exceeds("corr", threshold))
    if below is not None:
        kept = kept.filter(F.col("corr") < below)
    a, b = ordered_pair("col_a", "col_b")
    return kept.select(a.alias("col_a"), b.alias("col_b"), "corr").distinct().orderBy(F.desc("corr"))


def agreeing_pairs(first: DataFrame, second: DataFrame, digits: int | None = 6) -> DataFrame:
    """Pairs in both lists with the same correlation, to ``digits`` decimals."""
    if digits is None:
        return first.intersect(second)
    corr = F.round("corr", digits).alias("corr")
    return first.select("col_a", "col_b", corr).intersect(second.select("col_a", "col_b", corr))


def kept_columns(names: DataFrame, pairs: DataFrame, column: str = "column_name") -> DataFrame:
    """Names left after dropping the alphabetically later one of each strong pair."""
    dropped = pairs.select(F.greatest("col_a", "col_b").alias(column))
    return names.join(dropped, column, "left_anti")


def prune_correlated(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.6, weight: str | None = None
) -> list[str]:
    """``columns`` without the later name of each strong pair, in their order; rows count by ``weight``, if given."""
    pairs = _pair_rows(df, columns, weight)
    dropped = {b for _, b, corr in pairs if corr is not None and abs(corr) > threshold}
    return [name for name in columns if name not in dropped]
