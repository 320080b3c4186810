"""Product sums of wide tables against numpy and against the stacked form."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureflow.operators import correlation
from featureflow.operators.gramian import PRODUCTS, ROWS, SQUARES, SUMS, pair_sums


def wide(rows, width, holes, seed=0):
    draw = np.random.default_rng(seed)
    values = draw.normal(5, 2, (rows, width)) + draw.normal(0, 1, (rows, 1))
    if holes:
        values[draw.random((rows, width)) < 0.2] = np.nan
    return values


def frame(spark, values, **more):
    pdf = pd.DataFrame(values, columns=[f"c{k}" for k in range(values.shape[1])]).assign(**more)
    df = spark.createDataFrame(pdf).repartition(3)
    return df.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in df.columns])


@pytest.mark.parametrize("holes", [False, True])
def test_sums_over_the_rows_that_have_both(spark, holes):
    values = wide(200, 70, holes)  # a whole tile and a part
    weight = np.random.default_rng(1).integers(0, 4, 200).astype(float)
    df = frame(spark, values, w=weight)
    shifts = np.arange(70) / 10
    got = pair_sums(df, [f"c{k}" for k in range(70)], shifts, "w")
    there = ~np.isnan(values)
    x, m = np.where(there, values - shifts, 0.0).T, there.astype(float).T
    want = {PRODUCTS: (x * weight) @ x.T, SUMS: (x * weight) @ m.T, SQUARES: (x * x * weight) @ m.T, ROWS: (m * weight) @ m.T}
    for kind, matrix in want.items():
        np.testing.assert_allclose(got[kind], matrix, rtol=1e-10, atol=1e-9)


@pytest.mark.parametrize("limit", [1, 160])
@pytest.mark.parametrize("holes", [False, True])
def test_correlations_of_odd_columns(spark, monkeypatch, holes, limit):
    monkeypatch.setattr(correlation, "STACKED_COLUMNS", limit)
    values = wide(120, 12, holes)
    values[:, 3] = 7.0  # constant; the stacked form of Spark's own aggregate divided by zero here
    values[:, 4] += 1e9  # far from zero
    if holes:
        values[:, 5] = np.nan  # never there
        values[1:, 6] = np.nan  # there once
    df = frame(spark, values)
    want = pd.DataFrame(values, columns=df.columns).corr()
    got = correlation.correlation_pairs(df, df.columns).collect()
    assert len(got) == 66
    for a, b, corr in got:
        expected = want.loc[a, b]
        assert corr == (None if np.isnan(expected) else pytest.approx(expected, abs=1e-6)), (a, b)


def test_weights_stand_for_copies(spark):
    values = wide(60, 5, True)
    times = np.random.default_rng(2).integers(0, 4, 60)
    df = frame(spark, values, times=times.astype(float))
    names = [f"c{k}" for k in range(5)]
    want = pd.DataFrame(np.repeat(values, times, axis=0), columns=names).corr()
    for a, b, corr in correlation._pair_rows(df, names, "times"):
        assert corr == pytest.approx(want.loc[a, b]), (a, b)


def test_an_empty_wide_table_has_no_correlation(spark, monkeypatch):
    monkeypatch.setattr(correlation, "STACKED_COLUMNS", 1)
    df = frame(spark, wide(5, 4, False)).limit(0)
    assert {row["corr"] for row in correlation.correlation_pairs(df, df.columns).collect()} == {None}
