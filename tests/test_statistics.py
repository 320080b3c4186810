import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureflow.operators import correlation, profile, quantiles


def exact(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(p * len(values))) - 1] if values else None


def random_columns(n, seed=0):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, 3.0, rng.normal(3, 1, n))
    return pd.DataFrame(
        {
            "normal": rng.normal(0, 1, n),
            "hot": hot,
            "two": np.where(rng.random(n) < 0.5, 1.0, 2.0),
            "heavy": rng.pareto(0.3, n),
            "const": np.full(n, 7.0),
        }
    )


@pytest.mark.parametrize("gather_limit", [100_000, 20, 0])
def test_exact_quantiles_against_sorting(spark, monkeypatch, gather_limit):
    """A limit of 0 never gathers: brackets are cut until their ends decide."""
    monkeypatch.setattr(quantiles, "GATHER_LIMIT", gather_limit)
    pdf = random_columns(3000)
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(pdf).repartition(3)
    got, _ = quantiles.exact_quantiles(df, list(pdf), probabilities)
    for name in pdf:
        assert got[name] == [exact(pdf[name], p) for p in probabilities], name


def test_exact_quantiles_with_nulls_empty_and_tiny_columns(spark):
    data = [(1.0, None, None), (None, None, 5.0), (3.0, None, None)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got, _ = quantiles.exact_quantiles(df, ["a", "b", "c"], [0.5, 1.0])
    assert got == {"a": [1.0, 3.0], "b": [None, None], "c": [5.0, 5.0]}


def test_a_wrong_first_bracket_is_repaired(spark, monkeypatch):
    """Values far from every quantile as first ends, on either side."""
    start = quantiles._start

    def misled(row, probability, j):
        bracket = start(row, probability, j)
        bracket.low, bracket.high = (2.5, 2.75) if probability < 0.5 else (0.25, 0.5)
        return bracket

    monkeypatch.setattr(quantiles, "_start", misled)
    df = spark.createDataFrame([(float(i % 4),) for i in range(400)], "v double")
    got, _ = quantiles.exact_quantiles(df, ["v"], [0.2, 0.4, 0.8])
    assert got["v"] == [0.0, 1.0, 3.0]


@pytest.mark.parametrize("gather_limit", [100_000, 0])
def test_quantiles_of_large_integers_and_decimals_keep_every_digit(spark, monkeypatch, gather_limit):
    """Neighbours within one double, extremes of the type, and copies: the sketch alone cannot part them."""
    monkeypatch.setattr(quantiles, "GATHER_LIMIT", gather_limit)
    draw = random.Random(3)
    data = [
        (2**62 + draw.randrange(300), draw.choice((-(2**63), 2**63 - 1, 2**53 + 1)), Decimal(draw.randrange(10**6)).scaleb(-9) + 10**15)
        for _ in range(800)
    ]
    df = spark.createDataFrame(data, "near bigint, ends bigint, exact decimal(30,9)").repartition(3)
    probabilities = [0.0, 0.01, 0.4, 0.5, 0.99, 1.0]
    got, _ = quantiles.exact_quantiles(df, ["near", "ends"], probabilities)
    for i, name in enumerate(["near", "ends"]):
        assert got[name] == [exact([row[i] for row in data], p) for p in probabilities]
    got, _ = quantiles.exact_quantiles(df, ["exact"], probabilities)
    assert got["exact"] == [exact([row[2] for row in data], p) for p in probabilities]


def test_the_type_of_a_summary_holds_all_its_columns(spark):
    row = (2**53 + 1, Decimal("0.05"), Decimal(10) ** 30, 1.5)
    df = spark.createDataFrame([row], "n bigint, small decimal(5,2), large decimal(38,0), x double")
    wanted = {"n": "bigint", "n small": "decimal(21,2)", "small large": "double", "n x": "double"}
    for names, kind in wanted.items():
        summary = profile.numeric_summary(df, names.split(), exact=True)
        assert dict(summary.dtypes)["p50"] == kind, names
    only = profile.numeric_summary(df, ["n"], exact=True).first()
    assert (only["min"], only["p50"], only["max"]) == (2**53 + 1,) * 3
    assert only["mean"] == float(2**53 + 1)


def test_one_value_per_quantile_reaches_the_driver(spark, monkeypatch):
    """However many rows a task gathers."""
    seen = []
    narrow = quantiles._Quantiles.narrow

    def watched(self, brackets):
        collect = type(self.stacked).collect
        monkeypatch.setattr(type(self.stacked), "collect", lambda df: seen.append(collect(df)) or seen[-1])
        narrow(self, brackets)
        monkeypatch.setattr(type(self.stacked), "collect", collect)

    monkeypatch.setattr(quantiles._Quantiles, "narrow", watched)
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    quantiles.exact_quantiles(df, ["v"], [0.5])
    values = [value for rows in seen for row in rows for value in row]
    assert len(values) == 2 and not any(isinstance(value, list) for value in values)


def test_summary_exact_and_approximate(spark):
    pdf = random_columns(2000)[["normal", "two"]]
    df = spark.createDataFrame(pdf)
    for is_exact in (True, False):
        rows = {r["column_name"]: r for r in profile.numeric_summary(df, exact=is_exact).collect()}
        row = rows["normal"]
        assert row["count"] == 2000
        assert row["mean"] == pytest.approx(pdf["normal"].mean())
        assert row["stddev"] == pytest.approx(pdf["normal"].std())
        assert (row["min"], row["max"]) == (pdf["normal"].min(), pdf["normal"].max())
        assert row["p50"] == pytest.approx(exact(pdf["normal"], 0.5), abs=0 if is_exact else 0.01)


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "n int, s string")
    want = [("n", "int", 3, 0, 2), ("s", "string", 3, 1, 2)]
    assert rows(profile.column_profile(df, exact=df.columns)) == want
    assert rows(profile.column_profile(df)) == want
    assert rows(profile.group_counts(df, "n")) == [(1, 2), (2, 1)]
    assert profile.row_count(df).first()["rows"] == 3


def pairs_of(df, columns):
    rows = correlation.correlation_pairs(df, columns).collect()
    return {(r["col_a"], r["col_b"]): r["corr"] for r in rows}


def test_correlations_against_numpy(spark):
    pdf = random_columns(1000)[["normal", "hot", "heavy"]]
    pdf["mix"] = pdf["normal"] * 2 + pdf["hot"] + 1e9
    got = pairs_of(spark.createDataFrame(pdf), list(pdf))
    want = pdf.corr()
    for (a, b), corr in got.items():
        assert a < b and corr == pytest.approx(want.loc[a, b], abs=1e-7)
    assert len(got) == 6


def test_misleading_first_rows_do_not_cost_digits(spark):
    n = 20_000
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, n), "b": rng.normal(0, 1, n)})
    pdf["b"] += pdf["a"]
    far = pdf.copy()
    df = spark.createDataFrame(far).coalesce(1)
    original = correlation._product_sums
    calls = []

    def shifted(frame, columns, shifts):
        calls.append(dict(shifts))
        if len(calls) == 1:
            shifts.update({name: 1e9 for name in shifts})
        return original(frame, columns, shifts)

    correlation._product_sums = shifted
    try:
        got = pairs_of(df, ["a", "b"])
    finally:
        correlation._product_sums = original
    assert len(calls) == 2
    assert got["a", "b"] == pytest.approx(pdf.corr().loc["a", "b"], abs=1e-12)


def test_correlations_with_nulls_use_complete_pairs(spark):
    data = [(1.0, 2.0, 5.0), (2.0, None, 4.0), (3.0, 7.0, None), (4.0, 6.0, 1.0), (5.0, 9.0, 2.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = pairs_of(df, ["a", "b", "c"])
    want = pd.DataFrame(data, columns=["a", "b", "c"], dtype=float).corr()
    assert all(got[k] == pytest.approx(want.loc[k]) for k in got)


def test_nan_is_not_a_strong_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, float("nan")), (3.0, 1.0)], "a double, b double")
    pairs = correlation.correlation_pairs(df, ["a", "b"])
    assert math.isnan(pairs.first()["corr"])
    assert correlation.strong_pairs(pairs).count() == 0
    assert correlation.prune_correlated(df, ["a", "b"]) == ["a", "b"]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0)], "a double, b double")
    assert pairs_of(df, ["a", "b"]) == {("a", "b"): None}
    assert pairs_of(df.limit(0), ["a", "b"]) == {("a", "b"): None}


def test_a_constant_that_rounds_has_no_correlation(spark, monkeypatch):
    """The shift of the constant column is off by its last digit."""
    original = correlation._mean
    monkeypatch.setattr(correlation, "_mean", lambda values: original(values) * (1 + 2.3e-16))
    df = spark.range(3000).select(F.col("id").cast("double").alias("a"), F.lit(0.7).alias("b"))
    assert pairs_of(df, ["a", "b"]) == {("a", "b"): None}


def test_wide_tables_are_done_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(correlation, "COLUMNS_PER_SCAN", 3)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(200, 8)), columns=list("abcdefgh"))
    want = pdf.corr()
    got = pairs_of(spark.createDataFrame(pdf), list(pdf))
    assert len(got) == 28
    assert all(v == pytest.approx(want.loc[k]) for k, v in got.items())
    pdf.iloc[0, 0] = np.nan
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    want = pdf.corr()
    assert all(v == pytest.approx(want.loc[k]) for k, v in pairs_of(df, list(pdf)).items())


def test_all_pairs_read_the_table_in_one_scan(spark):
    pdf = random_columns(100)[["normal", "hot", "heavy"]]
    df = spark.createDataFrame(pdf)
    stacked = correlation._stacked(df, list(pdf), list(pdf)).agg(F.sum("_value"))
    plan = stacked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Python" not in plan


def test_matrix_pairs_agree_and_prune(spark, rows):
    rng = np.random.default_rng(3)
    a = rng.normal(size=500)
    pdf = pd.DataFrame({"b": a, "a": a + rng.normal(size=500) * 0.1, "z": rng.normal(size=500)})
    pdf["neg"] = -pdf["a"]
    df = spark.createDataFrame(pdf)
    names = ["b", "a", "z", "neg"]
    pairs = correlation.strong_pairs(correlation.correlation_pairs(df, names))
    matrix = correlation.correlation_matrix(df, names)
    assert matrix.count() == 16
    strong = correlation.strong_pairs(matrix, below=1.0)
    agreed = correlation.agreeing_pairs(pairs, strong)
    assert {(r[0], r[1]) for r in agreed.collect()} == {("a", "b"), ("a", "neg"), ("b", "neg")}
    order = [r["corr"] for r in pairs.collect()]
    assert order == sorted(order, reverse=True)
    assert correlation.prune_correlated(df, names) == ["a", "z"]
    kept = correlation.kept_columns(profile.column_names(df, names), pairs)
    assert rows(kept) == [("a",), ("z",)]
    assert correlation.correlate(df, "a", "neg").first()["corr"] == pytest.approx(-1.0)
