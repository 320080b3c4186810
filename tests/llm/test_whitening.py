"""Whitened embeddings against plain exact arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from featureflow.llm import whitening
from featureflow.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, n string, component string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", "c", 1) for i, v in rows], SCHEMA)


def plain(rows):
    """Kept rows as whole numbers, and n, sums and exact covariance of each length."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fits = {}
    for d in {len(x) for _, x in kept}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == d})
        n, sums = len(fit), [sum(x[k] for x in fit) for k in range(d)]
        cov = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) for j in range(d)] for i in range(d)]
        fits[d] = n, sums, [[Fraction(c, n**3) for c in row] for row in cov]
    return kept, fits


def check(spark, rows, tolerance=1e-9):
    kept, fits = plain(rows)
    got = sorted(whiten(frame(spark, rows)).collect(), key=repr)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    wanted = {}
    for i, x in kept:
        wanted.setdefault(i, []).append(x)
    for i, xs in wanted.items():
        expected = []
        for x in xs:
            n, sums, cov = fits[len(x)]
            values, vectors = np.linalg.eigh(np.array(cov, float).reshape(len(x), len(x))) if x else (np.zeros(0), None)
            values = values[::-1]
            trace = float(sum(cov[k][k] for k in range(len(x))))
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            for k in range(min(4, len(x))):
                if values[k] > len(x) * 2.3e-16 * trace:
                    vector = vectors[:, ::-1][:, k]
                    vector = vector * np.sign(vector[np.abs(vector).argmax()])
                    away = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums, strict=True)])
                    expected.append((k + 1, n, deviation, away @ vector / math.sqrt(values[k]), values[k] / trace))
        own = by_id.pop(i, [])
        assert len(own) == len(expected)
        for r, e in zip(sorted(own, key=lambda r: (r.n, r.component, r.whitened)), sorted(expected, key=lambda e: (e[1], e[0], e[3])), strict=True):
            assert (r.component, r.n, r.deviation_wide) == e[:3]
            assert r.deviation == (e[2] if e[2] < 2**63 else None)
            assert r.whitened == pytest.approx(e[3], abs=tolerance) and r.explained == pytest.approx(e[4], rel=1e-9)
            assert r.identity_error < 1e-9
    assert not by_id
    return got


def test_odd_rows(spark):
    draw = random.Random(11)
    rows = [(k, [draw.gauss(0, 1 + m) + 100 * m for m in range(6)]) for k in range(300)]
    rows += [(k, [draw.gauss(0, 1 + m) for m in range(3)]) for k in range(300, 340)]
    rows += [rows[0]] * 50 + [(None, rows[1][1]), (900, rows[1][1]), (900, rows[2][1])]
    rows += [(901, None), (902, []), (903, [1.0, None, 2.0]), (904, [float("nan")] * 3), (905, [float("inf"), 0.0, 0.0])]
    rows += [(906, [3.0]), (907, [-2.0]), (908, [0.0, -0.0]), (909, [0.001, -0.001])]
    check(spark, rows)


def test_fewer_components_than_dimensions(spark):
    rows = [(k, [float(k), 2.0 * k, -float(k), 5.0, 0.0]) for k in range(20)]
    got = check(spark, rows)
    assert {r.component for r in got} == {1} and len(got) == 20


def test_one_vector_and_no_rows_give_nothing(spark):
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    empty = whiten(frame(spark, []))
    assert empty.count() == 0 and empty.columns == [f.split()[0] for f in whitening.RESULT.split(", ")]


def test_large_numbers_stay_exact(spark):
    draw = random.Random(12)
    rows = [(k, [draw.uniform(-1e7, 1e7), 1e9 + draw.uniform(0, 1e3), draw.gauss(0, 1)]) for k in range(40)]
    check(spark, rows, 1e-7)
    rows = [(k, [draw.uniform(-1e14, 1e14), draw.uniform(-1e14, 1e14)]) for k in range(40)]
    assert all(r.deviation is None for r in check(spark, rows, 1e-7))
    wild = whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0])])).collect()
    assert {r.vec_id for r in wild} == {1, 2, 3} and all(math.isfinite(r.whitened) for r in wild)


def test_sums_of_squares_in_both_forms():
    draw = np.random.default_rng(1)
    y = draw.integers(-1000, 1000, (50, 7))
    small, wide = whitening.square_sums(y), whitening.square_sums(y * (1 << 40))
    assert small.dtype == np.int64 and wide.dtype == object
    assert (wide == small.astype(object) * (1 << 80)).all()
    assert small[2, 5] == ((y[:, 2] + y[:, 5]) ** 2).sum() and small[3, 3] == (y[:, 3] ** 2).sum()
