"""The two searches against brute force."""

from functools import reduce
from operator import add, mul

import numpy as np
import pytest

from featureflow.llm import vectors
from featureflow.llm.nearest import nearest_neighbours
from featureflow.llm.topk import top_scores

NAN, INF = float("nan"), float("inf")
ODD = [
    (1000, None),
    (1001, []),
    (1002, [0.0] * 8),
    (1003, [1.0] * 7 + [None]),
    (1004, [1.0] * 7 + [NAN]),
    (1005, [1.0] * 7 + [INF]),
    (None, [1.0] * 8),
    (1020, [0.5] * 3),
    (1021, [0.25] * 3),
    (1040, [0.0] * 8),
]


def table(spark, rows):
    extra = [(i, v, 1.0, 2, 3) for i, v in rows]
    return spark.createDataFrame(extra, "vec_id long, embedding array<float>, score double, rank int, query_id int")


def brute_force(rows, change, zero):
    """Answers of every query row, all rows but itself being candidates, in the order of their text."""
    vecs = []
    for i, v in rows:
        if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            vecs.append((i, [change(float(np.float32(x))) for x in v]))
    out = []
    for k, (q, a) in enumerate(vecs):
        if q % 20 == 0:
            scored = [(-reduce(add, map(mul, a, b)), i) for c, (i, b) in enumerate(vecs) if c != k and len(a) == len(b)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:20], 1)]
    return sorted(out)


@pytest.fixture(params=[(4096, 4096), (7, 8)])
def rows(request, monkeypatch):
    """Random vectors, some equal, some under one id; also with more than 50 blocks of candidates."""
    monkeypatch.setattr(vectors, "QUERY_BLOCK", request.param[0])
    monkeypatch.setattr(vectors, "BLOCK", request.param[1])
    draw = np.random.default_rng(5)
    some = draw.normal(0, 0.3, (400, 8)).astype(np.float32)
    some[50:60] = some[40]
    some[::31] *= 40
    made = [(k, v.tolist()) for k, v in enumerate(some)]
    return made + ODD + [(20, made[3][1]), (20, made[20][1]), (21, made[21][1])]


@pytest.mark.parametrize(
    ("search", "change", "zero"), [(nearest_neighbours, float, False), (top_scores, lambda x: int(np.floor(64 * x)), True)]
)
def test_search_matches_brute_force(spark, rows, search, change, zero):
    found = search(table(spark, rows).repartition(3)).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
    assert got == brute_force(rows, change, zero)


@pytest.mark.parametrize("search", [nearest_neighbours, top_scores])
def test_empty_and_single(spark, search):
    assert search(table(spark, [])).count() == 0
    assert search(table(spark, [(0, [1.0, 2.0])])).count() == 0
    assert search(table(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0])])).count() == 1


def test_huge_components_are_exact(spark):
    rows = [(0, [3e20, 1.0]), (1, [2e20, -5.0]), (2, [1.0, 1.0]), (3, [-3e38, 0.0]), (20, [1.0, 2.0])]
    got = top_scores(table(spark, rows)).where("query_id = 20").orderBy("rank").collect()
    ends = (1 << 63) - 1
    assert [(r.vec_id, r.score) for r in got] == [(0, ends), (1, ends), (2, 64 * 64 + 64 * 128), (3, -ends)]


@pytest.mark.parametrize("search", [nearest_neighbours, top_scores])
def test_rows_of_one_id_are_all_candidates(spark, search):
    rows = [(1, [1.0, 0.5]), (1, [0.25, 0.125]), (1, [0.25, 0.125]), (20, [1.0, 1.0])]
    got = search(table(spark, rows)).orderBy("rank").collect()
    unit = 1 if search is nearest_neighbours else 64 * 64
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(20, 1, 1.5 * unit), (20, 1, 0.375 * unit), (20, 1, 0.375 * unit)]


@pytest.mark.parametrize(("name", "search"), [("op5_nearest", nearest_neighbours), ("op6_top_scores", top_scores)])
def test_sql_over_repeated_ids(spark, rows, name, search):
    import duckdb
    import pyarrow as pa

    from featureflow.llm.queries import SQL

    ids, found = zip(*rows, strict=True)
    connection = duckdb.connect()
    connection.register("embeddings", pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(found, pa.list_(pa.float32()))}))
    want = sorted(connection.execute(SQL[name]).fetchall())
    got = search(table(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == want
