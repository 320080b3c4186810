import pytest

from featureflow.operators.balance import class_ratio, oversample, replicate_rows
from featureflow.operators.sampling import hash_split, random_split
from featureflow.operators.sets import common_rows, remaining_rows, union_rows


def table(spark, ones, zeros, other=0):
    data = [(i, 1) for i in range(ones)] + [(i, 0) for i in range(zeros)]
    return spark.createDataFrame(data + [(i, None) for i in range(other)], "id int, target int")


@pytest.mark.parametrize(
    "ones,zeros,want",
    [(3, 10, {1: 9, 0: 10}), (5, 5, {1: 5, 0: 5}), (7, 2, {1: 7, 0: 2}), (0, 4, {0: 4}), (4, 0, {1: 4})],
)
def test_oversample_by_the_integer_ratio(spark, ones, zeros, want):
    got = oversample(table(spark, ones, zeros, other=2), "target").groupBy("target").count().collect()
    assert {r["target"]: r["count"] for r in got} == want


def test_recorded_class_counts(spark):
    ratio = class_ratio(table(spark, 1627, 8500), "target").first()
    assert tuple(ratio) == (8500, 1627, 5)
    assert class_ratio(table(spark, 0, 3), "target").first()["ratio"] is None


def test_oversample_has_no_shuffle_of_rows(spark):
    plan = oversample(table(spark, 3, 10), "target")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0] and "Union" not in plan


def test_replicate(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(replicate_rows(df, 2)) == [(1,), (1,), (2,), (2,)]
    assert rows(replicate_rows(df, df["a"] - 1)) == [(2,)]


def test_hash_split_is_stable_and_whole(spark, rows):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = hash_split(df, ["k"])
    again, _ = hash_split(df.repartition(7), ["k"])
    assert rows(train) == rows(again)
    assert sorted(rows(train) + rows(test)) == [(i,) for i in range(2000)]
    assert 0.65 < len(rows(train)) / 2000 < 0.75
    salted, _ = hash_split(df, ["k"], salt="other")
    assert rows(salted) != rows(train)


def test_hash_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,)], "k int")
    train, test = hash_split(df, ["k"])
    assert train.count() + test.count() == 2


def test_random_split(spark):
    parts = random_split(spark.range(1000), (0.5, 0.5), seed=3)
    assert sum(p.count() for p in parts) == 1000


def test_sets(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n int, s string")
    b = spark.createDataFrame([(1, "x")], "n int, s string")
    assert rows(union_rows(a, b)) == [(1, "x")] * 3 + [(2, "y")]
    assert rows(union_rows(b, b.select("s", "n"), by_name=True)) == [(1, "x")] * 2
    assert rows(common_rows(a, b)) == [(1, "x")]
    assert rows(remaining_rows(a, b)) == [(1, "x"), (2, "y")]
