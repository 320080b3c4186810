import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from featureflow.functions import slice_vector, vector_elements
from featureflow.operators import encoding, joins
from featureflow.operators.scaling import min_max
from featureflow.operators.selection import (
    anova_scores,
    selected_columns,
    top_share,
    top_share_by_score,
)


def colours(spark):
    data = ["red"] * 3 + ["blue"] * 5 + ["ash"] * 3 + ["tan"]
    return spark.createDataFrame([(i, c) for i, c in enumerate(data)], "id int, colour string")


def test_index_order_and_labels(spark, rows):
    df = colours(spark)
    model = encoding.index_columns(["colour"]).fit(df)
    assert list(model.labelsArray[0]) == ["blue", "ash", "red", "tan"]
    assert rows(encoding.labels_table(spark, model)) == [
        ("colour", "ash", 1.0),
        ("colour", "blue", 0.0),
        ("colour", "red", 2.0),
        ("colour", "tan", 3.0),
    ]
    assert "colour_Indexed" in model.transform(df).columns


def test_scoring_rows_without_the_label_skip_its_indexer(spark):
    model = encoding.index_label("label", "indexedLabel").fit(
        spark.createDataFrame([(0.0,), (1.0,)], "label double")
    )
    assert model.transform(colours(spark)).columns == ["id", "colour"]


def test_one_hot_drops_the_last_category(spark):
    df = colours(spark)
    stages = [encoding.index_columns(["colour"]), encoding.encode_columns(["colour_Indexed"])]
    coded = Pipeline(stages=stages).fit(df).transform(df)
    values = {
        r["colour"]: list(r["v"])
        for r in coded.select("colour", vector_to_array("colour_Indexed_Coded").alias("v")).collect()
    }
    assert values["blue"] == [1.0, 0.0, 0.0] and values["tan"] == [0.0, 0.0, 0.0]


def test_null_feature_fails_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        encoding.assemble(["a", "b"]).transform(df).collect()
    assert encoding.assemble(["a", "b"], handle_invalid="skip").transform(df).count() == 1
    assert encoding.assemble(["a", "b"], handle_invalid="keep").transform(df).count() == 2


def test_category_index_of_any_size(spark, rows):
    """Ties, many partitions, a hot value and nulls; both join ways give the same."""
    data = [("hot",)] * 300 + [(f"v{i % 150:03d}",) for i in range(400)] + [(None,)] * 3
    df = spark.createDataFrame(data, "v string").repartition(6)
    index = encoding.category_index(df, "v")
    got = {r["v"]: (r["index"], r["rows"]) for r in index.collect()}
    counts = {}
    for (v,) in data:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    want = sorted(counts, key=lambda v: (-counts[v], v))
    assert {v: i for v, (i, _) in got.items()} == {v: i for i, v in enumerate(want)}
    assert {v: n for v, (_, n) in got.items()} == counts
    for hot in (0, 1, 40, 1000):
        attached = encoding.attach_index(df, index, "v", "i", hot=hot)
        pairs = rows(attached.select("v", "i"))
        assert len(pairs) == len(data)
        assert all(i == (got[v][0] if v else None) for v, i in pairs)


def test_vector_access(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    df = df.select(array_to_vector("v").alias("v"))
    row = vector_elements(df, "v", ["a", "b"]).first()
    assert (row["a"], row["b"]) == (1.0, 2.0)
    assert list(slice_vector(df, "v", [2, 0], "s").first()["s"]) == [3.0, 1.0]
    plan = vector_elements(df, "v", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_min_max(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, b double")
    stages = [encoding.assemble(["a", "b"]), min_max()]
    scaled = Pipeline(stages=stages).fit(df).transform(df)
    assert [list(r[0]) for r in scaled.select("scaledFeatures").collect()] == [
        [0.0, 0.5],
        [1.0, 0.5],
        [0.5, 0.5],
    ]


def test_anova_ranks_as_the_selector(spark):
    rng = np.random.default_rng(0)
    n, names = 600, list("abcdefgh")
    label = rng.integers(0, 3, n)
    data = rng.normal(size=(n, 8)) + np.outer(label, [0.0, 0.5, 0.1, 0.0, 0.3, 0.0, 0.2, 0.05])
    rows = [(float(y), *map(float, x)) for y, x in zip(label, data)]
    df = spark.createDataFrame(rows, "target double, " + ", ".join(f"{c} double" for c in names))
    scores = {r["column_name"]: r["f_score"] for r in anova_scores(df, names, "target").collect()}
    groups = [data[label == k] for k in range(3)]
    between = sum(len(g) * (g.mean(0) - data.mean(0)) ** 2 for g in groups) / 2
    within = sum(((g - g.mean(0)) ** 2).sum(0) for g in groups) / (n - 3)
    assert [scores[c] for c in names] == pytest.approx(list(between / within))
    stages = [encoding.assemble(names), top_share(features="features")]
    model = Pipeline(stages=stages).fit(df).stages[-1]
    kept = {r["column_name"] for r in selected_columns(spark, model, names).collect()}
    assert kept == set(sorted(names, key=scores.get, reverse=True)[:6])
    slicer = top_share_by_score(encoding.assemble(names).transform(df), "features")
    assert slicer.getIndices() == sorted(model.selectedFeatures)


def test_score_of_constant_split_and_missing_columns(spark):
    data = [(y, 7.0, float(y), None, float(i)) for i, y in enumerate([0, 0, 1, 1])]
    df = spark.createDataFrame(data, "target int, c double, s double, m double, x double")
    scores = {r[0]: r[1] for r in anova_scores(df, ["c", "s", "m", "x"], "target").collect()}
    assert scores["c"] is None and scores["m"] is None
    assert scores["s"] == float("inf") and scores["x"] == pytest.approx(8.0)
    one = anova_scores(df.filter("target = 0"), ["x"], "target").first()
    assert one["f_score"] is None


def test_strong_features_are_kept_where_p_values_are_zero(spark):
    """Four strong slots come last; all p values round to zero, so the stock order is by slot."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    names = list("abcdefgh")
    shift = [0.6, 0.6, 0.6, 0.6, 5.0, 5.0, 5.0, 5.0]
    data = [(int(k), *map(float, rng.normal(0, 1, 8) + k * np.array(shift))) for k in y]
    df = spark.createDataFrame(data, "target int, " + ", ".join(f"{c} double" for c in names))
    vectors = encoding.assemble(names).transform(df)
    assert top_share_by_score(vectors, "features", share=0.5).getIndices() == [4, 5, 6, 7]
    stock = top_share(features="features", share=0.5).fit(vectors)
    assert sorted(stock.selectedFeatures) == [0, 1, 2, 3]


def test_dimension_join_casts_and_drops(spark, rows):
    facts = spark.createDataFrame([("0.0",), ("1.0",), ("1.5",), ("x",), ("9.0",), (None,)], "p string")
    dim = spark.createDataFrame([(0, "zero"), (1, "one")], "id int, name string")
    joined = joins.join_dimension(facts, dim, "p", "id")
    assert rows(joined) == [("0.0", 0, "zero"), ("1.0", 1, "one")]
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_dimension_join_is_planned_by_size(spark):
    facts = spark.range(10).withColumn("f", F.col("id"))
    dim = spark.range(50).withColumnRenamed("id", "k")
    joined = joins.join_dimension(facts, dim, "f", "k")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.count() == 10


def test_dimension_join_keeps_every_digit(spark, rows):
    big = 9007199254740993
    dim = spark.createDataFrame([(big - 1, "wrong"), (big, "right"), (30, "thirty")], "k bigint, name string")
    numbers = spark.createDataFrame([(big,), (30,), (None,)], "f bigint")
    assert rows(joins.join_dimension(numbers, dim, "f", "k").select("name")) == [("right",), ("thirty",)]
    texts = spark.createDataFrame([(str(big),), (f"{big}.0",), ("3e1",), ("30.5",), ("x",)], "f string")
    assert rows(joins.join_dimension(texts, dim, "f", "k").select("name")) == [("right",), ("right",), ("thirty",)]
    small = spark.createDataFrame([(1, "one")], "k int, name string")
    wide = spark.createDataFrame([(1,), (1 + (1 << 32),)], "f bigint")
    assert rows(joins.join_dimension(wide, small, "f", "k").select("f")) == [(1,)]

