"""Node tables and walks against the models they come from."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featureflow.plans.forest import importances, node_table, predicted, walk
from featureflow.plans.training import random_forest


@pytest.fixture(scope="module")
def table(spark):
    """A categorical slot of five values, three numbers, three classes."""
    noise = F.rand(5)
    label = F.when(F.col("id") % 5 == 2, 2.0).when(noise + F.col("a") > 1.2, 1.0).otherwise(0.0)
    rows = spark.range(1500).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"))
    rows = rows.select("id", array_to_vector(F.array((F.col("id") % 5).cast("double"), "a", "b", "c")).alias("raw"), label.alias("label"))
    return rows


@pytest.mark.parametrize("depth", [0, 1, 6])
def test_walk_gives_the_votes_of_the_model(spark, table, depth):
    from pyspark.ml.feature import VectorIndexer

    indexed = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(table).transform(table)
    model = random_forest("features", "label", trees=5, maxDepth=depth).fit(indexed)
    nodes = node_table(spark, model)
    assert nodes.count() == sum(tree.numNodes for tree in model.trees)
    if depth == 6:
        assert nodes.where("categories is not null").count() > 0
    votes = {r["id"]: r for r in walk(nodes, indexed, ["id"], model).withColumn("class", predicted()).collect()}
    scored = model.transform(indexed).collect()
    assert len(votes) == len(scored) == 1500
    for row in scored:
        assert votes[row["id"]]["votes"] == pytest.approx(list(row["rawPrediction"]), abs=1e-9)
    ties = sum(votes[r["id"]]["class"] != r["prediction"] for r in scored)
    assert ties == 0
    got = {r["slot"]: r["importance"] for r in importances(nodes).collect()}
    want = {i: v for i, v in enumerate(model.featureImportances.toArray()) if v > 0}
    assert got == pytest.approx(want)


def test_walk_is_whole_without_rows(spark, table):
    features = table.withColumnRenamed("raw", "features")
    model = random_forest("features", "label", trees=2, maxDepth=2).fit(features)
    assert walk(node_table(spark, model), features.limit(0), ["id"], model).collect() == []


def test_inner_nodes_are_not_joined_by_a_product(spark, table):
    features = table.withColumnRenamed("raw", "features")
    model = random_forest("features", "label", trees=2, maxDepth=2).fit(features)
    plan = walk(node_table(spark, model), features, ["id"], model)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
