"""A fitted forest as a table of nodes, and its predictions by a walk of joins (MDL2, MDL6, MDL8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

NODE = ("tree", "node")


def node_table(spark: SparkSession, model: RandomForestClassificationModel, path: str | None = None) -> DataFrame:
    """One row per node of every tree, read back from the saved model: nothing passes through the driver.

    ``tree, node`` (the root is node 0), ``prediction, impurity, gain, stats``
    (training weight per class), ``slot, threshold, categories, left, right``.
    A row goes left if its slot is at most ``threshold`` or, where the slot is
    categorical, one of ``categories``. Leaves have null from ``gain`` and ``slot`` on.
    """
    path = path or work_path(spark, "forest")
    model.write().overwrite().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    categorical = split["numCategories"] >= 0
    values = split["leftCategoriesOrThreshold"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["prediction"].alias("prediction"),
        node["impurity"].alias("impurity"),
        node["impurityStats"].alias("stats"),
        F.when(inner, node["gain"]).alias("gain"),
        F.when(inner, split["featureIndex"]).alias("slot"),
        F.when(inner & ~categorical, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & categorical, values).alias("categories"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
    )


def levels(model: RandomForestClassificationModel) -> int:
    """Steps from the root to the deepest leaf."""
    return max((tree.depth for tree in model.trees), default=0)


def walk(
    nodes: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    model: RandomForestClassificationModel,
    features: str = "features",
) -> DataFrame:
    """``keys`` and the ``votes`` per class of the trees in ``nodes``, level by level; ``model`` gives their numbers only.

    ``keys`` are unique per row. Every row starts at the root of each tree; a level is a join with the inner
    nodes, which Spark broadcasts if they are below its size limit, and rows at
    a leaf stay. At the end the leaves' class shares are summed per key: a key's
    rows are in one task by then, so one partial row per key is shuffled.
    """
    inner = nodes.where(F.col("slot").isNotNull()).select(*NODE, "slot", "threshold", "categories", "left", "right")
    leaves = nodes.where(F.col("slot").isNull()).select(*NODE, "stats")
    tree = F.explode(F.sequence(F.lit(0), F.lit(model.getNumTrees - 1))).alias("tree")
    at = df.select(*keys, vector_to_array(features).alias("_values"), tree).withColumn("node", F.lit(0))
    value = F.get("_values", "slot")
    is_left = F.when(F.col("categories").isNull(), value <= F.col("threshold")).otherwise(
        F.array_contains("categories", value)
    )
    step = F.when(F.col("slot").isNull(), F.col("node")).when(is_left, F.col("left")).otherwise(F.col("right"))
    for _ in range(levels(model)):
        at = at.join(inner, list(NODE), "left").select(*keys, "_values", "tree", step.alias("node"))
    reached = at.join(leaves, list(NODE)).withColumn("_rows", _total("stats"))
    votes = [F.sum(F.get("stats", F.lit(i)) / F.col("_rows")) for i in range(model.numClasses)]
    return reached.groupBy(*keys).agg(F.array(*votes).alias("votes"))


def predicted(votes: str = "votes", digits: int = 9) -> Column:
    """The class of most votes, the least on ties; votes are rounded, as they were summed in any order."""
    level = F.transform(votes, lambda v: F.round(v, digits))
    return (F.array_position(level, F.array_max(level)) - 1).cast("double")


def importances(nodes: DataFrame) -> DataFrame:
    """Slot and its share of the gain, each tree's gains weighted by its training rows and summing to 1."""
    gains = nodes.where(F.col("slot").isNotNull()).groupBy("tree", "slot").agg(
        F.sum(F.col("gain") * _total("stats")).alias("gain")
    )
    per_tree = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
    shares = gains.join(per_tree, "tree").where("all > 0").withColumn("share", F.col("gain") / F.col("all"))
    trees = per_tree.where("all > 0").count()
    return shares.groupBy("slot").agg((F.sum("share") / F.lit(trees)).alias("importance"))


def _total(stats: str) -> Column:
    return F.aggregate(stats, F.lit(0.0), lambda sum_, v: sum_ + v)
