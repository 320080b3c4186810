"""Univariate feature selection by analysis of variance (FEA7)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import (
    UnivariateFeatureSelector,
    UnivariateFeatureSelectorModel,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.dimensions import dim_table
from .stacking import SLOT, VALUE, per_slot, stack_columns


def top_share(
    features: str = "scaledFeatures",
    label: str = "target",
    name: str = "selectedFeatures",
    share: float = 0.75,
) -> UnivariateFeatureSelector:
    """Selector of the best ``share`` of continuous slots for a categorical label."""
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol=name, selectionMode="percentile"
    )
    return (
        selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(share)
    )


def _f_scores(groups: DataFrame) -> DataFrame:
    """Slot and F statistic; infinite for perfectly split groups, null where undefined.

    ``groups`` has one row per slot and label: count, mean and variance.
    """
    slot = Window.partitionBy(SLOT)
    total = F.sum(F.col("n") * F.col("mean")).over(slot)
    grand = F.try_divide(total, F.sum("n").over(slot))
    spread = groups.withColumn("grand", grand).groupBy(SLOT).agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("variance")).alias("within"),
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
    )
    between = F.try_divide("between", F.col("k") - 1)
    within = F.try_divide("within", F.col("n") - F.col("k"))
    split = (F.col("within") == 0) & (F.col("between") > 0)
    score = F.when(split, F.lit(math.inf)).otherwise(F.try_divide(between, within))
    return spread.select(SLOT, score.alias("f_score"))


def _stacked_groups(stacked: DataFrame, label: str) -> DataFrame:
    return stacked.groupBy(SLOT, label).agg(
        F.count(VALUE).alias("n"), F.mean(VALUE).alias("mean"), F.var_pop(VALUE).alias("variance")
    )


def _vector_groups(df: DataFrame, features: str, label: str, weight: str | None = None) -> DataFrame:
    """Count, mean and variance of every slot by label, from sums over the stored entries of the vectors."""
    sums = Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s")
    times = F.lit(1.0) if weight is None else F.max(weight)
    groups = df.groupBy(label).agg(sums, times.alias("times"))
    n = F.col("s.count")
    slots = F.arrays_zip(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("variance")
    )
    rows = groups.select(n.alias("n"), "times", F.posexplode(slots).alias(SLOT, "slot"))
    variance = F.col("slot.variance") * F.try_divide(F.col("n") - 1, F.col("n"))
    return rows.select(SLOT, (F.col("n") * F.col("times")).alias("n"), F.col("slot.mean").alias("mean"), variance.alias("variance"))


def anova_scores(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """F statistic of each column across the label groups."""
    scores = _f_scores(_stacked_groups(stack_columns(df, columns, keep=[label]), label))
    return scores.select(per_slot(columns).alias("column_name"), "f_score")


def top_share_by_score(
    df: DataFrame,
    features: str = "scaledFeatures",
    label: str = "target",
    name: str = "selectedFeatures",
    share: float = 0.75,
    weight: str | None = None,
) -> VectorSlicer:
    """Slicer of the best ``share`` of slots, ranked by F statistic instead of p value.

    ``weight`` may name a column with one weight for all rows of a label: a row
    counts as so many.

    Both rank alike until p values round to zero, which on large tables they
    do for most features: ``top_share`` then keeps the first slots, whatever
    their strength. Slots keep their order, as there. Zeros of sparse vectors
    cost nothing: one row per label is shuffled, no row per slot.
    """
    scores = _f_scores(_vector_groups(df, features, label, weight)).collect()
    # One row per vector slot.
    ranked = sorted(scores, key=lambda r: (-(-1.0 if r["f_score"] is None else r["f_score"]), r[SLOT]))
    best = sorted(row[SLOT] for row in ranked[: int(len(ranked) * share)])
    return VectorSlicer(inputCol=features, outputCol=name, indices=best)


def selected_columns(spark, model: UnivariateFeatureSelectorModel, columns: Sequence[str]) -> DataFrame:
    """Slot and name of the features a fitted selector keeps."""
    rows = [(int(i), columns[i]) for i in model.selectedFeatures]
    return dim_table(spark, rows, "slot int, column_name string")
