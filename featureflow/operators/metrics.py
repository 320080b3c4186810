"""Classification metrics (AGG8-AGG12)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.dimensions import dim_table
from .stacking import SLOT, VALUE


def confusion_matrix(
    df: DataFrame,
    label: str = "target",
    prediction: str = "prediction",
    positive: Any = 1,
    negative: Any = 0,
) -> DataFrame:
    """tp, fp, fn, tn from one aggregate. Labels may be any two values; predictions are 1 and 0."""
    is_positive, is_negative = F.col(label) == positive, F.col(label) == negative
    says_positive, says_negative = F.col(prediction) == 1, F.col(prediction) == 0
    return df.agg(
        F.count_if(is_positive & says_positive).alias("tp"),
        F.count_if(is_negative & says_positive).alias("fp"),
        F.count_if(is_positive & says_negative).alias("fn"),
        F.count_if(is_negative & says_negative).alias("tn"),
    )


def prediction_quality(confusion: DataFrame) -> DataFrame:
    """Accuracy, precision and recall; null where there is nothing to divide by."""
    hits = F.col("tp") + F.col("tn")
    return confusion.withColumns(
        {
            "accuracy": F.try_divide(hits, hits + F.col("fp") + F.col("fn")),
            "precision": F.try_divide("tp", F.col("tp") + F.col("fp")),
            "recall": F.try_divide("tp", F.col("tp") + F.col("fn")),
        }
    )


def multiclass_accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows where prediction and label agree, and the rest as test error."""
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy")).withColumn("test_error", 1 - F.col("accuracy"))


def area_under_roc(df: DataFrame, label: str, score: str) -> float | None:
    """Exact area under ROC: the share of (positive, negative) pairs ranked right; see ``areas_under_roc``."""
    return areas_under_roc(df, label, [score])[0]


def areas_under_roc(df: DataFrame, label: str, scores: Sequence[str]) -> list[float | None]:
    """Exact area under ROC of several scores, from one scan and one range partitioning.

    A score is a number or a model's raw vector. Rows are reduced to counts
    per distinct score before they are dealt to ranges, so a score shared by
    many rows is one row of one range. Each range gives one row, and they are
    put together in order of their least scores: neither the number of
    partitions nor a task that runs again changes the result. Rows without a
    score or label are left out; null if a class is missing.
    """

    def value(name: str) -> Column:
        number = F.col(name)
        if not isinstance(df.schema[name].dataType, T.NumericType):
            number = F.get(vector_to_array(number), F.lit(1))
        return number.cast("double")

    stacked = F.posexplode(F.array(*map(value, scores))).alias(SLOT, VALUE)
    counts = (
        df.select((F.col(label) > 0.5).alias("y"), stacked)
        .filter(F.col(VALUE).isNotNull() & F.col("y").isNotNull())
        .groupBy(SLOT, VALUE)
        .agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    )
    ranged = counts.repartitionByRange(SLOT, VALUE).withColumn("part", F.spark_partition_id())
    below = F.sum("neg").over(Window.partitionBy("part", SLOT).orderBy(VALUE)) - F.col("neg")
    ranges = ranged.withColumn("won", F.col("pos") * (below + F.col("neg") / 2)).groupBy(SLOT, "part").agg(
        F.min(VALUE).alias("low"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won")
    )
    sums = [[0.0, 0.0, 0.0] for _ in scores]
    # One row per range; NaN is the greatest score, as in Spark's order.
    for row in sorted(ranges.collect(), key=lambda r: (r[SLOT], math.isnan(r["low"]), r["low"])):
        below, positives, won = sums[row[SLOT]]
        sums[row[SLOT]] = [below + row["neg"], positives + row["pos"], won + row["won"] + row["pos"] * below]
    return [won / (positives * below) if positives and below else None for below, positives, won in sums]


def binned_area_under_roc(df: DataFrame, label: str, score: str, bins: int = 1000) -> float:
    """As the stock evaluator reports it, from a curve thinned to about ``bins`` points."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(df.select(label, score))


def roc_table(df: DataFrame, label: str, score: str) -> DataFrame:
    return dim_table(df.sparkSession, [(area_under_roc(df, label, score),)], "auc double")


def training_summary(spark, model: LogisticRegressionModel) -> DataFrame:
    summary = model.summary
    row = (float(summary.accuracy), float(summary.areaUnderROC), int(summary.totalIterations))
    return dim_table(spark, [row], "accuracy double, auc double, iterations int")
