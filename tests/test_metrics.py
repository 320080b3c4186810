import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from featureflow.operators import metrics


def test_confusion_and_quality(spark):
    data = [("yes", 1.0)] * 3 + [("no", 1.0)] * 2 + [("yes", 0.0)] + [("no", 0.0)] * 4
    df = spark.createDataFrame(data, "label string, prediction double")
    table = metrics.confusion_matrix(df, "label", positive="yes", negative="no")
    row = metrics.prediction_quality(table).first()
    assert tuple(row) == (3, 2, 1, 4, 0.7, 0.6, 0.75)


def test_recorded_quality(spark):
    df = spark.createDataFrame([(1415, 447, 1013, 2156)], "tp bigint, fp bigint, fn bigint, tn bigint")
    row = metrics.prediction_quality(df).first()
    assert [round(row[i], 4) for i in (4, 5, 6)] == [0.7098, 0.7599, 0.5828]


def test_empty_denominators_are_null(spark):
    df = spark.createDataFrame([(0, 0.0)], "target int, prediction double")
    row = metrics.prediction_quality(metrics.confusion_matrix(df)).first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (1.0, None, None)


def test_confusion_is_one_aggregate(spark):
    df = spark.createDataFrame([(0, 0.0)], "target int, prediction double")
    plan = metrics.confusion_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Exchange") <= 1


@pytest.mark.parametrize("kind", ["continuous", "hot", "constant"])
def test_auc_equals_the_evaluator(spark, kind):
    rng = np.random.default_rng(4)
    n = 3000
    y = rng.integers(0, 2, n)
    score = {
        "continuous": rng.normal(size=n) + y,
        "hot": np.where(rng.random(n) < 0.4, 0.5, np.round(rng.random(n) + 0.2 * y, 2)),
        "constant": np.zeros(n),
    }[kind]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, score)], "y double, s double")
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    want = evaluator.evaluate(df)
    assert metrics.area_under_roc(df.repartition(5), "y", "s") == pytest.approx(want, abs=1e-12)
    assert metrics.binned_area_under_roc(df, "y", "s") == pytest.approx(want, abs=0.01)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.5)], "y double, s double")
    assert metrics.area_under_roc(df, "y", "s") is None
    assert metrics.area_under_roc(df.limit(0), "y", "s") is None


def test_multiclass_accuracy_equals_the_evaluator(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 7 % 3).cast("double").alias("p")
    )
    evaluator = MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="p", metricName="accuracy"
    )
    row = metrics.multiclass_accuracy(df, "label", "p").first()
    assert row["accuracy"] == pytest.approx(evaluator.evaluate(df))
    assert row["test_error"] == pytest.approx(1 - row["accuracy"])
