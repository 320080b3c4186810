"""The two use cases from file to model to batch and stream output, on small made-up files."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featureflow.functions import binary_target, columns_of_type, drop_positions, format_message
from featureflow.operators.joins import join_dimension
from featureflow.operators.metrics import confusion_matrix, multiclass_accuracy, prediction_quality
from featureflow.operators.profile import group_counts, numeric_summary
from featureflow.operators.sampling import random_split
from featureflow.plans.scoring import assemble_features, label_lines, score, write_positive_ids
from featureflow.plans.training import ChurnFlow, fit_forest
from featureflow.schemas import (
    CHURN_NEGATIVE,
    CHURN_POSITIVE,
    CHURN_SCHEMA,
    IRIS_CLASSES,
    IRIS_CLASSES_SCHEMA,
    IRIS_FEATURES,
    IRIS_FEATURES_SCHEMA,
    IRIS_SCHEMA,
)
from featureflow.sinks import save_model, start_batches, start_stream, wait, write_libsvm, write_messages
from featureflow.sources import dim_table, load_model, read_csv, read_libsvm, read_text_stream
from featureflow.streaming import score_batches, score_keys, score_labels


@pytest.fixture(scope="module")
def iris_model(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("iris")
    rng = np.random.default_rng(8)
    centres = [(5.0, 3.4, 1.5, 0.2), (5.9, 2.8, 4.3, 1.3), (6.6, 3.0, 5.6, 2.0)]
    data = [
        (float(k), Vectors.dense(np.abs(rng.normal(c, 0.2)).round(2).tolist()))
        for k, c in enumerate(centres)
        for _ in range(50)
    ]
    write_libsvm(spark.createDataFrame(data, ["label", "features"]), str(folder / "data"))
    table = read_libsvm(spark, str(folder / "data"), 4)
    train, test = random_split(table)
    model = fit_forest(train, labels_from=table)
    accuracy = multiclass_accuracy(score(model, test), "indexedLabel", "prediction").first()
    assert accuracy["accuracy"] > 0.9
    save_model(model, str(folder / "model"))
    return load_model(str(folder / "model"))


IRIS_LINES = ["5.0,3.4,1.5,0.2", "4.9,3,1.4,0.2", "6,2.8,4.4,1.3", "6.6,3.1,5.6,2.1"]
IRIS_WANT = [
    "4.9,3.0,1.4,0.2,0.0,Iris-setosa",
    "5.0,3.4,1.5,0.2,0.0,Iris-setosa",
    "6.0,2.8,4.4,1.3,1.0,Iris-versicolor",
    "6.6,3.1,5.6,2.1,2.0,Iris-virginica",
]


def test_iris_batch_lines_and_messages(spark, iris_model, tmp_path):
    path = tmp_path / "iris.csv"
    path.write_text(",".join(IRIS_SCHEMA.names) + "\n" + "\n".join(IRIS_LINES[:2]) + "\n\n"
                    + "\n".join(line + ",unknown" for line in IRIS_LINES[2:]))
    features = assemble_features(read_csv(spark, str(path), IRIS_SCHEMA), IRIS_FEATURES)
    dim = dim_table(spark, IRIS_CLASSES, IRIS_CLASSES_SCHEMA)
    scored = score(iris_model, features)
    assert sorted(r["value"] for r in label_lines(scored, dim, "iris_id", "iris_value").collect()) == IRIS_WANT
    out = str(tmp_path / "messages")
    named = join_dimension(scored, dim, "predictedLabel", "iris_id")
    write_messages(named, format_message("predictedLabel", "iris_value"), "text", {"path": out})
    messages = sorted(r[0] for r in spark.read.text(out).collect())
    assert messages == [
        "Prediction: 0.0 - Iris-setosa",
        "Prediction: 0.0 - Iris-setosa",
        "Prediction: 1.0 - Iris-versicolor",
        "Prediction: 2.0 - Iris-virginica",
    ]


@pytest.mark.parametrize("style", ["stream", "batches"])
def test_iris_stream(spark, iris_model, tmp_path, style):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.txt").write_text('"5.0","3.4",1.5,0.2\n' + "\n".join(IRIS_LINES[1:]) + "\n")
    lines = read_text_stream(spark, "text", {"path": str(folder)})
    dim = dim_table(spark, IRIS_CLASSES, IRIS_CLASSES_SCHEMA)

    def scored(df):
        return score_labels(
            df, iris_model, IRIS_FEATURES_SCHEMA, dim, "iris_id", "iris_value", mode="strict"
        )

    progress = str(tmp_path / "progress")
    if style == "stream":
        wait(start_stream(scored(lines), progress, "parquet", {"path": out}, every=None), 120)
    else:
        wait(start_batches(lines, score_batches(scored, out), progress, every=None), 120)
    assert sorted(r["value"] for r in spark.read.parquet(out).select("value").collect()) == IRIS_WANT


def churn_text(n=500, seed=9):
    rng = np.random.default_rng(seed)
    lines = []
    for i in range(n):
        leaves = rng.random() < 0.2
        limit, balance = rng.uniform(1000, 30000), rng.integers(0, 2500)
        count = int(rng.normal(45 if leaves else 70, 12))
        values = [
            700000000 + i, CHURN_POSITIVE if leaves else CHURN_NEGATIVE, rng.integers(26, 70),
            "MF"[rng.integers(0, 2)], rng.integers(0, 5), ["Graduate", "High School"][rng.integers(0, 2)],
            ["Married", "Single"][rng.integers(0, 2)], ["Less than $40K", "$80K - $120K"][rng.integers(0, 2)],
            ["Blue", "Silver", "Gold"][rng.integers(0, 3)], rng.integers(13, 56), rng.integers(1, 6),
            rng.integers(0, 6), rng.integers(0, 6), round(limit, 1), balance, round(limit - balance, 1),
            round(rng.random() + 0.3, 3), count * 60, count, round(rng.random() + 0.2, 3),
            round(balance / limit, 3), round(rng.random(), 5), round(rng.random(), 5),
        ]
        lines.append(",".join(str(v) for v in values))
    return lines


def test_churn_from_file_to_batch_and_stream(spark, tmp_path):
    lines = churn_text()
    path = tmp_path / "customers.csv"
    path.write_text(",".join(CHURN_SCHEMA.names) + "\n" + "\n".join(lines) + "\n")
    raw = read_csv(spark, str(path))
    assert raw.dtypes == spark.createDataFrame([], CHURN_SCHEMA).dtypes

    keyed = drop_positions(raw, (-2, -1))
    numeric = columns_of_type(keyed, exclude=["CLIENTNUM"])
    categorical = columns_of_type(keyed, ["string"], exclude=["Attrition_Flag"])
    assert (len(numeric), len(categorical)) == (14, 5)
    assert numeric_summary(keyed, numeric).count() == 14
    assert group_counts(keyed, "Customer_Age").agg(F.sum("count")).first()[0] == 500

    table = binary_target(keyed, "Attrition_Flag", CHURN_NEGATIVE)
    flow = ChurnFlow(numeric, categorical, ["CLIENTNUM"], regression={"regParam": 0.01, "elasticNetParam": 0.0})
    train, _ = flow.split(table)
    model = flow.fit(train)
    kept = model.stages[2].getInputCols()
    assert "Credit_Limit" not in kept and "Avg_Open_To_Buy" in kept
    assert "Total_Trans_Ct" not in kept and "Total_Trans_Amt" in kept
    save_model(model, str(tmp_path / "model"))
    model = load_model(str(tmp_path / "model"))

    scored = score(model, raw)
    confusion = confusion_matrix(scored, "Attrition_Flag", positive=CHURN_POSITIVE, negative=CHURN_NEGATIVE)
    quality = prediction_quality(confusion).first()
    assert quality["tp"] + quality["fp"] + quality["fn"] + quality["tn"] == 500
    assert quality["accuracy"] > 0.7 and quality["recall"] > 0.6

    write_positive_ids(model, read_csv(spark, str(path), CHURN_SCHEMA), "CLIENTNUM", str(tmp_path / "ids"), 1)
    ids = {int(r[0]) for r in spark.read.csv(str(tmp_path / "ids")).collect()}
    want = {r["CLIENTNUM"]: r["prediction"] for r in scored.select("CLIENTNUM", "prediction").collect()}
    assert ids == {key for key, prediction in want.items() if prediction == 1.0}

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(lines[:200]) + "\n")
    (folder / "b.txt").write_text("\n".join(lines[200:]) + "\n")
    stream = read_text_stream(spark, "text", {"path": str(folder)})
    out = score_keys(stream, model, CHURN_SCHEMA, "CLIENTNUM", mode="strict")
    options = {"path": str(tmp_path / "out")}
    wait(start_stream(out, str(tmp_path / "progress"), "parquet", options, every=None), 120)
    got = sorted(r["value"] for r in spark.read.parquet(options["path"]).collect())
    assert got == sorted(f"{key},{prediction}" for key, prediction in want.items())
