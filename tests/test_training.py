import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featureflow.functions import binary_target
from featureflow.operators.balance import weigh_classes
from featureflow.operators.correlation import _pair_rows
from featureflow.operators.encoding import assemble
from featureflow.operators.joins import join_dimension
from featureflow.operators.metrics import area_under_roc, training_summary
from featureflow.plans.held import held
from featureflow.plans.scoring import label_lines, positive_ids, score, write_positive_ids
from featureflow.plans.training import (
    ChurnFlow,
    coefficient_table,
    fit_forest,
    forest_table,
    importance_table,
    logistic_regression,
)
from featureflow.plans.tuning import (
    best_parameters,
    logistic_grid,
    optimality_residuals,
    tune,
    tuning_report,
    validation_split,
)
from featureflow.schemas import IRIS_CLASSES, IRIS_CLASSES_SCHEMA
from featureflow.sinks import save_model
from featureflow.sources import dim_table, load_model

NUMERIC = ["age", "balance", "limit"]


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(5)
    n = 1200
    leaves = rng.random(n) < 0.2
    data = [
        (i, "Attrited Customer" if y else "Existing Customer", float(rng.normal(40 + 6 * y, 5)), float(b),
         float(2 * b + rng.normal(0, 0.1)), "F" if rng.random() < 0.5 else "M",
         ["Blue", "Gold", "Silver"][int(rng.integers(0, 3))])
        for i, (y, b) in enumerate(zip(leaves, rng.normal(10, 3, n)))
    ]
    df = spark.createDataFrame(
        data, "id int, flag string, age double, balance double, `limit` double, gender string, card string"
    )
    return binary_target(df, "flag", "Existing Customer").persist()


@pytest.fixture(scope="module")
def flow():
    return ChurnFlow(
        NUMERIC, ["gender", "card"], ["id"], regression={"regParam": 0.01, "elasticNetParam": 0.0}
    )


@pytest.fixture(scope="module")
def fitted(customers, flow):
    train, test = flow.split(customers)
    return flow.fit(train), test


def test_split_keeps_copies_out_of_the_test_part(customers, flow):
    train, test = flow.split(customers)
    assert train.join(test, "id").count() == 0
    counts = {r["target"]: r["count"] for r in flow.balanced(train).groupBy("target").count().collect()}
    assert counts[1] > counts[0] / 2
    assert test.count() == test.select("id").distinct().count()


def test_oversample_first_lets_copies_on_both_sides(customers):
    flow = ChurnFlow(NUMERIC, ["gender"], ["id"], oversample_first=True)
    train, test = flow.split(customers)
    assert train.join(test, "id").count() > 0


def test_flow_prunes_encodes_selects_and_scores(spark, fitted):
    model, test = fitted
    # age and balance (limit is pruned), one slot for gender, two for card; three quarters kept.
    assert model.stages[-1].numFeatures == int(5 * 0.75)
    scored = score(model, test)
    assert {"rawPrediction", "probability", "prediction"} <= set(scored.columns)
    right = scored.filter(F.col("target") == F.col("prediction")).count() / test.count()
    assert right > 0.6
    rows = coefficient_table(spark, model.stages[-1]).collect()
    assert [r["slot"] for r in rows] == [-1, 0, 1, 2]
    summary = training_summary(spark, model.stages[-1]).first()
    assert summary["auc"] > 0.6 and summary["accuracy"] > 0.6


def test_selection_by_score_saves_and_scores(customers, tmp_path, rows):
    flow = ChurnFlow(
        NUMERIC, ["gender", "card"], ["id"], regression={"regParam": 0.01}, select_by="f_score"
    )
    train, test = flow.split(customers)
    model = flow.fit(train)
    assert model.stages[-1].numFeatures == int(5 * 0.75)
    save_model(model, str(tmp_path / "model"))
    keep = ["id", "prediction"]
    assert rows(score(load_model(str(tmp_path / "model")), test, keep)) == rows(score(model, test, keep))


def test_unseen_category_fails_unless_kept(spark, customers):
    odd = customers.limit(1).withColumn("card", F.lit("Violet"))
    for invalid in ("error", "keep"):
        flow = ChurnFlow(
            NUMERIC, ["card"], ["id"], regression={"regParam": 0.01}, handle_invalid=invalid
        )
        model = flow.fit(flow.split(customers)[0])
        if invalid == "keep":
            assert score(model, odd).count() == 1 and score(model, odd).first()["prediction"] is not None
        else:
            with pytest.raises(Exception, match="Unseen label"):
                score(model, odd).collect()


def test_saved_model_predicts_the_same_without_label(fitted, tmp_path, rows):
    model, test = fitted
    save_model(model, str(tmp_path / "model"))
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"))
    bare = test.drop("target", "flag")
    keep = ["id", "prediction"]
    assert rows(score(again, bare, keep)) == rows(score(model, test, keep))
    write_positive_ids(again, bare, "id", str(tmp_path / "ids"), num_files=1)
    written = bare.sparkSession.read.schema("id int").csv(str(tmp_path / "ids"))
    assert rows(written) == rows(positive_ids(model, test, "id")) != []


def test_scoring_reads_only_what_the_model_needs(fitted, tmp_path):
    model, test = fitted
    path = str(tmp_path / "table")
    test.withColumn("unused", F.lit("x")).write.parquet(path)
    ids = positive_ids(model, test.sparkSession.read.parquet(path), "id")
    schema = ids._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "unused" not in schema and "flag" not in schema and "age" in schema


def test_any_number_of_categories_is_encoded(spark, tmp_path, rows):
    """Beyond a hundred thousand: fitted, saved, loaded and scored; a new category counts as none of them."""
    rows_in = spark.range(120_000).select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("card"),
        (F.col("id") % 7).cast("double").alias("age"),
        (F.col("id") % 7 > 4).cast("int").alias("target"),
    )
    flow = ChurnFlow(
        ["age"], ["card"], ["id"], train_share=1.0, share=0.5, handle_invalid="keep", regression={"regParam": 0.01, "maxIter": 5}
    )
    model = flow.fit(rows_in)
    assert model.stages[-1].numFeatures == 120_001 // 2
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"))
    some = rows_in.limit(20).unionByName(rows_in.limit(1).withColumns({"id": F.lit(-1), "card": F.lit("new")}))
    keep = ["id", "prediction"]
    scored = rows(score(again, some, keep))
    assert scored == rows(score(model, some, keep))
    found = dict(scored)
    assert (found[0], found[6]) == (0.0, 1.0) and len(found) == 21


def test_tuning(spark, customers, flow):
    tuned = ChurnFlow(
        NUMERIC,
        ["gender"],
        ["id"],
        grid={"reg_param": (0.01, 10.0), "elastic_net": (1.0,), "fit_intercept": (True,)},
    )
    train, _ = tuned.split(customers)
    assert tuned.fit(train).stages[-1].getRegParam() == 0.01
    regression = logistic_regression("age_vector", maxIter=10)
    assert len(logistic_grid(regression)) == 18
    assert regression.getRegParam() == 0.2 and regression.getElasticNetParam() == 0.8
    grid = logistic_grid(regression, (0.01, 10.0), (1.0,), (True,))
    pipeline = Pipeline(stages=[assemble(["age"], "age_vector"), regression])
    model = tune(pipeline, train, grid)
    report = tuning_report(spark, model).collect()
    assert report[0]["metric"] > report[1]["metric"] and "regParam=0.01" in report[0]["params"]
    best = {r["param"]: r["value"] for r in best_parameters(spark, model).collect()}
    assert best == {"elasticNetParam": "1.0", "fitIntercept": "True", "regParam": "0.01"}


def test_weights_stand_for_copies(spark, customers):
    """Statistics, categories, selection and coefficients of weighted rows are those of the copies."""
    flow = ChurnFlow(NUMERIC, ["gender", "card"], ["id"], regression={"regParam": 0.0, "tol": 1e-10})
    train, _ = flow.split(customers)
    weighted, copied = flow.weighted(train), flow.balanced(train).withColumn("_weight", F.lit(1.0))
    assert weighted.count() == train.count() and weighted.agg(F.sum("_weight")).first()[0] == copied.count()
    holes = F.when(F.col("id") % 7 > 0, F.col("age")).alias("limit")
    with_nulls = [t.select("balance", "age", holes, "_weight") for t in (weighted, copied)]
    for tables in ((weighted, copied), with_nulls):
        pairs = [_pair_rows(t, NUMERIC, "_weight") for t in tables]
        assert [p[:2] for p in pairs[0]] == [p[:2] for p in pairs[1]]
        assert [p[2] for p in pairs[0]] == pytest.approx([p[2] for p in pairs[1]])
    fitted = []
    for table in (weighted, copied):
        with flow.prepared(table) as (features, ready):
            index, selector = features.stages[0], features.stages[-1]
            labels = [[tuple(r) for r in t.orderBy("index").collect()] for t in index.tables]
            model = logistic_regression(regParam=0.0, tol=1e-10).setWeightCol("_weight").fit(ready)
            fitted.append((labels, selector.getIndices(), [*model.coefficients.toArray(), model.intercept]))
    assert fitted[0][:2] == fitted[1][:2]
    assert fitted[0][2] == pytest.approx(fitted[1][2], abs=1e-4)
    assert "Generate" not in weighted._jdf.queryExecution().optimizedPlan().toString()


def test_tuning_does_not_depend_on_the_partitions(spark, customers):
    regression = logistic_regression("v", maxIter=200, tol=1e-10)
    grid = logistic_grid(regression, (0.01, 0.2), (0.0, 1.0), (True, False))
    pipeline = Pipeline(stages=[assemble(["age", "balance"], "v"), regression])
    weigh = lambda part: weigh_classes(part, "target")
    train = customers.select("id", "age", "balance", "target")
    found = [tune(pipeline, train.repartition(n, "id"), grid, keys=["id"], weigh=weigh, parallelism=3) for n in (2, 8)]
    assert found[0].metrics == pytest.approx(found[1].metrics, abs=1e-9) and found[0].best == found[1].best
    # No row of the validation part is copied, and each candidate's area is that of its own scores.
    part, valid = validation_split(train, ["id"])
    assert part.join(valid, "id").count() == 0 and valid.count() == valid.distinct().count()
    vectors = assemble(["age", "balance"], "v").transform(valid)
    for model, metric in zip(found[0].models, found[0].metrics, strict=True):
        assert metric == pytest.approx(area_under_roc(model.transform(vectors), "target", "rawPrediction"), abs=1e-12)


def test_residual_tells_a_fit_from_a_guess(spark, customers):
    table = weigh_classes(assemble(["age", "balance"], "v").transform(customers), "target")
    models = [
        logistic_regression("v", regParam=reg, elasticNetParam=mix, fitIntercept=icept, maxIter=most, tol=1e-9).setWeightCol("_weight").fit(table)
        for reg, mix, icept, most in ((0.0, 0.0, True, 300), (0.1, 0.5, True, 300), (0.05, 1.0, False, 300), (0.0, 0.0, True, 1))
    ]
    residuals = optimality_residuals(table, models)
    assert max(residuals[:3]) < 1e-4 < residuals[3]


def test_held_sizes_partitions(spark):
    small = spark.range(100).repartition(8)
    with held(small) as table:
        assert table.rdd.getNumPartitions() == 1 and table.count() == 100
    single = spark.range(1000).coalesce(1)
    with held(single, rows_per_task=100) as table:
        assert table.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert table.agg(F.sum("id")).first()[0] == 499500
    assert not single.is_cached and not small.is_cached


@pytest.fixture(scope="module")
def flowers(spark):
    """Three well separated classes with four measures, as text labels' indexes."""
    rng = np.random.default_rng(6)
    centres = [(5.0, 3.4, 1.5, 0.2), (5.9, 2.8, 4.3, 1.3), (6.6, 3.0, 5.6, 2.0)]
    data = [
        (float(k), Vectors.dense(rng.normal(c, 0.2).round(2).tolist()))
        for k, c in enumerate(centres)
        for _ in range(50)
    ]
    return spark.createDataFrame(data, ["label", "features"]).repartition(2).persist()


def test_forest(spark, flowers, rows):
    model = fit_forest(flowers)
    scored = score(model, flowers)
    right = scored.filter(F.col("predictedLabel").cast("double") == F.col("label")).count()
    assert right >= 145
    assert forest_table(spark, model.stages[2]).count() == 10
    total = importance_table(spark, model.stages[2]).agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)
    dim = dim_table(spark, IRIS_CLASSES, IRIS_CLASSES_SCHEMA)
    lines = label_lines(scored.drop("label"), dim, "iris_id", "iris_value")
    texts = [r["value"] for r in lines.collect()]
    assert len(texts) == 150
    assert all(t.split(",")[4:] in (["0.0", "Iris-setosa"], ["1.0", "Iris-versicolor"],
                                    ["2.0", "Iris-virginica"]) for t in texts)
    assert join_dimension(scored, dim.limit(2), "predictedLabel", "iris_id").count() < 150
