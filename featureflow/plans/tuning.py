"""Parameter search on one training/validation split, with a certificate of every fit (MDL3-MDL5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.balance import WEIGHT
from ..operators.metrics import areas_under_roc
from ..operators.sampling import hash_split
from ..sources.dimensions import dim_table
from .held import held

Weigh = Callable[[DataFrame], DataFrame]

#: Part of the training rows that candidates are fitted on, and what its key hash is salted with.
TRAIN_RATIO, SALT = 0.7, "validation"
#: A fit whose optimality conditions are off by no more counts as optimal.
OPTIMAL = 1e-3


def logistic_grid(
    regression: LogisticRegression,
    # The candidates of the recorded search.
    reg_param: Sequence[float] = (0.01, 0.1, 0.5),
    elastic_net: Sequence[float] = (0.0, 0.5, 1.0),
    fit_intercept: Sequence[bool] = (True, False),
) -> list:
    """Every combination of regularisation, mixing and intercept: 18 by default."""
    return (
        ParamGridBuilder()
        .addGrid(regression.regParam, list(reg_param))
        .addGrid(regression.fitIntercept, list(fit_intercept))
        .addGrid(regression.elasticNetParam, list(elastic_net))
        .build()
    )


@dataclass
class Tuned:
    """Candidates in order of the grid, what they reached on the validation part, and the winner fitted on all rows."""

    grid: list
    models: list[LogisticRegressionModel]
    metrics: list[float]
    residuals: list[float]
    bestModel: LogisticRegressionModel | PipelineModel | None = field(default=None)

    @property
    def best(self) -> int:
        return max(range(len(self.metrics)), key=lambda i: (self.metrics[i], -i))


def validation_split(df: DataFrame, keys: Sequence[str] | None = None, train_ratio: float = TRAIN_RATIO):
    """Training and validation part by hash of the keys: the same on any cluster, copies of a row on one side.

    Without ``keys`` all columns are the key.
    """
    if keys is None:
        keys = [F.col(name).cast("string") for name in df.columns]
    return hash_split(df, keys, train_ratio, SALT)


def tune_parts(
    regression: LogisticRegression,
    train: DataFrame,
    valid: DataFrame,
    grid: list,
    label: str = "target",
    parallelism: int = 2,
) -> Tuned:
    """Every candidate fitted on ``train`` and measured on ``valid``.

    All are scored in one pass over ``valid`` and ranked by one range
    partitioning; one more pass over ``train`` sums the optimality conditions of
    all fits. ``train`` is read for every fit, so hold it.
    """
    fits = regression.fitMultiple(train, grid)
    models: list = [None] * len(grid)

    def fit(_) -> None:
        index, model = next(fits)
        models[index] = model

    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(len(grid))))
    features = regression.getFeaturesCol()
    margins = [f"_margin{i}" for i in range(len(models))]
    areas = areas_under_roc(_with_margins(valid.select(label, features), models, margins), label, margins)
    residuals = optimality_residuals(train, models, label)
    return Tuned(grid, models, [0.0 if a is None else a for a in areas], residuals)


def _with_margins(df: DataFrame, models: Sequence[LogisticRegressionModel], names: Sequence[str]) -> DataFrame:
    """Margins of all models, in one pass."""
    kept = df.columns
    for model, name in zip(models, names, strict=True):
        own = model.copy().setPredictionCol("").setProbabilityCol("").setRawPredictionCol(name)
        df = own.transform(df)
    return df.select(*kept, *[F.get(vector_to_array(name), F.lit(1)).alias(name) for name in names])


def optimality_residuals(train: DataFrame, models: Sequence[LogisticRegressionModel], label: str = "target") -> list[float]:
    """How far each fit is from the minimum of its objective, whatever way it was found.

    At the minimum the slope of the loss by a standardised coefficient b is
    -reg * ((1 - mix) * b + mix * sign(b)), or within reg * mix of zero where b is
    zero, and the slope by the intercept is zero. Slopes are sums over the rows the
    models were fitted on, all in one aggregate. The result is the largest gap.
    """
    features = models[0].getFeaturesCol()
    weight = F.col(models[0].getWeightCol()) if models[0].isSet("weightCol") else F.lit(1.0)
    rows = train.select(features, F.col(label).cast("double").alias("_y"), weight.cast("double").alias("_w"))
    names = [f"_margin{i}" for i in range(len(models))]
    rows = _with_margins(rows, models, names)
    sums = [Summarizer.metrics("std").summary(F.col(features), F.col("_w")).alias("spread"), F.sum("_w").alias("rows")]
    for i, name in enumerate(names):
        slope = F.col("_w") * (1 / (1 + F.exp(-F.col(name))) - F.col("_y"))
        for sign, side in ((1, "up"), (-1, "down")):  # weights of a summary are not negative
            part = F.greatest(sign * slope, F.lit(0.0))
            sums.append(Summarizer.metrics("sum").summary(F.col(features), part).alias(f"{side}{i}"))
        sums.append(F.sum(slope).alias(f"level{i}"))
    row = rows.agg(*sums).first()
    spread, total = row["spread"]["std"].toArray(), row["rows"]
    used = spread > 0
    out = []
    for i, model in enumerate(models):
        b = model.coefficients.toArray()[used] * spread[used]
        slope = (row[f"up{i}"]["sum"].toArray() - row[f"down{i}"]["sum"].toArray())[used] / spread[used] / total
        reg, mix = model.getRegParam(), model.getElasticNetParam()
        slope = slope + reg * (1 - mix) * b
        gap = np.where(b != 0, np.abs(slope + reg * mix * np.sign(b)), np.maximum(np.abs(slope) - reg * mix, 0))
        level = abs(row[f"level{i}"]) / total if model.getFitIntercept() else 0.0
        out.append(float(max([level, *gap])))
    return out


def tune(
    estimator: Estimator,
    df: DataFrame,
    grid: list,
    label: str = "target",
    parallelism: int = 2,
    train_ratio: float = TRAIN_RATIO,
    keys: Sequence[str] | None = None,
    weigh: Weigh | None = None,
) -> Tuned:
    """Fit every candidate on one part, keep the best exact area under ROC on the other; the winner is fitted on all rows.

    ``estimator`` is a logistic regression or a pipeline that ends in one; its
    feature stages are fitted on the training part, and again on all rows for
    the winner. ``weigh`` adds a weight column to a training part: no row of the
    validation part is copied, weighed or seen by a fit that it judges.
    """
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    regression = stages[-1] if weigh is None else stages[-1].copy().setWeightCol(WEIGHT)
    weigh = weigh or (lambda part: part)
    with held(df) as table:
        train, valid = validation_split(table, keys, train_ratio)
        train = weigh(train)
        features = Pipeline(stages=stages[:-1]).fit(train)
        wanted = [label, regression.getFeaturesCol()]
        extra = [WEIGHT] if regression.isSet("weightCol") else []
        with held(features.transform(train).select(*wanted, *extra)) as ready:
            tuned = tune_parts(regression, ready, features.transform(valid).select(*wanted), grid, label, parallelism)
        everything = weigh(table)
        features = Pipeline(stages=stages[:-1]).fit(everything)
        best = regression.fit(features.transform(everything), grid[tuned.best])
        tuned.bestModel = PipelineModel(stages=[*features.stages, best]) if isinstance(estimator, Pipeline) else best
    return tuned


def tuning_report(spark, tuned: Tuned, bound: float = OPTIMAL) -> DataFrame:
    """Candidate number, parameters, metric and whether the fit is at its minimum, best first."""
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(metric), residual <= bound)
        for i, (params, metric, residual) in enumerate(zip(tuned.grid, tuned.metrics, tuned.residuals, strict=True))
    ]
    rows.sort(key=lambda row: (-row[2], row[0]))
    return dim_table(spark, rows, "candidate int, params string, metric double, optimal boolean")


def best_parameters(spark, tuned: Tuned) -> DataFrame:
    """Name and value of the winner's tuned parameters."""
    best = tuned.bestModel
    last = best.stages[-1] if hasattr(best, "stages") else best
    wanted = ("elasticNetParam", "fitIntercept", "regParam")
    values = {p.name: v for p, v in last.extractParamMap().items() if p.name in wanted}
    rows = [(name, str(values[name])) for name in wanted]
    return dim_table(spark, rows, "param string, value string")
