"""Training flows: churn-style logistic regression and label-style random forest (MDL1-MDL2, MDL6-MDL7)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.balance import WEIGHT, class_ratio, oversample, replicate_rows, weigh_classes
from ..operators.correlation import prune_correlated
from ..operators.encoding import (
    CODED,
    INDEXED,
    CategoryIndexer,
    assemble,
    encode_columns,
    index_columns,
    index_label,
    index_to_label,
    index_vector,
)
from ..operators.sampling import hash_split, random_split
from ..operators.scaling import min_max
from ..operators.selection import top_share, top_share_by_score
from ..sources.dimensions import dim_table
from .held import held
from .tuning import logistic_grid, tune_parts, validation_split

# The settings of the churn model and of its tuning split.
CHURN_REGRESSION = {"maxIter": 1000, "regParam": 0.2, "elasticNetParam": 0.8}
FOREST_TREES = 10
CORRELATION_THRESHOLD = 0.6


def logistic_regression(
    features: str = "selectedFeatures", label: str = "target", **params
) -> LogisticRegression:
    settings = {**CHURN_REGRESSION, **params}
    return LogisticRegression(featuresCol=features, labelCol=label, family="binomial", **settings)


def random_forest(
    features: str = "indexedFeatures",
    label: str = "indexedLabel",
    trees: int = FOREST_TREES,
    seed: int = 42,
    **params,
) -> RandomForestClassifier:
    """On large data raise ``maxMemoryInMB`` so that a level takes fewer scans."""
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, seed=seed, **params
    )


def feature_stages(
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str = "target",
    share: float | None = 0.75,
    handle_invalid: str = "error",
) -> list:
    """Index, encode, assemble, scale and, with a ``share``, select, as unfitted stages."""
    indexed = [name + INDEXED for name in categorical]
    stages = [index_columns(categorical, handle_invalid), encode_columns(indexed)] if categorical else []
    selector = [] if share is None else [top_share(label=label, share=share)]
    return [
        *stages,
        assemble([*numeric, *(name + CODED for name in indexed)]),
        min_max(),
        *selector,
    ]


@dataclass
class ChurnFlow:
    """What to learn from, and how; ``fit`` returns one saved-as-a-whole pipeline model.

    The test part is split off first by key and only the training part is
    balanced, by weights in all statistics and in the regression, so no row is
    copied and no statistic of a test row reaches training. ``oversample_first`` balances before the split instead, which
    lets copies of a row land on both sides. With ``handle_invalid="keep"`` a
    category that training did not see is scored as none of the known ones;
    by default it fails the job. Features are ranked by F statistic;
    ``select_by="p_value"`` takes the stock selector, whose p values round to
    zero on large tables, after which it keeps the first slots.

    Any number of categories is encoded: they are indexed by tables that are
    saved with the model, and coded as sparse vectors next to the scaled
    numbers. Codes are 0 or 1 already and are not scaled.
    """

    numeric: Sequence[str]
    categorical: Sequence[str]
    keys: Sequence[str]
    label: str = "target"
    minority: int = 1
    train_share: float = 0.7
    oversample_first: bool = False
    threshold: float = CORRELATION_THRESHOLD
    share: float = 0.75
    regression: dict = field(default_factory=dict)
    grid: dict | None = None
    parallelism: int = 2
    seed: int = 42
    handle_invalid: str = "error"
    select_by: str = "f_score"

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        wanted = df.select(*self.keys, *self.numeric, *self.categorical, self.label)
        if self.oversample_first:
            balanced = oversample(wanted, self.label, self.minority, 1 - self.minority)
            parts = random_split(balanced, (self.train_share, 1 - self.train_share), self.seed)
            return parts[0], parts[1]
        return hash_split(wanted, self.keys, self.train_share)

    def balanced(self, train: DataFrame) -> DataFrame:
        """The minority repeated in an already held table, so the copies are never stored."""
        if self.oversample_first:
            return train
        classes = (self.label, self.minority, 1 - self.minority)
        ratio = class_ratio(train, *classes).first()["ratio"]
        return oversample(train, *classes, ratio=ratio or 1)

    def stages(self, numeric: Sequence[str]) -> list:
        return feature_stages(
            numeric, self.categorical, self.label, self.share, self.handle_invalid
        )

    def weighted(self, train: DataFrame) -> DataFrame:
        """The training rows with the weights that stand for copies of the minority."""
        if self.oversample_first:
            return train.withColumn(WEIGHT, F.lit(1.0))
        return weigh_classes(train, self.label, self.minority, 1 - self.minority)

    def fit_scaled(self, table: DataFrame, numeric: Sequence[str]) -> PipelineModel:
        """Stages up to ``scaledFeatures``, fitted on weighted rows."""
        coded: list[Transformer] = []
        if self.categorical:
            index = CategoryIndexer(self.categorical, self.handle_invalid, WEIGHT).fit(table)
            coded = [index, index.coder()]
        scaled = [assemble(numeric, "numbers"), min_max("numbers", "scaledNumbers")] if numeric else []
        codes = [name + INDEXED + CODED for name in self.categorical]
        parts = [*(["scaledNumbers"] if numeric else []), *codes]
        return Pipeline(stages=[*coded, *scaled, assemble(parts, "scaledFeatures")]).fit(table)

    def fit_selector(self, ready: DataFrame) -> Transformer:
        if self.select_by == "p_value":  # the stock selector takes no weights
            return top_share(label=self.label, share=self.share).fit(replicate_rows(ready, F.col(WEIGHT)))
        return top_share_by_score(ready, label=self.label, share=self.share, weight=WEIGHT)

    @contextmanager
    def prepared(self, table: DataFrame) -> Iterator[tuple[PipelineModel, DataFrame]]:
        """Feature stages fitted on weighted rows, and what they make of them, evaluated once for all later scans."""
        numeric = prune_correlated(table, self.numeric, self.threshold, WEIGHT)
        scaled = self.fit_scaled(table, numeric)
        with held(scaled.transform(table).select(self.label, WEIGHT, "scaledFeatures")) as ready:
            selector = self.fit_selector(ready)
            selected = selector.transform(ready).select(self.label, WEIGHT, "selectedFeatures")
            yield PipelineModel(stages=[*scaled.stages, selector]), selected

    def fit(self, train: DataFrame) -> PipelineModel:
        """Fit all stages on ``train``, which is kept in memory or on disk meanwhile.

        With a ``grid`` all stages are first fitted on a part of ``train`` by key,
        and the candidates measured on the rest, which no stage has seen; the
        best one is then fitted, with its stages, on all of ``train``.
        """
        regression = logistic_regression(label=self.label, **self.regression).setWeightCol(WEIGHT)
        with held(train) as table:
            chosen = {}
            if self.grid is not None:
                grid = logistic_grid(regression, **self.grid)
                part, valid = validation_split(table, self.keys)
                with self.prepared(self.weighted(part)) as (features, ready):
                    measured = features.transform(valid)
                    tuned = tune_parts(regression, ready, measured, grid, self.label, self.parallelism)
                chosen = grid[tuned.best]
            with self.prepared(self.weighted(table)) as (features, ready):
                model = regression.fit(ready, chosen)
        return PipelineModel(stages=[*features.stages, model])


def fit_forest(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    max_categories: int = 20,
    labels_from: DataFrame | None = None,
    **forest,
) -> PipelineModel:
    """Index label and vector slots, grow a forest, turn predictions back into labels.

    ``labels_from`` names the table that holds every label, if ``df`` is a
    part that may miss one.
    """
    whole = df if labels_from is None else labels_from
    indexer = index_label(label, "indexedLabel").fit(whole)
    slots = index_vector(features, "indexedFeatures", max_categories).fit(whole)
    stages: list[Transformer] = [
        indexer,
        slots,
        random_forest(**forest),
        index_to_label(indexer.labelsArray[0]),
    ]
    return Pipeline(stages=stages).fit(df)


def coefficient_table(spark, model: LogisticRegressionModel) -> DataFrame:
    """Slot and coefficient; slot -1 is the intercept."""
    rows = [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    return dim_table(spark, [(-1, float(model.intercept)), *rows], "slot int, coefficient double")


def forest_table(spark, model: RandomForestClassificationModel) -> DataFrame:
    """Tree, depth, node count and weight."""
    rows = [
        (i, tree.depth, tree.numNodes, float(weight))
        for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True))
    ]
    return dim_table(spark, rows, "tree int, depth int, nodes int, weight double")


def importance_table(spark, model: RandomForestClassificationModel) -> DataFrame:
    rows = [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return dim_table(spark, rows, "slot int, importance double").orderBy(F.desc("importance"), "slot")
