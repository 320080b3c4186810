"""Applying a fitted pipeline to a table (MDL8-MDL9, JOI1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_fields
from ..functions.vectors import vector_elements
from ..operators.encoding import assemble
from ..operators.joins import join_dimension
from ..schemas import IRIS_FEATURES
from ..sinks.files import write_csv


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with rawPrediction, probability and prediction.

    Filter before scoring: the optimizer cannot move a filter below the model,
    but it does prune the columns no stage reads.
    """
    scored = model.transform(df)
    return scored if keep is None else scored.select(*keep)


def positive_ids(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Keys of the rows the model predicts as positive."""
    return score(model, df).filter(F.col("prediction") == 1).select(key)


def write_positive_ids(
    model: PipelineModel, df: DataFrame, key: str, path: str, num_files: int | None = None
) -> None:
    """Score, keep positive keys, write them as text; only keys are ever shuffled."""
    write_csv(positive_ids(model, df, key), path, num_files=num_files)


def assemble_features(
    df: DataFrame, names: Sequence[str], keep: Sequence[str] = (), handle_invalid: str = "error"
) -> DataFrame:
    """``features`` vector of the named columns; a null in one fails the job by default."""
    return assemble(names, handle_invalid=handle_invalid).transform(df).select(*keep, "features")


def label_lines(
    scored: DataFrame,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    names: Sequence[str] = tuple(IRIS_FEATURES),
    keep: Sequence[str] = (),
    name: str = "value",
) -> DataFrame:
    """One output line per scored row: its features, predicted label and label name."""
    named = join_dimension(scored, dim, "predictedLabel", dim_key)
    fields: list[Column | str] = [*names, "predictedLabel", dim_value]
    return vector_elements(named, "features", names).select(*keep, join_fields(*fields).alias(name))
