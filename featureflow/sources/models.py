"""Saved pipelines (SRC9)."""

from pyspark.ml import PipelineModel


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
