"""Saved pipelines (SNK7)."""

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
