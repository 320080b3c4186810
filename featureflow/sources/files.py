"""Batch file readers (SRC1-SRC3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    mode: str = "PERMISSIVE",
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Delimited text with an explicit schema, or with inferred types.

    Inference reads the input once more; ``sampling_ratio`` bounds the rows it
    looks at, and production jobs pass ``schema``. In PERMISSIVE mode blank
    lines are skipped and missing trailing fields are null.
    """
    reader = spark.read.option("header", header).option("mode", mode)
    if schema is None:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """``label double, features vector``; a pinned width saves the scan that finds it."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)
