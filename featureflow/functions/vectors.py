"""Access to vector columns without Python functions (SCL10-SCL11, UDF1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_elements(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Add the first elements of a vector as columns; the vector is unpacked once."""
    unpacked = df.withColumn("_elements", vector_to_array(vector))
    added = {name: F.get("_elements", F.lit(i)) for i, name in enumerate(names)}
    return unpacked.withColumns(added).drop("_elements")


def slice_vector(df: DataFrame, vector: str, indices: Sequence[int], name: str) -> DataFrame:
    slicer = VectorSlicer(inputCol=vector, outputCol=name, indices=list(indices))
    return slicer.transform(df)
