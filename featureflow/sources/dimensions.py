"""Literal dimension tables (SRC4)."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def dim_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small table from literal rows.

    Goes through Arrow, which gives Catalyst a local relation of known size
    rather than an RDD scan of unknown size.
    """
    names = [field.split()[0] for field in re.split(r",(?![^(<]*[)>])", schema)]
    columns = [[row[i] for row in rows] for i in range(len(names))]
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))), schema)
