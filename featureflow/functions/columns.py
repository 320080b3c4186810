"""Projections, filters and small scalar rules (PRJ2-PRJ6, FLT1-FLT2, SCL1, SCL12-SCL13)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.dimensions import dim_table

NUMERIC_TYPES = ("int", "double")


def drop_positions(df: DataFrame, positions: Iterable[int]) -> DataFrame:
    """Drop columns by position; negative positions count from the end."""
    names = df.columns
    return df.drop(*{names[i] for i in positions})


def copy_column(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(source))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def columns_of_type(
    df: DataFrame, types: Iterable[str] = NUMERIC_TYPES, exclude: Iterable[str] = ()
) -> list[str]:
    """Names of the columns with one of ``types``, in table order."""
    types, exclude = set(types), set(exclude)
    return [name for name, kind in df.dtypes if kind in types and name not in exclude]


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns there are of each type."""
    counts = Counter(kind for _, kind in df.dtypes)
    return dim_table(df.sparkSession, sorted(counts.items()), "type string, columns bigint")


def equals_all(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Rows where every named column equals its value."""
    return df.filter(reduce(and_, [F.col(name) == value for name, value in values.items()]))


def binary_target(df: DataFrame, source: str, negative: Any, name: str = "target") -> DataFrame:
    """0 where ``source`` equals ``negative``, else 1 (also for null)."""
    return df.withColumn(name, F.when(F.col(source) == negative, 0).otherwise(1))


def exceeds(value: Column | str, threshold: float) -> Column:
    """Absolute value above a threshold."""
    return F.abs(value) > threshold


def ordered_pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """The two names with the alphabetically smaller one first."""
    return F.least(a, b), F.greatest(a, b)
