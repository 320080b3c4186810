"""Class ratio, row replication and oversampling (AGG4, GEN1, GEN2)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column of row weights.
WEIGHT = "_weight"


def class_ratio(df: DataFrame, target: str, minority: Any = 1, majority: Any = 0) -> DataFrame:
    """Rows of both classes and their integer ratio; null if the minority is empty."""
    counts = df.agg(
        F.count_if(F.col(target) == majority).alias("majority_rows"),
        F.count_if(F.col(target) == minority).alias("minority_rows"),
    )
    ratio = F.expr("majority_rows div nullif(minority_rows, 0)")
    return counts.withColumn("ratio", ratio)


def replicate_rows(df: DataFrame, copies: int | Column) -> DataFrame:
    """Every row ``copies`` times, within its task."""
    times = F.lit(copies) if isinstance(copies, int) else copies
    copied = df.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), times.cast("int"))))
    return copied.drop("_copy")


def oversample(
    df: DataFrame, target: str, minority: Any = 1, majority: Any = 0, ratio: int | None = None
) -> DataFrame:
    """Rows of both classes, the minority repeated by the integer class ratio.

    One pass replicates in place of a union of two filtered scans; the ratio
    is a scalar subquery over the target column only, so nothing runs before
    the result is asked for and no row crosses the network. A known ``ratio``
    saves the subquery where the result is scanned many times.
    """
    if ratio is None:
        times = class_ratio(df, target, minority, majority).select("ratio").scalar()
    else:
        times = F.lit(ratio)
    copies = F.when(F.col(target) == minority, F.greatest(times, F.lit(1))).otherwise(1)
    return replicate_rows(df.filter(F.col(target).isin(minority, majority)), copies)


def weigh_classes(df: DataFrame, target: str, minority: Any = 1, majority: Any = 0, name: str = WEIGHT) -> DataFrame:
    """Rows of both classes with the weight that ``oversample`` gives them as copies.

    Sums over weighted rows are those over the copies, so statistics and fits
    that take weights give the same without a row more. The ratio is one small
    job over the target column.
    """
    ratio = class_ratio(df, target, minority, majority).first()["ratio"] or 1
    weight = F.when(F.col(target) == minority, float(max(ratio, 1))).otherwise(1.0)
    return df.filter(F.col(target).isin(minority, majority)).withColumn(name, weight)
