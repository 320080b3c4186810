"""Unions, and rows two tables share or do not share (SET1-SET4)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_rows(first: DataFrame, second: DataFrame, by_name: bool = False) -> DataFrame:
    """All rows of both, matching columns by position or by name."""
    return first.unionByName(second) if by_name else first.union(second)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def common_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.intersect(second)


def remaining_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.exceptAll(second)
