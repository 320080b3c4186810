"""Counts, summaries and column profiles (AGG1-AGG3, SRT1, PRJ6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import columns_of_type
from ..sources.dimensions import dim_table
from .quantiles import ACCURACY, exact_quantiles
from .stacking import SLOT, VALUE, common_kind, per_slot, stack_columns

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("p25", "p50", "p75")
SUMMARY_SCHEMA = (
    "column_name string, count bigint, mean double, stddev double, min {0}, p25 {0}, p50 {0}, p75 {0}, max {0}"
)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_counts(df: DataFrame, *columns: str, ordered: bool = True) -> DataFrame:
    counts = df.groupBy(*columns).count()
    return counts.orderBy(*columns) if ordered else counts


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False
) -> DataFrame:
    """Per column: count, mean, stddev, min, quartiles and max.

    Quartiles are approximate by default, as in ``DataFrame.summary``, from the
    same single scan; ``exact=True`` takes a few more scans. Exact values are of
    the type that holds all columns: integers, or decimals, summarised by themselves
    keep every digit, next to doubles they are doubles.
    """
    columns = list(columns or columns_of_type(df, ("int", "bigint", "float", "double")))
    kind = common_kind(df, columns) if exact else "double"
    mean = F.mean(VALUE)
    if kind != "double":  # a sum of doubles would lose digits of large numbers
        number = F.col(VALUE).cast("decimal(20,0)") if kind == "bigint" else F.col(VALUE)
        mean = F.try_sum(number).cast("double") / F.count(VALUE)
    statistics = [
        F.count(VALUE).alias("count"),
        mean.alias("mean"),
        F.stddev(VALUE).alias("stddev"),
        F.min(VALUE).alias("min"),
        F.max(VALUE).alias("max"),
    ]
    if exact:
        quartiles, rows = exact_quantiles(df, columns, QUARTILES, statistics)
        return dim_table(
            df.sparkSession,
            [
                (name, r["count"], r["mean"], r["stddev"], r["min"], *quartiles[name], r["max"])
                for name, r in rows.items()
            ],
            SUMMARY_SCHEMA.format(kind),
        )
    cuts = F.percentile_approx(VALUE, list(QUARTILES), ACCURACY).alias("cuts")
    summary = stack_columns(df, columns).groupBy(SLOT).agg(*statistics, cuts)
    quartiles = [F.get("cuts", F.lit(j)).alias(label) for j, label in enumerate(QUARTILE_NAMES)]
    name = per_slot(columns).alias("column_name")
    return summary.select(name, "count", "mean", "stddev", "min", *quartiles, "max")


def column_profile(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Type, rows, nulls and distinct values of every column.

    Distinct values are estimated, by one small sketch per column and task, but
    for the columns named in ``exact``: each of those is grouped by its values
    and then counted, in a scan of that column alone.
    """
    rough = [name for name in df.columns if name not in exact]
    counted = df.agg(
        F.count("*").alias("rows"),
        *[F.count(name).alias(f"n_{name}") for name in df.columns],
        *[F.approx_count_distinct(name).alias(f"d_{name}") for name in rough],
    )
    for name in exact:
        values = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*"))
        counted = counted.withColumn(f"d_{name}", F.lit(values.count()).cast("long"))
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("type"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n_{name}")).alias("nulls"),
            F.col(f"d_{name}").alias("distinct"),
        )
        for name, kind in df.dtypes
    ]
    return counted.select(F.inline(F.array(*lines)))


def column_names(df: DataFrame, columns: Sequence[str], name: str = "column_name") -> DataFrame:
    return dim_table(df.sparkSession, [(c,) for c in columns], f"{name} string")
