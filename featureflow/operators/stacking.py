"""One row per (row, column): wide statistics as a grouped aggregate.

A wide ``agg`` with several expressions per column leaves whole-stage code
generation once it has about a hundred buffers, and becomes an order of
magnitude slower. Stacking the columns first and grouping by their position
keeps the number of expressions fixed whatever the width. The stacked rows
never leave the task: only one partial row per column and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOT, VALUE = "_slot", "_value"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_kind(df: DataFrame, columns: Sequence[str]) -> str:
    """The type that holds every value of the columns exactly: bigint, a decimal, or else double.

    Integral columns next to decimals are decimals if 38 digits suffice.
    """
    types = [df.schema[name].dataType for name in columns]
    if types and all(isinstance(t, INTEGRAL) for t in types):
        return "bigint"
    if types and all(isinstance(t, (*INTEGRAL, T.DecimalType)) for t in types):
        sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (19, 0) for t in types]
        scale = max(scale for _, scale in sizes)
        precision = max(precision - digits for precision, digits in sizes) + scale
        if precision <= 38:
            return f"decimal({precision},{scale})"
    return "double"


def stack_columns(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), kind: str = "double"
) -> DataFrame:
    values = F.array(*[F.col(name).cast(kind) for name in columns])
    return df.select(*keep, F.posexplode(values).alias(SLOT, VALUE))


def per_slot(values: Sequence, slot: Column | str = SLOT) -> Column:
    """The literal that belongs to the row's slot."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(slot) if isinstance(slot, str) else slot)
