"""Inner join with a dimension table (JOI1-JOI3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def as_key(value: Column, given: T.DataType, kind: T.DataType) -> Column:
    """``value`` as the dimension's key type; null where it is no such key.

    Integers compare with integers as they are, so their statistics reach the
    scan and no digit is lost. Other values are whole numbers if they equal
    one: of text such as ``"0.0"`` the zeros after the point are left out; what
    is no whole number then is read as an exact decimal, or as a double beyond
    its digits.
    """
    if not isinstance(kind, INTEGRAL):
        return value if given == kind else value.try_cast(kind)
    if isinstance(given, INTEGRAL):
        return value
    if isinstance(given, T.StringType):
        # The usual texts take one pass over one value: the key is evaluated where rows are filtered and joined.
        usual = F.regexp_replace(F.trim(value), F.lit(r"\.0*$"), F.lit("")).try_cast(kind)
        exact, number = value.try_cast("decimal(38,18)"), value.try_cast("double")
        return F.coalesce(usual, _whole(exact, kind), F.when(exact.isNull(), _whole(number, kind)))
    return _whole(value, kind)


def _whole(number: Column, kind: T.DataType) -> Column:
    return F.when(number == F.floor(number), number.try_cast(kind))


def join_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "inner") -> DataFrame:
    """Rows of ``df`` with their dimension row; rows without one drop, or are kept by ``how="left"``.

    Keys are compared as the dimension's type by an explicit lenient cast, as
    a label index printed as text (``"0.0"``) does not cast to an integer. No
    job counts the dimension: Spark broadcasts it if its size in bytes, from
    the plan or as measured at run time, is below
    ``spark.sql.autoBroadcastJoinThreshold``, and else splits the partitions of
    hot keys.
    """
    value = as_key(F.col(key), df.schema[key].dataType, dim.schema[dim_key].dataType)
    return df.join(dim, value == dim[dim_key], how)
