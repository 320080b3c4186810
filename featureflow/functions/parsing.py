"""Positional parse of delimited text into typed columns (SCL2-SCL6).

All double quotes are removed before the split, so a quoted separator does
split: this is the line format of the scoring streams, not a CSV parser.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = "_fields"
PROBLEM = "_problem"


def split_fields(value: Column | str, sep: str = ",", drop_trailing: bool = True) -> Column:
    """Array of the fields of a line; trailing empty fields are dropped by default."""
    text = F.replace(value, F.lit('"'), F.lit(""))
    if drop_trailing:
        text = F.regexp_replace(text, f"(?:{re.escape(sep)})+$", "")
    return F.split(text, re.escape(sep))


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: A number with decimals, of which a lenient cast keeps the whole part.
WHOLE_PART = r"^\s*([+-]?\d+)\.\d*\s*$"


def _field(i: int, field: T.StructField, lenient: bool = False) -> Column:
    """The field as its type, or null. Integral fields drop decimals (``1.5`` is 1) if ``lenient``."""
    token = F.get(F.col(FIELDS), F.lit(i))
    if isinstance(field.dataType, T.StringType):
        return token
    if lenient and isinstance(field.dataType, INTEGRAL):
        token = F.coalesce(F.nullif(F.regexp_extract(token, WHOLE_PART, 1), F.lit("")), token)
    return token.try_cast(field.dataType)


def _problem(schema: T.StructType) -> Column:
    """Why a line does not fit the schema, or null."""
    width = len(schema)
    short = F.when(
        F.col(FIELDS).isNull() | (F.size(FIELDS) < width),
        F.format_string(f"expected {width} fields, found %s", F.size(FIELDS).cast("string")),
    )
    wrong = [
        F.when(_field(i, f).isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}"))
        for i, f in enumerate(schema)
        if not isinstance(f.dataType, T.StringType)
    ]
    return F.coalesce(short, *wrong)


def _typed(schema: T.StructType, lenient: bool = False) -> list[Column]:
    return [_field(i, f, lenient).alias(f.name) for i, f in enumerate(schema)]


def parse_csv_line(
    df: DataFrame,
    column: str,
    schema: T.StructType,
    mode: str = "permissive",
    keep: Sequence[str] = (),
    sep: str = ",",
    drop_trailing: bool = True,
) -> DataFrame:
    """Columns of ``schema`` (after ``keep``) parsed from a text column.

    permissive: missing and malformed fields are null; integral fields drop decimals.
    strict: such a line fails the job, whatever the session's ANSI setting,
    as soon as any parsed column is used.
    tag: malformed fields are null, integral ones with decimals too, plus the line and the reason in ``_problem``.
    """
    fields = df.select(*keep, column, split_fields(column, sep, drop_trailing).alias(FIELDS))
    if mode == "permissive":
        return fields.select(*keep, *_typed(schema, lenient=True))
    if mode == "strict":
        # The check sits in the array every parsed column is taken from: once per
        # row, where a filter would be pushed down and split the line again.
        problem = _problem(schema)
        guarded = F.when(problem.isNull(), F.col(FIELDS)).otherwise(F.raise_error(problem))
        return fields.select(*keep, guarded.alias(FIELDS)).select(*keep, *_typed(schema))
    if mode == "tag":
        return fields.select(*keep, *_typed(schema), column, _problem(schema).alias(PROBLEM))
    raise ValueError(f"unknown mode {mode!r}")


def quarantine_csv_line(
    df: DataFrame,
    column: str,
    schema: T.StructType,
    keep: Sequence[str] = (),
    sep: str = ",",
    drop_trailing: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the other lines with the reason in ``_problem``.

    Each part reads the input; the ``tag`` mode serves a single pass.
    """
    tagged = parse_csv_line(df, column, schema, "tag", keep, sep, drop_trailing)
    # Filters are not pushed below a generator, so a line is split once per part.
    parsed = F.inline(F.array(F.struct(*schema.names, PROBLEM)))
    tagged = tagged.select(*keep, column, parsed)
    good = tagged.filter(F.col(PROBLEM).isNull()).drop(column, PROBLEM)
    bad = tagged.filter(F.col(PROBLEM).isNotNull()).select(*keep, column, PROBLEM)
    return good, bad
