"""Output lines and messages (SCL7-SCL8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_fields(*columns: Column | str, sep: str = ",") -> Column:
    """Fields joined by ``sep``; nulls are left out, doubles print as ``3.0``."""
    return F.concat_ws(sep, *columns)


def format_message(first: Column | str, second: Column | str, prefix: str = "Prediction") -> Column:
    return F.format_string(f"{prefix}: %s - %s", first, second)
