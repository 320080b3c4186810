"""Column-level building blocks; all stay inside JVM expressions."""

from .columns import (
    binary_target,
    columns_of_type,
    copy_column,
    drop_positions,
    equals_all,
    exceeds,
    ordered_pair,
    rename_all,
    type_counts,
)
from .parsing import parse_csv_line, quarantine_csv_line, split_fields
from .text import format_message, join_fields
from .vectors import slice_vector, vector_elements

__all__ = [
    "binary_target",
    "columns_of_type",
    "copy_column",
    "drop_positions",
    "equals_all",
    "exceeds",
    "format_message",
    "join_fields",
    "ordered_pair",
    "parse_csv_line",
    "quarantine_csv_line",
    "rename_all",
    "slice_vector",
    "split_fields",
    "type_counts",
    "vector_elements",
]
