"""Readers: delimited text, LIBSVM, literal dimensions, text streams, saved models."""

from .dimensions import dim_table
from .files import read_csv, read_libsvm, read_table
from .models import load_model
from .streams import kafka_source_options, read_file_stream, read_table_stream, read_text_stream

__all__ = [
    "dim_table",
    "kafka_source_options",
    "load_model",
    "read_csv",
    "read_file_stream",
    "read_libsvm",
    "read_table",
    "read_table_stream",
    "read_text_stream",
]
