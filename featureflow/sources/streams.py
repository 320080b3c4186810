"""Text streams from Kafka or from files (SRC5-SRC8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_source_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    fail_on_data_loss: bool = True,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of one subscribed topic.

    ``max_offsets_per_trigger`` bounds a micro-batch after downtime;
    ``min_partitions`` splits a hot topic partition over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    optional = {
        "kafka.group.id": group_id,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    options.update({key: str(value) for key, value in optional.items() if value is not None})
    return options


def read_text_stream(
    spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None
) -> DataFrame:
    """Stream with one string column ``value``, from any source that has one."""
    return text_values(spark.readStream.format(fmt).options(**(options or {})).load())


def text_values(messages: DataFrame) -> DataFrame:
    """The ``value`` of messages as text; sources of messages give it as bytes."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream over the files of a stored table, be it a folder or a single file.

    The braces make the path a pattern with one match: a plain path to a
    single file is refused by the file source.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return read_file_stream(spark, f"{folder}/{{{name}.parquet}}", schema)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
