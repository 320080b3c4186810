"""Batch rows to Kafka (SNK4, SNK5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_messages(
    df: DataFrame, value: Column, fmt: str = "kafka", options: dict[str, str] | None = None
) -> None:
    """Append one message per row, sent by the executors that hold the rows."""
    writer = df.select(value.alias("value")).write.format(fmt).options(**(options or {}))
    writer.mode("append").save()
