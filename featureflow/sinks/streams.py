"""Starting and ending streaming queries (SNK3, STR4-STR7)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def _writer(df: DataFrame, checkpoint: str, every: str | None) -> DataStreamWriter:
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint location")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def start_stream(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    every: str | None = "1 second",
) -> StreamingQuery:
    """Append ``df`` to a sink; ``every=None`` drains what is there and stops."""
    return _writer(df, checkpoint, every).format(fmt).options(**(options or {})).start()


def start_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "1 second",
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` for every micro-batch that has rows."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handle(batch, batch_id)

    return _writer(df, checkpoint, every).foreachBatch(guarded).start()


def wait(query: StreamingQuery, timeout: float | None = None) -> None:
    """Block until the query ends; with ``timeout`` seconds, stop it and fail."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")
