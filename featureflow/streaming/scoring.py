"""Scoring of text streams (STR1-STR3).

Lines are parsed, scored and formatted by column expressions and MLlib
transformers only, so the functions here take a streaming DataFrame as well
as a batch one. All of them are stateless. Model, dimension and transformers
are built once, before the query starts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import PROBLEM, parse_csv_line
from ..functions.text import join_fields
from ..functions.vectors import vector_elements
from ..operators.joins import join_dimension
from ..plans.scoring import assemble_features, label_lines, score
from ..sinks.kafka import write_messages


def key_prediction_lines(scored: DataFrame, key: str, name: str = "value") -> DataFrame:
    return scored.select(join_fields(key, "prediction").alias(name))


def score_keys(
    lines: DataFrame,
    model: PipelineModel,
    schema: T.StructType,
    key: str,
    mode: str = "permissive",
    column: str = "value",
) -> DataFrame:
    """Text lines in, ``key,prediction`` lines out."""
    return key_prediction_lines(score(model, parse_csv_line(lines, column, schema, mode)), key)


def score_labels(
    lines: DataFrame,
    model: PipelineModel,
    schema: T.StructType,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    mode: str = "permissive",
    column: str = "value",
    handle_invalid: str = "error",
) -> DataFrame:
    """Text lines of numbers in, lines of numbers, predicted label and its name out."""
    names: Sequence[str] = schema.names
    parsed = parse_csv_line(lines, column, schema, mode)
    features = assemble_features(parsed, names, handle_invalid=handle_invalid)
    return label_lines(score(model, features), dim, dim_key, dim_value, names)


def score_sound_labels(
    lines: DataFrame,
    model: PipelineModel,
    schema: T.StructType,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    column: str = "value",
    stand_in: float = 0.0,
    topics: tuple[str, str] | None = None,
) -> DataFrame:
    """``score_labels`` that goes on at broken lines: one append holds lines and, with ``problem``, broken ones as they came.

    Each line is parsed once. A broken one passes the model with ``stand_in`` in
    its missing fields, a value the model must accept, so no null reaches the
    assembler; the outcome is thrown away. With ``topics`` a ``topic`` column
    sends sound lines to the first and broken ones to the second, as the message
    sink reads that column. Needs no micro-batch handler.
    """
    names: Sequence[str] = schema.names
    held = lines.select(F.col(column).alias("_line"))
    tagged = parse_csv_line(held, "_line", schema, "tag")
    filled = tagged.withColumns({f.name: F.coalesce(f.name, F.lit(stand_in).cast(f.dataType)) for f in schema})
    scored = score(model, assemble_features(filled, names, keep=["_line", PROBLEM]))
    named = vector_elements(
        join_dimension(scored, dim, "predictedLabel", dim_key, how="left"), "features", names
    )
    broken = F.col(PROBLEM).isNotNull()
    line = join_fields(*names, "predictedLabel", dim_value)
    target = [] if topics is None else [F.when(broken, topics[1]).otherwise(topics[0]).alias("topic")]
    kept = named.where(broken | F.col(dim_key).isNotNull())
    return kept.select(F.when(broken, F.col("_line")).otherwise(line).alias("value"), F.col(PROBLEM).alias("problem"), *target)


def score_batches(
    scorer: Callable[[DataFrame], DataFrame], folder: str, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """Handler that scores a micro-batch and writes it under its batch number.

    A batch that is run again after a failure overwrites its own output, so
    every row is there once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        target = f"{folder}/batch_id={batch_id}"
        scorer(batch).write.mode("overwrite").format(fmt).save(target)

    return handle


def send_batches(
    scorer: Callable[[DataFrame], DataFrame], options: dict[str, str], fmt: str = "kafka"
) -> Callable[[DataFrame, int], None]:
    """Handler that scores a micro-batch and sends its ``value`` column, at least once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_messages(scorer(batch), F.col("value"), fmt, options)

    return handle


MESSAGE_ID = "message_id"


class SendOnce:
    """Handler that appends a micro-batch's messages to ``folder`` so that readers see each once.

    A message's id is its batch, its text and its number among equal texts of
    the batch: the same however often, and on whatever partitions, the batch
    runs. A committed batch has an empty file of its number in ``log``, a shared
    folder, and is not sent again; one that failed between sending and commit is,
    with the same ids, and ``read_once`` drops what is there twice.
    """

    def __init__(self, spark: SparkSession, scorer: Callable[[DataFrame], DataFrame], folder: str, log: str):
        self.scorer, self.folder, self.log = scorer, folder, log
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(log).getFileSystem(spark._jsc.hadoopConfiguration())

    def send(self, batch: DataFrame, batch_id: int) -> None:
        # Copies of a text are counted first: a very common text is one row until it is written.
        texts = self.scorer(batch).groupBy("value").agg(F.count("*").alias("copies"))
        copies = texts.select("value", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        number = F.concat_ws("-", F.lit(str(batch_id)), F.sha2("value", 256), "copy")
        copies.select(number.alias(MESSAGE_ID), "value").write.mode("append").parquet(self.folder)

    def committed(self, batch_id: int) -> bool:
        return self.files.exists(self.path(f"{self.log}/{batch_id}"))

    def commit(self, batch_id: int) -> None:
        self.files.create(self.path(f"{self.log}/{batch_id}"), False).close()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not self.committed(batch_id):
            self.send(batch, batch_id)
            self.commit(batch_id)


def read_once(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of ``send_once``, each one time."""
    return spark.read.parquet(folder).dropDuplicates([MESSAGE_ID]).select("value")


def set_broken_aside(
    good: Callable[[DataFrame, int], None],
    bad: Callable[[DataFrame, int], None],
    schema: T.StructType,
    column: str = "value",
) -> Callable[[DataFrame, int], None]:
    """Handler that gives lines of the schema to ``good`` and all others, with ``_problem``, to ``bad``.

    So a broken line does not end the stream, nor does it end the one that is
    restarted on the same offsets. A micro-batch is parsed once for both.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(F.col(column).alias("_line"))  # the schema may have a field of the column's name
        tagged = parse_csv_line(lines, "_line", schema, "tag")
        tagged = tagged.select(F.col("_line").alias(column), PROBLEM).persist()
        try:
            good(tagged.where(F.col(PROBLEM).isNull()).select(column), batch_id)
            bad(tagged.where(F.col(PROBLEM).isNotNull()), batch_id)
        finally:
            tagged.unpersist()

    return handle
