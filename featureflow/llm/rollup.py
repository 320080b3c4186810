"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes becomes signed document rows: what the ledger of the batches
before it holds of the changed documents is taken back, what the batch brings is
added. Their sums by group are the batch's delta, and totals are the sum of all
deltas. A batch is committed by its manifest, a digest of its rows, which is
written last; its tables are named by that digest. So a commit that failed counts
for nothing and can be run again, and one of equal rows changes nothing. Other
rows replace a batch as long as no later one builds on it, and are refused then.
Only the groups of a batch are read for totals, never the documents.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import stored

GROUP = ["source", "lang", "version"]
LEDGER = "doc_id long, source string, lang string, version string, docs long, tokens long"
DELTA = "source string, lang string, version string, docs long, tokens long"

#: Tokenizers by version: the pattern of a token.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def token_count(text: str | Column, version: str) -> Column:
    """Number of tokens; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[version])), F.lit(0)).cast("long")


def _manifests(spark: SparkSession, path: str) -> dict[int, str]:
    """Content of every committed batch: one row each."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return {}
    rows = spark.read.schema("content string, batch int").parquet(f"{path}/manifest").collect()
    return {r["batch"]: r["content"] for r in rows}


def _committed(spark: SparkSession, path: str, batches: int) -> list[str]:
    """Content of the first ``batches`` batches, all of which must be committed."""
    known = _manifests(spark, path)
    missing = [k for k in range(batches) if k not in known]
    if missing:
        raise ValueError(f"batches {missing} are not committed")
    return [known[k] for k in range(batches)]


def _read(spark: SparkSession, path: str, part: str, contents: list[str], schema: str) -> DataFrame:
    """Rows of the batches with these contents, one after the other from batch 0."""
    whole = spark.createDataFrame([], schema)
    for batch, content in enumerate(contents):
        whole = whole.unionByName(spark.read.schema(schema).parquet(f"{path}/{part}/{batch}-{content}"))
    return whole


def _content(rows: DataFrame) -> str:
    """Digest of the rows, whatever their order and partitions."""
    marks = [F.sum(F.xxhash64(F.lit(k), "doc_id", "deleted", *GROUP, "tokens").cast("decimal(38,0)")) for k in (0, 1)]
    n, *sums = rows.agg(F.count("*"), *marks).first()
    return hashlib.sha256(repr((n, [str(x) for x in sums])).encode()).hexdigest()[:32]


def commit(changes: DataFrame, path: str, batch: int) -> None:
    """Commit batch ``batch`` (0, 1, 2, ... in turn; an earlier one again only with equal rows) to the store at ``path``.

    ``changes``: ``doc_id``, ``deleted`` (null is false), ``source``, ``lang``, ``version``,
    ``tokens``. A document's row replaces what was held of it; with ``deleted`` it
    only takes that back. Deleting an unknown document does nothing. Of several
    rows of a document within a batch one counts: a deletion before others, then
    the last in order of version, source, language and tokens. Rows without an
    id are left out. Null tokens count as 0, null groups are groups of their own. An
    empty batch is a batch. One committer writes at a time.
    """
    spark = changes.sparkSession
    marked = changes.where("doc_id is not null").select(
        F.col("doc_id").cast("long"),
        F.struct(
            F.coalesce("deleted", F.lit(False)).alias("deleted"),
            F.col("version").cast("string").alias("version"),
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        ).alias("row"),
    )
    last = stored(marked.groupBy("doc_id").agg(F.max("row").alias("row")).select("doc_id", "row.*"), "changes")
    earlier, content = _committed(spark, path, batch), _content(last)
    known = _manifests(spark, path)
    if known.get(batch) == content:
        return
    if later := sorted(k for k in known if k > batch):
        raise ValueError(f"batch {batch} has other rows now, but batches {later} build on it")
    new = last.where("not deleted").withColumn("docs", F.lit(1).cast("long"))
    columns = ["doc_id", *GROUP, "docs", "tokens"]
    if batch:
        old = _read(spark, path, "ledger", earlier, LEDGER).join(last.select("doc_id"), "doc_id", "left_semi")
        old = old.groupBy("doc_id", *GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        taken = old.where("docs <> 0").withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")})
        new = new.select(columns).unionByName(taken.select(columns))
    ledger = f"{path}/ledger/{batch}-{content}"
    new.select(columns).write.mode("overwrite").parquet(ledger)
    delta = spark.read.schema(LEDGER).parquet(ledger).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    delta.write.mode("overwrite").parquet(f"{path}/delta/{batch}-{content}")
    # The batch counts from here on.
    spark.createDataFrame([(content,)], "content string").write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")


def totals(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """``source``, ``lang``, ``version``, ``docs``, ``tokens`` after the first ``batches`` batches; empty groups are left out.

    A batch among them that is not committed is an error.
    """
    rows = _read(spark, path, "delta", _committed(spark, path, batches), DELTA).groupBy(*GROUP)
    return rows.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")
