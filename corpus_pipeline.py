"""From raw documents to encoded training text: reject, deduplicate, mix, encode.

Each stage takes ``(spark, docs, sf_dir)`` with what the stage before it kept and
returns a DataFrame. All but the last return the columns of the documents table,
further columns of the input are left out. A stage decides for each row by itself:
rows go through the toxicity and language operators, and have stored numbers in
deduplication and mixing, so repeated ids and rows without an id keep their own
decisions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm.bpe import encode_texts
from featureflow.llm.graph import stored
from featureflow.llm.langid import identify_languages
from featureflow.llm.mixing import mix
from featureflow.llm.neardup import near_duplicates
from featureflow.llm.queries import quality_weights
from featureflow.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """The documents with a number for each row, fixed as the rows are written."""
    return stored(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), purpose)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from all labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, held_out=F.lit(False), carried=COLUMNS)
    return scored.where("predicted = 0").select("row.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents close enough to a language of the corpus; texts without a letter go."""
    found = identify_languages(docs, held_out=F.lit(False), carried=COLUMNS)
    return found.where("not rejected").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: that with the smallest id; without any id, one of them.

    Classes are of rows, by text alone: rows without an id take part, and different
    texts under one id are different documents. Of equal rows without words one stays.
    """
    rows = _numbered(docs, "numbered")
    classes = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    classes = stored(classes.select(F.col("doc_id").alias("row"), "component_id", (F.col("n_shingles") > 0).alias("worded")), "classes")
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    worded = rows.select("row", "doc_id").join(classes.where("worded"), "row")
    kept = worded.groupBy("component_id").agg(F.min(least)["row"].alias("row")).select("row")
    once = rows.join(kept, "row", "left_semi").select(COLUMNS)
    wordless = rows.join(classes.where("worded"), "row", "left_anti").select(COLUMNS)
    return once.unionByName(wordless.distinct())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix by source takes it; those it does not take go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = _numbered(docs, "numbered")
    times = mix(rows, quality_weights(labels), number="row").where("taken > 0").select("row", F.expr("cast(taken div size as int)").alias("_times"))
    copies = rows.join(times, "row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, and how many."""
    return encode_texts(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", not_toxic),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Trained models have no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each writes its rows to the shared folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
