"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

A source's target comes from its weight, but never exceeds ``most`` times its
size; what is over goes to the others by weight. A source takes all its documents
as often as the target holds complete epochs. The fraction left is filled by
weighted sampling without replacement: each document draws the key -ln(u) / w
with w its quality weight, documents are ordered by key, and those whose sizes
sum up to the budget are taken, the last one if that is nearer than leaving it.

The order within a source is cut into ``BUCKETS`` ranges of the key. Sums of
ranges tell in which of them the budget ends; only the documents of that one
range are sorted, so that a source with a third of all documents is no burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored

#: Ranges of the sampling key within a source.
BUCKETS = 4096
#: Weights by position of the source, repeating; total target over total size; target over size at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Sources that are broadcast to the documents; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: str | Column) -> Column:
    """Number of runs of other characters than blank and 0x09 to 0x0D; null has none."""
    words = F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")
    return F.coalesce(F.when(F.get(words, F.lit(0)) != "", F.size(words)).otherwise(0), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """Number above 0 and below 1 from the first 52 bits of a digest: the same in every run and engine."""
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source (one row each): ``source``, ``source_size``, ``target``.

    The common level of the sources that do not reach their limit follows from
    the order of the limits: a source is limited if its limit, by weight, is
    below the level that it and all sources after it would share; beyond the
    first that is not, these levels only fall.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rows = sizes.withColumn("w", F.get(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS)).cast("int")))
    rows = rows.withColumn("limit", MOST * F.col("source_size"))
    tightest = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    budget = SHARE * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("w").over(tightest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", budget / left).withColumn("limited", F.col("limit") <= F.col("w") * F.col("level"))
    level = F.max(F.when(~F.col("limited"), F.col("level"))).over(whole)
    target = F.when(F.col("limited"), F.col("limit")).otherwise(F.least("limit", F.col("w") * level))
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, number: str | None = None) -> DataFrame:
    """How much of each document a mix by source takes.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; ``quality`` may give a weight above
    0 for documents (``doc_id``, ``weight``; the highest of several; 1 where there is
    none). Other columns are ignored. Result, one row per input row: ``doc_id``,
    ``source``, ``size`` in words, ``source_size``, ``target`` of the source, ``taken``
    words: a multiple of the size, at most ``MOST`` times.

    Sources in order of code points weigh ``WEIGHTS``, repeating; null is a source
    of its own and the last. Null and empty texts have size 0 and take nothing.
    Draws depend on ids only, so runs agree; rows of one id draw alike, and ties
    are ordered by id, then size. An empty table gives an empty table. ``number`` may
    name a column of numbers of the rows: the last of the order, and of the result.
    """
    own = [number] if number else []
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count("text").alias("size"), *own)
    if quality is not None:
        best = quality.where("weight > 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("weight").alias("weight"))
        rows = rows.join(best, "doc_id", "left")
    weight = F.coalesce(F.col("weight"), F.lit(1.0)).cast("double") if quality is not None else F.lit(1.0)
    draw = uniform(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    key = -F.log(draw) / weight
    bucket = F.least(F.floor(BUCKETS * (1 - F.exp(-key))), F.lit(BUCKETS - 1)).cast("int")
    rows = rows.withColumn("key", key).withColumn("bucket", bucket).select("doc_id", "source", "size", "key", "bucket", *own)
    rows = stored(rows, "sizes")

    ranges = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("range_size")), "ranges")
    sources = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    # Where each source's budget ends: the last range that begins below it.
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.withColumn("before", F.coalesce(F.sum("range_size").over(up_to), F.lit(0)))
    placed = _by_source(begun, sources)
    last = placed.where(F.col("before") < F.col("budget")).groupBy("source").agg(F.max(F.struct("bucket", "before")).alias("last"))
    plan = stored(_by_source(sources, last, "left").select("source", "source_size", "target", "epochs", "budget", "last.*"), "plan")

    known = _by_source(rows, F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan, "left", renamed="end")
    inside = known.where(F.col("bucket") == F.col("end_bucket"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size", *own).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    cut = inside.withColumn("chosen", start + F.col("size") / 2 <= F.col("budget"))
    rest = known.where(~F.coalesce(F.col("bucket") == F.col("end_bucket"), F.lit(False)))
    rest = rest.withColumn("chosen", F.coalesce(F.col("bucket") < F.col("end_bucket"), F.lit(False)))
    taken = F.col("size") * (F.col("epochs") + F.col("chosen").cast("long"))
    return cut.unionByName(rest).select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *own)


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner", renamed: str = "") -> DataFrame:
    """Join on ``source``, null included."""
    names = {c: f"{renamed}_{c}" if renamed and c == "bucket" else c for c in right.columns}
    right = right.select(*[F.col(c).alias(n) for c, n in names.items()]).withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")
