"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder, work_path

#: Rounds after which an unfinished contraction is reported as an error; each one at least halves the depth.
ROUNDS = 60


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a new table in the shared folder and read again: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable, for every node that has a link.

    ``links`` has long columns ``a`` and ``b``; nulls and loops are ignored. Result:
    ``node``, ``component``. Large-star and small-star contraction: each round
    points every neighbour of a node to the smallest one, first upwards then
    downwards, until each node points to its component. Minimums are combined
    before the shuffle, and the join back is one that adaptive execution splits
    for hubs. Every round is written to the shared folder.
    """
    shared_folder(links.sparkSession)
    ordered = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.where("a <> b").select(ordered.alias("x")).select("x.*").distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        links = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        down = links.join(least, "a")
        links = down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = stored(links.where("a <> b").distinct(), "links")
        # A node with one link down, to a node without one, is a star: nothing moves any more.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
    raise RuntimeError(f"components are not settled after {ROUNDS} rounds")
