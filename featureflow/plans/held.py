"""Tables kept for repeated scans, in partitions of a sensible size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

ROWS_PER_TASK = 20_000


@contextmanager
def held(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> Iterator[DataFrame]:
    """``df`` in memory or on disk for the length of the block.

    Iterative fits launch a job per step, so a few thousand rows spread over
    many partitions cost more in task starts than in work: those are
    coalesced. A table read in fewer tasks than there are cores is spread
    over them once. Larger tables stay as they are. Lost blocks are
    recomputed from the source.
    """
    spark = df.sparkSession
    kept = [df.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        rows = df.count()
        have = df.rdd.getNumPartitions()
        want = max(1, math.ceil(rows / rows_per_task))
        cores = spark.sparkContext.defaultParallelism
        if have > want:
            yield df.coalesce(want)
        elif have < min(want, cores):
            kept.append(df.repartition(min(want, cores)).persist(StorageLevel.MEMORY_AND_DISK))
            yield kept[-1]
        else:
            yield df
    finally:
        for table in kept:
            table.unpersist()
