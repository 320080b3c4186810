"""Tables of vectors, and the join of blocks of queries with blocks of candidates, for the two searches."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .words import runs

#: Rows of a block of queries and of one of candidates, about, as a hash deals them.
QUERY_BLOCK, BLOCK = 4096, 4096


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """Rows that take part: ``vec_id`` and ``vector`` (doubles), without null or non-finite components.

    Rows without an id or with an empty vector take no part. ``zero`` tells
    whether vectors of zeros do. Repeated rows and ids stay.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and size(vector) > 0").where(~bad)
    if not zero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def by_length(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, ids and vectors of each length; vectors of different lengths are never compared."""
    column = table.column("vector")
    column = column.combine_chunks()
    length = np.diff(column.offsets.to_numpy())
    number, ids = table.column("row").to_numpy(), table.column("vec_id").to_numpy()
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        yield number[at], ids[at], matrix(column.take(pa.array(at)))


class Heaps:
    """The ``top`` best candidates of each query so far; of equal scores the smaller id is better."""

    def __init__(self, size: int, top: int, kind: type):
        self.top, self.kind = top, kind
        self.heaps: list[list[tuple]] = [[] for _ in range(size)]
        self.bar = np.full(size, -np.inf)

    def merge(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Take pairs of query number and candidate. Of a query's pairs at most ``top`` reach its heap, however many tie."""
        open_to = score >= self.bar[query]
        query, ids, score = query[open_to], ids[open_to], score[open_to]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < self.top
        for q, value, vec in zip(query[best].tolist(), score[best].tolist(), ids[best].tolist(), strict=True):
            heap, entry = self.heaps[q], (value, -vec)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        for q in np.unique(query):
            if len(self.heaps[q]) == self.top:
                self.bar[q] = self.heaps[q][0][0]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, candidates and scores."""
        query = np.repeat(np.arange(len(self.heaps)), [len(h) for h in self.heaps])
        flat = [entry for heap in self.heaps for entry in heap]
        return query, np.array([-e[1] for e in flat], np.int64), np.array([e[0] for e in flat], self.kind)


def search(table: DataFrame, zero: bool, every: int, top: int, kind: str, method) -> DataFrame:
    """``top`` nearest rows for each query: ``query_id``, ``rank``, ``vec_id``, ``score`` of type ``kind``.

    Queries are the rows whose id is divisible by ``every``. A hash of the row
    number deals queries and candidates into blocks of bounded size, whatever
    ids and vectors repeat; every pair of blocks goes to one task, where
    ``method(rows, vectors, top)``, made for the queries, reads the candidates and
    passes on its best ones for each query, which are merged by rank. The work
    is that of queries times candidates; neither side leaves the executors.
    """
    # Numbered before it is written, so that a row that is computed again keeps its number.
    rows = stored(usable(table, zero).withColumn("row", F.monotonically_increasing_id()), "vectors")
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    # At least one block each, so that empty tables take the same way.
    q_blocks, c_blocks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n // BLOCK))

    def dealt(side: DataFrame, mine: str, blocks: int, other: str, others: int, code: int) -> DataFrame:
        side = side.withColumn(mine, F.pmod(F.xxhash64("row", F.lit(code)), F.lit(blocks)).cast("int"))
        every_other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return side.select("row", "vec_id", "vector", F.lit(code).alias("side"), mine, every_other)

    queries = dealt(rows.where(is_query), "q", q_blocks, "c", c_blocks, 0)
    pairs = queries.unionByName(dealt(rows, "c", c_blocks, "q", q_blocks, 1))
    pairs = pairs.repartition("q", "c").sortWithinPartitions("q", "c", "side")
    found = pairs.mapInArrow(_task(method, top), f"row long, query_id long, vec_id long, score {kind}")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _task(method, top: int):
    names = ["row", "query_id", "vec_id", "score"]

    def pair(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side = rows.column("side").to_numpy()
        cut = int(np.searchsorted(side, 1))
        searches = {v.shape[1]: (number, ids, method(number, v, top)) for number, ids, v in by_length(rows.slice(0, cut))}
        for number, ids, vectors in by_length(rows.slice(cut)):
            if vectors.shape[1] in searches:
                own, query_ids, one = searches[vectors.shape[1]]
                one.read(number, ids, vectors)
                query, vec, score = one.heaps.best()
                columns = [own[query], query_ids[query], vec, score]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["q", "c"]):
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                yield from pair(table.slice(begin, end - begin))

    return run
