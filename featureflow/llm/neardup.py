"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document's signature is 40 symbols of 16 bits and 256 symbols of one bit, each
from its own minimum over the document's shingles. The 40 symbols are split into
ten chunks of four. Two signatures that differ in at most 19 symbols differ, by
the pigeonhole principle, in at most one symbol of some chunk; so each chunk is
entered four times, with one symbol left out each time, and every pair within
that distance meets in one of the 40 entries. Pairs beyond it mostly meet as
well.

Within an entry, a pair is dropped only if both of its distances are too large:
that of the 40 symbols, counted on three bits of each, which is never more than
the true one, exceeds 19; and that of the one-bit signatures is five standard
deviations beyond its mean at the least linked similarity. So no pair within 19
symbols is lost, and of pairs of similarity 0.75 as a whole about one in 650,000
is (no entry shared, or both distances too large).

The rest bind documents to candidate clusters; no pair is written for that, only
a spanning forest per entry. Each cluster then gets its full shingle sets, and
every pair in it is compared exactly. Entries and clusters are cut into blocks,
and a task gets two blocks, so that no group lands in one task whatever its size.

Documents with equal sets are one node from the start. Nothing is capped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, stored
from .words import as_long, mix64, pieces, runs, words_of

#: Words of a shingle.
WORDS = 5
#: Links have 100 * intersection >= LINK * union.
LINK = 75
#: Symbols of the signature with 16 bits, and how many of them form a chunk.
SYMBOLS, CHUNK = 40, 4
#: Signature distance within which no pair is lost: one symbol of each chunk, and one more in all but one.
NEAR = 2 * (SYMBOLS // CHUNK) - 1
#: Bits of a symbol that go with an entry.
SKETCH = 3
#: Symbols of one bit.
BITS = 256
#: Documents of a block within an entry or a cluster, and shingles of a cluster's block.
BLOCK, BLOCK_SHINGLES = 512, 1 << 18

_ODD = mix64(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)
_A = (mix64(np.arange(101, 101 + BITS, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix64(np.arange(901, 901 + BITS, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_LONGS = SYMBOLS // 4
SYMBOL_COLUMNS = [f"s{i}" for i in range(_LONGS)]
BIT_COLUMNS = [f"b{i}" for i in range(BITS // 64)]
#: Symbols whose sketches share a long.
_PACKED = 64 // SKETCH
SKETCH_COLUMNS = [f"h{i}" for i in range(-(-SYMBOLS // _PACKED))]
_LOWEST = np.uint64(sum(1 << (SKETCH * k) for k in range(_PACKED)))


def bit_threshold() -> int:
    """Largest distance of one-bit signatures taken as a candidate: mean at the link threshold plus five deviations."""
    p = (1 - LINK / 100) / 2
    return math.floor(BITS * p + 5 * math.sqrt(BITS * p * (1 - p)))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of the column."""
    words = words_of(column)
    n, h = words.counts, words.hash
    usable = max(0, len(h) - WORDS + 1)
    total = np.zeros(usable, np.uint64)
    for k in range(WORDS):
        total += h[k : k + usable] * _ODD[k]
    total = mix64(total)
    for d in range(len(n)):
        begin = words.first[d]
        if n[d] >= WORDS:
            yield np.unique(total[begin : begin + n[d] - WORDS + 1])
        elif n[d]:
            few = np.append(h[begin : begin + n[d]] * _ODD[: n[d]], _ODD[WORDS + n[d]])
            yield mix64(few.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of the ``BITS`` hash functions over the shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BITS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(least, (_A[:, None] * x[None, k : k + 1024] + _B[:, None]).min(axis=1), out=least)
    return least


def fingerprint(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``set_id`` (fingerprint of the set, null without words), the signature."""

    def run(batches):
        for batch in pieces(batches, "text"):
            sizes, ids, least = [], [], []
            for shingles in shingle_sets(batch.column("text")):
                sizes.append(len(shingles))
                ids.append(fingerprint(shingles))
                least.append(minima(shingles))
            mixed = mix64(np.array(least, np.uint64).reshape(-1, BITS))
            symbols = np.ascontiguousarray((mixed[:, :SYMBOLS] >> np.uint64(48)).astype(np.uint16)).view(np.int64)
            bits = np.packbits((mixed & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
                + [pa.array(np.ascontiguousarray(column)) for column in (*symbols.T, *bits.T)],
                names=["doc_id", "n_shingles", "set_id", *SYMBOL_COLUMNS, *BIT_COLUMNS],
            )

    longs = ", ".join(f"{c} long" for c in SYMBOL_COLUMNS + BIT_COLUMNS)
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    return plain.mapInArrow(run, f"doc_id long, n_shingles long, set_id binary, {longs}")


def sketches(symbols: np.ndarray) -> np.ndarray:
    """``SKETCH`` bits of each symbol, packed into a few longs a row."""
    out = np.zeros((len(symbols), len(SKETCH_COLUMNS)), np.uint64)
    for k in range(SYMBOLS):
        low = symbols[:, k].astype(np.uint64) & np.uint64((1 << SKETCH) - 1)
        out[:, k // _PACKED] |= low << np.uint64(SKETCH * (k % _PACKED))
    return out


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols differ in their sketches, row by row: never more than differ in all bits."""
    differ = a ^ b
    folded = differ.copy()
    for k in range(1, SKETCH):
        folded |= differ >> np.uint64(k)
    return np.bitwise_count(folded & _LOWEST).sum(axis=1)


def entries(nodes: DataFrame) -> DataFrame:
    """Each node under its 40 index entries: chunk and left-out place decide, the other symbols are the key."""
    carried = ["node", *SKETCH_COLUMNS, *BIT_COLUMNS]

    def run(batches):
        for batch in batches:
            packed = np.stack([batch.column(c).to_numpy() for c in SYMBOL_COLUMNS], axis=1)
            symbols = np.ascontiguousarray(packed).view(np.uint16).astype(np.uint64)
            short = [as_long(np.ascontiguousarray(column)) for column in sketches(symbols).T]
            rest = [batch.column("node"), *short, *(batch.column(c) for c in BIT_COLUMNS)]
            for chunk in range(SYMBOLS // CHUNK):
                for left_out in range(CHUNK):
                    key = np.full(len(symbols), chunk * CHUNK + left_out, np.uint64)
                    for place in range(CHUNK):
                        if place != left_out:
                            key = mix64(key * _ODD[0] + symbols[:, chunk * CHUNK + place])
                    yield pa.RecordBatch.from_arrays([as_long(key), *rest], names=["key", *carried])

    longs = ", ".join(f"{c} long" for c in carried)
    return nodes.select("node", *SYMBOL_COLUMNS, *BIT_COLUMNS).mapInArrow(run, f"key long, {longs}")


def block_pairs(df: DataFrame, group: str, blocks: F.Column) -> DataFrame:
    """Each row once for every pair of blocks of its group that contains the row's block."""
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    df = df.withColumn("other", other)
    df = df.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    return df.drop("blocks", "mine", "other").repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")


class Forest:
    """Union of positions; ``links`` holds the pairs that joined two trees."""

    def __init__(self, size: int):
        self.root = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def find(self, a: int) -> int:
        root = self.root
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    def join(self, first: np.ndarray, second: np.ndarray) -> None:
        for a, b in zip(first.tolist(), second.tolist(), strict=True):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((a, b))
        while (flat := self.root[self.root]).tobytes() != self.root.tobytes():
            self.root = flat


def _links(nodes: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(nodes[at[:, 0]]), pa.array(nodes[at[:, 1]])], names=["a", "b"])


def candidate_links(index: DataFrame) -> DataFrame:
    """A spanning forest of the candidate pairs of every entry: ``a``, ``b``."""
    shared = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    far = bit_threshold()

    def run(batches):
        for table, starts in runs(batches, ["key", "low", "high"]):
            nodes = table.column("node").to_numpy()
            bits, short = (
                np.stack([table.column(c).to_numpy() for c in columns], axis=1).view(np.uint64)
                for columns in (BIT_COLUMNS, SKETCH_COLUMNS)
            )
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            forest = Forest(len(nodes))
            # Pairs at distance 1, 2, ... within their groups; rows whose group has ended leave.
            left = np.flatnonzero(group[:-1] == group[1:])
            step = 1
            while len(left):
                a, b = left, left + step
                new = forest.root[a] != forest.root[b]
                a, b = a[new], b[new]
                near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= far
                near[~near] = sketch_distance(short[a[~near]], short[b[~near]]) <= NEAR
                forest.join(a[near], b[near])
                step += 1
                left = left[left + step < len(group)]
                left = left[group[left] == group[left + step]]
            yield _links(nodes, forest.links)

    members = index.join(shared, "key")
    return block_pairs(members, "key", blocks).drop("n").mapInArrow(run, "a long, b long").distinct()


def exact_links(sets: DataFrame) -> DataFrame:
    """A spanning forest of the true links of every two blocks; all pairs are compared on full sets."""

    def run(batches):
        for table, starts in runs(batches, ["cluster", "low", "high"], rows=64):
            nodes = table.column("node").to_numpy()
            shingles = table.column("shingles")
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                if end - begin < 2:
                    continue
                own = [np.frombuffer(x.as_py(), np.uint64) for x in shingles.slice(begin, end - begin)]
                yield _links(nodes[begin:end], linked(own))

    return sets.mapInArrow(run, "a long, b long")


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of all pairs with enough in common: each set is counted against all later ones at once."""
    sizes = np.array([len(s) for s in sets])
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    seen = np.zeros(int(numbers.max()) + 1, np.int32)
    forest = Forest(len(sets))
    for i in range(len(sets) - 1):
        if (forest.root[i + 1 :] == forest.root[i]).all():
            continue
        own = numbers[begins[i] : ends[i]]
        seen[own] = 1
        common = np.add.reduceat(seen[numbers[ends[i] :]], begins[i + 1 :] - ends[i])
        seen[own] = 0
        hit = np.flatnonzero(100 * common >= LINK * (sizes[i] + sizes[i + 1 :] - common)) + i + 1
        forest.join(np.full(len(hit), i), hit)
    return forest.links


def cluster_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Full shingle sets of the members, once for every pair of blocks of their cluster."""
    stats = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    size = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    placed = members.join(stats.select("cluster", size.alias("blocks")), "cluster")
    # Members may be any share of the documents: one plan for every size, texts shuffled by id.
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(placed.hint("merge"), "node")

    def run(batches):
        for batch in pieces(batches, "text"):
            wanted = batch.column("set_id").to_pylist()
            sets = [s.tobytes() if fingerprint(s) == w else None for s, w in zip(shingle_sets(batch.column("text")), wanted, strict=True)]
            keep = pa.array([s is not None for s in sets])
            rest = [batch.column(c) for c in ("node", "cluster", "blocks")]
            out = pa.RecordBatch.from_arrays([*rest, pa.array(sets, pa.binary())], names=["node", "cluster", "blocks", "shingles"])
            yield out.filter(keep)

    sets = texts.select("node", "cluster", "blocks", "set_id", "text").mapInArrow(
        run, "node long, cluster long, blocks int, shingles binary"
    )
    return block_pairs(sets, "cluster", F.col("blocks"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of near-duplicate documents.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever
    their names. Result, one row per input row: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest ``doc_id`` reachable by links), ``kept``.

    Null or empty texts and texts without words have no shingles and stand
    alone. Texts with fewer than five words are one shingle. A repeated row, or
    an equal text under another id, belongs to the class of the smallest id; two
    texts under one id count as one document and bring their classes together.
    Rows without an id have no class (null) and are kept unless a row with an id
    has an equal set. An empty table gives an empty table.
    """
    rows = stored(signatures(docs), "signatures")
    longs = [F.first(c).alias(c) for c in SYMBOL_COLUMNS + BIT_COLUMNS]
    nodes = rows.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), *longs
    )
    nodes = stored(nodes.where("node is not null"), "nodes")
    clusters = components(candidate_links(entries(nodes)))
    members = nodes.select("node", "set_id", "n_shingles").join(clusters.withColumnRenamed("component", "cluster"), "node")
    members = stored(members, "members")
    classes = components(exact_links(cluster_sets(docs, members)))
    named = nodes.select("set_id", "node").join(classes, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("set_component")
    )
    own = F.coalesce("set_component", "doc_id")
    return rows.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"),
    )
