"""Quality of documents by a factorisation machine over words, structure and metadata.

A document is a sparse vector of three groups of features. Its words are hashed
into ``WORD_CELLS`` cells, weighted by the logarithm of their counts, at length
one. Structure statistics (shares of capitals, digits, marks, repeated words and
lines, lengths) are each spread over two neighbouring points of a scale, and so is
the declared length, with one cell each for a missing one and for one that is not
the text's. The score's logit is

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

and the pairs are summed in linear time, for each of the ``RANK`` factors, as
half of (sum_i v_i x_i)^2 - sum_i v_i^2 x_i^2.

The machine is fitted in numpy on a bounded sample of the labelled rows: the
texts of least hash, ``TRAIN_TEXTS`` of each label, and ``TRAIN_FEATURES`` features in
all. Tasks turn texts into features, so no text comes to the driver. Scoring
covers all rows, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .words import WHITE_WORDS, Words, column_bytes, mix64, pieces, words_of

#: Labelled texts of each label that the machine is fitted on at most, and features of them all together at most.
TRAIN_TEXTS, TRAIN_FEATURES = 4000, 3_000_000
#: Cells of the words, and points of each statistic's scale.
WORD_CELLS, POINTS = 1 << 16, 12
#: Size of the factors.
RANK = 8
#: Passes over the sample, steps at least (small samples get more passes), texts of a step, rate, and pull towards zero.
EPOCHS, STEPS, STEP_TEXTS, RATE, PULL = 6, 300, 64, 0.1, 1e-4

#: Statistics of a text: shares first, then numbers, which are put on a scale of doublings.
SHARES = (
    "capitals",
    "digits",
    "marks",
    "signs",
    "foreign",
    "blanks",
    "marked_words",
    "distinct_words",
    "echoed_words",
    "top_word",
    "distinct_lines",
)
NUMBERS = ("bytes", "words", "word_bytes", "line_words")
_DOUBLINGS = 20.0
_STATS = len(SHARES) + len(NUMBERS)
#: First cell of the declared length, then the cells of a missing and of a wrong one.
_DECLARED = WORD_CELLS + _STATS * POINTS
_MISSING, _WRONG = _DECLARED + POINTS, _DECLARED + POINTS + 1
CELLS = _WRONG + 1


def _lines() -> np.ndarray:
    inside = np.ones(256, bool)
    inside[list(b"\n\r")] = False
    return inside


def _kinds() -> np.ndarray:
    """Kind of each byte: capital, digit, mark of prose, other sign, beyond ASCII, blank; the rest are small letters."""
    kind = np.full(256, 6)
    kind[33:127] = 3
    kind[97:123] = 6
    kind[65:91], kind[48:58] = 0, 1
    kind[list(b".,;:'\"()?-")] = 2
    kind[128:] = 4
    kind[:33] = kind[127] = 5
    return kind


LINES, KINDS = _lines(), _kinds()


@dataclass
class Features:
    """Sparse rows: ``cell`` and ``value`` of row r are ``begin[r]:begin[r+1]``."""

    cell: np.ndarray
    value: np.ndarray
    begin: np.ndarray

    def take(self, rows: np.ndarray) -> Features:
        size = np.diff(self.begin)[rows]
        at = np.repeat(self.begin[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Features(self.cell[at], self.value[at], np.concatenate([[0], np.cumsum(size)]))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of the distinct words of each text."""
    order = np.lexsort((words.hash, words.text))
    text, value = words.text[order], words.hash[order]
    lead = np.ones(len(text), bool)
    lead[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(lead)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def statistics(column: pa.Array, words: Words, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row per text: ``SHARES``, then ``NUMBERS``, each from 0 to 1."""
    texts, counts, size = len(column), words.counts, np.diff(at)
    owner = np.repeat(np.arange(texts), size)
    kinds = np.bincount(owner * 7 + KINDS[raw], minlength=7 * texts).reshape(texts, 7)
    letters = kinds[:, 0] + kinds[:, 6]
    text, _, times = _distinct(words)
    distinct = np.bincount(text, minlength=texts)
    top = np.zeros(texts)
    np.maximum.at(top, text, times)
    echo = np.zeros(len(words.hash), bool)
    echo[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    last = raw[words.start + words.length - 1] if len(words.start) else np.zeros(0, np.uint8)
    lines = words_of(column, LINES)
    line_text, _, _ = _distinct(lines)
    inner = kinds.sum(axis=1) - kinds[:, 5]
    shares = [
        _share(kinds[:, 0], letters),
        _share(kinds[:, 1], inner),
        _share(kinds[:, 2], inner),
        _share(kinds[:, 3], inner),
        _share(kinds[:, 4], inner),
        _share(kinds[:, 5], size),
        _share(np.bincount(words.text[KINDS[last] == 3], minlength=texts), counts),
        _share(distinct, counts),
        _share(np.bincount(words.text[echo], minlength=texts), counts),
        _share(top, counts),
        _share(np.bincount(line_text, minlength=texts), lines.counts),
    ]
    numbers = [size, counts, _share(inner, counts), _share(counts, lines.counts)]
    scaled = [np.minimum(np.log2(1 + n) / _DOUBLINGS, 1.0) for n in numbers]
    return np.stack([np.sqrt(s) for s in shares] + scaled, axis=1)


def _on_scale(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two neighbouring points of a scale from 0 to 1, and how near the value is to each."""
    place = value * (POINTS - 1)
    low = np.minimum(place.astype(np.int64), POINTS - 2)
    return np.stack([first + low, first + low + 1], axis=-1), np.stack([1 - (place - low), place - low], axis=-1)


def features_of(column: pa.Array, declared: pa.Array) -> Features:
    """Features of whole texts and their declared lengths; null texts count as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    words = words_of(column, WHITE_WORDS)
    raw, at = column_bytes(column)
    texts = len(column)
    text, value, times = _distinct(words)
    cell = (mix64(value) % np.uint64(WORD_CELLS)).astype(np.int64)
    weight = np.log1p(times)
    length = np.sqrt(np.bincount(text, weight * weight, minlength=texts))
    scales = WORD_CELLS + POINTS * np.arange(_STATS)
    stat_cell, stat_value = _on_scale(statistics(column, words, raw, at), scales)
    letter = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])[at]
    known = declared.is_valid().to_numpy(zero_copy_only=False)
    said = declared.fill_null(0).to_numpy()
    on, near = _on_scale(np.clip(np.log2(1 + np.maximum(said, 0.0)) / _DOUBLINGS, 0, 1), np.full(texts, _DECLARED))
    other = np.where(known, np.where(said != np.diff(letter), 1.0, 0.0), 1.0)
    meta_cell = np.concatenate([on, np.where(known, _WRONG, _MISSING)[:, None]], axis=1)
    meta_value = np.concatenate([np.where(known[:, None], near, 0.0), other[:, None]], axis=1)
    stats = 2 * _STATS
    row = np.concatenate([text, np.repeat(np.arange(texts), stats), np.repeat(np.arange(texts), 3)])
    cells = np.concatenate([cell, stat_cell.reshape(-1), meta_cell.reshape(-1)])
    values = np.concatenate([weight / length[text], stat_value.reshape(-1), meta_value.reshape(-1)])
    there = values > 0
    order = np.argsort(row[there], kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(row[there], minlength=texts))])
    return Features(cells[there][order].astype(np.int32), values[there][order].astype(np.float32), begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Machine:
    """Level, a weight and ``RANK`` factors for every cell."""

    def __init__(self, seed: int = 13):
        self.level = 0.0
        self.weight = np.zeros(CELLS, np.float32)
        self.factor = np.random.default_rng(seed).normal(0, 0.05, (CELLS, RANK)).astype(np.float32)

    def _sums(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each row, and the sum of its factors."""
        part = self.factor[x.cell] * x.value[:, None]
        linear = np.add.reduceat(self.weight[x.cell] * x.value, x.begin[:-1])
        total = np.add.reduceat(part, x.begin[:-1])
        square = np.add.reduceat(part * part, x.begin[:-1])
        return self.level + linear + 0.5 * (total * total - square).sum(axis=1), total

    def logits(self, x: Features) -> np.ndarray:
        """Every row has features: those of its statistics."""
        return self._sums(x)[0].astype(np.float64) if len(x.begin) > 1 else np.zeros(0)

    def gradient(self, x: Features, target: np.ndarray, weigh: np.ndarray):
        """Of the weighted mean log loss: for the level, and by used cell for weight and factors."""
        logit, total = self._sums(x)
        slope = ((_sigmoid(logit) - target) * weigh / weigh.sum()).astype(np.float32)
        row = np.repeat(np.arange(len(target)), np.diff(x.begin))
        to_weight = slope[row] * x.value
        to_factor = to_weight[:, None] * (total[row] - self.factor[x.cell] * x.value[:, None])
        order = np.argsort(x.cell, kind="stable")
        lead = np.flatnonzero(np.diff(x.cell[order], prepend=-1))
        used = x.cell[order][lead]
        return slope.sum(), used, np.add.reduceat(to_weight[order], lead), np.add.reduceat(to_factor[order], lead)


def train(x: Features, target: np.ndarray, weigh: np.ndarray, seed: int = 13) -> Machine:
    """Machine fitted by adaptive gradient steps; the same rows in the same order give the same machine."""
    machine, draw = Machine(seed), np.random.default_rng(seed)
    seen = [1e-8, np.full(CELLS, 1e-8, np.float32), np.full((CELLS, RANK), 1e-8, np.float32)]
    epochs = max(EPOCHS, -(-STEPS // -(-len(target) // STEP_TEXTS)))
    for _ in range(epochs):
        order = draw.permutation(len(target))
        for k in range(0, len(order), STEP_TEXTS):
            own = order[k : k + STEP_TEXTS]
            level, used, weight, factor = machine.gradient(x.take(own), target[own], weigh[own])
            weight, factor = weight + PULL * machine.weight[used], factor + PULL * machine.factor[used]
            seen[0] += level * level
            seen[1][used] += weight * weight
            seen[2][used] += factor * factor
            machine.level -= RATE * level / seen[0] ** 0.5
            machine.weight[used] -= RATE * weight / np.sqrt(seen[1][used])
            machine.factor[used] -= RATE * factor / np.sqrt(seen[2][used])
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        x = features_of(batch.column("text"), batch.column("n_chars"))
        offsets = pa.array(x.begin.astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (x.cell, x.value)]
        columns = [batch.column("h"), *lists, pa.array(np.diff(x.begin).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["h", "cells", "values", "size"])


def training_sample(rows: DataFrame, labels: DataFrame) -> tuple[Features, np.ndarray, np.ndarray]:
    """Features, labels and weights of a bounded sample of the labelled rows, in order of their texts' hash.

    Copies of a text are one row, with the mean of their labels. Weights make
    each label count as in all labelled texts.
    """
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    named = rows.where("not held_out").select("doc_id", "h").join(marks, "doc_id")
    texts = named.groupBy("h").agg(F.avg("quality").alias("target")).withColumn("good", F.col("target") >= 0.5)
    counts = {r["good"]: r["count"] for r in texts.groupBy("good").count().collect()}
    chosen = [texts.where(F.col("good") == good).orderBy("h").limit(TRAIN_TEXTS) for good in (True, False)]
    chosen = chosen[0].union(chosen[1])
    own = rows.where("not held_out").join(F.broadcast(chosen), "h", "left_semi").select("h", "text", "n_chars")
    own = own.groupBy("h").agg(F.min(F.struct("text", "n_chars")).alias("one")).select("h", "one.*")
    own = own.mapInArrow(_featured, "h long, cells array<int>, values array<float>, size int")
    own = stored(own.join(F.broadcast(chosen), "h"), "quality-sample")
    sizes = own.select("h", F.sum("size").over(Window.orderBy("h")).alias("so_far"))
    taken = sizes.where(F.col("so_far") <= TRAIN_FEATURES).select("h")
    table = own.join(F.broadcast(taken), "h").orderBy("h").toArrow()
    cells, values = (table[c].combine_chunks() for c in ("cells", "values"))
    x = Features(*(v.flatten().to_numpy() for v in (cells, values)), np.concatenate([[0], np.cumsum(table["size"].to_numpy())]))
    good = table["good"].to_numpy().astype(bool)
    weigh = np.where(good, counts.get(True, 0) / max(good.sum(), 1), counts.get(False, 0) / max((~good).sum(), 1))
    return x, table["target"].to_numpy(), weigh


def score_quality(docs: DataFrame, labels: DataFrame, held_out: F.Column) -> DataFrame:
    """Quality of every whole text, learned from the labelled rows where ``held_out`` is false.

    ``docs`` needs ``doc_id``, ``text`` and ``n_chars``, ``labels`` ``doc_id`` and
    ``quality`` (0 or 1; other values and nulls are no labels, several of a document
    count with their mean); further columns are only used by ``held_out``. Result,
    one row per input row: ``doc_id``, ``held_out``, ``score`` in 0 to 1, ``predicted``
    (1 from 0.5 on). Null texts count as empty, and empty ones are scored by their
    structure and metadata; a missing ``n_chars`` is a feature of its own. Texts may
    have any length. Without both kinds of labels every row gets the share of
    good ones (0 without labels). Null in ``held_out`` counts as held out. Repeated
    rows get equal scores; an empty table gives an empty table.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
    )
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    x, target, weigh = training_sample(rows.withColumn("h", F.xxhash64("text")), labels)
    share = float((target * weigh).sum() / weigh.sum()) if len(target) else 0.0
    machine = train(x, target, weigh) if 0 < share < 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            score = np.full(batch.num_rows, share)
            if machine is not None:
                score = _sigmoid(machine.logits(features_of(batch.column("text"), batch.column("n_chars"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.select("doc_id", "held_out", "text", "n_chars").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )
