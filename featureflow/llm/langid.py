"""Language of documents by the nearest of several centroids per language.

A text is a vector of its byte sequences of one to four letters within words
(hashed), each entry the logarithm of its count times the sequence's inverse
document frequency, at length one. Each language has several centroids, found by
spherical k-means over its training texts. A text gets the language of the
centroid with the highest cosine; if that is below a low quantile of the cosines
of held-back training texts of its length, with a margin, it is rejected. A
held-back text's cosine is that with the centroids of its own language, found
without it.

Fitting uses a bounded sample of the labelled rows (``TRAIN_TEXTS`` of each
language, all languages); both it and prediction, which covers all rows, run in
tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .words import LETTER_WORDS, Words, mix64, pieces, words_of

#: Labelled texts of each language that the model is fitted on, about.
TRAIN_TEXTS = 1500
#: Entries of a vector, and bytes of the sequences.
SIZE, GRAMS = 4096, (1, 2, 3, 4)
#: Centroids of a language, and rounds of k-means.
CENTROIDS, ROUNDS = 4, 10
#: A text is rejected below this share of this quantile of the cosines in its length class.
MARGIN, QUANTILE = 0.7, 0.01
#: Parts of the training texts, each held back once; cosines that a quantile is taken of at least.
FOLDS, COSINES = 4, 50
#: Texts turned into vectors at once.
CHUNK = 512

_GROUPS = 24


def counts_of(words: Words) -> np.ndarray:
    """One row per text: logarithms of the counts of its sequences, by cell."""
    texts = len(words.first) - 1
    inside = np.zeros(len(words.data) + 1, np.int8)  # words are separate runs of letters
    inside[words.start] += 1
    inside[words.start + words.length] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    run = np.zeros(len(words.data), np.int32)
    run[words.start] = 1
    run = np.cumsum(run, dtype=np.int32)
    data = words.data.astype(np.uint64)
    owner = np.zeros(len(words.start) + 1, np.int64)
    owner[1:] = words.text
    total = np.zeros(texts * SIZE, np.float32)
    code = np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        last = len(data) - n + 1
        if last <= 0:
            break
        code = code[:last] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            at = np.flatnonzero(inside[:last] & inside[n - 1 :] & (run[:last] == run[n - 1 :]))
            cell = owner[run[at]] * SIZE + (mix64(code[at] + np.uint64(n)) % np.uint64(SIZE)).astype(np.int64)
            total += np.bincount(cell, minlength=texts * SIZE).astype(np.float32)
    return np.log1p(total.reshape(texts, SIZE))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """The rows at length one; zeros stay."""
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(length, np.float32(1e-12))


def vectors_of(words: Words, idf: np.ndarray) -> np.ndarray:
    """One row per text, of length one (zero without letters)."""
    return unit_rows(counts_of(words) * idf)


def in_chunks(column: pa.Array) -> Iterator[Words]:
    """Words of ``CHUNK`` texts at a time."""
    for k in range(0, len(column), CHUNK):
        yield words_of(column.slice(k, CHUNK), LETTER_WORDS)


def length_class(words: Words) -> np.ndarray:
    """Doublings of the text's letters and digits."""
    letters = np.concatenate([[0], np.cumsum(words.length)])[words.first]
    return np.minimum(np.log2(np.diff(letters) + 1).astype(np.int64), _GROUPS - 1)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` (or fewer) directions; the first centroids are rows far from each other, so runs agree."""
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(rounds):
        of = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[of == c].sum(axis=0) for c in range(len(centres))])
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres).astype(np.float32)
    return centres


def low_cosines(cosines: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Low quantile of the cosines by length class; classes of few texts are taken with the next ones, shorter texts never have the higher bound."""
    out = np.zeros(_GROUPS)
    for c in range(_GROUPS if len(cosines) else 0):
        away = np.abs(classes - c)
        reach = np.sort(away)[min(COSINES, len(away)) - 1]
        out[c] = np.quantile(cosines[away <= reach], QUANTILE)
    return np.minimum.accumulate(out[::-1])[::-1]


@dataclass
class Languages:
    """Languages in order of name, centroids with the language of each, inverse document frequencies and least cosines."""

    names: list[str]
    centres: np.ndarray
    of: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether the text is too far from every centroid, for each text."""
        names: list[str] = []
        scores, far = [], []
        for words in in_chunks(column):
            rows = vectors_of(words, self.idf)
            near = rows @ self.centres.T
            best = near.argmax(axis=1)
            score = near[np.arange(len(best)), best]
            names += [self.names[k] for k in self.of[best]]
            scores.append(score)
            far.append(score < self.least[length_class(words)])
        return names, np.concatenate(scores), np.concatenate(far)


def training_texts(rows: DataFrame) -> DataFrame:
    """Bounded sample of the training rows: ``lang``, ``h`` and ``text`` of about ``TRAIN_TEXTS`` distinct texts of each language.

    The texts of least hash; rows without an id, of one id, or of one text change nothing.
    """
    known = rows.where("not held_out and lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    texts = known.select("lang", "h").distinct()
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Somewhat more by a bound on the hash, so that no language is sorted whole.
    share = texts.groupBy("lang").agg((F.lit(1.2 * TRAIN_TEXTS + 200) / F.count("*")).alias("share"))
    low = texts.join(share, "lang").where(place < F.col("share"))
    order = Window.partitionBy("lang").orderBy(place, "h")
    chosen = low.select("lang", "h", F.row_number().over(order).alias("place")).where(F.col("place") <= TRAIN_TEXTS)
    own = known.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"], "left_semi")
    return own.groupBy("lang", "h").agg(F.min("text").alias("text"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as the cells of their sequences with the logarithms of their counts, and their length class."""
    for batch in pieces(batches, "text"):
        k = 0
        for words in in_chunks(batch.column("text")):
            counts = counts_of(words)
            row, cell = np.nonzero(counts)
            begin = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(begin), pa.array(v)) for v in (cell.astype(np.int32), counts[row, cell])]
            own = [batch.column(c).slice(k, len(counts)) for c in ("lang", "h")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(length_class(words)), *lists], names=["lang", "h", "size", "cells", "counts"])
            k += len(counts)


def _centroids_of_a_language(idf: np.ndarray):
    """Centroids from all texts of a language, and the nearest cosine of each text to those from the other folds."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        rows = np.zeros((len(table), SIZE), np.float32)
        begin = np.append(0, np.cumsum(pc.list_value_length(table["cells"]).to_numpy()))
        owner = np.repeat(np.arange(len(table)), np.diff(begin))
        cells = pc.list_flatten(table["cells"]).to_numpy()
        rows[owner, cells] = pc.list_flatten(table["counts"]).to_numpy() * idf[cells]
        real = rows.any(axis=1)
        rows, size = rows if real.all() else rows[real], table["size"].to_numpy()[real]
        rows /= np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
        fold, best = np.arange(len(rows)) % FOLDS, np.zeros(len(rows))
        for k in range(FOLDS):
            others = rows[fold != k]
            if len(others):
                best[fold == k] = (rows[fold == k] @ spherical_kmeans(others, CENTROIDS).T).max(axis=1)
        centres = spherical_kmeans(rows, CENTROIDS) if len(rows) else rows
        whole = [pa.array([v.tobytes()], pa.binary()) for v in (centres.astype("<f4"), best.astype("<f8"), size.astype("<i8"))]
        return pa.Table.from_arrays([table["lang"].slice(0, 1).combine_chunks(), *whole], names=["lang", "centres", "cosines", "sizes"])

    return run


def fit_languages(rows: DataFrame) -> Languages | None:
    """The model of the training rows; None without any.

    Texts become cells in tasks, and each language's centroids come from one task,
    which holds its bounded sample. The driver gets ``CENTROIDS`` vectors and
    ``TRAIN_TEXTS`` cosines of each language, however many there are.
    """
    form = "lang string, h long, size long, cells array<int>, counts array<float>"
    sample = stored(training_texts(rows).mapInArrow(_counted, form), "language-sample")
    texts = sample.count()
    seen = np.zeros(SIZE)
    for r in sample.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():
        seen[r["cell"]] = r["count"]
    idf = np.log((1 + texts) / (1 + seen)).astype(np.float32) + np.float32(1)
    found = sample.groupBy("lang").applyInArrow(_centroids_of_a_language(idf), "lang string, centres binary, cosines binary, sizes binary")
    found = sorted(found.collect(), key=lambda r: r["lang"])
    centres = [np.frombuffer(r["centres"], "<f4").reshape(-1, SIZE) for r in found]
    of = np.repeat(np.arange(len(found)), [len(c) for c in centres])
    if not len(of):
        return None
    cosines, sizes = (np.concatenate([np.frombuffer(r[c], t) for r in found]) for c, t in (("cosines", "<f8"), ("sizes", "<i8")))
    least = MARGIN * low_cosines(cosines, sizes)
    return Languages([r["lang"] for r in found], np.concatenate(centres), of, idf, least)


def identify_languages(docs: DataFrame, held_out: F.Column, carried: Sequence[str] = ()) -> DataFrame:
    """Language of every whole text, learned from the rows where ``held_out`` is false and ``lang`` is not null.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; further columns are only used
    by ``held_out``. Result, one row per input row: ``doc_id``, ``held_out``,
    ``lang_pred`` (a learned value; ``und`` for null texts and texts without a
    letter, and for all if nothing could be learned), ``score`` (cosine, 0 for
    ``und``), ``rejected`` (too far from every centroid, or ``und``). Null in
    ``held_out`` counts as held out. Repeated rows get equal predictions; ties go to
    the first language in order of name. An empty table gives an empty table. With
    ``carried``, each row also has these columns of its own input row, as ``row``.
    """
    row = [F.struct(*carried).alias("row")] if carried else []
    rows = docs.select(
        F.col("doc_id").cast("long"), "lang", F.lower("text").alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"), *row
    )
    extra = ["row"] if carried else []
    model = fit_languages(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            names, score, far = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            if model is not None:
                names, score, far = model.predict(batch.column("text"))
                names = [n if ok else "und" for n, ok in zip(names, lettered, strict=True)]
                score, far = np.where(lettered, np.clip(score, 0, 1), 0), far | ~lettered
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "held_out")),
                    *map(pa.array, (names, score.astype(np.float64), far)),
                    *(batch.column(c) for c in extra),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected", *extra],
            )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    form = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    form += "".join(f", row {rows.schema['row'].dataType.simpleString()}" for _ in extra)
    return rows.select("doc_id", "held_out", "text", lettered, *extra).mapInArrow(run, form)
