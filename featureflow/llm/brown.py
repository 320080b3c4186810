"""Language-model scores from a class-based bigram model with exchange clustering.

A text is its words, A-Z lower-cased, and one end token. P(word | previous word)
is P(class | previous class) * P(word | class). Every word seen at least twice in
training has a class of its own choice; singletons and unseen words take that of
the cell of their last three bytes. Clustering starts on the driver, with the
``UNIT_WORDS`` most frequent words and the cells as units. From there words move
one by one, in tasks: each counts its neighbours by class and goes to the class
that explains the training text best, the class table being all that is
broadcast of the others. The ``HEAD`` most frequent words, whose classes and
counts are broadcast, move in ``ROUNDS`` rounds of ``PARTS`` passes; a pass that
makes the table explain the text worse is undone. All other words move once,
after them; their classes and counts are joined by a hash of the word.

Counts, class bigrams and the scored words cover all tokens of the training
documents; the sizes above only bound what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import stored
from .words import Words, as_long, pieces, runs, words_of

#: Units that the clustering starts with: frequent words, and cells for all others.
UNIT_WORDS, SHAPES = 1024, 509
UNITS = UNIT_WORDS + SHAPES + 1
#: Classes, the end token's included, and passes of the exchange algorithm.
CLASSES, PASSES = 64, 8
#: Words whose classes and counts are broadcast; rounds in which they move, and parts of them that move at once.
HEAD = 1 << 18
ROUNDS, PARTS = 2, 3
#: Added to each word count within its class, and weight of the class unigram in a transition.
ADD, BACKOFF = 0.5, 4.0
#: The end token in place of a word's hash.
END = np.uint64(0xE2D0E2D0E2D0E2D0)
END_UNIT = UNITS - 1
#: Distinct words a task holds before it passes partial counts on.
HELD = 1 << 20
#: Bytes of codes and words handled at once.
CODES, MOVERS = 4 << 20, 512
#: Neighbours of a word are counted by the class after it, as itself, and by the class before it.
SELF, BEFORE, KEYS = CLASSES, CLASSES + 1, 2 * CLASSES + 1


def shapes_of(words: Words) -> np.ndarray:
    """Number of each word's shape: its last three bytes (or fewer)."""
    code = np.zeros(len(words.start), np.int64)
    last = words.start + words.length - 1
    for back in range(3):
        at = np.maximum(last - back, words.start)
        code = code * 257 + np.where(words.length > back, words.data[at].astype(np.int64) + 1, 0)
    return code % SHAPES


def _sum_by(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys; the first values summed, of the others any one."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    if not len(key):
        return [key, *values]
    return [key[first], np.add.reduceat(values[0][order], first), *(v[order][first] for v in values[1:])]


def word_counts(docs: DataFrame) -> DataFrame:
    """Count of every distinct token of the texts: ``word`` (hash), ``shape`` (-1 for the end token), ``n``."""

    def run(batches):
        held: list[list[np.ndarray]] = []

        def out():
            key, n, shape = _sum_by(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held[:] = [[key, n, shape]]
            return pa.RecordBatch.from_arrays([as_long(key), pa.array(shape), pa.array(n)], names=["word", "shape", "n"])

        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            key = np.append(words.hash, END)
            n = np.append(np.ones(len(words.hash), np.int64), batch.num_rows)
            held.append(_sum_by(key, n, np.append(shapes_of(words), -1)))
            if sum(len(h[0]) for h in held) > 2 * HELD:
                batch = out()
                if batch.num_rows > HELD:
                    held.clear()
                    yield batch
        if held:
            yield out()

    parts = docs.select("text").mapInArrow(run, "word long, shape long, n long")
    return parts.groupBy("word").agg(F.first("shape").alias("shape"), F.sum("n").alias("n"))


class Units:
    """Units of words, given the hashes of the words that have their own."""

    def __init__(self, frequent: np.ndarray):
        order = np.argsort(frequent)
        self.hashes, self.number = frequent[order], order

    def sequence(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Units of all tokens, each text followed by the end; the place of each word among them."""
        unit = UNIT_WORDS + shapes_of(words)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
            own = self.hashes[at] == words.hash
            unit[own] = self.number[at[own]]
        place = np.arange(len(words.hash)) + words.text
        tokens = np.full(len(words.hash) + len(words.first) - 1, END_UNIT)
        tokens[place] = unit
        return tokens, place


def code_texts(rows: DataFrame, head: np.ndarray, units: Units) -> DataFrame:
    """Texts as ``codes``: 32 bits a token, place in ``head``, its size for the end, beyond it the place in the text's ``rare``.

    ``rare`` are the distinct words outside the head, ``cells`` their cells.
    """
    order = np.argsort(head)
    hashes, end = head[order], len(head)

    def run(batches):
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            tokens, place = units.sequence(words)
            codes = np.full(len(tokens), end, np.int32)
            known = np.zeros(len(words.hash), bool)
            if end:
                at = np.minimum(np.searchsorted(hashes, words.hash), end - 1)
                known = hashes[at] == words.hash
                codes[place[known]] = order[at[known]]
            text, key, cell = words.text[~known], words.hash[~known], tokens[place[~known]] - UNIT_WORDS
            by = np.lexsort((key, text))
            new = np.ones(len(by), bool)
            new[1:] = (key[by][1:] != key[by][:-1]) | (text[by][1:] != text[by][:-1])
            at = by[new]
            first = np.searchsorted(text[at], np.arange(len(words.first)))
            rank = np.empty(len(by), np.int64)
            rank[by] = np.cumsum(new) - 1
            codes[place[~known]] = end + 1 + rank - first[text]
            begin = 4 * (words.first + np.arange(len(words.first)))
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), x) for x in (as_long(key[at]), pa.array(cell[at].astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), _binary(begin, codes), *lists], names=["doc_id", "held_out", "codes", "rare", "cells"]
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, codes binary, rare array<long>, cells array<int>")


def _binary(begin: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values, value k from byte ``begin[k]`` of the data on."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column in a row, and where each value begins (one more than values)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), at - at[0]


class Coded:
    """Codes of some coded texts; ``begin[k]:begin[k+1]`` are those of text k, ``tail`` the places of words outside the head."""

    def __init__(self, batch: pa.RecordBatch, end: int):
        data, at = _bytes(batch.column("codes"))
        self.codes, self.begin = data.view(np.int32), at // 4
        self.tail = np.flatnonzero(self.codes > end)
        text = np.searchsorted(self.begin, self.tail, "right") - 1
        self.number = self.codes[self.tail].astype(np.int64) - end - 1
        first = np.append(0, np.cumsum(batch.column("rare").value_lengths().to_numpy(zero_copy_only=False)))
        at = first[text] + self.number
        self.words = batch.column("rare").flatten().to_numpy()[at]
        self.cells = batch.column("cells").flatten().to_numpy()[at]

    def sequence(self, of_code: np.ndarray, of_cell: np.ndarray) -> np.ndarray:
        """What the tables say of each token; every text ends with the end token."""
        out = of_code[np.minimum(self.codes, len(of_code) - 1)]
        out[self.tail] = of_cell[self.cells]
        return out


def _portions(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CODES`` bytes of the column."""
    for batch in batches:
        ends, begin = _bytes(batch.column(column))[1], 0
        while begin < batch.num_rows:
            rows = max(1, int(np.searchsorted(ends, ends[begin] + CODES, "right")) - 1 - begin)
            yield batch.slice(begin, rows)
            begin += rows


def _table(rows: DataFrame, size: int) -> np.ndarray:
    """``size`` squared numbers from partial sums by ``pair``."""
    found = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(size, size)


def _pairs(sequences: Iterator[np.ndarray], size: int, end: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size * size, np.int64)
    for tokens in sequences:
        tokens = tokens.astype(np.int64)
        total += np.bincount(np.append(end, tokens[:-1]) * size + tokens, minlength=size * size)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])


def bigrams_of(coded: DataFrame, of_code: np.ndarray, of_cell: np.ndarray, size: int) -> np.ndarray:
    """How often each unit or class follows each other one, over all texts; ``size`` squared numbers whatever the input."""
    end = len(of_code) - 1

    def run(batches):
        parts = (Coded(b, end) for b in _portions(batches, "codes"))
        yield from _pairs((x.sequence(of_code, of_cell) for x in parts), size, int(of_code[end]))

    return _table(coded.mapInArrow(run, "pair long, n long"), size)


def _packed(key: np.ndarray, n: np.ndarray, word: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each word with its neighbours: ``key`` is its place among the words times ``KEYS``, plus the neighbour."""
    first = np.append(np.flatnonzero(np.append(True, key[1:] // KEYS != key[:-1] // KEYS)), len(key)) if len(key) else np.zeros(1, int)
    row = np.zeros(len(key), [("k", "u1"), ("n", "<u4")])
    row["k"], row["n"] = key % KEYS, n
    for k in range(0, len(first) - 1, 1 << 14):
        cut = first[k : k + (1 << 14) + 1]
        own = key[cut[:-1]] // KEYS
        seen = _binary((cut - cut[0]) * row.itemsize, row[cut[0] : cut[-1]])
        yield pa.RecordBatch.from_arrays([as_long(word[own]), pa.array(cell[own]), seen], names=["word", "cell", "seen"])


def _neighbours(x: Coded, classes: np.ndarray, at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the token and what is counted, for all neighbours of the tokens at ``at``; ``same``: the next is the same word."""
    before = np.append(0, classes[:-1])[at] + BEFORE
    again = np.append(False, same[:-1])  # the pair of a word with itself counts once
    follows = np.where(same[at], SELF, classes[np.minimum(at + 1, len(classes) - 1)])
    return np.concatenate([at, at[~again[at]]]), np.concatenate([follows, before[~again[at]]])


SEEN = "word long, cell int, seen binary"


def head_neighbours(coded: DataFrame, of_code: np.ndarray, of_cell: np.ndarray, part: int) -> DataFrame:
    """Neighbours by class of each word of a part of the head; ``word`` is its code."""
    end = len(of_code) - 1
    size = (end + PARTS - 1) // PARTS

    def run(batches):
        total = np.zeros(size * KEYS, np.uint32)
        for batch in _portions(batches, "codes"):
            x = Coded(batch, end)
            classes = x.sequence(of_code, of_cell).astype(np.int64)
            same = np.append(x.codes[1:] == x.codes[:-1], False)
            at = np.flatnonzero((x.codes < end) & (x.codes % PARTS == part))
            place, what = _neighbours(x, classes, at, same)
            key, n = np.unique(x.codes[place].astype(np.int64) // PARTS * KEYS + what, return_counts=True)
            total[key] += n.astype(np.uint32)
        key = np.flatnonzero(total)
        yield from _packed(key, total[key], np.arange(size) * PARTS + part, np.full(size, -1, np.int32))

    return coded.mapInArrow(run, SEEN)


def tail_neighbours(coded: DataFrame, of_code: np.ndarray, of_cell: np.ndarray) -> DataFrame:
    """Neighbours by class of each word outside the head; ``word`` is its hash."""
    end = len(of_code) - 1

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def out():
            word, what, cell = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            words, first, own = np.unique(word, return_index=True, return_inverse=True)
            key, n = np.unique(own.astype(np.int64) * KEYS + what, return_counts=True)
            return _packed(key, n, words, cell[first].astype(np.int32))

        for batch in _portions(batches, "codes"):
            x = Coded(batch, end)
            classes = x.sequence(of_code, of_cell).astype(np.int64)
            word, cell = np.zeros(len(classes), np.int64), np.zeros(len(classes), np.int64)
            word[x.tail], cell[x.tail] = x.words, x.cells
            tail = x.codes > end
            same = np.append(tail[1:] & tail[:-1] & (word[1:] == word[:-1]), False)
            place, what = _neighbours(x, classes, x.tail, same)
            held.append((word[place], what, cell[place]))
            if sum(len(h[0]) for h in held) > 2 * HELD:
                yield from out()
        if held:
            yield from out()

    return coded.mapInArrow(run, SEEN)


def best_classes(seen: np.ndarray, old: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each word that raises the log likelihood of the class bigrams most if it alone moves; a row of ``seen`` per word."""
    size, each = len(table), np.arange(len(seen))
    follow, twice, lead = seen[:, :size], seen[:, size], seen[:, size + 1 :]
    own = follow[each, old] + lead[each, old] + twice
    gain = np.zeros((len(seen), size))
    for counts, other, way in ((follow, lead, table), (lead, follow, table.T)):
        w, c = np.nonzero(counts)
        n = counts[w, c][:, None]
        base = way[:, c].T.copy()
        inside = np.flatnonzero(c == old[w])
        base[inside] -= other[w[inside]]
        outside = np.flatnonzero(c != old[w])
        base[outside, old[w[outside]]] -= n[outside, 0]
        base = np.maximum(base, 0)
        change = _xlogx(base + n) - _xlogx(base)
        change[np.arange(len(w)), c] = 0  # the class with itself follows below
        if len(w):
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            gain[w[first]] += np.add.reduceat(change, first)
    base = np.tile(table.diagonal(), (len(seen), 1))
    base[each, old] -= own
    gain += _xlogx(base + follow + lead + twice[:, None]) - _xlogx(base)
    for sums, mass in ((table.sum(axis=1), follow.sum(axis=1) + twice), (table.sum(axis=0), lead.sum(axis=1) + twice)):
        base = np.tile(sums, (len(seen), 1))
        base[each, old] -= mass
        gain -= _xlogx(base + mass[:, None]) - _xlogx(base)
    gain[:, 0] = -np.inf  # the end token is alone
    new = gain.argmax(axis=1)
    return np.where(gain[each, new] > gain[each, old] * (1 + 1e-9 * np.sign(gain[each, old])), new, old)


def moved(neighbours: DataFrame, of_code: np.ndarray, of_cell: np.ndarray, table: np.ndarray) -> DataFrame:
    """``word``, ``class``: the best class of every word seen at least twice, all other words as they are."""

    def run(batches):
        for rows, starts in runs(batches, ["word"]):
            word, cell = (rows.column(c).to_numpy()[starts[:-1]] for c in ("word", "cell"))
            old = np.where(cell < 0, of_code[np.where(cell < 0, word, 0)], of_cell[cell])
            data, at = _bytes(rows.column("seen"))
            entry = data.view([("k", "u1"), ("n", "<u4")])
            at = at[starts] // entry.itemsize
            for k in range(0, len(word), MOVERS):
                cut = at[k : k + MOVERS + 1]
                some = entry[cut[0] : cut[-1]]
                key = np.repeat(np.arange(len(cut) - 1), np.diff(cut)) * KEYS + some["k"]
                seen = np.bincount(key, some["n"], (len(cut) - 1) * KEYS).reshape(-1, KEYS)
                often = seen[:, : SELF + 1].sum(axis=1) > 1
                own = slice(k, k + MOVERS)
                new = best_classes(seen[often], old[own][often], table)
                yield pa.RecordBatch.from_arrays([pa.array(word[own][often]), pa.array(new.astype(np.int32))], names=["word", "class"])

    return neighbours.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word long, class int")


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for a term that is the same for all classes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def exchange_head(coded: DataFrame, of_code: np.ndarray, of_cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the codes after all rounds, and the class bigrams."""
    table = bigrams_of(coded, of_code, of_cell, CLASSES)
    for step in range(ROUNDS * PARTS):
        rows = moved(head_neighbours(coded, of_code, of_cell, step % PARTS), of_code, of_cell, table).toArrow()
        found = of_code.copy()
        found[rows["word"].to_numpy()] = rows["class"].to_numpy()
        new = bigrams_of(coded, found, of_cell, CLASSES)
        if likelihood(new) > likelihood(table):
            of_code, table = found, new
    return of_code, table


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each unit; the last unit, the end token, is alone in class 0.

    Each unit in turn moves to the class that raises the log likelihood of the
    class bigrams most, until a pass moves none or ``passes`` are done. The start
    deals units to classes by descending frequency, so runs agree.
    """
    size = len(bigrams)
    mass, led = bigrams.sum(axis=0), bigrams.sum(axis=1)
    order = [u for u in np.argsort(-mass, kind="stable") if u != size - 1 and mass[u]]
    of = np.zeros(size, np.int64)
    of[: size - 1] = 1 + np.arange(size - 1) % (classes - 1)
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    after, before = bigrams @ member, bigrams.T @ member  # unit with following, with preceding classes
    table = member.T @ after
    rows, columns = member.T @ led, member.T @ mass
    for _ in range(passes):
        moved = 0
        for u in order:
            old, twice = of[u], bigrams[u, u]
            r, left = after[u].copy(), before[u].copy()
            table[old] -= r
            table[:, old] -= left
            table[old, old] += twice
            r[old] -= twice
            left[old] -= twice
            rows[old] -= led[u]
            columns[old] -= mass[u]
            diagonal = table.diagonal()
            gain = (_xlogx(table + r) - _xlogx(table)).sum(axis=1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(axis=1)
            gain -= _xlogx(diagonal + r) + _xlogx(diagonal + left) - _xlogx(diagonal)
            gain += _xlogx(diagonal + r + left + twice)
            gain -= _xlogx(rows + led[u]) - _xlogx(rows) + _xlogx(columns + mass[u]) - _xlogx(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9 * abs(gain[old]):
                new = old
            r[new] += twice
            left[new] += twice
            table[new] += r
            table[:, new] += left
            table[new, new] -= twice
            rows[new] += led[u]
            columns[new] += mass[u]
            if new != old:
                moved += 1
                of[u] = new
                for counts, way in ((after, bigrams[:, u]), (before, bigrams[u])):
                    counts[:, old] -= way
                    counts[:, new] += way
        if not moved:
            break
    return of


class ClassModel:
    """Log10 transition table and the words' share of each class, for scoring in tasks.

    ``bigrams``, ``kinds`` (distinct words) and ``of`` (class) are by unit, or by
    class; ``counts`` by code, the end token's last. ``head`` and ``units`` are the
    words that codes and units stand for.
    """

    def __init__(self, bigrams: np.ndarray, kinds: np.ndarray, of: np.ndarray, head: np.ndarray, counts: np.ndarray, units: Units):
        member = np.zeros((len(of), CLASSES))
        member[np.arange(len(of)), of] = 1
        table = member.T @ bigrams @ member
        mass = table.sum(axis=0)
        share = (mass + 1) / (mass.sum() + CLASSES)
        self.transition = np.log10((table + BACKOFF * share) / (table.sum(axis=1, keepdims=True) + BACKOFF))
        # The end token is the only word of its class.
        self.shared = np.log10(mass + ADD * (kinds @ member + 1))
        self.shared[0] = 0.0
        self.of, self.units = of, units
        self.head, self.counts = head, counts

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's sum over its tokens, from their classes."""
        for batch in _portions(batches, "classes"):
            classes, at = _bytes(batch.column("classes"))
            value = self.transition[np.append(np.uint8(0), classes[:-1]), classes] - self.shared[classes]
            sums = pa.array(np.add.reduceat(value, at[:-1]) if batch.num_rows else np.zeros(0))
            rest = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "counted", "known")]
            yield pa.RecordBatch.from_arrays([*rest, sums], names=["doc_id", "held_out", "n_tokens", "counted", "known", "model"])


def classed_texts(coded: DataFrame, words: DataFrame, of_code: np.ndarray, of_cell: np.ndarray, logs: np.ndarray) -> DataFrame:
    """Texts as ``classes``, one byte a token, and sums over their words: ``counted`` (logarithms of counts), ``known``.

    ``words`` has ``word``, ``n`` and, for those that chose one, ``class``; ``logs`` is by code.
    """
    end = len(of_code) - 1
    fixed = "row long, doc_id long, held_out boolean, n_tokens long, counted double, known long, classes binary"

    def by_head(batches):
        for batch in _portions(batches, "codes"):
            x = Coded(batch, end)
            value, known = logs[np.minimum(x.codes, end)], np.ones(len(x.codes), np.int64)
            value[x.tail], known[x.tail] = 0, 0
            sums = [np.add.reduceat(v, x.begin[:-1]) for v in (value, known)]
            number = _binary(4 * np.searchsorted(x.tail, x.begin), x.number.astype(np.int32))
            own = [batch.column(c) for c in ("row", "doc_id", "held_out")]
            classes = _binary(x.begin, x.sequence(of_code, of_cell).astype(np.uint8))
            tail = _binary(4 * np.searchsorted(x.tail, x.begin), (x.tail - np.repeat(x.begin[:-1], np.diff(np.searchsorted(x.tail, x.begin)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(np.diff(x.begin)), *map(pa.array, sums), classes, tail, number],
                names=["row", "doc_id", "held_out", "n_tokens", "counted", "known", "classes", "tail", "number"],
            )

    def by_word(batches):
        for batch in _portions(batches, "classes"):
            classes, begin = _bytes(batch.column("classes"))
            classes = classes.copy()
            chosen = batch.column("chosen")
            sizes = chosen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = chosen.flatten().to_numpy()
            text = np.repeat(np.arange(batch.num_rows), sizes)
            tail, at = _bytes(batch.column("tail"))
            where = np.repeat(np.arange(batch.num_rows), np.diff(at) // 4)
            number = _bytes(batch.column("number"))[0].view(np.int32).astype(np.int64)
            if len(values):
                # Choices by text and number of the word within it; words without one keep their cell's class.
                key = (text.astype(np.int64) << 32) + (values >> 8)
                order = np.argsort(key)
                key, values = key[order], values[order]
                want = (where.astype(np.int64) << 32) + number
                found = np.minimum(np.searchsorted(key, want), len(key) - 1)
                hit = key[found] == want
                place = begin[where] + tail.view(np.int32)
                classes[place[hit]] = (values[found[hit]] & 255).astype(np.uint8)
            rest = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "counted", "known")]
            yield pa.RecordBatch.from_arrays(
                [*rest, _binary(begin, classes)], names=["doc_id", "held_out", "n_tokens", "counted", "known", "classes"]
            )

    first = coded.select("row", "doc_id", "held_out", "codes", "rare", "cells").mapInArrow(by_head, fixed + ", tail binary, number binary")
    # How often a text has each of its rare words follows from the codes.
    rare = coded.where(F.size("rare") > 0).select("row", "codes", "rare", "cells")

    def times(batches):
        for batch in _portions(batches, "codes"):
            x = Coded(batch, end)
            lengths = batch.column("rare").value_lengths().to_numpy(zero_copy_only=False)
            start = np.append(0, np.cumsum(lengths))
            text = np.searchsorted(x.begin, x.tail, "right") - 1
            k = np.bincount(start[text] + x.number, minlength=start[-1])
            row = np.repeat(batch.column("row").to_numpy(), lengths)
            number = np.arange(start[-1]) - np.repeat(start[:-1], lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), batch.column("rare").flatten(), pa.array(number), pa.array(k)], names=["row", "word", "number", "k"]
            )

    found = rare.mapInArrow(times, "row long, word long, number long, k long").join(words, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("rare_counted"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.shiftleft("number", 8) + F.col("class"))).alias("chosen"),
    )
    whole = first.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))).alias("counted"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("known"),
        "classes",
        "tail",
        "number",
        "chosen",
    )
    return whole.mapInArrow(by_word, "doc_id long, held_out boolean, n_tokens long, counted double, known long, classes binary")


def score_texts(docs: DataFrame, held_out: F.Column) -> DataFrame:
    """Scores of all documents by a model of those where ``held_out`` is false.

    ``docs`` needs ``doc_id`` and ``text``; other columns are only used by
    ``held_out``. Result, one row per input row: ``doc_id``, ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigram),
    ``score`` (class model), both log10. Null texts count as empty ones: a single
    end token. Repeated rows and ids each get their row. Null in ``held_out``
    counts as false. Without training documents every token is unknown, and the
    scores are those of the smoothing alone.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = stored(word_counts(rows.where(~F.col("held_out"))), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where("shape >= 0").orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    head, number = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    units = Units(head[:UNIT_WORDS])
    end = len(head)
    # Row numbers are fixed once the rows are written.
    coded = stored(code_texts(rows, head, units).withColumn("row", F.monotonically_increasing_id()), "coded")
    learned = coded.where(~F.col("held_out"))
    unit = np.append(UNIT_WORDS + top["shape"].to_numpy(), END_UNIT)
    unit[: min(end, UNIT_WORDS)] = np.arange(min(end, UNIT_WORDS))
    of = exchange(bigrams_of(learned, unit, UNIT_WORDS + np.arange(SHAPES), UNITS))
    of_code, of_cell = of[unit], of[UNIT_WORDS : UNIT_WORDS + SHAPES]
    kinds, choices = np.zeros(CLASSES), None
    if end:
        of_code, table = exchange_head(learned, of_code, of_cell)
        kinds += np.bincount(of_code[:end], minlength=CLASSES)
    words = counts.select("word", "n", F.lit(None).cast("int").alias("class"))
    if distinct - 1 > end:
        # Words outside the head come after its last one.
        last = top.slice(end - 1).to_pylist()[0]
        outside = (F.col("shape") >= 0) & ((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"])))
        rarer = learned.where(F.size("rare") > 0)
        choices = moved(tail_neighbours(rarer, of_code, of_cell), of_code, of_cell, table)
        words = stored(counts.where(outside).join(choices, "word", "left").select("word", "shape", "n", "class"), "word-classes")
        for shape, own, n in words.groupBy("shape", "class").count().collect():
            kinds[of_cell[shape] if own is None else own] += n
        words = words.select("word", "n", "class")
    ends = counts.where("shape = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    number = np.append(number, ends)
    classed = stored(classed_texts(coded, words, of_code, of_cell, np.log10(number + ADD)), "classed")

    def sequences(batches):
        yield from _pairs((_bytes(b.column("classes"))[0] for b in _portions(batches, "classes")), CLASSES, 0)

    table = _table(classed.where(~F.col("held_out")).select("classes").mapInArrow(sequences, "pair long, n long"), CLASSES)
    model = ClassModel(table, kinds, np.arange(CLASSES), head, number, units)

    def run(batches):
        yield from model.rows(batches)

    scored = classed.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, counted double, known long, model double")
    per_token = float(np.log10(total + ADD * (distinct + 1)))
    end_known = 1 if ends else 0
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") - (1 - end_known)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("counted") - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("model") + F.col("counted") - float(np.log10(ends + ADD))).alias("score"),
    )
