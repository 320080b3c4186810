"""Words of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: What separates words in the contracts: blank and 0x09 to 0x0D.
WHITE = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once; bounds the numpy arrays of a task.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_power = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        size = max(n, 2 * len(_power), 256)
        _power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _BASE))])
    return _power


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of MurmurHash3: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lower_table() -> np.ndarray:
    """Byte to byte, with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def white_words() -> np.ndarray:
    """True for each byte that belongs to a word of the contracts."""
    inside = np.ones(256, bool)
    inside[list(WHITE)] = False
    return inside


def letter_words() -> np.ndarray:
    """True for ASCII letters and digits and for all bytes of other scripts."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


LOWER, WHITE_WORDS, LETTER_WORDS = lower_table(), white_words(), letter_words()


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text begins (one more than texts); null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``PIECE`` bytes of text, whole texts each."""
    for batch in batches:
        sizes = np.diff(column_bytes(batch.column(name))[1])
        begin = 0
        while begin < batch.num_rows:
            total = np.cumsum(sizes[begin:])
            rows = max(1, int(np.searchsorted(total, PIECE, "right")))
            yield batch.slice(begin, rows)
            begin += rows


@dataclass
class Words:
    """``start`` and ``length`` in bytes, a 64-bit ``hash``; ``first[d]:first[d+1]`` are the words of text d."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(column: pa.Array, inside: np.ndarray = WHITE_WORDS) -> Words:
    """All words of a text column, A-Z lower-cased, split where ``inside`` is false or a text ends."""
    raw, at = column_bytes(column)
    data = LOWER[raw]
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (edge[:-1] | ~before))
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    length = np.flatnonzero(word & (edge[1:] | ~after)) + 1 - start
    first = np.searchsorted(start, at)
    if not len(start):
        return Words(data, start, length, np.zeros(0, np.uint64), first)
    begin = np.cumsum(length) - length
    place = np.arange(int(begin[-1] + length[-1])) - np.repeat(begin, length)
    value = (data[word].astype(np.uint64) + np.uint64(1)) * _powers(int(length.max()))[place]
    return Words(data, start, length, mix64(np.add.reduceat(value, begin)), first)


def as_long(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches cut between groups: a table of whole groups, and where each group begins (one more than groups).

    Partitions must be sorted by ``keys``, which are longs or ints. Only the rows of
    one group, or ``rows`` rows of small ones, are held.
    """
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(table: pa.Table, last: bool):
        values = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, bool)
        change[:1] = True
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if last:
            return table, np.append(starts, table.num_rows), None
        return table.slice(0, int(starts[-1])), starts, table.slice(int(starts[-1]))

    grown = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < max(rows, 2 * grown):
            continue
        done, starts, rest = cut(pa.Table.from_batches(held), False)
        held = rest.to_batches()
        count = grown = rest.num_rows
        if done.num_rows:
            yield done, starts
    if count:
        done, starts, _ = cut(pa.Table.from_batches(held), True)
        yield done, starts
