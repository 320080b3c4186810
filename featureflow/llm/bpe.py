"""Byte-pair encoding and decoding with the files of public tokenizers.

The file gives vocabulary, merges, normalisation and word pattern; it is read on
the driver, as its path is a parameter, and reaches the tasks with the job. A
word's parts stand in one contiguous array next to the ranks of adjacent pairs:
scan for the least rank, delete that boundary, refresh the two neighbouring
ranks. The distinct words of many texts, one word a row, take each step together.
Words beyond the widest array use a heap of pairs instead, as the
scans would grow with the square of the length; both give the same parts.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import pieces

#: Widths of the rank arrays in bytes of a word; longer words use the heap.
WIDTHS = (8, 12, 16, 24, 48, 128)
#: Distinct words a task remembers before it starts anew, and bytes of them with their ids and decoded texts.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 16 << 20
#: Entries of the rank arrays that words are put into at once.
CELLS = 1 << 19


def byte_characters() -> list[str]:
    """Printable character that stands for each byte: itself where it is one, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merges:
    """Rank of each pair of parts that merges, and the part that each rank gives."""

    def __init__(self, merges: list[list[str]], vocabulary: dict[str, int]):
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            self.rank.setdefault((vocabulary[a], vocabulary[b]), rank)
        self.whole = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.none = len(merges)
        keys = np.array([self._key(np.int64(a), np.int64(b)) for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.by_key = keys[order], np.array(list(self.rank.values()), np.int64)[order]

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a << 32) + b

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``none`` where a pair does not merge or a part is missing (-1)."""
        key = self._key(a, b)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.by_key[at], self.none)


class Tokenizer:
    """Encoder of a tokenizer file of this kind: NFC, blanks, lower case; words by pattern; byte pairs with word ends."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE"
            or kinds != ["NFC", "Replace", "Lowercase"]
            or [p["type"] for p in split] != ["Split", "ByteLevel"]
            or split[0]["behavior"] != "Removed"
            or not split[0]["invert"]
            or spec["decoder"]
        ):
            raise ValueError("a tokenizer file of another kind")
        blanks = spec["normalizer"]["normalizers"][1]
        if (blanks["pattern"], blanks["content"]) != ({"Regex": r"\s+"}, " "):
            raise ValueError("a tokenizer file with another treatment of blanks")
        self.pattern = regex.compile(split[0]["pattern"]["Regex"])
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in self.vocabulary.items()}
        self.merges = Merges(model["merges"], self.vocabulary)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        strings = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None
        characters = byte_characters()
        self.inner = np.array([self.vocabulary[c] for c in characters], np.int64)
        self.last = np.array([self.vocabulary[c + self.end] for c in characters], np.int64)
        #: Words met so far, with their ids as bytes and their decoded text.
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        self.held = 0

    def forget(self) -> None:
        """Let go of all words; a worker process outlives the task that met them."""
        self.ids, self.decoded, self.held = {}, {}, 0

    def normalize(self, text: str) -> str:
        """The text as the pattern sees it. Lower case is by character: a final sigma is like any other.

        Runs of blanks need not become one blank, as the pattern leaves out blanks of any kind.
        """
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def learn(self, words: list[str]) -> None:
        """Remember the ids and the decoded text of words not met before."""
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        found: list = [None] * len(words)
        for low, high in zip((0, *WIDTHS[:-1]), WIDTHS, strict=True):
            own = np.flatnonzero((size > low) & (size <= high))
            for begin in range(0, len(own), CELLS // high):
                chosen = own[begin : begin + CELLS // high]
                parts = np.full((len(chosen), high), -1, np.int64)
                inside = np.arange(high) < size[chosen][:, None]
                parts[inside] = self.inner[np.frombuffer(b"".join(data[k] for k in chosen), np.uint8)]
                parts[np.arange(len(chosen)), size[chosen] - 1] = self.last[[data[k][-1] for k in chosen]]
                for k, ids in zip(chosen, scan_merges(parts, self.merges), strict=True):
                    found[k] = ids.tolist()
        for k in np.flatnonzero(size > WIDTHS[-1]):
            parts = self.inner[np.frombuffer(data[k], np.uint8)].tolist()
            found[k] = heap_merges(parts[:-1] + [int(self.last[data[k][-1]])], self.merges)
        for word, ids in zip(words, found, strict=True):
            ids = [self.special[word]] if word in self.special else ids
            packed, plain = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
            self.ids[word], self.decoded[word] = packed, plain
            self.held += len(word) + len(packed) + len(plain)

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Of each text the ids, as little-endian unsigned 32-bit integers, and their decoded text."""
        if len(self.ids) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.forget()
        split = [self.segments(text) for text in texts]
        self.learn(list({w for words in split for w in words if w not in self.ids}))
        ids, decoded = self.ids.__getitem__, self.decoded.__getitem__
        return [(b"".join(map(ids, words)), " ".join(map(decoded, words))) for words in split]

    def segments(self, text: str) -> list[str]:
        """The words of a text in order; strings of special tokens stand as they are."""
        if not (self.specials and self.specials.search(text)):
            return self.pattern.findall(self.normalize(text))
        out = []
        for segment in self.specials.split(text):
            out += [segment] if segment in self.special else self.pattern.findall(self.normalize(segment))
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens with blanks between them, special ones included; ids without a token are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def scan_merges(parts: np.ndarray, merges: Merges) -> list[np.ndarray]:
    """Merged parts of short words, one word a row, padded with -1; every step makes one merge in each word left."""
    done: list[np.ndarray | None] = [None] * len(parts)
    row = np.arange(len(parts))
    places = np.arange(parts.shape[1])
    ranks = merges.ranks(parts[:, :-1], parts[:, 1:])
    while len(row):
        at = ranks.argmin(axis=1)
        each = np.arange(len(row))
        least = ranks[each, at]
        live = least < merges.none
        for k in np.flatnonzero(~live):
            done[row[k]] = parts[k][parts[k] >= 0]
        row, parts, ranks, at, least = row[live], parts[live], ranks[live], at[live], least[live]
        each = np.arange(len(row))
        parts[each, at] = merges.whole[least]
        # Delete the boundary after the merged part, in both arrays.
        moved = np.minimum(places + (places > at[:, None]), len(places) - 1)
        parts = np.take_along_axis(parts, moved, axis=1)
        parts[:, -1] = -1
        moved = np.minimum(places[:-1] + (places[:-1] >= at[:, None]), len(places) - 2)
        ranks = np.take_along_axis(ranks, moved, axis=1)
        ranks[:, -1] = merges.none
        # Refresh the ranks beside the merged part.
        after = np.minimum(at, len(places) - 2)
        ranks[each, after] = merges.ranks(parts[each, after], parts[each, after + 1])
        before = np.maximum(at - 1, 0)
        ranks[each, before] = merges.ranks(parts[each, before], parts[each, before + 1])
    return done


def heap_merges(parts: list[int], merges: Merges) -> list[int]:
    """Merged parts of a long word, by a heap of pairs and links between the parts left."""
    size = len(parts)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < size and (rank := merges.rank.get((parts[i], parts[j]))) is not None:
            heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(size - 1):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= size or parts[j] != right:
            continue  # one of the two has been merged since
        parts[i] = int(merges.whole[merges.rank[left, right]])
        parts[j] = -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p >= 0]


@functools.lru_cache(maxsize=2)
def tokenizer_of(file: str) -> Tokenizer:
    """One tokenizer per worker process, so that tasks need not read the file again."""
    return Tokenizer(file)


def encoded_batches(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    """The rows of one task encoded and decoded; what it remembers goes when it ends, however it ends."""
    tokenizer = tokenizer_of(file)
    try:
        for batch in pieces(batches, "text"):
            encoded = tokenizer.encode_all([text or "" for text in batch.column("text").to_pylist()])
            ids = [e[0] for e in encoded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([e[1] for e in encoded], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )
    finally:
        tokenizer.forget()


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """Every whole text encoded and decoded again.

    ``path`` is a tokenizer file that the driver can read. ``docs`` needs ``doc_id``
    and ``text``; other columns are left out, whatever their names. Result, one row
    per input row: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit
    integers in a row), ``decoded``. Strings of special tokens in a text become
    those tokens. Null and empty texts have no tokens and decode to the empty
    text. Repeated rows give repeated rows, an empty table an empty one.
    """
    with open(path, encoding="utf-8") as f:
        file = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded_batches(batches, file)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
