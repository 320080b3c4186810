"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is a vector of the word (hashed) next to the mean of the vectors
of its character sequences of three and five bytes (hashed). Two gated recurrent
layers read each window of words, one from each end; attention weighs their
states, and a linear layer gives the window's logit. A text's score is that of
its most toxic window; windows overlap by eight words and cover the whole text. In
training a text's loss goes to its most toxic window in the same way.

Training runs on a bounded sample of the labelled rows (``TRAIN_TOXIC`` and
``TRAIN_CLEAN`` whole texts, ``TRAIN_BYTES`` of them); scoring covers all rows, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .words import LETTER_WORDS, Words, mix64, pieces, words_of

#: Labelled texts that the model is fitted on at most, by label.
TRAIN_TOXIC, TRAIN_CLEAN = 2000, 6000
#: Bytes of them all together at most.
TRAIN_BYTES = 64 << 20
#: Words of a window and from one window's begin to the next.
WINDOW, STRIDE = 32, 24
#: Rows of the word and character tables, vector size of each, state size of each direction, attention size.
WORD_ROWS, CHAR_ROWS, SIZE, HIDDEN, ATTENTION = 1 << 15, 1 << 14, 8, 8, 8
#: Bytes of the character sequences.
GRAMS = (3, 5)
#: Passes over the sample, steps at least (small samples get more passes), texts of a step, Adam's rate.
EPOCHS, STEPS, STEP_TEXTS, RATE = 5, 250, 64, 0.01
#: Share of the words whose own vector is left out in a training step.
UNHEARD = 0.3
#: Windows scored at once.
CHUNK = 2048


@dataclass
class Inputs:
    """Distinct words of some texts, their character sequences, and the texts' windows as rows of word numbers."""

    word: np.ndarray
    gram: np.ndarray
    gram_begin: np.ndarray
    windows: np.ndarray  # -1 after the text's end
    text: np.ndarray  # number of each window's text


def inputs_of(words: Words) -> Inputs:
    _, at, number = np.unique(words.hash, return_index=True, return_inverse=True)
    length = words.length[at] + 2
    begin = np.cumsum(length) - length
    # Each distinct word between two marks, all in a row.
    spelled = np.full(int(length.sum()), 256, np.uint64)
    place = np.arange(int((length - 2).sum())) - np.repeat(begin - 2 * np.arange(len(at)), length - 2)
    inner = np.repeat(begin + 1, length - 2) + place
    spelled[inner] = words.data[np.repeat(words.start[at], length - 2) + place]
    owner = np.repeat(np.arange(len(at)), length)
    codes, owners = [], []
    for n in GRAMS:
        last = len(spelled) - n + 1
        if last > 0:
            code = np.full(last, n, np.uint64)
            for k in range(n):
                code = code * np.uint64(0x100000001B3) + spelled[k : k + last]
            inside = owner[:last] == owner[n - 1 :]
            codes.append(mix64(code[inside]) % np.uint64(CHAR_ROWS))
            owners.append(owner[:last][inside])
    owners, codes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, codes))
    order = np.argsort(owners, kind="stable")
    counts = words.counts
    many = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), many)
    step = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    index = (words.first[:-1][text] + step * STRIDE)[:, None] + np.arange(WINDOW)
    inside = index < words.first[1:][text][:, None]
    windows = np.full(index.shape, -1, np.int64)
    windows[inside] = number[index[inside]]
    return Inputs(
        (words.hash[at] % np.uint64(WORD_ROWS)).astype(np.int64),
        codes[order].astype(np.int64),
        np.searchsorted(owners[order], np.arange(len(at) + 1)),
        windows,
        text,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Network:
    """The network; the gates' weights stand in the order update, reset, candidate."""

    def __init__(self, seed: int = 8):
        draw = np.random.default_rng(seed)

        def normal(*shape, scale):
            return draw.normal(0, scale, shape).astype(np.float32)

        h, d = HIDDEN, 2 * SIZE
        self.p = {
            "words": normal(WORD_ROWS, SIZE, scale=0.1),
            "chars": normal(CHAR_ROWS, SIZE, scale=0.1),
            "into": normal(2, d, 3 * h, scale=d**-0.5),
            "bias": np.zeros((2, 1, 3 * h), np.float32),
            "back": normal(2, h, 3 * h, scale=h**-0.5),
            "look": normal(2 * h, ATTENTION, scale=(2 * h) ** -0.5),
            "weigh": normal(ATTENTION, scale=ATTENTION**-0.5),
            "out": normal(2 * h, scale=(2 * h) ** -0.5),
            "level": np.zeros(1, np.float32),
        }

    def vectors(self, x: Inputs) -> np.ndarray:
        """Input vector of each distinct word, and zeros for the place after a text's end."""
        out = np.zeros((len(x.word) + 1, 2 * SIZE), np.float32)
        out[:-1, :SIZE] = self.p["words"][x.word]
        many = np.diff(x.gram_begin)
        if len(x.gram):
            some = many > 0
            total = np.add.reduceat(self.p["chars"][x.gram], x.gram_begin[:-1][some])
            out[:-1, SIZE:][some] = total / many[some, None].astype(np.float32)
        return out

    def forward(self, gates: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logit of each window. ``gates`` are the projected vectors (direction, word, gates)."""
        h, steps = HIDDEN, windows.shape[1]
        real = (windows >= 0).astype(np.float32)
        flat = gates.reshape(-1, 3 * h)
        windows = windows % len(gates[0])  # the place after a text's end is the last row
        from_end = windows + len(gates[0])
        state = np.zeros((2, len(windows), h), np.float32)
        states = np.empty((steps, 2, len(windows), h), np.float32)
        tape = []
        for t in range(steps):
            place = (t, steps - 1 - t)
            given = flat[np.stack([windows[:, t], from_end[:, steps - 1 - t]])]
            there = np.stack([real[:, t], real[:, steps - 1 - t]])[:, :, None]
            own = state @ self.p["back"]
            gate = _sigmoid(given[..., : 2 * h] + own[..., : 2 * h])
            z, r = gate[..., :h], gate[..., h:]
            new = np.tanh(given[..., 2 * h :] + r * own[..., 2 * h :])
            if keep:
                tape.append((state, z, r, new, own[..., 2 * h :], there))
            state = state + there * z * (new - state)
            for k in (0, 1):
                states[place[k], k] = state[k]
        both = np.concatenate([states[:, 0], states[:, 1]], axis=2)
        seen = np.tanh(both @ self.p["look"])
        weight = seen @ self.p["weigh"]
        weight = np.where(real.T > 0, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0)) * real.T
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = (weight[..., None] * both).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["level"]
        return (logit, (tape, both, seen, weight, pooled)) if keep else logit

    def gates(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.p["into"] + self.p["bias"]

    def logits(self, x: Inputs) -> np.ndarray:
        gates = self.gates(self.vectors(x))
        parts = [self.forward(gates, x.windows[k : k + CHUNK]) for k in range(0, len(x.windows), CHUNK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradient(self, x: Inputs, windows: np.ndarray, target: np.ndarray, heard: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss of the windows' logits; words not ``heard`` are known by their characters only."""
        p, h, steps = self.p, HIDDEN, windows.shape[1]
        vectors = self.vectors(x)
        vectors[:-1, :SIZE] *= heard[:, None]
        gates = self.gates(vectors)
        logit, (tape, both, seen, weight, pooled) = self.forward(gates, windows, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        slope = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g["level"][0] = slope.sum()
        g["out"] = slope @ pooled
        to_pooled = slope[:, None] * p["out"]
        to_both = weight[..., None] * to_pooled
        to_weight = (both * to_pooled).sum(axis=2)
        to_weight = weight * (to_weight - (weight * to_weight).sum(axis=0))
        g["weigh"] = np.einsum("tb,tba->a", to_weight, seen)
        to_seen = to_weight[..., None] * p["weigh"] * (1 - seen * seen)
        g["look"] = np.einsum("tbh,tba->ha", both, to_seen)
        to_both = to_both + to_seen @ p["look"].T
        to_states = np.stack([to_both[..., :h], to_both[..., h:]], axis=1)
        to_gates = np.zeros_like(gates)
        carried = np.zeros_like(tape[0][0])
        for t in reversed(range(steps)):
            place = (t, steps - 1 - t)
            before, z, r, new, own, there = tape[t]
            carried = carried + np.stack([to_states[place[k], k] for k in (0, 1)])
            moved = carried * there
            to_new = moved * z * (1 - new * new)
            to_z = moved * (new - before) * z * (1 - z)
            to_r = to_new * own * r * (1 - r)
            inner = np.concatenate([to_z, to_r, to_new * r], axis=2)
            g["back"] += before.transpose(0, 2, 1) @ inner
            carried = carried - moved * z + inner @ p["back"].transpose(0, 2, 1)
            outer = np.concatenate([to_z, to_r, to_new], axis=2)
            for k in (0, 1):
                np.add.at(to_gates[k], windows[:, place[k]], outer[k])
        to_gates[:, -1] = 0
        g["bias"] = to_gates.sum(axis=1, keepdims=True)
        g["into"] = vectors.T @ to_gates
        to_vectors = (to_gates @ p["into"].transpose(0, 2, 1)).sum(axis=0)
        used = np.flatnonzero(np.abs(to_vectors[:-1]).sum(axis=1))
        np.add.at(g["words"], x.word[used], to_vectors[used, :SIZE] * heard[used, None])
        for u in used:
            own = x.gram[x.gram_begin[u] : x.gram_begin[u + 1]]
            if len(own):
                np.add.at(g["chars"], own, to_vectors[u, SIZE:] / len(own))
        return g


def train(texts: pa.Array, toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 8) -> Network:
    """Network fitted to whole labelled texts; the same rows in the same order give the same network."""
    net, draw = Network(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    each = -(-len(texts) // STEP_TEXTS)
    epochs = max(epochs, -(-STEPS // each))
    count, steps = 0, epochs * each
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for k in range(0, len(order), STEP_TEXTS):
            chosen = order[k : k + STEP_TEXTS]
            x = inputs_of(words_of(texts.take(pa.array(chosen)), LETTER_WORDS))
            worst = most_toxic(net.logits(x), x.text, len(chosen))
            heard = (draw.random(len(x.word)) >= UNHEARD).astype(np.float32)
            grads = net.gradient(x, x.windows[worst], toxic[chosen].astype(np.float32), heard)
            count += 1
            rate = RATE * (1 - count / (steps + 1))
            for name, g in grads.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                scale = rate * (1 - 0.99**count) ** 0.5 / (1 - 0.9**count)
                net.p[name] -= scale * first[name] / (np.sqrt(second[name]) + np.float32(1e-7))
    return net


def most_toxic(logits: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Number of each text's window with the highest logit; every text has a window."""
    order = np.lexsort((-logits, text))
    return order[np.searchsorted(text[order], np.arange(texts))]


def training_sample(docs: DataFrame, labels: DataFrame, held_out: F.Column) -> pa.Table:
    """Bounded sample of the labelled training rows: ``text``, ``toxic``; the texts of least hash of each label.

    Copies of a text are one row, with their highest label, so neither repeated
    ids nor repeated texts make it larger.
    """
    marks = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = docs.where(~held_out).select("doc_id", F.xxhash64("text").alias("h"), "text")
    texts = train.select("doc_id", "h").join(marks, "doc_id").groupBy("h").agg(F.max("toxic").alias("toxic"))
    chosen = [texts.where(F.col("toxic") == t).orderBy("h").limit(n) for t, n in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))]
    chosen = chosen[0].union(chosen[1])
    own = train.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))
    own = stored(own.join(F.broadcast(chosen), "h"), "toxicity-sample")
    # A whole text counts as long as the texts up to it stay within the bound, whatever its length.
    so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(Window.orderBy("h"))
    within = own.select("h", so_far.alias("bytes")).where(F.col("bytes") <= TRAIN_BYTES).select("h")
    return own.join(F.broadcast(within), "h").orderBy("h").select("text", "toxic").toArrow()


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: F.Column, carried: Sequence[str] = ()) -> DataFrame:
    """Toxicity of every whole text, learned from the labelled rows where ``held_out`` is false.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic`` (0 or
    1, other values and nulls are no labels; of repeated labels of a document the
    highest counts); further columns are only used by ``held_out``. Result, one row
    per input row: ``doc_id``, ``held_out``, ``score`` in 0 to 1, ``predicted`` (1
    from 0.5 on). Null texts and texts without words get the share of toxic rows
    in the sample. Without both kinds of labels every row gets that share (0
    without labels). Null in ``held_out`` counts as held out. Repeated rows get
    equal scores; an empty table gives an empty table. With ``carried``, each row also has
    these columns of its own input row, as ``row``.
    """
    held_out = F.coalesce(held_out, F.lit(True))
    row = [F.struct(*carried).alias("row")] if carried else []
    rows = docs.select(F.col("doc_id").cast("long"), F.lower("text").alias("text"), held_out.alias("held_out"), *row)
    extra = ["row"] if carried else []
    sample = training_sample(rows, labels.select(F.col("doc_id").cast("long"), "toxic"), F.col("held_out"))
    toxic = sample["toxic"].to_numpy().astype(np.float64)
    share = float(toxic.mean()) if len(toxic) else 0.0
    net = train(sample["text"].combine_chunks(), toxic) if 0 < share < 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            score = np.full(batch.num_rows, share)
            if net is not None:
                words = words_of(batch.column("text"), LETTER_WORDS)
                x = inputs_of(words)
                logits = net.logits(x)
                worst = logits[most_toxic(logits, x.text, batch.num_rows)].astype(np.float64)
                score = np.where(words.counts > 0, 1 / (1 + np.exp(-worst)), share)
            predicted = pa.array((score >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), predicted, *(batch.column(c) for c in extra)],
                names=["doc_id", "held_out", "score", "predicted", *extra],
            )

    form = "doc_id long, held_out boolean, score double, predicted int"
    form += "".join(f", row {rows.schema['row'].dataType.simpleString()}" for _ in extra)
    return rows.select("doc_id", "held_out", "text", *extra).mapInArrow(run, form)
