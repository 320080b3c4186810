"""Language and toxicity models against plain forms of themselves, and the bounds of their samples."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureflow.llm import langid, toxicity
from featureflow.llm.words import LETTER_WORDS, mix64, words_of

MASK = (1 << 64) - 1
RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def plain_vector(text, idf):
    counts = Counter()
    for word in RUN.findall(text.lower().encode()):
        for n in langid.GRAMS:
            for k in range(len(word) - n + 1):
                code = 0
                for b in word[k : k + n]:
                    code = (code * 0x100000001B3 + b + 1) & MASK
                cell = int(mix64(np.array([(code + n) & MASK], np.uint64))[0]) % langid.SIZE
                counts[cell] += 1
    values = {c: math.log1p(n) * float(idf[c]) for c, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {c: v / length for c, v in values.items()}


def plain_state(p, side, word, state):
    def sig(x):
        return 1 / (1 + np.exp(-x))

    h = toxicity.HIDDEN
    given, own = word @ p["into"][side] + p["bias"][side][0], state @ p["back"][side]
    z, r = sig(given[:h] + own[:h]), sig(given[h : 2 * h] + own[h : 2 * h])
    return state + z * (np.tanh(given[2 * h :] + r * own[2 * h :]) - state)


def plain_toxicity(net, text):
    """Logit of the most toxic window, word by word."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vectors = []
    for word in RUN.findall(text.lower().encode()):
        number = int(words_of(pa.array([word.decode()]), LETTER_WORDS).hash[0]) % toxicity.WORD_ROWS
        spelled, chars = [256, *word, 256], []
        for n in toxicity.GRAMS:
            for k in range(len(spelled) - n + 1):
                code = n
                for b in spelled[k : k + n]:
                    code = (code * 0x100000001B3 + b) & MASK
                chars.append(p["chars"][int(mix64(np.array([code], np.uint64))[0]) % toxicity.CHAR_ROWS])
        vectors.append(np.concatenate([p["words"][number], np.mean(chars, axis=0) if chars else np.zeros(toxicity.SIZE)]))
    logits, begin = [], 0
    while begin == 0 or begin + toxicity.WINDOW - toxicity.STRIDE < len(vectors):
        window = vectors[begin : begin + toxicity.WINDOW]
        sides = []
        for side, order in enumerate((window, window[::-1])):
            state, states = np.zeros(toxicity.HIDDEN), []
            for word in order:
                state = plain_state(p, side, word, state)
                states.append(state)
            sides.append(states if side == 0 else states[::-1])
        both = np.concatenate([np.array(s).reshape(-1, toxicity.HIDDEN) for s in sides], axis=1)
        weight = np.exp(np.tanh(both @ p["look"]) @ p["weigh"])
        logits.append(float((weight / weight.sum()) @ both @ p["out"] + p["level"][0]))
        begin += toxicity.STRIDE
    return max(logits)


def invented(draw, syllables, words):
    return " ".join("".join(draw.choices(syllables, k=draw.randrange(1, 4))) for _ in range(words))


KINDS = {"en": ["th", "er", "ing"], "fr": ["eau", "é", "oi"], "de": ["sch", "ung", "ü"]}


def language_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, held_out boolean")


def test_language_score_is_the_largest_cosine(spark):
    draw = random.Random(1)
    rows = [(k, lang, invented(draw, KINDS[lang], draw.choice([2, 50])), False) for k, lang in enumerate(sorted(KINDS) * 30)]
    docs = language_rows(spark, [*rows, (900, None, "ther " * 50_000, False), (901, None, "x1 Ü!", False)])
    model = langid.fit_languages(docs)
    assert model.names == sorted(KINDS)
    centres = [(model.names[k], c) for k, c in zip(model.of, model.centres, strict=True)]
    got = langid.identify_languages(docs, F.lit(False), carried=["text"]).collect()
    for r in got:
        vector = plain_vector(r.row.text, model.idf)
        near = [(sum(v * float(c[cell]) for cell, v in vector.items()), name) for name, c in centres]
        best = max(s for s, _ in near)
        assert r.score == pytest.approx(min(best, 1), abs=1e-4) and r.lang_pred in [n for s, n in near if s > best - 1e-4]


def test_every_language_is_learned_whatever_the_ids(spark):
    draw = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(300):
        own = [a + b for a, b in zip(draw.sample(letters, 6), draw.sample(letters, 6), strict=True)]
        texts = [invented(draw, own, 60) for _ in range(3)]
        rows += [(None if k % 2 else 5, f"l{k:03d}", t, False) for t in texts]
    rows += [(7, "l000", rows[0][2], False)] * 10_000
    docs = language_rows(spark, rows).repartition(4)
    sample = langid.training_texts(docs)
    assert sample.count() == 900 and sample.select("lang").distinct().count() == 300
    got = langid.identify_languages(docs.distinct(), F.lit(False), carried=["lang"]).collect()
    assert sum(r.lang_pred == r.row.lang for r in got) > 0.97 * len(got)


def test_language_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_TEXTS", 50)
    rows = [(None, lang, f"{lang} text {k}", False) for k in range(2000) for lang in ("a", "b")]
    counts = langid.training_texts(language_rows(spark, rows)).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in counts} == {"a": 50, "b": 50}


def test_toxicity_score_is_the_most_toxic_window(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 30)
    draw = random.Random(3)
    texts = [invented(draw, ["th", "er", "é"], n) + (" vexor" if k % 3 == 0 else "") for k, n in enumerate([1, 5, 31, 32, 33, 56, 57, 300] * 4)]
    net = toxicity.train(pa.array(texts), np.array([k % 3 == 0 for k in range(len(texts))], float))
    for text in texts[:16]:
        x = toxicity.inputs_of(words_of(pa.array([text]), LETTER_WORDS))
        assert net.logits(x).max() == pytest.approx(plain_toxicity(net, text), abs=1e-3)


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_TOXIC", 5)
    monkeypatch.setattr(toxicity, "TRAIN_CLEAN", 20)
    rows = [(1, "the same text")] * 3000 + [(2, f"text {k}") for k in range(500)] + [(k, f"bad {k}") for k in range(3, 40)]
    docs = spark.createDataFrame([(i, t, False) for i, t in rows], "doc_id long, text string, held_out boolean")
    labels = spark.createDataFrame([(1, 0), (2, 0), *((k, 1) for k in range(3, 40))], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels, F.col("held_out")).to_pydict()
    assert Counter(sample["toxic"]) == {1: 5, 0: 20} and len(set(sample["text"])) == 25
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 60)
    sample = toxicity.training_sample(docs, labels, F.col("held_out")).to_pydict()
    assert 0 < sum(len(t) for t in sample["text"]) <= 60


def test_long_texts_are_read_whole(spark):
    draw = random.Random(4)
    docs = [(k, invented(draw, ["th", "er"], 30) + (" vexor" if k % 2 else "")) for k in range(60)]
    docs.append((100, "th er " * 100_000 + "vexor vexor"))
    docs = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, labels, F.lit(False)).collect()}
    assert got[100] == 1 and got[0] == 0
