"""Quality scores against a plain machine, and on odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureflow.llm import quality
from featureflow.llm.quality import SHARES, Machine, features_of, score_quality, statistics, train
from featureflow.llm.words import WHITE_WORDS, column_bytes, words_of

ODD = ["", "   \n", "One two two.\nOne\n\nthree THREE %%% é", "a" * 5000, "!", "x\ty\x0bz " * 700, "12 34, 5$ Ü"]


def column(texts):
    return pa.array(texts, pa.string())


def plain_statistics(text):
    data = text.encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", data.lower()) if w]
    given = [w for w in re.split(rb"[\x20\x09-\x0d]+", data) if w]
    lines = [w for w in re.split(rb"[\n\r]+", data.lower()) if w]
    kind = Counter()
    for b in data:
        c = chr(b)
        blank = b < 33 or b == 127
        known = "capitals" if "A" <= c <= "Z" else "small" if "a" <= c <= "z" else "digits" if "0" <= c <= "9" else None
        kind[known or ("blanks" if blank else "foreign" if b > 127 else "marks" if c in ".,;:'\"()?-" else "signs")] += 1
    inner = len(data) - kind["blanks"]
    sign = [w for w in given if 33 <= w[-1] < 127 and not chr(w[-1]).isalnum() and chr(w[-1]) not in ".,;:'\"()?-"]
    share = {
        "capitals": (kind["capitals"], kind["capitals"] + kind["small"]),
        **{k: (kind[k], inner) for k in ("digits", "marks", "signs", "foreign")},
        "blanks": (kind["blanks"], len(data)),
        "marked_words": (len(sign), len(words)),
        "distinct_words": (len(set(words)), len(words)),
        "echoed_words": (sum(a == b for a, b in itertools.pairwise(words)), len(words)),
        "top_word": (max(Counter(words).values(), default=0), len(words)),
        "distinct_lines": (len(set(lines)), len(lines)),
    }
    numbers = [len(data), len(words), inner / max(len(words), 1), len(words) / max(len(lines), 1)]
    return [math.sqrt(a / max(b, 1)) for a, b in (share[k] for k in SHARES)] + [min(math.log2(1 + n) / 20, 1) for n in numbers]


def test_statistics_of_odd_texts():
    texts = column(ODD)
    got = statistics(texts, words_of(texts, WHITE_WORDS), *column_bytes(texts))
    assert got == pytest.approx(np.array([plain_statistics(t) for t in ODD]))


def test_features_do_not_depend_on_the_other_texts():
    said = pa.array([len(t) if k % 3 else None for k, t in enumerate(ODD)], pa.float64())
    together = features_of(column(ODD), said)
    for k, text in enumerate(ODD):
        alone = features_of(column([text]), said.slice(k, 1))
        one = together.take(np.array([k]))
        assert (alone.cell == one.cell).all() and (alone.value == one.value).all()


def test_linear_time_sum_is_the_sum_over_all_pairs():
    x = features_of(column(ODD), pa.array([1.0] * len(ODD)))
    machine = Machine(3)
    machine.weight[:] = np.random.default_rng(4).normal(size=len(machine.weight))
    machine.level = 0.25
    for r, logit in enumerate(machine.logits(x)):
        row = [(int(x.cell[k]), float(x.value[k])) for k in range(x.begin[r], x.begin[r + 1])][:400]
        if x.begin[r + 1] - x.begin[r] > 400:
            continue
        plain = machine.level + sum(machine.weight[i] * a for i, a in row)
        plain += sum(float(machine.factor[i].astype(float) @ machine.factor[j]) * a * b for (i, a), (j, b) in itertools.combinations(row, 2))
        assert logit == pytest.approx(plain, abs=1e-4)


def test_gradient_is_that_of_the_loss():
    x = features_of(column(ODD), pa.array([None, 2.0, 3.0, 4.0, None, 6.0, 7.0], pa.float64()))
    target, weigh = np.array([1.0, 0, 1, 0, 0.5, 1, 0]), np.array([1.0, 2, 1, 3, 1, 1, 2])
    machine = Machine(5)

    def loss():
        p = 1 / (1 + np.exp(-machine.logits(x)))
        return -(weigh * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() / weigh.sum()

    level, used, to_weight, to_factor = machine.gradient(x, target, weigh)
    for k in range(0, len(used), 5):
        for table, place, slope in ((machine.weight, (used[k],), to_weight[k]), (machine.factor, (used[k], 2), to_factor[k, 2])):
            old, side = table[place], []
            for step in (0.02, -0.02):
                table[place] = old + np.float32(step)
                side.append(loss())
            table[place] = old
            assert slope == pytest.approx((side[0] - side[1]) / 0.04, abs=2e-4)
    machine.level = 0.01
    before = loss()
    machine.level = -0.01
    assert level == pytest.approx((before - loss()) / 0.02, abs=1e-4)


def invented(draw, good):
    words = ["".join(draw.choices("aeioulnrst", k=draw.randrange(2, 9))) for _ in range(draw.randrange(20, 80))]
    if not good:
        words = [w for w in words[:8] for _ in range(9)] if draw.random() < 0.5 else [w.upper() + "!!" for w in words]
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(13)
    docs = [(k, invented(draw, k % 4 > 0)) for k in range(400)]
    docs += [docs[1]] * 30 + [(None, docs[0][1]), (None, docs[1][1]), (401, None), (402, ""), (403, "word " * 200_000)]
    rows = [(i, t, None if i and i % 7 == 0 else len(t or ""), "xx", 0.5, 1, "a") for i, t in docs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, quality string, score double, h int, size string")
    labels = [(k, int(k % 4 > 0), None, "t") for k in range(400)] + [(None, 1, 0, "t"), (3, 1, 0, "t"), (5, None, 1, "t"), (401, 7, 0, "t")]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    got = score_quality(docs, labels, F.col("doc_id") % 3 == 1).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (r.doc_id is None or r.doc_id % 3 == 1)
    right = [r.predicted == (r.doc_id % 4 > 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(right) / len(right) > 0.97
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    again = score_quality(docs.repartition(3), labels, F.col("doc_id") % 3 == 1).collect()
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_tables_without_labels_or_rows(tables):
    docs, labels = tables
    none = score_quality(docs, labels.where("false"), F.lit(False)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.0, 0)]
    only = score_quality(docs, labels.where("quality = 1"), F.lit(False)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in only] == [(1.0, 1)]
    assert score_quality(docs.where("false"), labels, F.lit(False)).count() == 0


def test_sample_is_bounded(tables, monkeypatch):
    docs, labels = tables
    monkeypatch.setattr(quality, "TRAIN_TEXTS", 20)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("n_chars").cast("double"), F.lit(False).alias("held_out"))
    x, target, weigh = quality.training_sample(rows.withColumn("h", F.xxhash64("text")), labels)
    assert sorted(target) == [0.0] * 20 + [1.0] * 20
    assert weigh[target == 1].sum() / weigh[target == 0].sum() == pytest.approx(299 / 100, rel=0.05)
    monkeypatch.setattr(quality, "TRAIN_FEATURES", 500)
    x, target, _ = quality.training_sample(rows.withColumn("h", F.xxhash64("text")), labels)
    assert 0 < len(x.cell) <= 500 and len(target) == len(x.begin) - 1


def test_same_rows_give_the_same_machine():
    draw = random.Random(2)
    texts = column([invented(draw, k % 2) for k in range(40)])
    x = features_of(texts, pa.array([None] * 40, pa.float64()))
    a, b = (train(x, np.arange(40) % 2, np.ones(40)) for _ in range(2))
    assert (a.weight == b.weight).all() and (a.factor == b.factor).all()
