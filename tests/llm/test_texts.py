"""Encoding, language, toxicity and class-model scores on small inputs."""

import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from featureflow.llm import brown, langid, toxicity
from featureflow.llm.bpe import Merges, Tokenizer, encode_texts, heap_merges, scan_merges
from featureflow.llm.words import LETTER_WORDS, words_of

PATH = public_tokenizers.path("word_bpe_49k.json")
EXTRA = ", lang string, score double, ids int, held_out int, predicted string, n_tokens string"


def frame(spark, rows, lang=None):
    full = [(i, t, lang[k] if lang else "xx", 0.0, 1, 2, "p", "n") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string" + EXTRA)


ODD = ["", " \n\t ", "a" * 3000, "ab" * 700, "x<|endoftext|>Y <|startoftext|><|endoftext|>", "it's I'LL we'Re 12345 ½", "ΑΣ ΣΑΣ ς", "İ é Å"]


def test_encoding_matches_the_library(spark):
    library = Library.from_file(PATH)
    draw = random.Random(4)
    texts = ODD + ["".join(draw.choices("abcdefghij'sltre <>|éß汉🙂\x1c\x85\n", k=draw.randrange(200))) for _ in range(200)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, None), (3, texts[3])]
    got = encode_texts(frame(spark, rows).repartition(3), PATH).collect()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got) == want
    assert encode_texts(frame(spark, []), PATH).count() == 0


def test_words_can_be_forgotten(monkeypatch):
    from featureflow.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    tokenizer = Tokenizer(open(PATH, encoding="utf-8").read())
    first = tokenizer.encode_all(["one two three four five", "six one <|endoftext|>"])
    assert tokenizer.encode_all(["one two three four five", "six one <|endoftext|>"]) == first


def test_long_words_are_forgotten_by_their_bytes(monkeypatch):
    from featureflow.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 20_000)
    tokenizer = Tokenizer(open(PATH, encoding="utf-8").read())
    draw = random.Random(8)
    texts = ["".join(draw.choices("abcdefghij", k=1000)) for _ in range(60)]
    library = Library.from_file(PATH)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode_all([text]) == [(struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False))]
        held = sum(map(len, (*tokenizer.ids, *tokenizer.ids.values(), *tokenizer.decoded.values())))
        assert held < 30_000


def test_words_go_when_the_task_ends():
    from featureflow.llm import bpe

    file = open(PATH, encoding="utf-8").read()
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array(["one two three", None])})
    ended, stopped = bpe.encoded_batches(iter([rows]), file), bpe.encoded_batches(iter([rows, rows]), file)
    for task in (ended, stopped):
        assert next(task).column("decoded").to_pylist() == ["one</w> two</w> three</w>", ""]
        assert bpe.tokenizer_of(file).ids
        list(task) if task is ended else task.close()
        assert not bpe.tokenizer_of(file).ids and not bpe.tokenizer_of(file).decoded


def test_words_are_learned_in_arrays_of_bounded_size(monkeypatch):
    from featureflow.llm import bpe

    draw = random.Random(9)
    text = " ".join("".join(draw.choices("abcdefghijst", k=draw.randrange(1, 140))) for _ in range(500))
    file, sizes = open(PATH, encoding="utf-8").read(), []
    want = Tokenizer(file).encode_all([text])
    scan = bpe.scan_merges
    monkeypatch.setattr(bpe, "CELLS", 1024)
    monkeypatch.setattr(bpe, "scan_merges", lambda parts, merges: sizes.append(parts.size) or scan(parts, merges))
    assert Tokenizer(file).encode_all([text]) == want
    assert max(sizes) <= 1024


def test_scan_and_heap_give_the_parts_of_a_plain_search():
    draw = random.Random(6)
    letters = {c: k for k, c in enumerate("abc")}
    vocabulary, merges = dict(letters), []
    for _ in range(40):
        a, b = draw.choices(list(vocabulary), k=2)
        if a + b not in vocabulary:
            vocabulary[a + b] = len(vocabulary)
            merges.append([a, b])
    table = Merges(merges, vocabulary)
    for _ in range(100):
        parts = [draw.randrange(3) for _ in range(draw.randrange(2, 30))]
        plain = list(parts)
        while pairs := [(table.rank[p], k) for k, p in enumerate(zip(plain, plain[1:], strict=False)) if p in table.rank]:
            rank, k = min(pairs)
            plain[k : k + 2] = [int(table.whole[rank])]
        padded = np.array([parts + [-1] * (30 - len(parts))])
        assert scan_merges(padded, table)[0].tolist() == plain
        assert heap_merges(list(parts), table) == plain


def invented(draw, syllables, words):
    return " ".join("".join(draw.choices(syllables, k=draw.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def languages():
    draw = random.Random(7)
    kinds = {"en": ["th", "er", "ing", "on"], "fr": ["eau", "é", "re", "oi"], "de": ["sch", "ung", "ü", "er"]}
    rows, langs = [], []
    for i in range(240):
        lang = draw.choice(list(kinds))
        rows.append((i, invented(draw, kinds[lang], draw.choice([4, 30, 200]))))
        langs.append(lang)
    return rows, langs


def test_languages_of_held_out_texts(spark, languages):
    rows, langs = languages
    odd = [(500, None), (501, ""), (502, "123 ... 4"), (503, "汉字" * 40), (None, "the ering on ther"), (3, rows[3][1])]
    docs = frame(spark, rows + odd, langs + ["en", None, "fr", None, None, langs[3]])
    got = langid.identify_languages(docs, F.col("doc_id") % 3 == 1).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    held = [i for i, _ in rows if i % 3 == 1]
    assert all(by_id[i].held_out for i in held)
    assert sum(by_id[i].lang_pred == langs[i] for i in held) >= 0.95 * len(held)
    assert not any(by_id[i].rejected for i, _ in rows)
    for i in (500, 501, 502):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[503].rejected and by_id[503].lang_pred in langs
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_without_labels_or_rows(spark):
    docs = frame(spark, [(1, "the on"), (2, None)], [None, None])
    assert [r.lang_pred for r in langid.identify_languages(docs, F.lit(False)).collect()] == ["und", "und"]
    assert langid.identify_languages(frame(spark, []), F.lit(False)).count() == 0


@pytest.fixture(scope="module")
def insults():
    draw = random.Random(8)
    rows, toxic = [], []
    for i in range(400):
        words = invented(draw, ["th", "er", "ing", "on", "a"], draw.choice([3, 40, 150])).split()
        bad = i % 4 == 0
        if bad:
            words[draw.randrange(len(words))] = draw.choice(["Zorgling", "zorgmuk,", "vexor"])
        rows.append((i, " ".join(words)))
        toxic.append(int(bad))
    return rows, toxic


def test_toxicity_of_held_out_texts(spark, insults, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 120)
    rows, toxic = insults
    odd = [(500, None), (501, ""), (502, "..."), (None, "zorgling er"), (4, rows[4][1])]
    labels = [(i, t) for (i, _), t in zip(rows, toxic, strict=True)] + [(1, None), (2, 7), (None, 1), (0, 1)]
    labels = spark.createDataFrame([(i, t, "x") for i, t in labels], "doc_id long, toxic int, text string")
    got = toxicity.score_toxicity(frame(spark, rows + odd), labels, F.col("doc_id") % 5 == 0).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    held = [i for i, _ in rows if i % 5 == 0]
    assert sum(by_id[i].predicted == toxic[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({by_id[i].score for i in (500, 501, 502)}) == 1 and by_id[500].predicted == 0
    assert by_id[None].held_out


def test_toxicity_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(frame(spark, [(1, "a")]), labels, F.lit(False)).collect()] == [0.0]
    assert toxicity.score_toxicity(frame(spark, []), labels, F.lit(False)).count() == 0


def test_windows_cover_all_words():
    x = toxicity.inputs_of(words_of(pa.array([" ".join(f"w{k}" for k in range(200)), "", "a"]), LETTER_WORDS))
    numbers = set(x.windows[x.text == 0].ravel().tolist()) - {-1}
    assert len(numbers) == 200
    assert (x.text == 1).sum() == 1 and (x.windows[x.text == 1] == -1).all()


def test_gradient_of_the_network():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = toxicity.inputs_of(words_of(pa.array(["ab cd efg ab", "xy " * 40]), LETTER_WORDS))
    target, heard = np.array([1.0] + [0.0] * (len(x.windows) - 1)), np.ones(len(x.word))

    def loss():
        logit = net.forward(net.gates(net.vectors(x).astype(np.float64)), x.windows)
        return float(np.mean(np.logaddexp(0, logit) - target * logit))

    grads = net.gradient(x, x.windows, target, heard)
    for name in ("into", "bias", "back", "look", "weigh", "out", "level"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for k in np.linspace(0, flat.size - 1, 5).astype(int):
            was = flat[k]
            flat[k] = was + 1e-4
            up = loss()
            flat[k] = was - 1e-4
            down = loss()
            flat[k] = was
            assert g[k] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-5), name


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_class_scores_match_a_plain_model(spark, languages, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 1030)  # most words are outside the head
    rows = languages[0][:80] + [(900, None), (901, ""), (902, "NEVER seen Never"), (None, "th er"), (3, languages[0][3][1])]
    rows += [(1000 + k, invented(random.Random(k), ["ab", "cd", "ef", "gh", "i"], 400)) for k in range(10)]
    got = brown.score_texts(frame(spark, rows).repartition(4), F.col("doc_id") % 5 == 1).collect()
    counts = Counter()
    for i, t in rows:
        if i is None or i % 5 != 1:
            counts.update(WORD.findall((t or "").lower()) + ["</s>"])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        tokens = WORD.findall((t or "").lower()) + ["</s>"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        want[i, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert brown.score_texts(frame(spark, []), F.lit(False)).count() == 0


def test_word_probabilities_sum_to_one_after_every_class(spark):
    draw = random.Random(9)
    texts = [invented(draw, ["a", "b", "c"], 30) for _ in range(30)]
    counts = Counter(w for t in texts for w in t.split())
    column = pa.array(list(counts))
    words = words_of(column)
    units = brown.Units(np.array([], np.uint64))
    tokens, place = units.sequence(words)
    kinds = np.bincount(tokens[place], minlength=brown.UNITS).astype(float)
    bigrams = np.zeros((brown.UNITS, brown.UNITS))
    for t in texts:
        seq, _ = units.sequence(words_of(pa.array([t])))
        for a, b in zip([brown.END_UNIT, *seq], seq, strict=False):
            bigrams[a, b] += 1
    of = brown.exchange(bigrams)
    model = brown.ClassModel(bigrams, kinds, of, words.hash, np.array([counts[w] for w in counts]), units)
    mass = defaultdict(float)
    for k, w in enumerate(counts):
        c = of[tokens[place[k]]]
        mass[c] += (counts[w] + brown.ADD) / 10 ** model.shared[c]
    for c in range(1, brown.CLASSES):
        unseen = brown.ADD / 10 ** model.shared[c]
        assert mass[c] + unseen == pytest.approx(1.0)
    assert (10**model.transition).sum(axis=1) == pytest.approx(1.0)


def test_exchange_finds_alternating_classes():
    draw = np.random.default_rng(3)
    bigrams = np.zeros((21, 21))
    for _ in range(20_000):
        a, b = draw.integers(0, 10), 10 + draw.integers(0, 10)
        bigrams[a, b] += 1
        bigrams[b, draw.integers(0, 10)] += 1
    bigrams[20, 0] = bigrams[0, 20] = 1
    of = brown.exchange(bigrams, classes=3)
    assert of[20] == 0 and len(set(of[:10])) == 1 and len(set(of[10:20])) == 1 and of[0] != of[10]


@pytest.mark.parametrize("head", [1100, 1 << 18])
def test_infrequent_words_of_one_ending_get_classes_of_their_own(spark, monkeypatch, head):
    """Words of two kinds take turns; all end alike, and those asked for are beyond the first units."""
    monkeypatch.setattr(brown, "HEAD", head)
    draw = random.Random(5)
    kinds = [[f"{kind}{k}xyz" for k in range(800)] for kind in "ab"]
    often = [4 if k < 600 else 1 for k in range(800)]
    texts = [" ".join(w for pair in zip(*(draw.choices(k, often, k=60) for k in kinds), strict=True) for w in pair) for _ in range(400)]
    rare = [draw.sample(k[600:], 50) for k in kinds]
    turns = " ".join(w for pair in zip(*rare, strict=True) for w in pair)
    rows = [*enumerate(texts), (1000, turns), (1001, " ".join(rare[0] + rare[1]))]
    got = {r.doc_id: r.score for r in brown.score_texts(frame(spark, rows), F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 10


def test_words_move_to_the_class_that_explains_most():
    draw = np.random.default_rng(4)
    words = draw.integers(1, 30, 600)
    words[::20] = 0
    bigrams = np.zeros((30, 30))
    np.add.at(bigrams, (words[:-1], words[1:]), 1)
    old = np.append(0, draw.integers(1, 5, 29))

    def table(of):
        member = np.eye(5)[of]
        return member.T @ bigrams @ member

    follow, lead = bigrams @ np.eye(5)[old], bigrams.T @ np.eye(5)[old]
    twice = bigrams.diagonal()
    for counts in (follow, lead):
        counts[np.arange(30), old] -= twice
    seen = np.concatenate([follow, twice[:, None], lead], axis=1)[1:]
    for w, new in enumerate(brown.best_classes(seen, old[1:], table(old)), 1):
        values = [brown.likelihood(table(np.where(np.arange(30) == w, c, old))) for c in range(1, 5)]
        assert values[new - 1] == pytest.approx(max(values))


def test_languages_that_were_not_learned_are_rejected(spark, languages):
    rows, langs = languages
    draw = random.Random(11)
    kinds = (["aki", "suo", "mäl", "vyk"], ["ży", "przec", "wł", "ów"], ["0a9f", "7be1", "c4d2", "38"], ["при", "вет", "ска", "мо"])
    others = [(1000 + k, invented(draw, kind, 200)) for k, kind in enumerate(kinds)]
    docs = frame(spark, rows + others, langs + [None] * len(others))
    got = {r.doc_id: r.rejected for r in langid.identify_languages(docs, F.col("doc_id") % 3 == 1).collect()}
    assert all(got[i] for i, _ in others)
    assert not any(got[i] for i, _ in rows)


def test_bounds_follow_the_length_class():
    classes = np.repeat([3, 7], [60, 200])
    cosines = np.append(np.full(60, 0.2), np.append([0.01], np.full(199, 0.6)))
    least = langid.low_cosines(cosines, classes)
    assert least[3] == pytest.approx(0.2) and least[7] == pytest.approx(0.6) and (np.diff(least) >= 0).all()
