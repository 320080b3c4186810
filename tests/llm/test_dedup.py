"""Near duplicates and components against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featureflow.llm.graph import components
from featureflow.llm.neardup import linked, near_duplicates, shingle_sets
from featureflow.llm.words import runs, words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def shingles(text):
    words = tokens(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute_force(rows):
    """doc_id to (n_shingles, component) for rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.fixture
def corpus():
    draw = random.Random(2)
    vocabulary = ["".join(draw.choices("abcdefgé", k=draw.randrange(1, 8))) for _ in range(400)]
    rows, bases = [], []
    for i in range(300):
        if bases and draw.random() < 0.5:
            words = list(draw.choice(bases))
            for _ in range(draw.randrange(0, 6)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
        else:
            words = draw.choices(vocabulary, k=draw.choice([1, 3, 4, 5, 6, 40, 120, 400]))
            bases.append(words)
        rows.append((i, draw.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "ONE"), (305, "x" * 50_000), (306, "É one")]


def test_near_duplicates_match_brute_force(spark, corpus):
    docs = spark.createDataFrame([(i, t, 1, "k", 0) for i, t in corpus], "doc_id long, text string, node long, cluster string, a int")
    got = {r.doc_id: r for r in near_duplicates(docs.repartition(5)).collect()}
    want = brute_force(corpus)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert len({c for _, c in want.values()}) < len(want) - 50


def test_repeated_rows_and_missing_ids(spark):
    text = "a b c d e f g h"
    rows = [(7, text), (7, text), (None, text), (None, "other words here now and then"), (5, text), (9, None), (9, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr)
    want = [(5, 5, True), (7, 5, False), (7, 5, False), (9, 9, True), (9, 9, True), (None, None, False), (None, None, True)]
    assert found == sorted(want, key=repr)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_large_group_of_near_copies_is_cut_into_blocks(spark, monkeypatch):
    from featureflow.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK", 16)
    draw = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(100):
        words = list(base)
        words[draw.randrange(150)] = f"new{i}"
        rows.append((i, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té.", max_size=40)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    words = words_of(pa.array(texts, pa.string()))
    cut = [bytes(words.data[s : s + n]) for s, n in zip(words.start, words.length, strict=True)]
    assert [cut[a:b] for a, b in itertools.pairwise(words.first)] == [tokens(t) for t in texts]
    assert [len(s) for s in shingle_sets(pa.array(texts, pa.string()))] == [len(shingles(t)) for t in texts]
    by_hash = dict(zip(words.hash.tolist(), cut, strict=True))
    assert len(by_hash) == len(set(cut))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 12), min_size=1), min_size=2, max_size=8))
def test_linked_gives_the_components_of_all_pairs(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]

    def grouped(pairs):
        group = list(range(len(sets)))
        for a, b in pairs:
            group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
        return group

    pairs = [
        (a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    assert grouped(linked(arrays)) == grouped(pairs)


def test_runs_are_whole_groups():
    keys = np.repeat(np.arange(50), np.random.default_rng(1).integers(1, 40, 50))
    table = pa.table({"k": keys, "v": np.arange(len(keys))})
    got = []
    for part, starts in runs(iter(table.to_batches(max_chunksize=17)), ["k"], rows=100):
        for a, b in itertools.pairwise(starts):
            group = part.slice(a, b - a)
            assert len(set(group["k"].to_pylist())) == 1
            got.append(group["k"][0].as_py())
    assert got == list(range(50))


def test_no_pair_within_the_signature_distance_is_lost(spark):
    """Signatures 15 to 21 symbols away from a base, their one-bit symbols drawn anew: all pairs within 19 are linked."""
    from featureflow.llm import neardup

    draw = np.random.default_rng(11)
    symbols, bits = [], []
    for _ in range(60):
        base = draw.integers(0, 1 << 16, neardup.SYMBOLS, dtype=np.uint16)
        for far in (0, *range(15, 22)):
            moved = base.copy()
            at = draw.choice(neardup.SYMBOLS, far, replace=False)
            moved[at] ^= draw.integers(1, 1 << 16, far, dtype=np.uint16)
            symbols.append(moved)
            bits.append(draw.integers(0, 1 << 63, len(neardup.BIT_COLUMNS), dtype=np.int64))
    symbols, bits = np.array(symbols), np.array(bits)
    longs = np.hstack([symbols.view(np.int64), bits]).tolist()
    schema = ", ".join(f"{c} long" for c in ["node", *neardup.SYMBOL_COLUMNS, *neardup.BIT_COLUMNS])
    nodes = spark.createDataFrame([(i, *row) for i, row in enumerate(longs)], schema)
    links = neardup.candidate_links(neardup.entries(nodes.repartition(5)))
    group = {r.node: r.component for r in components(links).collect()}
    distance = (symbols[:, None] != symbols[None]).sum(axis=2)
    first, second = np.nonzero(np.triu(distance <= neardup.NEAR, 1))
    assert len(first) >= 60 * 5
    assert np.bitwise_count(bits[first] ^ bits[second]).sum(axis=1).min() > neardup.bit_threshold()
    assert all(group.get(a, a) == group.get(b, b) for a, b in zip(first.tolist(), second.tolist(), strict=True))


def test_the_sketch_distance_is_never_above_the_true_one():
    from featureflow.llm import neardup

    draw = np.random.default_rng(12)
    a = draw.integers(0, 1 << 16, (500, neardup.SYMBOLS), dtype=np.uint16)
    b = np.where(draw.random(a.shape) < 0.5, a, draw.integers(0, 1 << 16, a.shape, dtype=np.uint16))
    low = (1 << neardup.SKETCH) - 1
    got = neardup.sketch_distance(neardup.sketches(a), neardup.sketches(b))
    assert (got == ((a & low) != (b & low)).sum(axis=1)).all()
    assert (got <= (a != b).sum(axis=1)).all()
