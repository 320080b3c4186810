"""Words one edit apart against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from featureflow.llm import variants
from featureflow.llm.variants import Acceptor, near_words, roots, spelling_variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def invented(draw, size, letters="abcé", longest=6):
    return sorted({"".join(draw.choices(letters, k=draw.randrange(longest + 1))) for _ in range(size)})


def test_acceptor_accepts_its_words_in_order_and_is_minimal():
    words = invented(random.Random(1), 300)
    acceptor = Acceptor(words)

    def accepted(state):
        found = {""} if acceptor.accepts[state] else set()
        for k in range(acceptor.arc[state], acceptor.arc[state] + acceptor.arcs[state]):
            found |= {chr(acceptor.label[k]) + rest for rest in accepted(acceptor.to[k])}
        assert len(found) == acceptor.size[state]
        return frozenset(found)

    languages = [accepted(s) for s in range(len(acceptor.arcs))]
    assert len(set(languages)) == len(languages) and languages[acceptor.state[0]] == set(words)


@pytest.mark.parametrize("seed", range(4))
def test_composition_gives_every_pair_once(seed, monkeypatch):
    monkeypatch.setattr(variants, "ARCS", 7)
    monkeypatch.setattr(variants, "PAIRS", 50)
    draw = random.Random(seed)
    words = invented(draw, 200, "ab" if seed % 2 else "abcdé", 7)
    acceptor = Acceptor(words)
    pairs = [tuple(sorted(p)) for a, b in acceptor.near(np.arange(len(acceptor.parent))) for p in zip(a.tolist(), b.tolist(), strict=True)]
    assert len(set(pairs)) == len(pairs)
    assert set(pairs) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and one_edit(a, b)}


def plain_near(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) if v else None for w, v in near.items()}
    return near, best


@pytest.mark.parametrize("part", [1000, 40, 3])
def test_near_words_over_parts(spark, monkeypatch, part):
    monkeypatch.setattr(variants, "PART_WORDS", part)
    draw = random.Random(part)
    n = {w: draw.choice([2, 3, 3, 40, 400]) for w in invented(draw, 150, "abé", 6) if w}
    n |= {"x" * 500: 2, "x" * 501: 5, "x" * 250 + "y" + "x" * 249: 60}
    near, best = plain_near(n)
    got = near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert sorted((r.word, r.n, r.n_near, r.best, r.best_n) for r in got) == sorted(
        (w, n[w], len(near[w]), best[w], n.get(best[w])) for w in n
    )


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near, best = plain_near(n)
    form = {w: b if b and n[b] >= 10 * n[w] else None for w, b in best.items()}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def test_variants_of_documents(spark, rows, monkeypatch):
    monkeypatch.setattr(variants, "PART_WORDS", 100)
    draw = random.Random(3)
    stems = ["".join(draw.choices("abcdeÉöß", k=draw.randrange(7, 10))) for _ in range(12)]
    weights = [3 ** (k % 7) for k in range(12)]

    def text():
        words = []
        for w in draw.choices(stems, weights, k=60):
            if draw.random() < 0.15:
                k = draw.randrange(len(w))
                w = w[:k] + draw.choice(["", "a", "ÿ", w[k] * 2]) + w[k + 1 :]
            words.append(draw.choice([w, w.upper() if w.isascii() else w, w]))
        return draw.choice([" ", "-", "× ", "1"]).join(words)

    docs = [(k, text()) for k in range(60)]
    docs += [docs[0]] * 5 + [(None, docs[1][1]), (None, None), (70, ""), (71, "Ab1 x"), (72, "q" * 4000 + " " + "q" * 3999 + " " + "q" * 4000)]
    frame = spark.createDataFrame([(i, t, "w", 1, "f") for i, t in docs], "doc_id long, text string, word string, n int, form string")
    got = spelling_variants(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(rows(got), key=repr) == plain_variants(docs)
    assert spelling_variants(frame.where("false")).count() == 0


def test_long_chains_of_forms(spark, rows):
    links = [(f"w{k}", f"w{k + 1}") for k in range(18)] + [("other", "w3")]
    got = rows(roots(spark.createDataFrame(links, "word string, form string")))
    assert got == sorted([(f"w{k}", "w18") for k in range(18)] + [("other", "w18")], key=repr)
