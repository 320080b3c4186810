"""Spelling variants: all pairs of words one edit apart, by composing acceptors with a one-edit transducer.

The vocabulary is cut into ranges of its order, a part each, and every part gets
its minimised acceptor A. Composing A, the transducer T of one edit, and A again
walks both acceptors together: up to the edit they are in one state q; T then
reads a letter of q on one side and another letter, or none, on the other; from
there both read the same letters until both accept. A word's number is the sum of
the words that its path skips, so what the composition accepts from q is a list
of number pairs that holds wherever a path of the part leads to q, and where both
sides meet in one state again, all its words follow as a range.

A part sees all pairs whose edit lies behind its initial states: those nodes that
none of the words around the part pass through. Pairs with the edit on the way
to such a state may lie in two parts; there the two sides must have equal rests
after the edit, so they meet in a shuffle by depth, prefix and rest. A group of
that shuffle has at most one word for each letter, and one more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import stored

#: Code points of a word at least, occurrences of a word at least, occurrences of a form for one of its variant.
LETTERS, OCCURRENCES, OUTNUMBER = 7, 2, 10
#: Every run whose checksum this divides loses a code point.
DIVISOR = 31
#: Words and code points of a part, about.
PART_WORDS, PART_LETTERS = 1 << 15, 1 << 20
#: Arcs whose edits are walked at once, and pairs that are counted at once.
ARCS, PAIRS = 1 << 14, 1 << 20
#: Form chains halve with each round; occurrences grow tenfold with each link, so 18 links are the most.
ROUNDS = 6

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPAN = 1 << 21  # above every code point


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group, and place within it, of every member."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words, with the prefix tree it comes from.

    Nodes of the tree are numbered level by level; ``state`` is the state of each.
    Arcs lie together by state, in order of letters: ``label``, ``to``, and ``skip``,
    the number of the state's words before those behind the arc.
    """

    def __init__(self, words: list[str]):
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(length) - length
        self._tree(letters, length, begin)
        self._minimise()

    def _tree(self, letters: np.ndarray, length: np.ndarray, begin: np.ndarray) -> None:
        zero = np.zeros(1, np.int64)
        parent, label, first, level = [zero - 1], [zero], [zero], [0, 1]
        rows, node = np.arange(len(length)), np.zeros(len(length), np.int64)
        ends, depth = [], 0
        while len(rows):
            inside = length[rows] > depth
            ends.append(node[~inside])
            rows, node = rows[inside], node[inside]
            letter = letters[begin[rows] + depth]
            new = np.ones(len(rows), bool)
            new[1:] = (node[1:] != node[:-1]) | (letter[1:] != letter[:-1])
            parent.append(node[new])
            label.append(letter[new])
            first.append(rows[new])
            node = level[-1] + np.cumsum(new) - 1
            level.append(level[-1] + int(new.sum()))
            depth += 1
        self.parent, self.node_label, self.first = (np.concatenate(x) for x in (parent, label, first))
        nodes = len(self.parent)
        self.final = np.zeros(nodes, bool)
        self.final[np.concatenate(ends) if ends else []] = True
        self.children = np.bincount(self.parent[1:], minlength=nodes)
        self.child = np.searchsorted(self.parent[1:], np.arange(nodes)) + 1
        self.words = self.final.astype(np.int64)
        self.height = np.zeros(nodes, np.int64)
        for a, b in reversed(list(zip(level[1:-1], level[2:], strict=True))):
            np.add.at(self.words, self.parent[a:b], self.words[a:b])
            np.maximum.at(self.height, self.parent[a:b], self.height[a:b] + 1)

    def _minimise(self) -> None:
        """Nodes of equal height, finality and arcs are one state; heights from the leaves up."""
        self.state = np.full(len(self.parent), -1, np.int64)
        order = np.lexsort((self.children, self.height))
        change = np.diff(self.height[order], prepend=-1) | np.diff(self.children[order], prepend=-1)
        example, states = [], 0
        for own in np.split(order, np.flatnonzero(change)[1:]):
            child = self.child[own][:, None] + np.arange(self.children[own[0]])
            form = np.concatenate([self.final[own][:, None], self.node_label[child], self.state[child]], axis=1)
            _, at, number = np.unique(form, axis=0, return_index=True, return_inverse=True)
            self.state[own] = states + number.reshape(-1)
            example.append(own[at])
            states += len(at)
        example = np.concatenate(example)
        self.arcs = self.children[example]
        self.arc = np.cumsum(self.arcs) - self.arcs
        self.source, place = _spread(self.arcs)
        child = self.child[example][self.source] + place
        self.label, self.to = self.node_label[child], self.state[child]
        self.skip = self.first[child] - self.first[example][self.source]
        self.accepts, self.size = self.final[example], self.words[example]
        self.key = self.source * _SPAN + self.label

    def path(self, word: str) -> list[int]:
        """Nodes that the word passes through, as far as it goes."""
        node, found = 0, [0]
        for letter in map(ord, word):
            begin, end = self.child[node], self.child[node] + self.children[node]
            node = begin + int(np.searchsorted(self.node_label[begin:end], letter))
            if node == end or self.node_label[node] != letter:
                break
            found.append(int(node))
        return found

    def edits(self, state: np.ndarray):
        """What the composition accepts with the edit in one of these states: state, and numbers from it of both words.

        A letter that is read on one side only must be the last of equal letters, so every pair comes once.
        """
        wanted = np.zeros(len(self.arcs), bool)
        wanted[state] = True
        own = np.flatnonzero(wanted[self.source])
        end = self.arc + self.arcs
        for k in range(0, len(own), ARCS):
            arc = own[k : k + ARCS]
            q = self.source[arc]
            group, place = _spread(end[q] - arc - 1)
            other = arc[group] + 1 + place
            yield from self._walk(
                np.concatenate([q[group], q]),
                np.concatenate([self.to[arc][group], self.to[arc]]),
                np.concatenate([self.to[other], q]),
                np.concatenate([self.skip[arc][group], self.skip[arc]]),
                np.concatenate([self.skip[other], np.zeros(len(q), np.int64)]),
                np.concatenate([np.full(len(group), -1), self.label[arc]]),
            )

    def _walk(self, q, left, right, a, b, banned):
        while len(q):
            same = left == right
            group, place = _spread(self.size[left[same]])
            yield q[same][group], a[same][group] + place, b[same][group] + place
            both = ~same & self.accepts[left] & self.accepts[right]
            yield q[both], a[both], b[both]
            q, left, right, a, b, banned = (x[~same] for x in (q, left, right, a, b, banned))
            swap = self.arcs[left] > self.arcs[right]
            left, right = np.where(swap, right, left), np.where(swap, left, right)
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            group, place = _spread(self.arcs[left])
            arc = self.arc[left][group] + place
            key = right[group] * _SPAN + self.label[arc]
            match = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = (self.key[match] == key) & (self.label[arc] != banned[group])
            group, arc, match = group[on], arc[on], match[on]
            q, left, right = q[group], self.to[arc], self.to[match]
            a, b = a[group] + self.skip[arc], b[group] + self.skip[match]
            banned = np.full(len(q), -1)

    def near(self, nodes: np.ndarray):
        """Pairs of word numbers one edit apart, each once, with the edit at one of these nodes of the tree."""
        nodes = nodes[np.argsort(self.state[nodes], kind="stable")]
        states, begin, counts = np.unique(self.state[nodes], return_index=True, return_counts=True)
        if not len(states):
            return
        for q, a, b in self.edits(states):
            at = np.searchsorted(states, q)
            total = np.cumsum(counts[at])
            low = 0
            while low < len(at):  # a state's pairs, repeated for every path to it, in pieces
                high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS)))
                group, place = _spread(counts[at[low:high]])
                base = self.first[nodes[begin[at[low:high]][group] + place]]
                yield base + a[low:high][group], base + b[low:high][group]
                low = high


class Best:
    """Near words of each word so far: how many, and the one of most occurrences (ties: the first in order)."""

    def __init__(self, n: np.ndarray):
        self.n, self.count = n, np.zeros(len(n), np.int64)
        self.best = np.full(len(n), -1)

    def add(self, word: np.ndarray, near: np.ndarray) -> None:
        self.count += np.bincount(word, minlength=len(self.n))
        old = np.flatnonzero(self.best >= 0)
        word, near = np.concatenate([word, old]), np.concatenate([near, self.best[old]])
        order = np.lexsort((near, -self.n[near], word))
        word, near = word[order], near[order]
        lead = np.flatnonzero(np.diff(word, prepend=-1))
        self.best[word[lead]] = near[lead]


PART = "word string, n long, n_near long, best_n long, best string, reach int"


def _near_in_part(around: dict[int, tuple[str | None, str | None]]):
    """Near words within a part, and how many nodes of each word's path the words around the part share."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("word")
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        acceptor, found = Acceptor(words), Best(n)
        inside, reach = np.ones(len(acceptor.parent), bool), np.zeros(len(words), np.int32)
        outer = around[table.column("part")[0].as_py()]
        shared = sorted({node for word in outer if word is not None for node in acceptor.path(word)})
        for node in shared:
            inside[node] = False
            reach[acceptor.first[node] : acceptor.first[node] + acceptor.words[node]] += 1
        for a, b in acceptor.near(np.flatnonzero(inside)):
            found.add(np.concatenate([a, b]), np.concatenate([b, a]))
        known = found.best >= 0
        at = pa.array(np.where(known, found.best, 0), mask=~known)
        return pa.Table.from_arrays(
            [
                table.column("word"),
                table.column("n"),
                pa.array(found.count),
                table.column("n").take(at),
                table.column("word").take(at),
                pa.array(reach),
            ],
            names=["word", "n", "n_near", "best_n", "best", "reach"],
        )

    return run


def _over_parts(rows: DataFrame) -> DataFrame:
    """Near words whose edit lies on the way to a part's initial states: they meet by prefix and rest."""
    depth = F.expr("sequence(0, least(reach - 1, char_length(word)))")
    rows = rows.where("reach > 0").select("word", "n", F.explode(depth).alias("depth"))
    rows = rows.withColumn("letter", F.expr("substring(word, depth + 1, 1)"))
    without = F.expr("concat(substring(word, 1, depth), substring(word, depth + 2))")
    keys = F.when(F.col("letter") == "", F.array("word")).otherwise(F.array(F.col("word"), without))
    rows = rows.select("depth", F.explode(keys).alias("key"), F.struct("letter", "n", "word").alias("one"))
    groups = rows.groupBy("depth", "key").agg(F.collect_list("one").alias("all")).where(F.size("all") > 1)
    # A whole word and one that lost a letter are near at this depth if the letter is not also the next one.
    others = F.filter("all", lambda x: x["letter"] != F.col("one.letter"))
    best = F.array_min(F.transform("others", lambda x: F.struct((-x["n"]).alias("n"), x["word"].alias("word"))))
    each = groups.select(F.explode("all").alias("one"), "all").select("one", others.alias("others")).where(F.size("others") > 0)
    return each.select("one.word", "one.n", F.size("others").cast("long").alias("n_near"), best.alias("best"))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """For each of the distinct words (``word``, ``n``): ``n_near``, and ``best``, the near word of largest ``n`` (``best_n``).

    Near are words that differ by exactly one inserted, deleted or replaced code
    point; of equal ``n`` the smallest in order of code points is best. Work and
    memory of a task grow with the code points of its part; only the first and
    last word of each part come to the driver.
    """
    size = vocabulary.agg(F.count("*").alias("words"), F.sum(F.char_length("word")).alias("letters")).first()
    parts = max(1, -(-size.words // PART_WORDS), -(-(size.letters or 0) // PART_LETTERS))
    ranged = vocabulary.select("word", "n").repartitionByRange(parts, "word")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "word-parts")
    ends = ranged.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last")).orderBy("first").collect()
    last, first = [None, *(r["last"] for r in ends)], [*(r["first"] for r in ends), None]
    around = {r["part"]: (last[k], first[k + 1]) for k, r in enumerate(ends)}
    inside = stored(ranged.groupBy("part").applyInArrow(_near_in_part(around), PART), "near-words")
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = inside.select("word", "n", "n_near", best.alias("best"))
    if len(ends) > 1:
        found = found.unionByName(_over_parts(inside))
    found = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n", "n_near", F.col("best.word").alias("best"), (-F.col("best.n")).alias("best_n"))


def occurring_words(docs: DataFrame) -> DataFrame:
    """Words of the documents and how often they occur: ``word``, ``n``; see ``spelling_variants``."""
    run = F.regexp_extract_all("text", F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{LETTERS},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(run).alias("run"))
    runs = runs.select("name", F.translate("run", _CAPITALS, _CAPITALS.lower()).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "name", "run")).alias("h"))
    shorter = F.expr("concat(substring(run, 1, int(h % char_length(run))), substring(run, int(h % char_length(run)) + 2))")
    word = F.when(F.col("h") % DIVISOR == 0, shorter).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).where(F.char_length("word") >= LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= OCCURRENCES)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the end of its chain of forms, ``root``, for rows ``word``, ``form`` without a cycle."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(ROUNDS):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "forms")
        if links.where("next is not null").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")
    raise RuntimeError(f"chains of forms are longer than {2**ROUNDS} links")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs``, each with the more frequent word one edit away that it may be a variant of.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Words are
    maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; a run whose
    crc32 of ``<doc_id>:<run>`` is divisible by 31 loses the code point at that
    number modulo its length. Of the results those of at least 7 code points and
    2 occurrences count. Result, one row per word: ``word``, ``n`` occurrences,
    ``n_near`` other words one edit away, ``form``: that with most occurrences
    (ties: smallest in order of code points) if it has at least ten times the
    word's, else null, ``form_n``, and ``root``: the last word along the forms,
    the word itself without one. A null id counts as empty text; null and empty
    texts have no words; repeated rows count as often as they occur; texts and
    words may have any length. An empty table gives an empty table.
    """
    vocabulary = stored(occurring_words(docs), "words")
    near = near_words(vocabulary)
    chosen = F.col("best_n") >= OUTNUMBER * F.col("n")
    form: list[Column] = [F.when(chosen, F.col(c)).alias(a) for c, a in (("best", "form"), ("best_n", "form_n"))]
    found = stored(near.select("word", "n", "n_near", *form), "variants")
    ends = roots(found.where("form is not null").select("word", "form"))
    joined = found.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
