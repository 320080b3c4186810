"""Archives, mixing, totals and the pipeline on small inputs."""

import hashlib
import os
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featureflow.llm import rollup
from featureflow.llm.mixing import mix, targets, word_count
from featureflow.llm.neardup import near_duplicates
from featureflow.llm.queries import QUERIES
from featureflow.llm.warc import MAGIC, Reader, archived_pages, member, read_archives, write_archives

PAGES = "page_id long, url string, html string, valid int, digest int, record_type int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, 2, 3) for i, u, h in rows], PAGES)


def test_archived_pages(spark, tmp_path):
    big, small = "é" * 700, "x" * 999
    rows = [(1, "http://a/1 2\n", big), (5, None, big), (3, "u", big), (5, None, big), (None, "u", big)]
    rows += [(7, "u", small), (8, "u", small), (9, "u", None), (10, "u", ""), (None, "u", "alone" * 300), (11, "u", "z" * 3_000_000)]
    got = archived_pages(pages_of(spark, rows), str(tmp_path / "a")).collect()

    def want(i, html):
        data = (html or "").encode()
        latest = 5 if html == big and i != 5 else None
        kind = "response" if latest is None else "revisit"
        return (i, len(data), hashlib.sha1(data).hexdigest(), kind, latest, True)

    assert Counter(map(tuple, got)) == Counter(want(i, h) for i, _, h in rows)
    assert archived_pages(pages_of(spark, []), str(tmp_path / "b")).count() == 0


def test_archives_are_read_whole_from_small_ranges(spark, tmp_path):
    draw = random.Random(1)
    rows = []
    for i in range(150):
        parts = [draw.choice([MAGIC + b"\x08\x00\0\0\0\0\0\x03", MAGIC, draw.randbytes(60)]) for _ in range(draw.randrange(250))]
        rows.append((f"urn:{i}", "u", bytearray(b"".join(parts))))
    records = spark.createDataFrame(rows, "record_id string, url string, payload binary")
    path = str(tmp_path / "a")
    write_archives(records.withColumns({"digest": F.sha1("payload"), "refers_to": F.lit(None).cast("string")}).repartition(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = read_archives(spark, path)
        assert got.rdd.getNumPartitions() > 50
        assert Counter((r.record_id, bytes(r.payload), r.valid) for r in got.collect()) == Counter((i, bytes(p), True) for i, _, p in rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives_are_read_under_both_suffixes(spark, tmp_path):
    draw = random.Random(4)
    bodies = {f"urn:{k}": draw.randbytes(draw.randrange(6000)) for k in range(200)}
    data = b"".join(member(i, "u", body, hashlib.sha1(body).hexdigest(), None) for i, body in bodies.items())
    want = sorted((i, body, True) for i, body in bodies.items())
    for name in ("a.warc", "a.warc.gz"):
        folder = tmp_path / name.replace(".", "-")
        folder.mkdir()
        (folder / name).write_bytes(data)
        got = sorted((r.record_id, bytes(r.payload), r.valid) for r in read_archives(spark, str(folder)).collect())
        assert got == want, name


def test_damaged_members_are_left_out():
    good = [member(f"urn:{k}", None, os.urandom(300), "00" * 20, None) for k in range(3)]
    for data in (good[0] + good[1][:200] + good[2], good[0] + b"rubbish" + zlib.compress(b"x") + good[2]):
        reader, found = Reader(keep_loose=False), []
        for piece in data.split(MAGIC)[1:]:
            found += reader.piece(piece)
        assert [r["record_id"] for r in found] == ["urn:0", "urn:2"]


def test_targets_are_filled_up_to_their_limits(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 5), ("d", 0), (None, 2000)]
    got = {r.source: r.target for r in targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    size, left, budget = dict(sizes), dict(weights), 1.5 * 3015
    want = {}
    while over := [s for s in left if budget * left[s] / sum(left.values()) > 2 * size[s]]:
        for s in over:
            want[s] = 2.0 * size[s]
        budget -= sum(want[s] for s in over)
        left = {s: w for s, w in left.items() if s not in over}
    want |= {s: budget * w / sum(left.values()) for s, w in left.items()}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.5 * 3015)


def test_mix_takes_targets_in_epochs(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 40)), draw.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    rows += [(700, None, "a"), (701, "", "b"), (702, " \t\n\v\f\r ", "c"), (None, "x y", "a"), (3, rows[3][1], rows[3][2])]
    docs = spark.createDataFrame([(i, t, s, 9, 9.0, "z") for i, t, s in rows], "doc_id long, text string, source string, size int, key double, bucket string")
    quality = spark.createDataFrame([(i, 8.0 if i % 2 else 0.1) for i in range(600)] + [(1, None), (2, -1.0), (1, 2.0)], "doc_id long, weight double")
    got = mix(docs, quality).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    assert all(r.taken % r.size == 0 and r.taken <= 2 * r.size if r.size else r.taken == 0 for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    # Good documents are drawn more often in the fractional part.
    some = [r for r in got if r.source == "a" and r.doc_id is not None and r.doc_id < 600 and r.size]
    share = [sum(r.taken / r.size for r in some if r.doc_id % 2 == k) / sum(1 for r in some if r.doc_id % 2 == k) for k in (0, 1)]
    assert share[1] > share[0]
    assert Counter(map(tuple, mix(docs.repartition(7), quality).collect())) == Counter(map(tuple, got))
    assert mix(docs.limit(0), quality).count() == 0


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\nc  d ", "\v\f\r", "a b  "]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(word_count("text").alias("n")).collect()
    assert [r.n for r in rows] == [0, 0, 0, 1, 4, 0, 2]


CHANGES = "doc_id long, deleted boolean, source string, lang string, version string, tokens long, docs int"


def changes(spark, *rows):
    return spark.createDataFrame([(*r, 5) for r in rows], CHANGES)


def test_totals_follow_inserts_revisions_and_deletes(spark, tmp_path):
    path = str(tmp_path)
    first = changes(
        spark,
        (1, False, "a", "en", "v1", 10),
        (1, False, "a", "en", "v1", 10),
        (2, None, "a", None, "v1", 5),
        (3, False, None, "fr", "v1", 7),
        (4, False, "b", "fr", "v1", None),
        (None, False, "a", "en", "v1", 99),
    )
    second = changes(spark, (1, False, "a", "en", "v2", 12), (3, True, None, None, None, None), (9, True, "a", "en", "v1", 4))
    third = changes(spark, (3, False, "b", "fr", "v2", 1), (2, True, None, None, None, None))
    rollup.commit(first, path, 0)
    rollup.commit(second, path, 1)
    rollup.commit(first, path, 0)

    def state(n):
        return {tuple(r) for r in rollup.totals(spark, path, n).collect()}

    assert state(1) == {("a", "en", "v1", 1, 10), ("a", None, "v1", 1, 5), (None, "fr", "v1", 1, 7), ("b", "fr", "v1", 1, 0)}
    after = {("a", "en", "v2", 1, 12), ("a", None, "v1", 1, 5), ("b", "fr", "v1", 1, 0)}
    assert state(2) == after
    rollup.commit(third, path, 2)
    rollup.commit(second, path, 1)
    rollup.commit(third, path, 2)
    assert state(3) == {("a", "en", "v2", 1, 12), ("b", "fr", "v1", 1, 0), ("b", "fr", "v2", 1, 1)}
    assert state(2) == after
    assert state(0) == set()
    rollup.commit(changes(spark), path, 3)
    assert state(4) == state(3)


def test_corrected_and_missing_batches(spark, tmp_path):
    """Other rows under a committed number: refused once later batches build on them, taken while it is the last one."""
    path = str(tmp_path / "store")
    rollup.commit(changes(spark, (1, False, "a", "en", "v1", 10)), path, 0)
    rollup.commit(changes(spark, (2, False, "a", "en", "v1", 20)), path, 1)
    rollup.commit(changes(spark, (2, False, "a", "en", "v1", 15), (3, False, "a", "en", "v1", 5)), path, 1)
    assert [tuple(r) for r in rollup.totals(spark, path, 2).collect()] == [("a", "en", "v1", 3, 30)]
    rollup.commit(changes(spark, (2, False, "a", "en", "v1", 20)), path, 2)
    for batch in (0, 1):
        with pytest.raises(ValueError, match="build on it"):
            rollup.commit(changes(spark, (1, False, "a", "en", "v1", 11)), path, batch)
    assert [tuple(r) for r in rollup.totals(spark, path, 3).collect()] == [("a", "en", "v1", 3, 35)]
    with pytest.raises(ValueError, match="not committed"):
        rollup.commit(changes(spark), path, 4)
    with pytest.raises(ValueError, match="not committed"):
        rollup.totals(spark, path, 4)


def test_pipeline_stages(spark, monkeypatch):
    """Each stage against what its operator says of the same rows, on the smallest tables."""
    from featureflow.llm import toxicity

    monkeypatch.setattr(toxicity, "STEPS", 20)
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    nameless = docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("a few words of their own here")})
    docs = docs.unionByName(docs.where("doc_id < 3")).unionByName(nameless).withColumn("node", F.lit(1)).withColumn("kept", F.lit("x"))
    functions = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "encoding"]
    for name in ("toxicity", "language", "near_duplicates", "mixing"):
        out = functions[name](spark, docs, folder)
        assert out.columns == corpus_pipeline.COLUMNS
        assert functions[name](spark, docs.limit(0), folder).count() == 0
    once = functions["near_duplicates"](spark, docs, folder)
    want = {r.doc_id for r in near_duplicates(docs).where("kept").collect()}
    assert Counter(r.doc_id for r in once.collect()) == Counter(want)
    taken = {(r.doc_id, r.source): r.taken // max(r.size, 1) for r in mix(once, spark.createDataFrame([], "doc_id long, weight double")).collect()}
    assert sum(taken.values()) > 0
    encoded = functions["encoding"](spark, once, folder)
    assert encoded.count() == once.count()


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_decides_row_by_row(spark, monkeypatch, tmp_path):
    """Rows without an id and of one id, under operators that decide by the text alone."""
    good = ["a b c d e f g h i j k l m n", "one two three four five six seven eight nine", "o p q r s t u v w x y z"]
    rows = [(None, good[0]), (None, "bad"), (7, good[1]), (7, "bad"), (7, good[2]), (None, good[0]), (9, good[2]), (None, good[1])]
    rows += [(None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def decided(name, value):
        return lambda docs, *_, held_out, carried: docs.select(value.alias(name), F.struct(*carried).alias("row"))

    bad = F.col("text") == "bad"
    monkeypatch.setattr(corpus_pipeline, "score_toxicity", decided("predicted", bad.cast("int")))
    monkeypatch.setattr(corpus_pipeline, "identify_languages", decided("rejected", bad))

    def after(stage, docs):
        return Counter((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path)).collect())

    clean = Counter(r for r in rows if r[1] != "bad")
    assert after("toxicity", docs) == after("language", docs) == clean
    once = Counter([(None, good[0]), (7, good[1]), (7, good[2]), (None, ""), (None, "bad")])
    near = after("near_duplicates", docs.where(~bad | F.col("doc_id").isNull()))
    assert near == once
    # The source's words are taken at a weight of one: 1.5 times its size, so each row once, and some twice.
    taken = after("mixing", docs.where(~bad))
    want = Counter()
    for r in mix(docs.where(~bad)).collect():
        want[r.doc_id, r.size] += r.taken // max(r.size, 1)
    got = Counter()
    for (i, t), n in taken.items():
        got[i, len(t.split())] += n
    assert got == +want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:3])
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(
        [(None, good[0]), (7, good[1]), (7, good[2]), (None, "")]
    )


def test_operators_carry_their_rows(spark, monkeypatch):
    from featureflow.llm import langid, toxicity

    monkeypatch.setattr(toxicity, "STEPS", 5)
    rows = [(None, "You ARE a fool", 1), (4, "The tree is green", 2), (4, "what a fool", 3), (None, None, 4), (5, "123", 5)]
    docs = spark.createDataFrame([(i, t, "en", n) for i, t, n in rows], "doc_id long, text string, lang string, n int")
    labels = spark.createDataFrame([(4, 0), (5, 1)], "doc_id long, toxic int")
    found = langid.identify_languages(docs, F.lit(False), carried=["n", "text"]).collect()
    assert {(r.doc_id, r.row.text, r.row.n) for r in found} == set(rows)
    assert {r.row.n for r in found if r.lang_pred == "und"} == {4, 5}
    scored = toxicity.score_toxicity(docs, labels, F.lit(False), carried=["n", "text"]).collect()
    assert {(r.doc_id, r.row.text, r.row.n) for r in scored} == set(rows)
