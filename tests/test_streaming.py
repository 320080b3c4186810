from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from featureflow.schemas import record
from featureflow.sinks import start_batches, start_stream, wait
from featureflow.sources import read_table_stream, read_text_stream
from featureflow.streaming import SendOnce, read_once, score_batches, score_keys, send_batches

SCHEMA = record("id int, value double")
RULE = "SELECT *, CASE WHEN value > 5 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"


@pytest.fixture(scope="module")
def model(spark):
    return PipelineModel(stages=[SQLTransformer(statement=RULE)])


def put(folder, name, numbers):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f'"{i}",{float(i)}\n' for i in numbers))


def wanted(numbers):
    return sorted(f"{i},{1.0 if i > 5 else 0.0}" for i in numbers)


def source(spark, folder):
    return read_text_stream(spark, "text", {"path": str(folder)})


def found(spark, path):
    return sorted(r["value"] for r in spark.read.parquet(path).select("value").collect())


def test_stream_equals_batch_over_two_files_and_a_restart(spark, model, tmp_path):
    folder, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    put(folder, "a.txt", range(0, 8))
    put(folder, "b.txt", range(8, 12))

    def run():
        lines = score_keys(source(spark, folder), model, SCHEMA, "id", mode="strict")
        wait(start_stream(lines, progress, "parquet", {"path": out}, every=None), 120)

    run()
    assert found(spark, out) == wanted(range(12))
    put(folder, "c.txt", range(12, 15))
    run()
    run()
    assert found(spark, out) == wanted(range(15))
    batch = score_keys(spark.read.text(str(folder)), model, SCHEMA, "id")
    assert sorted(r["value"] for r in batch.collect()) == found(spark, out)


def test_batches_rerun_overwrites_its_own_output(spark, model, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "a.txt", range(10))
    handler = score_batches(lambda b: score_keys(b, model, SCHEMA, "id"), out)
    seen = []

    def twice(batch, batch_id):
        seen.append(batch_id)
        handler(batch, batch_id)
        handler(batch, batch_id)

    wait(start_batches(source(spark, folder), twice, str(tmp_path / "p"), every=None), 120)
    assert seen == [0] and found(spark, out) == wanted(range(10))


def test_empty_batches_are_skipped(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.txt", [])
    put(folder, "b.txt", [])
    seen = []
    stream = source(spark, folder)
    wait(start_batches(stream, lambda b, i: seen.append(i), str(tmp_path / "p"), every=None), 120)
    assert seen == []


def test_batches_sent_as_messages(spark, model, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "a.txt", range(4))
    handler = send_batches(lambda b: score_keys(b, model, SCHEMA, "id"), {"path": out}, "text")
    wait(start_batches(source(spark, folder), handler, str(tmp_path / "p"), every=None), 120)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == wanted(range(4))


def test_strict_stream_ends_on_a_bad_line(spark, model, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("1,2.0\nbroken\n")
    lines = score_keys(source(spark, folder), model, SCHEMA, "id", mode="strict")
    with pytest.raises(Exception, match="expected 2 fields"):
        options = {"path": str(tmp_path / "out")}
        wait(start_stream(lines, str(tmp_path / "p"), "parquet", options, every=None), 120)


def test_cadence_timeout_and_checkpoint(spark, model, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.txt", range(3))
    lines = score_keys(source(spark, folder), model, SCHEMA, "id")
    query = start_stream(lines, str(tmp_path / "p"), "parquet", {"path": str(tmp_path / "out")})
    query.processAllAvailable()
    assert query.isActive
    with pytest.raises(TimeoutError):
        wait(query, 0.1)
    assert not query.isActive
    assert found(spark, str(tmp_path / "out")) == wanted(range(3))
    with pytest.raises(ValueError):
        start_stream(lines, "")


def test_stored_table_as_a_stream(spark, tmp_path):
    """A folder of part files, and a table that is one file."""
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    single = tmp_path / "one"
    spark.range(5).coalesce(1).write.parquet(str(single))
    next(single.glob("part-*.parquet")).rename(tmp_path / "one.parquet")
    for name, count in (("many", 30), ("one", 5)):
        stream = read_table_stream(spark, str(tmp_path), name)
        options = {"path": str(tmp_path / f"out-{name}")}
        wait(start_stream(stream, str(tmp_path / f"p-{name}"), "parquet", options, every=None), 120)
        assert spark.read.parquet(options["path"]).distinct().count() == count


def test_stream_plan_has_no_python_and_no_state(spark, model, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.txt", range(3))
    lines = score_keys(source(spark, folder), model, SCHEMA, "id").filter(F.lit(True))
    plan = lines._jdf.queryExecution().analyzed().toString()
    assert lines.isStreaming and "Python" not in plan and "Aggregate" not in plan


def test_messages_are_seen_once_whatever_fails(spark, tmp_path):
    """Sent twice before the commit, sent again after it, on other partitions, with repeated and empty messages."""
    batch = spark.createDataFrame([("a",)] * 5 + [("b",), ("",), ("c",)], "value string")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    sender = SendOnce(spark, lambda b: b, out, log)
    sender.send(batch, 0)
    sender(batch.repartition(5), 0)
    sender(batch.repartition(2), 0)
    sender(batch.filter("value = 'a'").limit(1), 1)
    assert spark.read.parquet(out).count() == 17
    assert Counter(r["value"] for r in read_once(spark, out).collect()) == Counter({"a": 6, "b": 1, "": 1, "c": 1})
