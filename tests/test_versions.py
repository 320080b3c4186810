"""Published models: whole or not there, checked, and taken up by a running stream."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from featureflow.operators.encoding import assemble
from featureflow.plans.training import fit_forest
from featureflow.schemas import record
from featureflow.sinks import LatestModel, ModelVersions, start_batches, start_stream, wait
from featureflow.sources import dim_table
from featureflow.streaming import score_batches, score_sound_labels


def rule(n):
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, id * {n} AS prediction FROM __THIS__")])


def answer(model, spark):
    return model.transform(spark.range(3, 4)).first()["prediction"]


def test_versions_are_numbered_checked_and_whole(spark, tmp_path):
    versions = ModelVersions(spark, str(tmp_path / "m"))
    assert versions.latest() is None
    with pytest.raises(ValueError, match="at all"):
        versions.load()
    assert [versions.publish(rule(n)) for n in (10, 20)] == [1, 2]
    assert [answer(versions.load(n), spark) for n in (1, 2, None)] == [30, 60, 60]

    (tmp_path / "m/versions/3.json").write_text('{"model": "half')  # a publisher that died on the way
    assert versions.latest() == 2
    with pytest.raises(ValueError, match="no version 3"):
        versions.load(3)
    assert versions.publish(rule(40)) == 4

    stage = next((tmp_path / "m/models" / versions.manifest(1)["model"]).glob("stages/*/metadata/part-*"))
    (stage.parent / f".{stage.name}.crc").unlink(missing_ok=True)
    stage.write_text(stage.read_text().replace("* 10", "* 11"))
    with pytest.raises(ValueError, match="changed files.*stages"):
        versions.load(1)
    assert answer(versions.load(2), spark) == 60


def test_two_publishers_never_share_a_number(spark, tmp_path, monkeypatch):
    one, other = (ModelVersions(spark, str(tmp_path / "m")) for _ in range(2))
    assert one.publish(rule(1)) == 1
    monkeypatch.setattr(other, "numbers", lambda: [])  # looked before the first had published
    assert other.publish(rule(2)) == 2
    assert answer(one.load(1), spark) == 3


def test_a_stream_takes_up_a_new_version(spark, tmp_path):
    versions = ModelVersions(spark, str(tmp_path / "m"))
    scorer = LatestModel(versions, lambda model, batch: model.transform(batch))
    versions.publish(rule(10))
    for turn in (1, 2):
        spark.range(turn, turn + 1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        handler = score_batches(scorer, str(tmp_path / "out"))
        wait(start_batches(stream, handler, str(tmp_path / "progress"), every=None))
        if turn == 1:
            versions.publish(rule(20))
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "prediction", "version").collect()
    assert sorted(map(tuple, got)) == [(1, 10, 1), (2, 40, 2)]


def test_broken_lines_stay_in_the_stream_with_their_problem(spark, tmp_path):
    table = assemble(["x", "y"]).transform(
        spark.range(400).select(*[(F.col("id") / d % 2).cast("int").cast("double").alias(n) for n, d in (("x", 1), ("y", 2))])
    ).withColumn("label", F.col("x"))
    model = fit_forest(table, trees=1, bootstrap=False)
    names = dim_table(spark, [(1, "one")], "class_id int, class_name string")
    text = ["1,0", "0,1", "1", "1,?", "", '"1",1', "1,1,9"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/lines.txt").write_text("\n".join(text) + "\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    scored = score_sound_labels(
        stream, model, record("x double, y double"), names, "class_id", "class_name", topics=("good", "bad")
    )
    wait(start_stream(scored, str(tmp_path / "progress"), "json", {"path": str(tmp_path / "out")}, every=None))
    got = spark.read.schema("value string, problem string, topic string").json(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [
            ("1.0,0.0,1.0,one", None, "good"),  # the line of class 0 has no name and drops, as in the plain form
            ("1", "expected 2 fields, found 1", "bad"),
            ("1,?", "y is not double", "bad"),
            ("", "expected 2 fields, found 1", "bad"),
            ("1.0,1.0,1.0,one", None, "good"),
            ("1.0,1.0,1.0,one", None, "good"),
        ],
        key=repr,
    )
