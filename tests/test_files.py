from pathlib import Path

import pytest
from pyspark.ml.linalg import Vectors

from featureflow.schemas import IRIS_SCHEMA
from featureflow.session import shared_folder, work_path
from featureflow.sinks import kafka_sink_options, write_csv, write_libsvm
from featureflow.sources import kafka_source_options, read_csv, read_libsvm

# Same shapes as the scoring file: whole numbers, a blank line, rows without the last field.
IRIS_TEXT = """sepal_length,sepal_width,petal_length,petal_width,species
5.0,3,1.5,0.2,Iris-setosa
6,3.1,4.6,1.4,Iris-versicolor

5.0,3,1.5,0.2
6,3.1,4.6,1.4"""


def test_short_and_blank_lines_under_a_schema(spark, tmp_path):
    path = tmp_path / "iris.csv"
    path.write_text(IRIS_TEXT)
    got = read_csv(spark, str(path), IRIS_SCHEMA).collect()
    assert len(got) == 4
    assert [r["species"] for r in got] == ["Iris-setosa", "Iris-versicolor", None, None]
    assert got[1]["sepal_length"] == 6.0


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,2.5,x\n2,3,y\n")
    assert read_csv(spark, str(path)).dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


@pytest.mark.parametrize("num_files", [1, 3])
def test_number_of_files_and_overwrite(spark, tmp_path, num_files):
    path = str(tmp_path / "out")
    df = spark.range(1000).repartition(5)
    write_csv(df, path)
    write_csv(df, path, num_files=num_files)
    assert len(list(Path(path).glob("part-*.csv"))) == num_files
    assert spark.read.csv(path).count() == 1000


def test_libsvm_keeps_labels_and_sparse_slots(spark, tmp_path):
    path = str(tmp_path / "data")
    data = [(0.0, Vectors.dense(1.5, 0.0, 2.0)), (1.0, Vectors.sparse(3, [2], [4.0]))]
    write_libsvm(spark.createDataFrame(data, ["label", "features"]), path)
    back = {r["label"]: r["features"].toArray().tolist() for r in read_libsvm(spark, path, 3).collect()}
    assert back == {0.0: [1.5, 0.0, 2.0], 1.0: [0.0, 0.0, 4.0]}


def test_kafka_options():
    options = kafka_source_options(
        "host:9092", "in", group_id="g", fail_on_data_loss=False, max_offsets_per_trigger=1000
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "in",
        "failOnDataLoss": "false",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_source_options("h", "t")["failOnDataLoss"] == "true"
    assert kafka_sink_options("h", "out") == {"kafka.bootstrap.servers": "h", "topic": "out"}


def test_work_paths_are_new_and_in_the_shared_folder(spark):
    one, two = work_path(spark, "x"), work_path(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))
