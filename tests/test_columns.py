from pyspark.sql import functions as F

from featureflow.functions import (
    binary_target,
    columns_of_type,
    copy_column,
    drop_positions,
    equals_all,
    exceeds,
    format_message,
    join_fields,
    ordered_pair,
    rename_all,
    type_counts,
)
from featureflow.schemas import CHURN_SCHEMA, IRIS_CLASSES, IRIS_CLASSES_SCHEMA
from featureflow.sources import dim_table


def test_drop_first_and_last_two(spark):
    df = spark.createDataFrame([], CHURN_SCHEMA)
    names = drop_positions(df, (0, -2, -1)).columns
    assert names == CHURN_SCHEMA.names[1:-2]


def test_columns_by_type_and_counts(spark, rows):
    df = drop_positions(spark.createDataFrame([], CHURN_SCHEMA), (0, -2, -1))
    assert rows(type_counts(df)) == [("double", 5), ("int", 9), ("string", 6)]
    assert len(columns_of_type(df)) == 14
    assert "Attrition_Flag" not in columns_of_type(df, ["string"], exclude=["Attrition_Flag"])


def test_binary_target_null_is_one(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert rows(binary_target(df, "s", "a")) == [("a", 0), ("b", 1), (None, 1)]


def test_copy_rename_filter(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (1, "y")], "a int, b string")
    assert copy_column(df, "a", "c").columns == ["a", "b", "c"]
    assert rename_all(df, ["p", "q"]).columns == ["p", "q"]
    assert rows(equals_all(df, {"a": 1, "b": "y"})) == [(1, "y")]


def test_pairs_and_threshold(spark):
    df = spark.createDataFrame([("b", "a", -0.7), ("a", "b", 0.5)], "x string, y string, r double")
    got = df.filter(exceeds("r", 0.6)).select(*ordered_pair("x", "y")).collect()
    assert [tuple(r) for r in got] == [("a", "b")]


def test_lines_skip_nulls_and_print_doubles(spark):
    df = spark.createDataFrame([(3.0, None, "z")], "a double, b string, c string")
    row = df.select(join_fields("a", "b", "c"), format_message("a", "c")).first()
    assert tuple(row) == ("3.0,z", "Prediction: 3.0 - z")


def test_dimension_is_a_local_relation_of_known_type(spark):
    dim = dim_table(spark, IRIS_CLASSES, IRIS_CLASSES_SCHEMA)
    assert dim.dtypes == [("iris_id", "int"), ("iris_value", "string")]
    assert [tuple(r) for r in dim.orderBy("iris_id").collect()] == IRIS_CLASSES
    plan = dim.select(F.col("iris_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation")
