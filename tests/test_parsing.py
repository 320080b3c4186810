import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featureflow.functions import parse_csv_line, quarantine_csv_line, split_fields
from featureflow.schemas import CHURN_SCHEMA, IRIS_FEATURES_SCHEMA, record

SCHEMA = record("id int, name string, score double")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_split_removes_quotes_and_trailing_empty_fields(spark):
    df = lines(spark, '"a","b,c",d', "a,,b,,", "", "a|b")
    got = [r[0] for r in df.select(split_fields("value")).collect()]
    assert got == [["a", "b", "c", "d"], ["a", "", "b"], [""], ["a|b"]]
    kept = [r[0] for r in df.select(split_fields("value", drop_trailing=False)).collect()]
    assert kept[1] == ["a", "", "b", "", ""]
    assert lines(spark, "a|b").select(split_fields("value", "|")).first()[0] == ["a", "b"]


def test_permissive_gives_nulls(spark):
    df = lines(spark, '1,"x",2.5', "1,x", "one,x,2", "", ",x,", "7,,3,more", None)
    got = [tuple(r) for r in parse_csv_line(df, "value", SCHEMA).collect()]
    assert got == [
        (1, "x", 2.5),
        (1, "x", None),
        (None, "x", 2.0),
        (None, None, None),
        (None, "x", None),
        (7, "", 3.0),
        (None, None, None),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fails_on_any_bad_line_whatever_the_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = parse_csv_line(lines(spark, "1,x,2"), "value", SCHEMA, "strict")
        assert [tuple(r) for r in good.collect()] == [(1, "x", 2.0)]
        for bad in ("1,x", "a,x,2", "1,x,", None):
            with pytest.raises(Exception, match="expected 3 fields|is not int|is not double"):
                parse_csv_line(lines(spark, "1,x,2", bad), "value", SCHEMA, "strict").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_strict_checks_even_if_the_bad_column_is_not_selected(spark):
    parsed = parse_csv_line(lines(spark, "1,x,bad"), "value", SCHEMA, "strict")
    with pytest.raises(Exception, match="score is not double"):
        parsed.select("id").collect()


def test_quarantine_keeps_every_line_once(spark, rows):
    df = lines(spark, "1,x,2", "1,x", "a,x,2", None)
    good, bad = quarantine_csv_line(df, "value", SCHEMA)
    assert rows(good) == [(1, "x", 2.0)]
    assert rows(bad) == [
        ("1,x", "expected 3 fields, found 2"),
        ("a,x,2", "id is not int"),
        (None, "expected 3 fields, found null"),
    ]


def test_churn_line_and_iris_line(spark):
    line = ",".join("text" if f.dataType.typeName() == "string" else "7" for f in CHURN_SCHEMA)
    row = parse_csv_line(lines(spark, line), "value", CHURN_SCHEMA, "strict").first()
    assert len(row) == 23 and row["CLIENTNUM"] == 7 and row["Gender"] == "text"
    row = parse_csv_line(lines(spark, '"5.1","3",1.4,0.2'), "value", IRIS_FEATURES_SCHEMA).first()
    assert tuple(row) == (5.1, 3.0, 1.4, 0.2)


def test_line_is_split_once_per_row(spark):
    plan = parse_csv_line(lines(spark, "1,x,2"), "value", SCHEMA)._jdf.queryExecution()
    optimized = plan.optimizedPlan().toString()
    assert optimized.count("split(") <= 3 and "Python" not in optimized


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab,"1.- ', max_size=12), min_size=40, max_size=40))
def test_split_against_plain_strings(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = df.select("i", split_fields("value").alias("f")).orderBy("i").collect()
    assert [r["f"] for r in got] == [v.replace('"', "").rstrip(",").split(",") for v in values]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_csv_line(lines(spark, "1"), "value", SCHEMA, "other")
