"""Named queries over the shared test tables, with an equivalent SQL text where there is one.

Each query takes a session and the folder of the tables and reads its tables
whole. ``ids`` names the operators a query exercises.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass
from itertools import combinations

from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    binary_target,
    copy_column,
    drop_positions,
    equals_all,
    rename_all,
)
from ..functions.parsing import parse_csv_line, quarantine_csv_line
from ..functions.text import format_message, join_fields
from ..functions.vectors import slice_vector, vector_elements
from ..operators import balance, correlation, encoding, joins, metrics, profile, sampling, sets
from ..operators.scaling import min_max
from ..operators.selection import (
    anova_scores,
    selected_columns,
    top_share,
    top_share_by_score,
)
from ..schemas import record
from ..session import work_path
from ..sinks import (
    ModelVersions,
    save_model,
    start_batches,
    start_stream,
    wait,
    write_csv,
    write_libsvm,
    write_messages,
)
from ..sources import dim_table, load_model, read_csv, read_libsvm, read_table, read_table_stream
from ..sources.streams import text_values
from ..streaming import SendOnce, read_once, score_batches, score_keys, score_labels, score_sound_labels, send_batches, set_broken_aside
from .forest import importances, node_table, predicted, walk
from .held import held
from .scoring import score, write_positive_ids
from .training import (
    ChurnFlow,
    coefficient_table,
    fit_forest,
    forest_table,
    importance_table,
    logistic_regression,
    random_forest,
)
from .tuning import OPTIMAL, best_parameters, logistic_grid, optimality_residuals, tune, tuning_report

Build = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    build: Build
    ids: tuple[str, ...]
    sql: str | None = None


CATALOGUE: dict[str, Query] = {}


def query(ids: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        CATALOGUE[build.__name__] = Query(build, tuple(ids.split()), sql)
        return build

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# Counting, balancing and splitting -----------------------------------------

ORDER_TARGET_SQL = "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END"


def order_targets(spark: SparkSession, folder: str) -> DataFrame:
    return binary_target(read_table(spark, folder, "orders"), "o_orderstatus", "F")


@query("AGG1", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return profile.row_count(read_table(spark, folder, "lineitem"))


@query(
    "SCL1 PRJ4 AGG2 SRT1",
    f"SELECT {ORDER_TARGET_SQL} AS target, count(*) AS count FROM orders GROUP BY 1",
)
def class_balance(spark, folder):
    return profile.group_counts(order_targets(spark, folder), "target")


RATIO_SQL = f"""
    SELECT count(*) FILTER (WHERE {ORDER_TARGET_SQL} = 1) AS majority_rows,
           count(*) FILTER (WHERE {ORDER_TARGET_SQL} = 0) AS minority_rows
    FROM orders"""


@query("AGG4", f"SELECT *, majority_rows // minority_rows AS ratio FROM ({RATIO_SQL})")
def class_ratio(spark, folder):
    return balance.class_ratio(order_targets(spark, folder), "target", minority=0, majority=1)


OVERSAMPLED_SQL = f"""
    WITH ratio AS (SELECT majority_rows // minority_rows AS k FROM ({RATIO_SQL})),
    copies AS (
        SELECT o_orderkey, o_totalprice, {ORDER_TARGET_SQL} AS target,
               unnest(range(CASE WHEN {ORDER_TARGET_SQL} = 0 THEN k ELSE 1 END)) AS copy
        FROM orders, ratio)"""


@query(
    "GEN2 GEN1 AGG4 FLT1 SET1",
    f"{OVERSAMPLED_SQL} SELECT target, count(*) AS count FROM copies GROUP BY 1",
)
def oversample_counts(spark, folder):
    balanced = balance.oversample(order_targets(spark, folder), "target", minority=0, majority=1)
    return profile.group_counts(balanced, "target")


@query("GEN2 PRJ3", f"{OVERSAMPLED_SQL} SELECT o_orderkey, o_totalprice, target FROM copies")
def oversample_rows(spark, folder):
    balanced = balance.oversample(order_targets(spark, folder), "target", minority=0, majority=1)
    return balanced.select("o_orderkey", "o_totalprice", "target")


@query("GEN1 SCL9", "SELECT p_partkey, p_name FROM part, range(3)")
def replicate_rows(spark, folder):
    return balance.replicate_rows(read_table(spark, folder, "part"), 3).select("p_partkey", "p_name")


@query(
    "SET1",
    """SELECT c_custkey AS key, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def union_rows(spark, folder):
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    both = rename_all(sets.union_rows(customers, suppliers), ["key", "balance"])
    swapped = suppliers.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return sets.union_rows(both, swapped, by_name=True)


@query("SET2", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return sets.distinct_rows(lines.select("l_returnflag", "l_linestatus", "l_linenumber"))


@query(
    "SET3",
    """SELECT c_custkey AS custkey FROM customer
       INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)
def common_keys(spark, folder):
    customers = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    orders = equals_all(read_table(spark, folder, "orders"), {"o_orderstatus": "F"})
    return sets.common_rows(customers, orders.select("o_custkey"))


@query(
    "SET4",
    """SELECT c_custkey AS custkey FROM customer
       EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)
def remaining_keys(spark, folder):
    customers = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    orders = equals_all(read_table(spark, folder, "orders"), {"o_orderstatus": "F"})
    return sets.remaining_rows(customers, orders.select("o_custkey"))


KEY_HASH_SQL = "('0x' || md5(o_orderkey::VARCHAR)[1:8])::BIGINT"
SPLIT_SHARE = 0.705


@query(
    "GEN3",
    f"""SELECT o_orderkey, CASE WHEN {KEY_HASH_SQL} < round({SPLIT_SHARE} * 4294967296)
               THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hash_split(spark, folder):
    train, test = sampling.hash_split(
        read_table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], SPLIT_SHARE
    )
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "GEN3",
    "SELECT count(*) AS rows, count(*) AS distinct_keys, true AS near_share FROM orders",
)
def random_split(spark, folder):
    """The parts together hold every order once, and the first holds about its share."""
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    parts = sampling.random_split(orders)
    tagged = [part.withColumn("part", F.lit(i)) for i, part in enumerate(parts)]
    share = F.avg(1 - F.col("part"))
    return sets.union_rows(*tagged).agg(
        F.count("*").alias("rows"),
        F.count_distinct("o_orderkey").alias("distinct_keys"),
        F.abs(share - 0.7).__lt__(0.05).alias("near_share"),
    )


@query("PAR1", "SELECT count(*) AS rows, sum(p_size)::BIGINT AS sizes, 4 AS partitions FROM part")
def repartition_rows(spark, folder):
    part = read_table(spark, folder, "part").repartition(4)
    placed = part.withColumn("_task", F.spark_partition_id())
    return placed.agg(
        F.count("*").alias("rows"),
        F.sum("p_size").alias("sizes"),
        F.count_distinct("_task").cast("int").alias("partitions"),
    )


# Projections, filters, text -------------------------------------------------


@query(
    "PRJ1 PRJ2 PRJ4 PRJ5",
    "SELECT p_name AS name, p_brand AS brand, p_type AS type, p_brand AS maker FROM part",
)
def drop_columns(spark, folder):
    trimmed = drop_positions(read_table(spark, folder, "part"), (0, -2, -1))
    return rename_all(copy_column(trimmed, "p_brand", "maker"), ["name", "brand", "type", "maker"])


@query(
    "FLT1 PRJ1",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def equality_filter(spark, folder):
    orders = equals_all(read_table(spark, folder, "orders"), {"o_orderstatus": "F"})
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "FLT2",
    """SELECT o_orderkey FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def conjunctive_filter(spark, folder):
    wanted = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    return equals_all(read_table(spark, folder, "orders"), wanted).select("o_orderkey")


@query(
    "LIM1 SRT2",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_orders(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "SCL7 SCL5",
    """SELECT o_orderkey,
              concat_ws(',', o_orderkey, nullif(o_orderstatus, 'P'), o_totalprice) AS line
       FROM orders""",
)
def format_line(spark, folder):
    status = F.nullif("o_orderstatus", F.lit("P"))
    line = join_fields("o_orderkey", status, "o_totalprice")
    return read_table(spark, folder, "orders").select("o_orderkey", line.alias("line"))


@query(
    "SCL8 SNK5",
    """SELECT 'Prediction: ' || c_mktsegment || ' - ' || c_name AS value FROM customer""",
)
def format_messages(spark, folder):
    """Messages go through the batch message sink, here text files."""
    path = work_path(spark, "messages")
    message = format_message("c_mktsegment", "c_name")
    write_messages(read_table(spark, folder, "customer"), message, "text", {"path": path})
    return spark.read.text(path)


EVENT_SCHEMA = record("event_id int, event_type string, value double, user_id int")


def event_lines(spark: SparkSession, folder: str, broken: bool) -> DataFrame:
    return lines_of(read_table(spark, folder, "events"), broken)


def lines_of(events: DataFrame, broken: bool) -> DataFrame:
    """Events as text lines; ``broken`` spoils a part of them in four ways."""
    kind = F.format_string('"%s"', "event_type")
    line = F.concat_ws(",", "event_id", kind, "value", "user_id")
    if broken:
        turn = F.col("event_id") % 10
        line = (
            F.when(turn == 3, F.concat_ws(",", "event_id", kind))
            .when(turn == 5, F.concat_ws(",", "event_id", kind, F.lit("n/a"), "user_id"))
            .when(turn == 7, F.concat_ws(",", "event_id", kind, "value", F.lit(""), F.lit("")))
            .when(turn == 9, F.concat_ws(",", "event_id", kind, "value", "user_id", F.lit("more")))
            .otherwise(line)
        )
    return events.select("event_id", line.alias("line"))


BROKEN_SQL = """
    WITH lines AS (
        SELECT event_id AS id, CASE event_id % 10
            WHEN 3 THEN concat_ws(',', event_id, '"' || event_type || '"')
            WHEN 5 THEN concat_ws(',', event_id, '"' || event_type || '"', 'n/a', user_id)
            WHEN 7 THEN concat_ws(',', event_id, '"' || event_type || '"', value, '', '')
            WHEN 9 THEN concat_ws(',', event_id, '"' || event_type || '"', value, user_id, 'more')
            ELSE concat_ws(',', event_id, '"' || event_type || '"', value, user_id) END AS line
        FROM events),
    fields AS (
        SELECT id, line, string_split(rtrim(replace(line, '"', ''), ','), ',') AS f FROM lines),
    parsed AS (
        SELECT id, line, len(f) AS n, try_cast(f[1] AS INTEGER) AS event_id, f[2] AS event_type,
               try_cast(f[3] AS DOUBLE) AS value, try_cast(f[4] AS INTEGER) AS user_id
        FROM fields)"""


@query(
    "SCL2 SCL3 SCL4 SCL5 SCL6 UDF2",
    f"{BROKEN_SQL} SELECT event_id, event_type, value, user_id FROM parsed",
)
def parse_permissive(spark, folder):
    return parse_csv_line(event_lines(spark, folder, True), "line", EVENT_SCHEMA)


JUDGED_SQL = f"""{BROKEN_SQL},
    judged AS (
        SELECT *, CASE
            WHEN n < 4 THEN 'expected 4 fields, found ' || n
            WHEN event_id IS NULL THEN 'event_id is not int'
            WHEN value IS NULL THEN 'value is not double'
            WHEN user_id IS NULL THEN 'user_id is not int' END AS problem
        FROM parsed)"""


@query(
    "SCL6",
    f"""{JUDGED_SQL}
    SELECT id, CASE WHEN problem IS NULL THEN 'good' ELSE 'bad' END AS part,
           CASE WHEN problem IS NULL THEN value END AS value,
           CASE WHEN problem IS NOT NULL THEN line END AS line, problem
    FROM judged""",
)
def parse_quarantine(spark, folder):
    lines = event_lines(spark, folder, True).withColumnRenamed("event_id", "id")
    good, bad = quarantine_csv_line(lines, "line", EVENT_SCHEMA, keep=["id"])
    good = good.select("id", F.lit("good").alias("part"), "value")
    bad = bad.select("id", F.lit("bad").alias("part"), "line", F.col("_problem").alias("problem"))
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "SCL5 SCL6",
    """SELECT event_id::INTEGER AS event_id, event_type, value, user_id::INTEGER AS user_id
       FROM events""",
)
def parse_strict(spark, folder):
    return parse_csv_line(event_lines(spark, folder, False), "line", EVENT_SCHEMA, "strict")


# Files ------------------------------------------------------------------------

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("SRC2 SNK1 SNK2 PAR1", CUSTOMER_SQL)
def csv_roundtrip(spark, folder):
    """Written without header as two files, read back with the explicit schema."""
    customers = read_table(spark, folder, "customer")
    path = work_path(spark, "csv")
    write_csv(customers, path, num_files=2)
    return read_csv(spark, path, customers.schema, header=False)


@query(
    "SRC1 SNK1 SNK6",
    """SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
       FROM customer""",
)
def csv_inferred(spark, folder):
    """Written with header, types found again from the text."""
    path = work_path(spark, "csv")
    write_csv(read_table(spark, folder, "customer"), path, header=True)
    return read_csv(spark, path)


@query(
    "SRC2",
    """SELECT o_orderkey, o_totalprice,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def csv_short_rows(spark, folder):
    """Lines without the last field, and blank lines, under a three-column schema."""
    orders = read_table(spark, folder, "orders")
    full = join_fields("o_orderkey", "o_totalprice", "o_orderstatus")
    short = F.concat(join_fields("o_orderkey", "o_totalprice"), F.lit("\n"))
    line = F.when(F.col("o_orderstatus") == "P", short).otherwise(full)
    path = work_path(spark, "csv")
    orders.select(line.alias("value")).write.text(path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string"
    return read_csv(spark, path, schema, header=False)


def embedding_vectors(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings")
    values = F.col("embedding").cast("array<double>")
    return table.select("vec_id", F.col("label").cast("double").alias("label"),
                        array_to_vector(values).alias("features"))


EMBEDDING_WIDTH = 64


@query(
    "SRC3",
    """SELECT label::DOUBLE AS label, count(*) AS rows,
              round(sum(list_sum(embedding::DOUBLE[])), 4) AS total
       FROM embeddings GROUP BY 1""",
)
def libsvm_roundtrip(spark, folder):
    path = work_path(spark, "libsvm")
    write_libsvm(embedding_vectors(spark, folder), path)
    back = read_libsvm(spark, path, EMBEDDING_WIDTH)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return back.groupBy("label").agg(
        F.count("*").alias("rows"), F.round(F.sum(total), 4).alias("total")
    )


@query(
    "SCL10 UDF1 FEA4",
    """SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b,
              embedding[3]::DOUBLE AS c, embedding[4]::DOUBLE AS d
       FROM embeddings""",
)
def vector_elements_of(spark, folder):
    found = vector_elements(embedding_vectors(spark, folder), "features", ["a", "b", "c", "d"])
    return found.select("vec_id", "a", "b", "c", "d")


@query(
    "SCL11",
    """SELECT vec_id, embedding[64]::DOUBLE AS last, embedding[6]::DOUBLE AS sixth
       FROM embeddings""",
)
def vector_slice(spark, folder):
    sliced = slice_vector(embedding_vectors(spark, folder), "features", [63, 5], "part")
    return vector_elements(sliced, "part", ["last", "sixth"]).select("vec_id", "last", "sixth")


# Statistics ---------------------------------------------------------------------

SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@query(
    "AGG3 PRJ1 PRJ6",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
                   round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min,
                   quantile_disc({c}, 0.25)::DOUBLE AS p25, quantile_disc({c}, 0.5)::DOUBLE AS p50,
                   quantile_disc({c}, 0.75)::DOUBLE AS p75, max({c})::DOUBLE AS max
            FROM lineitem"""
        for c in SUMMARY_COLUMNS
    ),
)
def numeric_summary(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return rounded(profile.numeric_summary(lines, SUMMARY_COLUMNS, exact=True), 6, "mean", "stddev")


LARGE_KEYS_SQL = """
    WITH keys AS (
        SELECT 9007199254740993 + 2 * o_orderkey AS order_number, 4611686018427387 * (o_custkey % 2000) AS customer_number,
               -9223372036854775807 + o_orderkey AS least_number
        FROM orders)"""
LARGE_KEYS = ("order_number", "customer_number", "least_number")


@query(
    "AGG3",
    LARGE_KEYS_SQL
    + " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count({c}) AS count, min({c}) AS min, quantile_disc({c}, 0.25) AS p25,
               quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, max({c}) AS max
        FROM keys"""
        for c in LARGE_KEYS
    ),
)
def integer_summary(spark, folder):
    """Integers beyond the 53 bits of a double keep every digit."""
    key, customer = F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint")
    keys = read_table(spark, folder, "orders").select(
        (F.lit(9007199254740993) + 2 * key).alias("order_number"),
        (F.lit(4611686018427387) * (customer % 2000)).alias("customer_number"),
        (F.lit(-9223372036854775807) + key).alias("least_number"),
    )
    return profile.numeric_summary(keys, LARGE_KEYS, exact=True).drop("mean", "stddev")


PRICES_SQL = "WITH prices AS (SELECT o_totalprice::DECIMAL(12,2)::DECIMAL(28,2) * 1000000000::DECIMAL(10,0) AS price FROM orders)"


@query(
    "AGG3",
    f"""{PRICES_SQL}
        SELECT 'price' AS column_name, count(price) AS count, min(price)::DECIMAL(30,2)::VARCHAR AS min,
               quantile_disc(price, 0.25)::DECIMAL(30,2)::VARCHAR AS p25,
               quantile_disc(price, 0.5)::DECIMAL(30,2)::VARCHAR AS p50,
               quantile_disc(price, 0.75)::DECIMAL(30,2)::VARCHAR AS p75, max(price)::DECIMAL(30,2)::VARCHAR AS max
        FROM prices""",
)
def decimal_summary(spark, folder):
    """Decimals are compared and returned as decimals."""
    price = F.col("o_totalprice").cast("decimal(12,2)") * F.lit(10**9).cast("decimal(12,0)")
    prices = read_table(spark, folder, "orders").select(price.cast("decimal(30,2)").alias("price"))
    summary = profile.numeric_summary(prices, ["price"], exact=True).drop("mean", "stddev")
    return summary.select("column_name", "count", *[F.col(c).cast("string") for c in ("min", "p25", "p50", "p75", "max")])


@query("AGG3")
def numeric_summary_approx(spark, folder):
    return profile.numeric_summary(read_table(spark, folder, "lineitem"), SUMMARY_COLUMNS)


# How the two systems name the column types of the profiled table.
PROFILE_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "PRJ6",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS type, count(*) AS rows,
                   count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct
            FROM orders"""
        for c, kind in PROFILE_TYPES.items()
    ),
)
def column_profile(spark, folder):
    orders = read_table(spark, folder, "orders")
    return profile.column_profile(orders, exact=orders.columns)


# SQL of the measured columns, valid in both systems.
MEASURES = {
    "quantity": "l_quantity",
    "extendedprice": "l_extendedprice",
    "discount": "l_discount",
    "tax": "l_tax",
    "linenumber": "CAST(l_linenumber AS DOUBLE)",
    "orderkey": "CAST(l_orderkey AS DOUBLE)",
    "partkey": "CAST(l_partkey AS DOUBLE)",
    "suppkey": "CAST(l_suppkey AS DOUBLE)",
    "net": "l_extendedprice * (1 - l_discount)",
    "gross": "l_extendedprice * (1 + l_tax)",
    "unit": "l_extendedprice / l_quantity",
    "saving": "l_extendedprice * l_discount",
    "levy": "l_extendedprice * l_tax",
    "weight": "l_quantity * 2.5 + l_linenumber",
}
MEASURE_NAMES = sorted(MEASURES)
MEASURES_SQL = "SELECT {} FROM lineitem".format(
    ", ".join(f"{sql} AS {name}" for name, sql in MEASURES.items())
)


def measures(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return lines.select(*keep, *[F.expr(sql).alias(name) for name, sql in MEASURES.items()])


def _pairs_sql(pairs) -> str:
    """Long table of correlations; adding zero turns -0.0 into 0.0."""
    corrs = ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(pairs))
    lines = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(c{i}, 6) + 0.0 AS corr FROM one"
        for i, (a, b) in enumerate(pairs)
    )
    return f"WITH m AS ({MEASURES_SQL}), one AS (SELECT {corrs} FROM m), pairs AS ({lines})"


PAIRS_SQL = _pairs_sql(list(combinations(MEASURE_NAMES, 2)))
MATRIX_SQL = _pairs_sql([(a, b) for a in MEASURE_NAMES for b in MEASURE_NAMES])


@query("AGG5 SCL13", f"{PAIRS_SQL} SELECT * FROM pairs")
def corr_pairs(spark, folder):
    pairs = correlation.correlation_pairs(measures(spark, folder), MEASURE_NAMES)
    return rounded(pairs, 6, "corr")


@query("AGG6 JOI4", f"{MATRIX_SQL} SELECT * FROM pairs")
def corr_matrix(spark, folder):
    matrix = correlation.correlation_matrix(measures(spark, folder), MEASURE_NAMES)
    return rounded(matrix, 6, "corr")


WIDE_CORR_SQL = """
    WITH e AS (SELECT vec_id, embedding AS x, unnest(range(1, 65)) AS k FROM embeddings WHERE embedding IS NOT NULL),
    v AS (SELECT vec_id, k, x[k]::DOUBLE AS a, x[k % 64 + 1]::DOUBLE AS b FROM e),
    w AS (SELECT vec_id, 'x' || (k - 1) AS name, a AS value FROM v
          UNION ALL SELECT vec_id, 's' || (k - 1), CASE WHEN (vec_id + k - 1) % 7 > 0 THEN a * a END FROM v
          UNION ALL SELECT vec_id, 'p' || (k - 1), a * b FROM v)
    SELECT l.name AS col_a, r.name AS col_b, round(corr(l.value, r.value), 6) + 0.0 AS corr
    FROM w l JOIN w r ON l.vec_id = r.vec_id AND l.name < r.name GROUP BY ALL"""


@query("AGG5 FEA9", WIDE_CORR_SQL)
def wide_corr(spark, folder):
    """192 columns, a third of them with nulls, multiplied in blocks of rows."""
    at = [F.col("embedding")[k].cast("double") for k in range(EMBEDDING_WIDTH)]
    squares = [F.when((F.col("vec_id") + k) % 7 > 0, x * x) for k, x in enumerate(at)]
    products = [x * at[(k + 1) % EMBEDDING_WIDTH] for k, x in enumerate(at)]
    named = [c.alias(f"{kind}{k}") for kind, part in zip("xsp", (at, squares, products), strict=True) for k, c in enumerate(part)]
    table = read_table(spark, folder, "embeddings").where("embedding IS NOT NULL").select(*named)
    return correlation.correlation_pairs(table, table.columns).withColumn("corr", F.round("corr", 6) + F.lit(0.0))


@query(
    "AGG7 SCL12 SRT2",
    f"{PAIRS_SQL} SELECT * FROM pairs WHERE abs(corr) > 0.6",
)
def strong_pairs(spark, folder):
    pairs = correlation.correlation_pairs(measures(spark, folder), MEASURE_NAMES)
    return rounded(correlation.strong_pairs(pairs), 6, "corr")


@query(
    "SET3 SET2 AGG7",
    f"{PAIRS_SQL} SELECT * FROM pairs WHERE abs(corr) > 0.6 AND corr < 1.0",
)
def corr_agree(spark, folder):
    table = measures(spark, folder)
    one = correlation.strong_pairs(correlation.correlation_pairs(table, MEASURE_NAMES))
    two = correlation.strong_pairs(
        correlation.assembled_correlation_matrix(table, MEASURE_NAMES), below=1.0
    )
    return correlation.agreeing_pairs(one, two)


@query(
    "FEA9 SET4 SCL13",
    f"""{PAIRS_SQL}, names AS (SELECT DISTINCT unnest([col_a, col_b]) AS column_name FROM pairs)
        SELECT column_name FROM names
        WHERE column_name NOT IN (SELECT greatest(col_a, col_b) FROM pairs WHERE abs(corr) > 0.6)""",
)
def kept_columns(spark, folder):
    table = measures(spark, folder)
    strong = correlation.strong_pairs(correlation.correlation_pairs(table, MEASURE_NAMES))
    names = profile.column_names(table, MEASURE_NAMES)
    return correlation.kept_columns(names, strong)


# Feature stages -------------------------------------------------------------------


@query(
    "FEA1",
    """WITH n AS (SELECT event_type, count(*) AS rows FROM events GROUP BY 1)
       SELECT event_type, rows,
              (row_number() OVER (ORDER BY rows DESC, event_type) - 1)::DOUBLE AS index
       FROM n""",
)
def label_index(spark, folder):
    events = read_table(spark, folder, "events")
    indexed = encoding.index_label("event_type", "index").fit(events).transform(events)
    return indexed.groupBy("event_type", "index").agg(F.count("*").alias("rows"))


@query(
    "FEA2",
    """WITH f AS (SELECT l_returnflag AS v, row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS i
                  FROM lineitem GROUP BY 1),
            s AS (SELECT l_linestatus AS v, row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS i
                  FROM lineitem GROUP BY 1)
       SELECT l_returnflag, l_linestatus, f.i::DOUBLE AS "l_returnflag_Indexed",
              s.i::DOUBLE AS "l_linestatus_Indexed", count(*) AS rows
       FROM lineitem JOIN f ON l_returnflag = f.v JOIN s ON l_linestatus = s.v
       GROUP BY ALL""",
)
def multi_index(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    columns = ["l_returnflag", "l_linestatus"]
    indexed = encoding.index_columns(columns).fit(lines).transform(lines)
    by = columns + [name + encoding.INDEXED for name in columns]
    return indexed.groupBy(*by).agg(F.count("*").alias("rows"))


CATEGORY_SQL = """
    WITH n AS (SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1),
    idx AS (SELECT o_custkey, rows,
                   row_number() OVER (ORDER BY rows DESC, o_custkey::VARCHAR) - 1 AS index FROM n)"""


@query("FEA1", f"{CATEGORY_SQL} SELECT * FROM idx")
def category_index(spark, folder):
    return encoding.category_index(read_table(spark, folder, "orders"), "o_custkey")


@query(
    "FEA1",
    f"""{CATEGORY_SQL} SELECT o_orderkey, o_custkey, index AS cust_index
        FROM orders JOIN idx USING (o_custkey)""",
)
def indexed_orders(spark, folder):
    """A small head, so that frequent and rare categories take their own way."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    index = encoding.category_index(orders, "o_custkey")
    return encoding.attach_index(orders, index, "o_custkey", "cust_index", hot=100)


@query(
    "FEA3",
    """WITH f AS (SELECT o_orderpriority AS v,
                         row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS i
                  FROM orders GROUP BY 1)
       SELECT o_orderkey, i::INTEGER AS slot, 1.0::DOUBLE AS value
       FROM orders JOIN f ON o_orderpriority = v WHERE i < (SELECT max(i) FROM f)""",
)
def one_hot(spark, folder):
    orders = read_table(spark, folder, "orders")
    indexer = encoding.index_columns(["o_orderpriority"])
    encoder = encoding.encode_columns(["o_orderpriority_Indexed"])
    coded = Pipeline(stages=[indexer, encoder]).fit(orders).transform(orders)
    slots = F.posexplode(vector_to_array("o_orderpriority_Indexed_Coded")).alias("slot", "value")
    return coded.select("o_orderkey", slots).filter(F.col("value") != 0)


@query(
    "FEA2 FEA3",
    f"""{CATEGORY_SQL},
        c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
        SELECT o_orderstatus, index::INTEGER AS slot, n::DOUBLE AS rows
        FROM c JOIN idx USING (o_custkey) WHERE index < (SELECT max(index) FROM idx)""",
)
def coded_customers(spark, folder):
    """Sparse codes of a column with as many categories as customers, summed by status."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderstatus")
    index = encoding.CategoryIndexer(["o_custkey"]).fit(orders)
    coded = index.coder().transform(index.transform(orders))
    total = Summarizer.metrics("sum").summary(F.col("o_custkey_Indexed_Coded")).alias("s")
    sums = coded.groupBy("o_orderstatus").agg(total)
    slots = F.posexplode(vector_to_array("s.sum")).alias("slot", "rows")
    return sums.select("o_orderstatus", slots).filter(F.col("rows") != 0)


VECTOR_COLUMNS = ["l_linenumber", "l_discount", "l_tax", "l_quantity"]


@query(
    "FEA5 FEA4",
    " UNION ALL ".join(
        f"""SELECT {i} AS slot, value::DOUBLE AS value,
                   (row_number() OVER (ORDER BY value) - 1)::INTEGER AS index
            FROM (SELECT DISTINCT {c} AS value, (SELECT count(DISTINCT {c}) FROM lineitem) AS n
                  FROM lineitem)
            WHERE n <= 20"""
        for i, c in enumerate(VECTOR_COLUMNS)
    ),
)
def vector_index(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    vectors = encoding.assemble(VECTOR_COLUMNS).transform(lines)
    return encoding.vector_categories(spark, encoding.index_vector().fit(vectors))


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "FEA6 FEA4",
    """WITH r AS (SELECT min(l_quantity) a, max(l_quantity) b, min(l_extendedprice) c,
                         max(l_extendedprice) d, min(l_discount) e, max(l_discount) f FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              floor((l_quantity - a) / (b - a) * 1e6 + 0.5) / 1e6 AS l_quantity,
              floor((l_extendedprice - c) / (d - c) * 1e6 + 0.5) / 1e6 AS l_extendedprice,
              floor((l_discount - e) / (f - e) * 1e6 + 0.5) / 1e6 AS l_discount,
              0.5::DOUBLE AS constant
       FROM lineitem, r""",
)
def min_max_scaled(spark, folder):
    lines = read_table(spark, folder, "lineitem").withColumn("constant", F.lit(7.0))
    columns = [*SCALED, "constant"]
    scaler = Pipeline(stages=[encoding.assemble(columns), min_max()]).fit(lines)
    scaled = scaler.transform(lines).select(
        "l_orderkey", "l_linenumber", F.col("scaledFeatures").alias("v")
    )
    found = vector_elements(scaled, "v", columns).drop("v")
    # Cheaper than decimal rounding of every value.
    return found.withColumns({name: F.floor(F.col(name) * 1e6 + 0.5) / 1e6 for name in columns})


ANOVA_SQL = f"""
    WITH m AS (SELECT l_returnflag, {", ".join(f"{sql} AS {name}" for name, sql in MEASURES.items())}
               FROM lineitem),
    long AS ({" UNION ALL ".join(
        f"SELECT {i} AS slot, '{c}' AS column_name, l_returnflag, {c} AS value FROM m"
        for i, c in enumerate(MEASURE_NAMES))}),
    g AS (SELECT slot, column_name, l_returnflag, count(*) AS n, avg(value) AS mean,
                 var_pop(value) AS variance
          FROM long GROUP BY ALL),
    t AS (SELECT *, sum(n * mean) OVER (PARTITION BY slot) / sum(n) OVER (PARTITION BY slot) AS grand
          FROM g),
    f AS (SELECT slot, column_name,
                 (sum(n * (mean - grand) ** 2) / (count(*) - 1))
                 / (sum(n * variance) / (sum(n) - count(*))) AS f_score
          FROM t GROUP BY ALL)"""


@query("FEA7", f"{ANOVA_SQL} SELECT column_name, round(f_score, 6) AS f_score FROM f")
def anova(spark, folder):
    table = measures(spark, folder, "l_returnflag")
    return rounded(anova_scores(table, MEASURE_NAMES, "l_returnflag"), 6, "f_score")


@query(
    "FEA7",
    f"""{ANOVA_SQL} SELECT slot::INTEGER AS slot, column_name FROM f
        ORDER BY f_score DESC, slot LIMIT {int(len(MEASURE_NAMES) * 0.75)}""",
)
def selected_features(spark, folder):
    table = measures(spark, folder, "l_returnflag")
    stages = [
        encoding.index_label("l_returnflag", "target"),
        encoding.assemble(MEASURE_NAMES),
        top_share(features="features"),
    ]
    fitted = Pipeline(stages=stages).fit(table)
    return selected_columns(spark, fitted.stages[-1], MEASURE_NAMES)


@query(
    "FEA7",
    f"""{ANOVA_SQL} SELECT slot::INTEGER AS slot, column_name FROM f
        ORDER BY f_score DESC, slot LIMIT {int(len(MEASURE_NAMES) * 0.75)}""",
)
def selected_by_score(spark, folder):
    table = encoding.assemble(MEASURE_NAMES).transform(measures(spark, folder, "l_returnflag"))
    slicer = top_share_by_score(table, "features", "l_returnflag")
    rows = [(i, MEASURE_NAMES[i]) for i in slicer.getIndices()]
    return dim_table(spark, rows, "slot int, column_name string")


@query("FEA8", "SELECT event_id, event_type, event_type AS found FROM events")
def index_to_label(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "event_type")
    indexer = encoding.index_label("event_type", "prediction").fit(events)
    back = encoding.index_to_label(indexer.labelsArray[0], name="found")
    return back.transform(indexer.transform(events)).drop("prediction")


# Metrics ----------------------------------------------------------------------------

CONFUSION_SQL = """
    SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp,
           count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
           count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn,
           count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn
    FROM labels"""


@query("AGG8 FLT2", CONFUSION_SQL)
def confusion(spark, folder):
    return metrics.confusion_matrix(read_table(spark, folder, "labels"), "quality", "toxic")


@query(
    "AGG9",
    f"""SELECT *, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
               round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall
        FROM ({CONFUSION_SQL})""",
)
def prediction_quality(spark, folder):
    table = metrics.confusion_matrix(read_table(spark, folder, "labels"), "quality", "toxic")
    return rounded(metrics.prediction_quality(table), 9, "accuracy", "precision", "recall")


@query(
    "AGG11",
    """WITH g AS (SELECT l_extendedprice AS s,
                         count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE AS pos,
                         count(*) FILTER (WHERE l_returnflag <> 'R')::DOUBLE AS neg
                  FROM lineitem GROUP BY 1),
            b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
                                                    AND 1 PRECEDING), 0) AS below FROM g)
       SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM b""",
)
def auc(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label")
    table = lines.select(label, F.col("l_extendedprice").alias("score"))
    return rounded(metrics.roc_table(table, "label", "score"), 9, "auc")


@query(
    "AGG10",
    """SELECT round(avg(CASE WHEN l_returnflag = p THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
              round(1 - avg(CASE WHEN l_returnflag = p THEN 1.0 ELSE 0.0 END), 9) AS test_error
       FROM (SELECT l_returnflag, CASE WHEN l_discount < 0.03 THEN 'A'
                                       WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS p
             FROM lineitem)""",
)
def multiclass_accuracy(spark, folder):
    rule = F.when(F.col("l_discount") < 0.03, "A").when(F.col("l_discount") < 0.07, "N").otherwise("R")
    table = read_table(spark, folder, "lineitem").withColumn("p", rule)
    return rounded(metrics.multiclass_accuracy(table, "l_returnflag", "p"), 9, "accuracy", "test_error")


# Joins and models ----------------------------------------------------------------------

# Names of four of the five event kinds by index text; the fifth has no row.
KIND_NAMES = [(0, "first"), (1, "second"), (2, "third"), (3, "fourth")]


@query(
    "SRC4 JOI1",
    """WITH k AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i
                  FROM events GROUP BY 1)
       SELECT event_id, i::INTEGER AS kind_id, ['first', 'second', 'third', 'fourth'][i + 1] AS kind
       FROM events JOIN k USING (event_type) WHERE i < 4""",
)
def dim_join(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "event_type")
    indexed = encoding.index_label("event_type", "index").fit(events).transform(events)
    text = indexed.select("event_id", F.col("index").cast("string").alias("predictedLabel"))
    kinds = dim_table(spark, KIND_NAMES, "kind_id int, kind string")
    joined = joins.join_dimension(text, kinds, "predictedLabel", "kind_id")
    return joined.select("event_id", "kind_id", "kind")


def quality_table(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with numeric and categorical features."""
    documents = read_table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
    )
    labels = read_table(spark, folder, "labels").withColumnRenamed("quality", "target")
    return documents.join(labels, "doc_id")


def quality_flow(**settings) -> ChurnFlow:
    return ChurnFlow(
        numeric=["n_chars", "n_lines", "n_words", "toxic"],
        categorical=["lang", "source"],
        keys=["doc_id"],
        minority=0,
        handle_invalid="keep",
        **settings,
    )


def _quality_model(spark, folder, **settings) -> tuple[PipelineModel, DataFrame]:
    flow = quality_flow(**settings)
    train, test = flow.split(quality_table(spark, folder))
    return flow.fit(train), test


LIGHT = {"regParam": 0.01, "elasticNetParam": 0.0}


@query("MDL1 MDL7 MDL8")
def lr_score(spark, folder):
    model, test = _quality_model(spark, folder, regression=LIGHT)
    scored = score(model, test)
    share = F.get(vector_to_array("probability"), F.lit(1)).alias("probability")
    return scored.select("doc_id", "target", "prediction", share)


@query("MDL6")
def lr_report(spark, folder):
    model, _ = _quality_model(spark, folder, regression=LIGHT)
    return coefficient_table(spark, model.stages[-1])


@query("AGG12")
def lr_summary(spark, folder):
    model, _ = _quality_model(spark, folder, regression=LIGHT)
    return metrics.training_summary(spark, model.stages[-1])


@query("MDL1 MDL3", "SELECT TRUE AS optimal, count(*) AS rows FROM labels WHERE quality IN (0, 1)")
def lr_certificate(spark, folder):
    """The regression behind its own selected features is at the minimum of its objective on the rows it was fitted on."""
    flow = quality_flow(regression=LIGHT)
    table = quality_table(spark, folder)
    train, test = flow.split(table)
    model = flow.fit(train)
    weighted = PipelineModel(stages=model.stages[:-1]).transform(flow.weighted(train))
    gap = optimality_residuals(weighted, [model.stages[-1]], flow.label)[0]
    # Both parts together are all rows: the split loses none.
    rows = train.select("doc_id").union(test.select("doc_id"))
    return rows.agg(F.lit(gap <= OPTIMAL).alias("optimal"), F.count("*").alias("rows"))


def odds_table(spark: SparkSession, folder: str) -> DataFrame:
    labels = read_table(spark, folder, "labels").withColumnRenamed("quality", "target")
    return encoding.assemble(["toxic"], "selectedFeatures").transform(labels)


ODDS = {"regParam": 0.0, "elasticNetParam": 0.0, "tol": 1e-12}
ODDS_SQL = f"WITH c AS ({CONFUSION_SQL})"


@query(
    "MDL1 MDL6",
    f"""{ODDS_SQL}
        SELECT -1 AS slot, round(ln(fn / tn), 3) + 0.0 AS coefficient FROM c
        UNION ALL SELECT 0, round(ln((tp * tn) / (fp * fn)), 3) + 0.0 FROM c""",
)
def lr_odds(spark, folder):
    """On one binary feature the unpenalised fit is known: the log odds and their ratio."""
    model = logistic_regression(**ODDS).fit(odds_table(spark, folder))
    return rounded(coefficient_table(spark, model), 3, "coefficient")


@query(
    "AGG12 MDL1",
    f"""{ODDS_SQL}
        SELECT round((greatest(tp, fp) + greatest(fn, tn)) / (tp + fp + fn + tn), 9) AS accuracy,
               round(CASE WHEN tp * tn < fp * fn THEN 1 - area ELSE area END, 9) AS auc
        FROM (SELECT *, (tp * tn + (tp * fp + fn * tn) / 2) / ((tp + fn) * (fp + tn)) AS area FROM c)""",
)
def lr_odds_summary(spark, folder):
    model = logistic_regression(**ODDS).fit(odds_table(spark, folder))
    summary = metrics.training_summary(spark, model).select("accuracy", "auc")
    return rounded(summary, 9, "accuracy", "auc")


@query(
    "MDL1 MDL8",
    f"""{ODDS_SQL}
        SELECT doc_id, round(CASE WHEN toxic = 1 THEN tp / (tp + fp) ELSE fn / (fn + tn) END, 4)
                   AS probability,
               CASE WHEN toxic = 1 THEN (tp > fp)::INTEGER ELSE (fn > tn)::INTEGER END::DOUBLE
                   AS prediction
        FROM labels, c""",
)
def lr_odds_score(spark, folder):
    table = odds_table(spark, folder)
    scored = score(PipelineModel(stages=[logistic_regression(**ODDS).fit(table)]), table)
    share = F.round(F.get(vector_to_array("probability"), F.lit(1)), 4).alias("probability")
    return scored.select("doc_id", share, "prediction")


@query("MDL3 MDL4 MDL5")
def tune_flow(spark, folder):
    """The regression tuned behind feature stages fitted on the training part, classes balanced by weights."""
    flow = quality_flow()
    train, _ = flow.split(quality_table(spark, folder))
    regression = logistic_regression(maxIter=100)
    pipeline = Pipeline(stages=[*flow.stages(flow.numeric), regression])
    tuned = tune(pipeline, train, logistic_grid(regression), parallelism=4, keys=flow.keys, weigh=flow.weighted)
    return tuning_report(spark, tuned)


# With one binary feature the sign of its coefficient decides the ranking. The coefficient is zero where the
# slope at zero, by the feature's spread, is within the absolute penalty; else it has the slope's opposite sign.
TUNED_SQL = """
    WITH g AS (
        SELECT row_number() OVER (ORDER BY ri, ii, mi) - 1 AS candidate, reg, mix, icept
        FROM (SELECT unnest({regs}) AS reg, generate_subscripts({regs}, 1) AS ri),
             (SELECT unnest({intercepts}) AS icept, generate_subscripts({intercepts}, 1) AS ii),
             (SELECT unnest({mixes}) AS mix, generate_subscripts({mixes}, 1) AS mi)
    ),
    l AS (
        SELECT *, ('0x' || md5(concat_ws('|', doc_id::VARCHAR, 'validation'))[1:8])::BIGINT < round(0.7 * 4294967296) AS train FROM labels
    ),
    t AS (
        SELECT train, count(*) FILTER (WHERE quality = 1 AND toxic = 1)::DOUBLE AS tp,
               count(*) FILTER (WHERE quality = 0 AND toxic = 1)::DOUBLE AS fp,
               count(*) FILTER (WHERE quality = 1 AND toxic = 0)::DOUBLE AS fn,
               count(*) FILTER (WHERE quality = 0 AND toxic = 0)::DOUBLE AS tn
        FROM l GROUP BY train
    ),
    w AS (SELECT tp, fp, fn, tn, greatest((tp + fn) // (fp + tn), 1) AS c FROM t WHERE train),
    s AS (SELECT *, tp + c * fp AS x, tp + fn + c * (fp + tn) AS n, tp + fn + c * c * (fp + tn) AS nn FROM w),
    m AS (
        SELECT g.*, ((CASE WHEN icept THEN (tp + fn) / n ELSE 0.5 END) * x - tp) / n
                    / sqrt((x - x * x / n) / (n - nn / n)) AS slope
        FROM g, s
    ),
    v AS (SELECT (tp * tn + (tp * fp + fn * tn) / 2) / ((tp + fn) * (fp + tn)) AS area FROM t WHERE NOT train),
    r AS (
        SELECT candidate, reg, mix, icept,
               CASE WHEN abs(slope) <= reg * mix THEN 0.5 WHEN slope < 0 THEN area ELSE 1 - area END AS metric
        FROM m, v
    )"""


def tuned_sql(regs: str, mixes: str, intercepts: str) -> str:
    return TUNED_SQL.format(regs=regs, mixes=mixes, intercepts=intercepts)


def odds_tuned(spark, folder, *grid):
    """The search on one binary feature, where what each candidate reaches is known."""
    labels = read_table(spark, folder, "labels").withColumnRenamed("quality", "target")
    regression = logistic_regression(maxIter=200, tol=1e-8)
    stages = [encoding.assemble(["toxic"], "selectedFeatures"), regression]
    return tune(
        Pipeline(stages=stages),
        labels,
        logistic_grid(regression, *grid),
        parallelism=4,
        keys=["doc_id"],
        weigh=lambda part: balance.weigh_classes(part, "target", 0, 1),
    )


@query(
    "MDL3 MDL4 MDL5",
    tuned_sql("[0.01, 0.1, 0.5]", "[0.0, 0.5, 1.0]", "[true, false]")
    + """
    SELECT candidate::INTEGER AS candidate,
           format('elasticNetParam={}, fitIntercept={}, regParam={}', mix, CASE WHEN icept THEN 'True' ELSE 'False' END, reg) AS params,
           round(metric, 9) AS metric, true AS optimal
    FROM r""",
)
def tune_grid(spark, folder):
    return rounded(tuning_report(spark, odds_tuned(spark, folder)), 9, "metric")


@query(
    "MDL4 MDL5 MDL7",
    tuned_sql("[10.0, 0.01]", "[1.0]", "[true]")
    + """,
    b AS (SELECT reg, mix FROM r ORDER BY round(metric, 12) DESC, candidate LIMIT 1)
    SELECT 'elasticNetParam' AS param, mix::DOUBLE::VARCHAR AS value FROM b
    UNION ALL SELECT 'fitIntercept', 'True'
    UNION ALL SELECT 'regParam', reg::DOUBLE::VARCHAR FROM b""",
)
def best_params(spark, folder):
    """The whole pipeline tuned, among candidates one of which leaves no feature."""
    return best_parameters(spark, odds_tuned(spark, folder, (10.0, 0.01), (1.0,), (True,)))


@query("MDL2 FEA5 FEA8 MDL7 MDL8")
def rf_score(spark, folder):
    table = embedding_vectors(spark, folder)
    train, test = sampling.hash_split(table, ["vec_id"])
    model = fit_forest(train, labels_from=table)
    return score(model, test, ["vec_id", "label", "prediction", "predictedLabel"])


@query(
    "MDL2 FEA1 FEA5 FEA8 MDL7 MDL8",
    """WITH n AS (SELECT l_linenumber, l_returnflag, count(*) AS rows FROM lineitem GROUP BY ALL)
       SELECT l_linenumber, arg_max(l_returnflag, rows) AS "predictedLabel", sum(rows)::BIGINT AS rows
       FROM n GROUP BY 1""",
)
def rf_majority(spark, folder):
    """One whole tree on one categorical feature predicts the majority label of each value."""
    lines = read_table(spark, folder, "lineitem").select("l_linenumber", "l_returnflag")
    table = encoding.assemble(["l_linenumber"]).transform(lines)
    model = fit_forest(table, "l_returnflag", trees=1, bootstrap=False, maxDepth=10)
    scored = score(model, table, ["l_linenumber", "predictedLabel"])
    return scored.groupBy("l_linenumber", "predictedLabel").agg(F.count("*").alias("rows"))


@query("MDL6")
def rf_trees(spark, folder):
    return forest_table(spark, fit_forest(embedding_vectors(spark, folder)).stages[2])


@query("MDL6")
def rf_importance(spark, folder):
    return importance_table(spark, fit_forest(embedding_vectors(spark, folder)).stages[2])


@query("MDL2 MDL6 MDL8", "SELECT count(*) AS rows, 0::BIGINT AS other_votes, 0::BIGINT AS other_classes FROM embeddings")
def rf_walk(spark, folder):
    """Votes and classes by joins of rows with the node table, against the model's own."""
    table = embedding_vectors(spark, folder)
    fitted = fit_forest(table)
    model = fitted.stages[2]
    scored = score(fitted, table, ["vec_id", "indexedFeatures", "rawPrediction", "prediction"])
    votes = walk(node_table(spark, model), scored, ["vec_id"], model, "indexedFeatures")
    both = scored.select("vec_id", vector_to_array("rawPrediction").alias("raw"), "prediction").join(votes, "vec_id")
    apart = F.exists(F.zip_with("raw", "votes", lambda a, b: F.abs(a - b) > 1e-9), lambda far: far)
    # On a tie the order of the sum decides in the model.
    clear = F.abs(F.get("raw", predicted().cast("int")) - F.array_max("raw")) > 1e-9
    return both.agg(
        F.count("*").alias("rows"), F.count_if(apart).alias("other_votes"), F.count_if(clear).alias("other_classes")
    )


def known_tree_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two yes or no features and a label; the tree that parts them best is a matter of counting."""
    lines = read_table(spark, folder, "lineitem").select(
        (F.col("l_quantity") > 25).cast("double").alias("large"),
        (F.col("l_linenumber") > 1).cast("double").alias("later"),
    )
    target = F.when(F.col("large") == 1, F.col("later")).otherwise(0.0).alias("target")
    return encoding.assemble(["large", "later"], "features").transform(lines.select("*", target))


def known_forest(spark: SparkSession, folder: str):
    forest = random_forest("features", "target", trees=1, bootstrap=False, maxDepth=2)
    return forest.fit(known_tree_table(spark, folder))


# The label is 1 where both features are: the better first cut is counted, the second one is pure.
KNOWN_TREE_SQL = """
    WITH t AS (SELECT (l_quantity > 25)::INTEGER AS large, (l_linenumber > 1)::INTEGER AS later FROM lineitem),
    n AS (SELECT count(*)::DOUBLE AS rows, sum(large)::DOUBLE AS large, sum(later)::DOUBLE AS later,
                 sum(large * later)::DOUBLE AS ones FROM t),
    cuts AS (
        SELECT slot, rows, ones, yes, ones / yes AS share, 2 * (ones / rows) * (1 - ones / rows) AS whole,
               2 * (ones / yes) * (1 - ones / yes) AS part
        FROM (SELECT 0 AS slot, rows, ones, large AS yes FROM n UNION ALL SELECT 1, rows, ones, later FROM n)),
    gains AS (SELECT *, whole - yes / rows * part AS gain FROM cuts),
    first AS (SELECT * FROM gains ORDER BY gain DESC, slot LIMIT 1)"""


@query(
    "MDL2 MDL6",
    f"""{KNOWN_TREE_SQL}
        SELECT 0 AS node, slot, 0.5 AS threshold, 1 AS left, 2 AS right, (ones > rows - ones)::INTEGER::DOUBLE AS prediction,
               round(whole, 6) AS impurity, round(gain, 6) AS gain, rows - ones AS zeros, ones FROM first
        UNION ALL SELECT 1, NULL, NULL, NULL, NULL, 0, 0, NULL, rows - yes, 0 FROM first
        UNION ALL SELECT 2, 1 - slot, 0.5, 3, 4, (ones > yes - ones)::INTEGER::DOUBLE, round(part, 6), round(part, 6),
                         yes - ones, ones FROM first
        UNION ALL SELECT 3, NULL, NULL, NULL, NULL, 0, 0, NULL, yes - ones, 0 FROM first
        UNION ALL SELECT 4, NULL, NULL, NULL, NULL, 1, 0, NULL, 0, ones FROM first""",
)
def tree_nodes(spark, folder):
    """Node table of a tree whose cuts, impurities, gains and counts are known."""
    nodes = node_table(spark, known_forest(spark, folder))
    zeros, ones = (F.get("stats", F.lit(i)).alias(name) for i, name in enumerate(("zeros", "ones")))
    kept = nodes.select("node", "slot", "threshold", "left", "right", "prediction", "impurity", "gain", zeros, ones)
    return rounded(kept, 6, "impurity", "gain")


@query(
    "MDL6",
    f"""{KNOWN_TREE_SQL}
        SELECT slot, round(gain / (gain + yes / rows * part), 6) AS importance FROM first
        UNION ALL SELECT 1 - slot, round(yes / rows * part / (gain + yes / rows * part), 6) FROM first""",
)
def tree_importance(spark, folder):
    """Importances from the node table of the known tree."""
    return rounded(importances(node_table(spark, known_forest(spark, folder))), 6, "importance")


@query("AGG10 MDL2")
def rf_accuracy(spark, folder):
    table = embedding_vectors(spark, folder)
    train, test = sampling.hash_split(table, ["vec_id"])
    scored = score(fit_forest(train, labels_from=table), test)
    return metrics.multiclass_accuracy(scored, "indexedLabel", "prediction")


@query("SNK7 SRC9", "SELECT count(*) AS rows, 0::BIGINT AS mismatches FROM embeddings")
def model_roundtrip(spark, folder):
    table = embedding_vectors(spark, folder)
    model = fit_forest(table)
    path = work_path(spark, "model")
    save_model(model, path)
    first = score(model, table, ["label", "features", F.col("predictedLabel").alias("first")])
    both = score(load_model(path), first, ["first", "predictedLabel"])
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("first") != F.col("predictedLabel")).alias("mismatches"),
    )


def rule_model(rule: str) -> PipelineModel:
    """Pipeline with a fixed rule in place of a learned stage."""
    statement = f"SELECT *, CASE WHEN {rule} THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


@query(
    "MDL9 MDL8 FLT1 PRJ1 SNK1 SNK2",
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'F'",
)
def positive_order_ids(spark, folder):
    model = rule_model("o_totalprice > 300000 AND o_orderstatus = 'F'")
    path = work_path(spark, "positive")
    write_positive_ids(model, read_table(spark, folder, "orders"), "o_orderkey", path, num_files=1)
    return read_csv(spark, path, "o_orderkey bigint", header=False)


def learned_model(spark: SparkSession, folder: str) -> PipelineModel:
    """The regression whose answer is known, fitted, saved and loaded again."""
    labels = read_table(spark, folder, "labels").withColumnRenamed("quality", "target")
    stages = [encoding.assemble(["toxic"], "selectedFeatures"), logistic_regression(**ODDS)]
    path = work_path(spark, "learned")
    save_model(Pipeline(stages=stages).fit(labels), path)
    return load_model(path)


LEARNED_SQL = f"""{ODDS_SQL},
    p AS (SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN tp > fp ELSE fn > tn END AS good FROM labels, c)"""


@query("MDL9 MDL1 MDL8 SNK7 SRC9 FLT1 PRJ1 SNK1", f"{LEARNED_SQL} SELECT doc_id FROM p WHERE good")
def learned_ids(spark, folder):
    """Keys that a learned, saved and loaded model predicts as positive, as text files."""
    model, path = learned_model(spark, folder), work_path(spark, "positive")
    write_positive_ids(model, read_table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id", path)
    return read_csv(spark, path, "doc_id bigint", header=False)


@query(
    "SNK7 SRC9 MDL6",
    f"""{ODDS_SQL},
        w AS (SELECT 1 AS version, 1 AS sign UNION ALL SELECT 2, -1)
        SELECT version, -1 AS slot, round(sign * ln(fn / tn), 3) + 0.0 AS coefficient FROM c, w
        UNION ALL SELECT version, 0, round(sign * ln((tp * tn) / (fp * fn)), 3) + 0.0 FROM c, w""",
)
def model_versions(spark, folder):
    """Two published versions, the second with labels exchanged, loaded by number: both answers are known."""
    versions = ModelVersions(spark, work_path(spark, "versions"))
    table = odds_table(spark, folder)
    for labelled in (table, table.withColumn("target", 1 - F.col("target"))):
        versions.publish(PipelineModel(stages=[logistic_regression(**ODDS).fit(labelled)]))
    tables = [
        coefficient_table(spark, versions.load(number).stages[-1]).select(F.lit(number).alias("version"), "*")
        for number in versions.numbers()
    ]
    return rounded(tables[0].unionByName(tables[1]), 3, "coefficient")


def label_stream(spark: SparkSession, folder: str) -> DataFrame:
    labels = read_table_stream(spark, folder, "labels")
    return labels.select(join_fields("doc_id", "toxic").alias("value"))


LABEL_SCHEMA = record("doc_id bigint, toxic int")
LEARNED_LINES_SQL = f"{LEARNED_SQL} SELECT doc_id || ',' || CASE WHEN good THEN '1.0' ELSE '0.0' END AS value FROM p"


@query("STR1 STR4 STR5 MDL8 SNK7 SRC9", LEARNED_LINES_SQL)
def stream_learned(spark, folder):
    """Lines of a stream through a learned, saved and loaded model."""
    lines = score_keys(label_stream(spark, folder), learned_model(spark, folder), LABEL_SCHEMA, "doc_id")
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "progress")
    wait(start_stream(lines, checkpoint, "parquet", {"path": out}, every=None))
    return spark.read.parquet(out)


@query(
    "SNK4 STR3 STR6 MDL8",
    f"""{LEARNED_SQL} SELECT doc_id || ',' || CASE WHEN good THEN '1.0' ELSE '0.0' END AS value, 1::BIGINT AS copies FROM p""",
)
def stream_once(spark, folder):
    """A learned model's messages, sent once although the first try of the batch failed between sending and commit."""
    model = learned_model(spark, folder)
    out, log, checkpoint = (work_path(spark, name) for name in ("messages", "sent", "progress"))
    sender = SendOnce(spark, lambda b: score_keys(b, model, LABEL_SCHEMA, "doc_id"), out, log)

    def failing(batch: DataFrame, batch_id: int) -> None:
        sender.send(batch, batch_id)
        raise RuntimeError("lost between sending and commit")

    lines = label_stream(spark, folder)
    with suppress(StreamingQueryException):
        wait(start_batches(lines, failing, checkpoint, every=None))
    wait(start_batches(lines, sender, checkpoint, every=None))
    again = read_table(spark, folder, "labels").select(join_fields("doc_id", "toxic").alias("value"))
    sender(again, 0)  # a committed batch is not sent again
    return read_once(spark, out).groupBy("value").agg(F.count("*").alias("copies"))


@query("GEN2 FEA1 FEA2 FEA3 FEA4 FEA6 FEA7 FEA9 MDL1 MDL7 MDL8 AGG8 AGG9 AGG11")
def churn_flow(spark, folder):
    """Flagship: from the raw tables to the quality of the model on rows it has not seen."""
    orders = order_targets(spark, folder)
    customers = read_table(spark, folder, "customer")
    table = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        "target",
        "o_totalprice",
        "c_acctbal",
        (F.col("o_totalprice") - F.col("c_acctbal")).alias("p_difference"),
        F.month("o_orderdate").cast("double").alias("o_month"),
        F.col("c_nationkey").cast("double").alias("c_nationkey"),
        "o_orderpriority",
        "c_mktsegment",
    )
    flow = ChurnFlow(
        numeric=["c_acctbal", "c_nationkey", "o_month", "o_totalprice", "p_difference"],
        categorical=["o_orderpriority", "c_mktsegment"],
        keys=["o_orderkey"],
        minority=0,
        handle_invalid="keep",
        regression=LIGHT,
    )
    train, test = flow.split(table)
    scored = score(flow.fit(train), test, ["target", "rawPrediction", "prediction"])
    with held(scored) as table:
        auc_value = metrics.area_under_roc(table, "target", "rawPrediction")
        quality = metrics.prediction_quality(metrics.confusion_matrix(table)).first()
    schema = (
        "tp bigint, fp bigint, fn bigint, tn bigint, "
        "accuracy double, precision double, recall double, auc double"
    )
    return dim_table(spark, [(*quality, auc_value)], schema)


# Streams ------------------------------------------------------------------------------

EVENT_RULE = "value > 50 AND event_type = 'purchase'"
STREAM_SQL = """
    SELECT event_id || ',' || CASE WHEN value > 50 AND event_type = 'purchase'
                                   THEN '1.0' ELSE '0.0' END AS value
    FROM events"""


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table_stream(spark, folder, "events")
    return events.select(join_fields("event_id", "event_type", "value", "user_id").alias("value"))


@query("STR1 STR4 STR5 STR7", STREAM_SQL)
def stream_score(spark, folder):
    lines = score_keys(event_stream(spark, folder), rule_model(EVENT_RULE), EVENT_SCHEMA, "event_id")
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "progress")
    wait(start_stream(lines, checkpoint, "parquet", {"path": out}, every=None))
    return spark.read.parquet(out)


@query("STR3 FLT3", STREAM_SQL)
def stream_batches(spark, folder):
    model = rule_model(EVENT_RULE)
    out, checkpoint = work_path(spark, "batches"), work_path(spark, "progress")
    handler = score_batches(lambda b: score_keys(b, model, EVENT_SCHEMA, "event_id"), out)
    wait(start_batches(event_stream(spark, folder), handler, checkpoint, every=None))
    return spark.read.parquet(out).select("value")


@query(
    "SRC8 JOI3 SNK4 UDF3 STR3 STR6",
    """WITH n AS (SELECT unnest(['click', 'purchase']) AS event_type, unnest(['a click', 'a purchase']) AS kind)
       SELECT event_id || ',' || CASE WHEN value > 50 AND event_type = 'purchase' THEN '1.0' ELSE '0.0' END
              || ',' || kind AS value
       FROM events JOIN n USING (event_type)""",
)
def stream_messages(spark, folder):
    """Messages of bytes, scored and joined with a table in micro-batches at a fixed pace, sent as messages."""
    events = read_table_stream(spark, folder, "events")
    line = join_fields("event_id", "event_type", "value", "user_id")
    messages = text_values(events.select(line.cast("binary").alias("value")))
    kinds = dim_table(spark, [("click", "a click"), ("purchase", "a purchase")], "name string, kind string")
    model = rule_model(EVENT_RULE)

    def scorer(batch: DataFrame) -> DataFrame:
        scored = score(model, parse_csv_line(batch, "value", EVENT_SCHEMA))
        named = joins.join_dimension(scored, kinds, "event_type", "name")
        return named.select(join_fields("event_id", "prediction", "kind").alias("value"))

    out, checkpoint = work_path(spark, "messages"), work_path(spark, "progress")
    running = start_batches(messages, send_batches(scorer, {"path": out}, "text"), checkpoint, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.text(out)


@query(
    "STR3 SCL6",
    f"""{JUDGED_SQL}
    SELECT 'good' AS part, NULL AS problem, event_id || ',' || CASE WHEN value > 50 AND event_type = 'purchase'
                                                THEN '1.0' ELSE '0.0' END AS value
    FROM judged WHERE problem IS NULL
    UNION ALL SELECT 'bad', problem, line FROM judged WHERE problem IS NOT NULL""",
)
def stream_broken_lines(spark, folder):
    """Broken lines go to a place of their own, and the stream goes on."""
    stream = lines_of(read_table_stream(spark, folder, "events"), True).select(F.col("line").alias("value"))
    good, bad, checkpoint = (work_path(spark, name) for name in ("good", "bad", "progress"))
    model = rule_model(EVENT_RULE)
    handler = set_broken_aside(
        score_batches(lambda b: score_keys(b, model, EVENT_SCHEMA, "event_id"), good),
        score_batches(lambda b: b, bad),
        EVENT_SCHEMA,
    )
    wait(start_batches(stream, handler, checkpoint, every=None))
    scored = spark.read.parquet(good).select(F.lit("good").alias("part"), F.lit(None).cast("string").alias("problem"), "value")
    broken = spark.read.parquet(bad).select(F.lit("bad").alias("part"), F.col("_problem").alias("problem"), "value")
    return scored.unionByName(broken)


@query(
    "STR2 JOI2 SCL10",
    """SELECT count(*) AS batch_rows, count(*) AS stream_rows, 0::BIGINT AS only_batch,
              0::BIGINT AS only_stream FROM embeddings""",
)
def stream_labels(spark, folder):
    """A forest behind a stream of text lines, joined with the label names, against the batch job."""
    names = [f"e{i:02d}" for i in range(EMBEDDING_WIDTH)]
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in names])
    model = fit_forest(embedding_vectors(spark, folder))
    dim = dim_table(spark, [(i, f"class {i}") for i in range(10)], "class_id int, class_name string")
    line = F.concat_ws(",", F.col("embedding").cast("array<double>").cast("array<string>"))

    table = read_table(spark, folder, "embeddings")
    stream = read_table_stream(spark, folder, "embeddings")

    def lines(df: DataFrame) -> DataFrame:
        text = df.select(line.alias("value"))
        return score_labels(text, model, schema, dim, "class_id", "class_name")

    out, checkpoint = work_path(spark, "labels"), work_path(spark, "progress")
    wait(start_stream(lines(stream), checkpoint, "parquet", {"path": out}, every=None))
    counts = [
        df.groupBy("value").agg(F.count("*").alias(name))
        for df, name in ((lines(table), "batch"), (spark.read.parquet(out), "stream"))
    ]
    both = counts[0].join(counts[1], "value", "full").fillna(0)
    return both.agg(
        F.sum("batch").alias("batch_rows"),
        F.sum("stream").alias("stream_rows"),
        F.sum(F.greatest(F.col("batch") - F.col("stream"), F.lit(0))).alias("only_batch"),
        F.sum(F.greatest(F.col("stream") - F.col("batch"), F.lit(0))).alias("only_stream"),
    )


SOUND_SCHEMA = record("large double, later double")


@query(
    "STR2 JOI2 SCL6 MDL2",
    """WITH t AS (SELECT l_orderkey % 10 AS turn, (l_quantity > 25)::INTEGER AS large,
                         (l_linenumber > 1)::INTEGER AS later FROM lineitem),
       o AS (SELECT CASE turn WHEN 3 THEN large::VARCHAR WHEN 5 THEN large || ',n/a'
                    ELSE large || '.0,' || later || '.0,' || CASE WHEN large * later = 1 THEN '1.0,both' ELSE '0.0,not both' END
                    END AS value,
                    CASE turn WHEN 3 THEN 'expected 2 fields, found 1' WHEN 5 THEN 'later is not double' END AS problem
             FROM t)
       SELECT value, problem, count(*) AS rows FROM o GROUP BY ALL""",
)
def stream_sound_labels(spark, folder):
    """A continuous stream with broken lines through a learned tree whose answers are known, in one append."""
    model = fit_forest(known_tree_table(spark, folder), "target", trees=1, bootstrap=False)
    names = dim_table(spark, [(0, "not both"), (1, "both")], "class_id int, class_name string")
    large, later = ((F.col(c) > n).cast("int") for c, n in (("l_quantity", 25), ("l_linenumber", 1)))
    turn = F.col("l_orderkey") % 10
    line = (
        F.when(turn == 3, large.cast("string"))
        .when(turn == 5, F.concat_ws(",", large, F.lit("n/a")))
        .otherwise(F.concat_ws(",", large, later))
    )
    lines = read_table_stream(spark, folder, "lineitem").select(line.alias("value"))
    scored = score_sound_labels(lines, model, SOUND_SCHEMA, names, "class_id", "class_name")
    out, checkpoint = work_path(spark, "sound"), work_path(spark, "progress")
    wait(start_stream(scored, checkpoint, "parquet", {"path": out}, every=None))
    return spark.read.parquet(out).groupBy("value", "problem").agg(F.count("*").alias("rows"))
