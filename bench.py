"""Times of the headline queries: one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median
counts. Results go to a sink that discards them, so every row is computed
and none is collected.
"""

import json
import os
import statistics
import time

from featureflow.plans.catalogue import CATALOGUE
from featureflow.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "class_balance",
    "class_ratio",
    "oversample_counts",
    "oversample_rows",
    "numeric_summary",
    "numeric_summary_approx",
    "column_profile",
    "corr_pairs",
    "corr_matrix",
    "hash_split",
    "parse_permissive",
    "parse_strict",
    "multi_index",
    "one_hot",
    "indexed_orders",
    "min_max_scaled",
    "anova",
    "selected_features",
    "selected_by_score",
    "confusion",
    "prediction_quality",
    "auc",
    "multiclass_accuracy",
    "dim_join",
    "lr_score",
    "tune_grid",
    "tune_flow",
    "rf_score",
    "model_roundtrip",
    "positive_order_ids",
    "churn_flow",
    "stream_score",
    "stream_batches",
]


def seconds(spark, build) -> float:
    start = time.perf_counter()
    build(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session("featureflow-bench", CPUS)
    queries = {}
    for name in HEADLINE:
        build = CATALOGUE[name].build
        seconds(spark, build)
        queries[name] = round(statistics.median(seconds(spark, build) for _ in range(RUNS)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
