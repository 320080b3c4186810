"""Side-by-side run of the catalogue and its SQL: ``python tests/oracle.py [sf] [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _frame(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    nullable = [c for c in pdf if str(pdf[c].dtype).startswith("Int")]
    pdf = pdf.astype({c: "float64" for c in nullable})
    return pdf.sort_values(list(pdf.columns), na_position="last").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """Why two results are not the same rows and columns, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    got, want = _frame(got), _frame(want)
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got if got[c].dtype != want[c].dtype]
    try:
        pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=not kinds)
    except AssertionError as error:
        return str(error)
    return f"types {kinds}" if kinds else None


def main(scale: str, *names: str) -> None:
    from featureflow.plans.catalogue import CATALOGUE
    from featureflow.session import local_session

    folder = f"{TESTDATA}/sf{scale}"
    spark, con = local_session(), connect(folder)
    for name in names or CATALOGUE:
        query, start = CATALOGUE[name], time.time()
        try:
            got = query.build(spark, folder).toPandas()
            problem = f"{len(got)} rows only"
            if query.sql:
                problem = differences(got, con.execute(query.sql).df()) or "ok"
        except Exception as error:  # noqa: BLE001
            problem = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:7.2f} s  {problem}", flush=True)


if __name__ == "__main__":
    main(*(sys.argv[1:] or ["0.01"]))
