"""Batch file writers (SNK1, SNK2, PAR1)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool = False,
    num_files: int | None = None,
) -> None:
    """Delimited text, without header by default.

    ``num_files`` repartitions before the write. It is a shuffle of the output
    rows; ``coalesce`` would save it but pull the whole upstream computation
    into as few tasks. Left unset, each task writes its own file.
    """
    if num_files is not None:
        df = df.repartition(num_files)
    df.write.mode(mode).option("header", header).csv(path)


def write_libsvm(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("label", "features").write.mode(mode).format("libsvm").save(path)
