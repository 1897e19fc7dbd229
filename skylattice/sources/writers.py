"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write part files; without ``overwrite`` an existing path is an error."""
    df.write.mode("overwrite" if overwrite else "error").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write one directory per value of ``by``, replacing only those written.

    The rebalance hint gathers each directory into few files and splits a
    directory that holds much of the data over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .mode("overwrite")
        .parquet(path)
    )


def write_folds(folds: DataFrame, path: str) -> None:
    """Write all folds at once, one directory per fold and role."""
    (
        folds.hint("rebalance", "fold_id", "role")
        .write.option("partitionOverwriteMode", "static")
        .partitionBy("fold_id", "role")
        .mode("overwrite")
        .parquet(path)
    )


def write_and_count(df: DataFrame, path: str, overwrite: bool = False) -> int:
    """Write and return the number of rows found when reading back."""
    write_parquet(df, path, overwrite)
    return df.sparkSession.read.parquet(path).count()
