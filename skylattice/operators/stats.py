"""Correlation and feature selection by correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F


def label_correlation(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """``column_name, correlation`` with the label, all columns in one pass.

    A constant column has no correlation and gives null.
    """
    columns = list(columns)
    y = F.col(label).cast("double")

    def pearson(x: Column) -> Column:
        # corr() itself divides by zero for a constant column
        spread = F.stddev_pop(F.when(x.isNotNull(), y)) * F.stddev_pop(F.when(y.isNotNull(), x))
        return F.try_divide(F.covar_pop(y, x), spread)

    wide = df.agg(
        *[pearson(F.col(c).cast("double")).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"r{i}").alias("correlation"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_a, column_b, correlation`` for every ordered pair of columns.

    Rows with a null in any of the columns are left out. The matrix has one
    entry per pair of columns, whatever the number of rows; undefined entries
    are null.
    """
    columns = list(columns)
    vectors = VectorAssembler(
        inputCols=columns, outputCol="__features", handleInvalid="skip"
    ).transform(df.select(*columns))
    matrix = Correlation.corr(vectors, "__features").first()[0].toArray()
    rows = [
        (a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_a string, column_b string, correlation double"
    )


def correlated_pairs(matrix: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Pairs of different columns correlated above ``threshold``, either sign."""
    return matrix.filter(
        (F.col("column_a") < F.col("column_b")) & (F.abs("correlation") > threshold)
    )


def collapsible_columns(
    matrix: DataFrame, threshold: float = 0.95, prefixes: Sequence[str] = ("Max", "Min")
) -> list[str]:
    """Correlated columns named as an extreme, leaving the average to stand for them."""
    pairs = correlated_pairs(matrix, threshold)
    names = pairs.select(F.col("column_a").alias("c")).union(pairs.select("column_b")).distinct()
    return sorted(r["c"] for r in names.collect() if r["c"].startswith(tuple(prefixes)))


def weak_columns(
    correlations: DataFrame, threshold: float = 0.01, keep: Sequence[str] = ()
) -> list[str]:
    """Columns correlated less than ``threshold``; undefined counts as 0."""
    weak = correlations.filter(F.abs(F.coalesce("correlation", F.lit(0.0))) < threshold)
    return sorted(r["column_name"] for r in weak.collect() if r["column_name"] not in keep)
