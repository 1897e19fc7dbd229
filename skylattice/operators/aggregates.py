"""Group counts and sums, label balance, histograms and top-k."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def group_count(df: DataFrame, *keys: str | Column, out: str = "n_rows") -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_sum(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` per key combination."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def value_counts(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Rows per value in the order of the values; nulls are left out."""
    return (
        df.select(key.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(name)
    )


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """``n_rows, n_keys``: how many keys occur how often."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_keys"))


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Total, positive and negative rows of a 0/1 label and their percentages."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    return counts.select(
        "*",
        F.try_divide(F.col("positives") * 100, "total").alias("positive_pct"),
        F.try_divide(F.col("negatives") * 100, "total").alias("negative_pct"),
    )


def column_range(df: DataFrame, *columns: str) -> DataFrame:
    """``<c>_min, <c>_max, <c>_n`` of the columns, in one row."""
    stats = []
    for c in columns:
        stats += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.count(c).alias(f"{c}_n"),
        ]
    return df.agg(*stats)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bin, lower, upper, n_rows`` of equal-width bins, empty bins included.

    The last bin holds its upper end. Null and NaN values are left out. When
    all values are equal the bins span half a unit to either side.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, lower double, upper double, n_rows bigint"
        )
    lo, hi = ends["lo"], ends["hi"]
    if math.isinf(lo) or math.isinf(hi):
        raise ValueError(f"column {column} holds infinite values")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    counts = values.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("upper"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_rows")
    )


def top_k(df: DataFrame, k: int, by: str, *tie: str) -> DataFrame:
    """The ``k`` rows with the greatest ``by``, equal ones in the order of ``tie``."""
    return df.orderBy(F.desc(by), *tie).limit(k)
