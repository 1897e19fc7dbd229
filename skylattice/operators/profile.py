"""Table and column profiles. Every profile is one aggregation over the data."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from skylattice.operators.ranks import exact_quantiles


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, whatever their width."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def _long_form(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn the one row of an aggregate into one row per struct of ``rows``."""
    return wide.select(F.inline(F.array(*rows)))


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows, n_columns`` of several tables."""
    result = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        result = one if result is None else result.unionByName(one)
    return result


def estimated_bytes(df: DataFrame) -> int:
    """Size Spark's optimizer expects for ``df``, from ``EXPLAIN COST``."""
    view = f"sized_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        plan = df.sparkSession.sql(f"EXPLAIN COST SELECT * FROM {view}").first()[0]
    finally:
        df.sparkSession.catalog.dropTempView(view)
    optimized = plan.split("== Optimized Logical Plan ==")[1]
    number, unit = re.search(r"sizeInBytes=([\d.E+]+) (\w+)", optimized).groups()
    scale = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"].index(unit)
    return int(float(number) * 1024**scale)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``n_files, n_bytes`` of the files below ``path``; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").cast("bigint").alias("n_bytes")
    )


def missing_flag(
    df: DataFrame, column: str, treat_nan: bool = False, sentinels: Sequence[str] | None = None
) -> Column:
    """Whether a value counts as missing.

    NaN counts with ``treat_nan`` in floating columns. With ``sentinels`` an
    empty text or one containing any of them counts in text columns.
    """
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    missing = value.isNull()
    if treat_nan and isinstance(kind, (DoubleType, FloatType)):
        missing = missing | F.isnan(value)
    if sentinels is not None and isinstance(kind, StringType):
        missing = missing | (value == "")
        for text in sentinels:
            missing = missing | value.contains(text)
    return missing


def null_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    treat_nan: bool = False,
    sentinels: Sequence[str] | None = None,
) -> DataFrame:
    """``column_name, data_type, n_missing, missing_pct``, most missing first."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    wide = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[
            F.count_if(missing_flag(df, c, treat_nan, sentinels)).alias(f"__m{i}")
            for i, c in enumerate(columns)
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(f"__m{i}").alias("n_missing"),
            (F.try_divide(f"__m{i}", "__n") * 100).alias("missing_pct"),
        )
        for i, c in enumerate(columns)
    ]
    return _long_form(wide, rows).orderBy(F.desc("missing_pct"), "column_name")


def missing_proportion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, proportion``: missing fraction rounded to two places."""
    return null_profile(df, columns).select(
        "column_name", F.round(F.col("missing_pct") / 100, 2).alias("proportion")
    )


def duplicate_profile(df: DataFrame) -> DataFrame:
    """``metric, value``: total, distinct and duplicate rows, in one pass."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    wide = counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("kinds")
    )
    return _long_form(
        wide,
        [
            F.struct(F.lit(name).alias("metric"), value.alias("value"))
            for name, value in [
                ("Total Row Count", F.col("total")),
                ("Distinct Row Count", F.col("kinds")),
                ("Duplicate Row Count", F.col("total") - F.col("kinds")),
            ]
        ],
    )


def schema_diff(tables: dict[str, DataFrame]) -> DataFrame:
    """``column_name`` and one ``in_<table>`` flag per table."""
    spark = next(iter(tables.values())).sparkSession
    names = sorted({c for df in tables.values() for c in df.columns})
    rows = [(c, *[c in df.columns for df in tables.values()]) for c in names]
    flags = ", ".join(f"in_{t} boolean" for t in tables)
    return spark.createDataFrame(rows, f"column_name string, {flags}")


def column_sources(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``column_name, source``: first table having the column, else ``created``."""
    rows = [
        (c, next((t for t, frame in tables.items() if c in frame.columns), "created"))
        for c in df.columns
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, source string")


def assert_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` itself; raises when a required column is absent."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def first_values(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """``column_name, first_value``: first non-null value of each column as text.

    First means smallest ``order``; all columns are found in one pass.
    """
    columns = list(columns)
    wide = df.agg(
        *[
            F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), F.col(order))).alias(
                f"v{i}"
            )
            for i, c in enumerate(columns)
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("first_value"))
        for i, c in enumerate(columns)
    ]
    return _long_form(wide, rows)


def summary_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n, mean, stddev, min, max``; text has no mean or stddev.

    Minimum and maximum are given as text, since the columns differ in type.
    """
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        number = value.cast("double") if c in numeric else F.lit(None).cast("double")
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.avg(number).alias(f"a{i}"),
            F.stddev(number).alias(f"s{i}"),
            F.min(value).cast("string").alias(f"l{i}"),
            F.max(value).cast("string").alias(f"h{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("n"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"l{i}").alias("min"),
                F.col(f"h{i}").alias("max"),
            )
        )
    return _long_form(df.agg(*aggregates), rows)


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """``column_name, mean, median, stddev`` of all columns in one pass.

    The median is approximate: its rank is off by at most ``1 / accuracy`` of
    the rows. A statistic without a value is 0.
    """
    columns = list(columns or numeric_columns(df))
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        aggregates += [
            F.avg(value).alias(f"a{i}"),
            F.percentile_approx(value, 0.5, accuracy).alias(f"m{i}"),
            F.stddev(value).alias(f"s{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                *[
                    F.coalesce(F.col(f"{letter}{i}"), F.lit(0.0)).alias(name)
                    for letter, name in [("a", "mean"), ("m", "median"), ("s", "stddev")]
                ],
            )
        )
    return _long_form(df.agg(*aggregates), rows)


def iqr_fence(df: DataFrame, column: str, factor: float = 1.5) -> tuple[float, float]:
    """Lower and upper fence of a column from its exact quartiles."""
    quartiles = exact_quantiles(df, column, [0.25, 0.75]).first()
    if quartiles is None:
        raise ValueError(f"column {column} has no values")
    q1, q3 = quartiles["q0"], quartiles["q1"]
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Rows of ``df`` outside the fence of ``column``."""
    low, high = iqr_fence(df, column, factor)
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary of the positive values of every group."""
    positive = df.filter(F.col(group).isNotNull() & (F.col(value) > 0))
    five = exact_quantiles(positive, value, [0.0, 0.25, 0.5, 0.75, 1.0], by=[group])
    names = ["low", "q1", "median", "q3", "high"]
    return five.select(
        group, F.col("n").alias("n"), *[F.col(f"q{i}").alias(x) for i, x in enumerate(names)]
    )
