"""Parquet, CSV and fold readers, and read-through builds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

NOT_BUILT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """All part files below ``path``; with a schema no file is opened to plan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line and a given schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    delimiter: str = ",",
    partitions: int | None = None,
) -> DataFrame:
    """CSV with every column as text; gzip is recognised by the file name.

    A gzip file is read by one task, so ``partitions`` spreads its rows for the
    work that follows. Without ``columns`` the header line names them.
    """
    reader = spark.read.option("header", True).option("delimiter", delimiter)
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def load_or_build(
    spark: SparkSession, path: str, builder: Callable[[], DataFrame], **write_options: str
) -> DataFrame:
    """The table stored at ``path``, built and written first when there is none.

    Only a missing or empty path triggers the build; any other error is raised.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NOT_BUILT:
            raise
    builder().write.options(**write_options).mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    """Folds written by :func:`skylattice.sources.writers.write_folds`."""
    return spark.read.parquet(path)


def read_numbered_folds(spark: SparkSession, path: str) -> DataFrame:
    """Folds kept as directories ``train_<i>_df`` and ``val_<i>_df``.

    The fold number and role become the columns ``fold_id`` and ``role``.
    """
    df = spark.read.parquet(f"{path}/train_*_df", f"{path}/val_*_df")
    name = F.col("_metadata.file_path")
    pattern = r"/(train|val)_(\d+)_df/[^/]*$"
    return df.select(
        "*",
        F.regexp_extract(name, pattern, 2).cast("int").alias("fold_id"),
        F.regexp_extract(name, pattern, 1).alias("role"),
    )


def fold_ids(folds: DataFrame) -> list[int]:
    """The fold numbers present, in order."""
    rows = folds.select("fold_id").distinct().orderBy("fold_id").collect()
    return [r["fold_id"] for r in rows]


def fold_part(folds: DataFrame, fold_id: int, role: str) -> DataFrame:
    """Training or validation rows of one fold (prunes partitions on disk)."""
    part = folds.filter((F.col("fold_id") == fold_id) & (F.col("role") == role))
    return part.drop("fold_id", "role")
