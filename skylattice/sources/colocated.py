"""Tables stored by the buckets of a key, which join on it without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_colocated(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Store ``df`` as the catalog table ``name``, dealt to ``buckets`` by ``keys`` and sorted inside.

    One file per bucket: rows are dealt to the buckets' tasks first. Tables that
    are to be joined need the same number of buckets and keys of one type. Take as many
    buckets as give files of 128 to 512 MB. An existing table is replaced.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*(sort_by or keys)).saveAsTable(name)


def read_colocated(spark: SparkSession, name: str) -> DataFrame:
    """A stored table; its buckets and their order are known to the planner."""
    return spark.read.table(name)


def colocated_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on the bucket keys, by merging the sorted buckets as they are stored."""
    return left.hint("merge").join(right.hint("merge"), list(keys), how)
