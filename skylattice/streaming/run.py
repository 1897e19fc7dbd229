"""Sources, sinks and runs of streams over files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass
class Run:
    """What a finished run did, batch by batch."""

    batches: int = 0
    rows_read: int = 0
    rows_late: int = 0
    #: rows of state after each batch, summed over the operators
    state_rows: list[int] = field(default_factory=list)
    state_bytes: list[int] = field(default_factory=list)


def read_files(
    spark: SparkSession, path: str, schema, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the Parquet files that are or come to be in a folder, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(df: DataFrame, path: str, checkpoint: str, timeout: int = 3600) -> Run:
    """Work off all files there are, append the rows to ``path`` and stop.

    Started again with the same ``checkpoint``, it goes on with the files that
    have come since; a run that was cut off repeats its last batch, of which the
    sink takes each row once. Raises what made the query fail, and ``TimeoutError``
    if it is not done after ``timeout`` seconds.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"the stream was not done after {timeout} seconds")
        return _told(query.recentProgress)
    finally:
        query.stop()


def _told(progress: Sequence) -> Run:
    run = Run()
    for p in progress:
        states = p["stateOperators"]
        run.batches += 1
        run.rows_read += sum(s["numInputRows"] for s in p["sources"])
        run.rows_late += sum(s["numRowsDroppedByWatermark"] for s in states)
        run.state_rows.append(sum(s["numRowsTotal"] for s in states))
        run.state_bytes.append(sum(s["memoryUsedBytes"] for s in states))
    return run


def write_slices(df: DataFrame, path: str, slice_of: Column, n: int) -> None:
    """Write the rows as one set of files per slice 0 .. n - 1, one after the other.

    For replaying a table as a stream: a file source takes files by their age.
    """
    numbered = df.withColumn("__slice", slice_of)
    for i in range(n):
        part = numbered.where(F.col("__slice") == i).drop("__slice")
        part.write.mode("append").parquet(path)
