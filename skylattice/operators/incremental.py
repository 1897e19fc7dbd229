"""Bucket statistics that are stored in mergeable form and brought up to date by batches.

A stored row has count, sum, least and largest value of every measure of one
entity and bucket, and the columns of its latest reading. Two rows of a bucket
merge into one, so a new batch of readings, late ones included, changes only the
days it has readings of; their directories are replaced, the others not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylattice.functions.casting import text_to
from skylattice.functions.temporal import bucket_ceil
from skylattice.operators.joins import TIME_KEY, latest_per_bucket
from skylattice.operators.windows import dedupe_latest
from skylattice.session import broadcast_if_small, materialize
from skylattice.sources.writers import write_partitioned

#: Directory of a bucket: the day, in UTC, of its end.
DAY = "bucket_day"
#: The last batch that a directory has taken in.
BATCH = "last_batch"


def _parts(measures: Sequence[str]) -> list[tuple[str, str]]:
    return [(part, m) for m in measures for part in ("N", "Sum", "Min", "Max")]


def partial_statistics(
    readings: DataFrame,
    entity: str,
    time: str,
    measures: Sequence[str],
    width: int,
    offset: int = 0,
    latest: Sequence[str] = (),
) -> DataFrame:
    """``N_``, ``Sum_``, ``Min_`` and ``Max_`` of every measure, ``time`` and ``latest`` of the latest reading.

    One row per entity and bucket of the readings. Measures may be text; what is
    no number does not count. Readings without entity or time are left out.
    """
    types, nothing = dict(readings.dtypes), F.lit(None).cast("double")

    def number(m: str) -> Column:
        return F.nanvl(text_to(m, "double") if types[m] == "string" else F.col(m).cast("double"), nothing)

    named = {"N": F.count, "Sum": F.sum, "Min": F.min, "Max": F.max}
    timed = readings.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
    grouped = (
        timed.withColumn(TIME_KEY, bucket_ceil(F.col(time), width, offset))
        .groupBy(entity, TIME_KEY)
        .agg(*[named[part](number(m)).alias(f"{part}_{m}") for part, m in _parts(measures)])
    )
    renamed = timed.select(entity, time, *[F.col(c).alias(f"Last_{c}") for c in latest])
    newest = latest_per_bucket(renamed, entity, time, width, offset, [f"Last_{c}" for c in latest])
    return grouped.join(newest, [entity, TIME_KEY])


def merge_statistics(partials: DataFrame, entity: str, time: str, measures: Sequence[str]) -> DataFrame:
    """One row per entity and bucket of any number of ``partial_statistics`` rows."""
    named = {"N": F.sum, "Sum": F.sum, "Min": F.min, "Max": F.max}
    grouped = partials.groupBy(entity, TIME_KEY).agg(
        *[named[part](f"{part}_{m}").alias(f"{part}_{m}") for part, m in _parts(measures)]
    )
    last = [c for c in partials.columns if c.startswith("Last_")]
    newest = dedupe_latest(partials.select(entity, TIME_KEY, time, *last), [entity, TIME_KEY], time)
    return grouped.join(newest, [entity, TIME_KEY])


def upsert_statistics(
    partials: DataFrame, path: str, entity: str, time: str, measures: Sequence[str], batch: int
) -> None:
    """Merge a batch of ``partial_statistics`` rows into the table at ``path``.

    Only the directories of days the batch has buckets in are read and replaced.
    Batches have rising numbers. A directory that has taken in this batch or a later one is left as it is,
    so a batch that broke off between two directories is repeated as a whole;
    this also suits ``foreachBatch`` of a stream. One writer at a time.
    """
    spark = partials.sparkSession
    day = F.date_from_unix_date(F.floor(F.unix_seconds(TIME_KEY) / 86_400).cast("int"))
    new = materialize(partials.withColumn(DAY, day), "batch")
    stored = _stored(spark, path, new)
    if stored is not None:
        days = new.select(DAY).distinct()
        old = stored.join(broadcast_if_small(days), DAY, "left_semi")
        done = materialize(
            old.groupBy(DAY).agg(F.max(BATCH).alias("b")).where(F.col("b") >= batch).select(DAY), "done"
        )
        left_out = broadcast_if_small(done)
        new = new.join(left_out, DAY, "left_anti")
        new = new.unionByName(old.drop(BATCH).join(left_out, DAY, "left_anti"))
    merged = merge_statistics(new.drop(DAY), entity, time, measures)
    # stored first: what is replaced must not be what is read
    ready = materialize(merged.withColumn(DAY, day).withColumn(BATCH, F.lit(batch).cast("long")), "merged")
    write_partitioned(ready, path, [DAY])


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The rows stored at ``path``, with the columns of a batch; None before the first one."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields if f.name != DAY]
    try:
        return spark.read.schema(", ".join([*columns, f"{BATCH} long", f"{DAY} date"])).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def finished_statistics(stored: DataFrame, entity: str, measures: Sequence[str]) -> DataFrame:
    """``Max_``, ``Min_`` and ``Avg_`` of every measure, as ``operators.joins.bucket_statistics`` has them."""
    stats: list[Column] = []
    for m in measures:
        mean = F.try_divide(F.col(f"Sum_{m}"), F.col(f"N_{m}"))
        stats += [F.col(f"Max_{m}"), F.col(f"Min_{m}"), mean.alias(f"Avg_{m}")]
    return stored.select(entity, TIME_KEY, *stats)
