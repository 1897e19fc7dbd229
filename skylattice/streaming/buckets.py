"""Bucket statistics and bucket join over streams, in append mode.

Both agree with their batch twins in ``operators.joins`` on all rows that are not
late. A bucket holds the readings after its start and up to its end, both
included there; the window is therefore put on the instant a microsecond
earlier, which turns ``(start, end]`` into the ``[start, end)`` of a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skylattice.functions.casting import text_to
from skylattice.functions.temporal import bucket_floor, shifted
from skylattice.operators.joins import TIME_KEY

#: The event time that a stream carries from operator to operator.
EVENT_TIME = "__event_time"


def _before(ts: Column) -> Column:
    """The instant a microsecond earlier."""
    return F.timestamp_micros(F.unix_micros(ts) - F.lit(1))


def stream_bucket_statistics(
    readings: DataFrame,
    entity: str,
    time: str,
    measures: Sequence[str],
    width: int,
    delay: str,
    offset: int = 0,
) -> DataFrame:
    """``Max_``, ``Min_``, ``Avg_`` and ``N_`` of every measure per entity and bucket, when it is complete.

    A bucket is given once, as soon as no reading at most ``delay`` behind the
    newest can fall into it; readings that come later are dropped and counted by
    the query (see ``run.late_rows``). Readings without entity or time are left
    out. State is one row per entity and open bucket.
    """
    types, nothing = dict(readings.dtypes), F.lit(None).cast("double")
    stats: list[Column] = []
    for m in measures:
        number = F.nanvl(text_to(m, "double"), nothing) if types[m] == "string" else F.col(m).cast("double")
        stats += [
            F.max(number).alias(f"Max_{m}"),
            F.min(number).alias(f"Min_{m}"),
            F.avg(number).alias(f"Avg_{m}"),
            F.count(number).alias(f"N_{m}"),
        ]
    timed = (
        readings.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
        .select(entity, *measures, _before(F.col(time)).alias(EVENT_TIME))
        .withWatermark(EVENT_TIME, delay)
    )
    window = F.window(EVENT_TIME, f"{width} seconds", startTime=f"{offset} seconds")
    grouped = timed.groupBy(entity, window.alias("__window")).agg(*stats)
    return grouped.select(
        entity,
        F.window_time("__window").alias(EVENT_TIME),
        F.col("__window.end").alias(TIME_KEY),
        *[c for c in grouped.columns if c not in (entity, "__window")],
    )


def stream_bucket_join(
    left: DataFrame,
    per_bucket: DataFrame,
    entity: str,
    time: str,
    width: int,
    lead: int,
    delay: str,
    offset: int = 0,
) -> DataFrame:
    """Left join of a stream to the buckets of ``stream_bucket_statistics``.

    The bucket of a row is the one that ends at or before ``time - lead``. A row is
    given once, with its bucket when that is complete, else with nulls when no
    reading can fall into it any more. Rows more than ``delay`` behind the newest row of ``left``,
    counted in buckets, are dropped and counted. Rows without entity or time get
    nulls at once. State is the rows and buckets that still wait for each other.
    """
    key = bucket_floor(shifted(F.col(time), -lead), width, offset)
    has_key = F.col(entity).isNotNull() & F.col(time).isNotNull()
    added = [c for c in per_bucket.columns if c not in (entity, TIME_KEY, EVENT_TIME)]
    buckets = per_bucket.select(
        F.col(entity).alias("__entity"), F.col(EVENT_TIME).alias("__bucket_time"), *added
    )
    timed = (
        left.where(has_key)
        .withColumn(TIME_KEY, key)
        .withColumn(EVENT_TIME, _before(F.col(TIME_KEY)))
        .withWatermark(EVENT_TIME, delay)
    )
    joined = timed.join(
        buckets,
        (F.col(entity) == F.col("__entity")) & (F.col(EVENT_TIME) == F.col("__bucket_time")),
        "left_outer",
    )
    types = dict(per_bucket.dtypes)
    without = left.where(~has_key).select(
        *left.columns, key.alias(TIME_KEY), *[F.lit(None).cast(types[c]).alias(c) for c in added]
    )
    return joined.select(*left.columns, TIME_KEY, *added).unionByName(without)
