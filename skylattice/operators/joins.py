"""Nearest-neighbour, lookup, time-bucket and as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skylattice.functions.casting import text_to
from skylattice.functions.temporal import MICROS, bucket_ceil, bucket_floor, day_of, shifted
from skylattice.operators.windows import dedupe_latest
from skylattice.session import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    left_join_spread,
    lookup_join,
)

TIME_KEY = "time_key"


def nearest_per_key(
    df: DataFrame,
    key: str,
    distance: str,
    keep_ties: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the smallest ``distance`` of every ``key``.

    Ties go to the smallest remaining columns, in their order, so there is one
    row per key; ``keep_ties`` keeps all rows at the minimum instead. ``columns``
    names those wanted, other ones are not read. The minimum is a hash
    aggregation over two columns; only rows at the minimum are compared whole.
    """
    wanted = list(columns or df.columns)
    rows = df.select(*dict.fromkeys([key, distance, *wanted])).filter(
        F.col(distance).isNotNull() & F.col(key).isNotNull()
    )
    lowest = rows.groupBy(F.col(key).alias("__key")).agg(F.min(distance).alias("__lowest"))
    at = (F.col(key) == F.col("__key")) & (F.col(distance) == F.col("__lowest"))
    if keep_ties:
        return rows.join(lowest, at, "left_semi").select(*wanted)
    rest = [c for c in rows.columns if c not in (key, distance)]
    best = (
        rows.join(lowest, at, "left_semi")
        .groupBy(key)
        .agg(F.min(F.struct(distance, *rest)).alias("best"))
    )
    return best.select(key, "best.*").select(*wanted)


def lookup_enrich(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    unique: bool = True,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Left join of a lookup table; every fact row is kept, and appears once.

    A key that the table repeats is an error, unless ``unique`` is off: then its
    rows multiply. The bounds are those of a broadcast; ``stored`` says that the
    table is read from storage as it is.
    """
    keyed = dim.filter(F.col(dim_key).isNotNull()).withColumn("__key", F.col(dim_key))
    joined = lookup_join(
        fact.withColumn("__key", F.col(fact_key)), keyed, ["__key"], max_rows, max_bytes, unique, stored
    )
    return joined.drop("__key")


def role_join(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, prefix: str, **options
) -> DataFrame:
    """Left join of ``dim`` in one role, its columns renamed with ``prefix``.

    Options are those of :func:`lookup_enrich`.
    """
    renamed = dim.select([F.col(c).alias(f"{prefix}{c}") for c in dim.columns])
    return lookup_enrich(fact, renamed, fact_key, f"{prefix}{dim_key}", **options)


def _timed(readings: DataFrame, entity: str, time: str, width: int, offset: int) -> DataFrame:
    """Readings with entity and time, keyed by the first bucket boundary at or after them."""
    return readings.filter(F.col(entity).isNotNull() & F.col(time).isNotNull()).withColumn(
        TIME_KEY, bucket_ceil(F.col(time), width, offset)
    )


def latest_per_bucket(
    readings: DataFrame,
    entity: str,
    time: str,
    width: int,
    offset: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Latest reading of every entity and time bucket, keyed by the bucket end.

    ``columns`` names what is wanted of it, by default everything. Readings at
    the same instant are ordered by these columns.
    """
    rest = list(columns or [c for c in readings.columns if c not in (entity, time)])
    keyed = _timed(readings, entity, time, width, offset).select(entity, TIME_KEY, time, *rest)
    return dedupe_latest(keyed, [entity, TIME_KEY], time)


def bucket_statistics(
    readings: DataFrame,
    entity: str,
    time: str,
    measures: Sequence[str],
    width: int,
    offset: int = 0,
    latest: Sequence[str] | None = None,
) -> DataFrame:
    """``Max_``, ``Min_`` and ``Avg_`` of every measure per entity and bucket.

    Measures may be text; what is no number is left out of the statistics, which
    are one hash aggregation. With ``latest`` the time and these columns of the
    latest reading come along, found apart from it.
    """
    types, nothing = dict(readings.dtypes), F.lit(None).cast("double")
    numbers = {
        m: F.nanvl(text_to(m, "double"), nothing)
        if types[m] == "string"
        else F.col(m).cast("double")
        for m in measures
    }
    stats: list[Column] = []
    for m, number in numbers.items():
        stats += [
            F.max(number).alias(f"Max_{m}"),
            F.min(number).alias(f"Min_{m}"),
            F.avg(number).alias(f"Avg_{m}"),
        ]
    keyed = _timed(readings, entity, time, width, offset)
    if not stats:
        return latest_per_bucket(readings, entity, time, width, offset, latest)
    grouped = keyed.groupBy(entity, TIME_KEY).agg(*stats)
    if latest is None:
        return grouped
    newest = latest_per_bucket(readings, entity, time, width, offset, latest)
    return newest.join(grouped, [entity, TIME_KEY])


def bucket_join(
    left: DataFrame,
    per_bucket: DataFrame,
    entity: str,
    time: str,
    width: int,
    lead: int,
    offset: int = 0,
) -> DataFrame:
    """Left join of one row per (entity, bucket) to rows ``lead`` seconds later.

    The left key is the bucket start at or before ``time - lead`` and the right
    key the bucket end at or after the reading, so a reading is never newer than
    ``time - lead``. Every left row appears once.
    """
    keyed = left.withColumn(
        TIME_KEY, bucket_floor(shifted(F.col(time), -lead), width, offset)
    )
    return left_join_spread(keyed, per_bucket, [entity, TIME_KEY])


def asof_previous(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_time: str,
    right_time: str,
    value: str,
    out: str,
    lead: int,
    left_day: str | None = None,
    right_day: str | None = None,
    max_days: int = 1,
    slice_seconds: int = 60,
) -> DataFrame:
    """Add ``out``: the latest earlier ``value`` of the same keys.

    A right row counts when it is strictly earlier than ``left_time - lead`` and
    its day is at most ``max_days`` from the left day (the days of the times
    unless other columns are named). Every left row appears once; without a
    match ``out`` is null. Of several right rows at one instant the largest
    value is taken.

    No pairs are formed and no key is sorted as a whole: both sides shrink to
    one row per key, day and instant; a first window carries the latest value
    across the time slices of a day (at most ``86400 / slice_seconds`` per right
    day) and puts it in front of each slice, a second one runs inside a slice.
    """
    names = [f"__k{i}" for i in range(len(left_keys))]
    cut = F.unix_micros(F.col(left_time)) - F.lit(lead * MICROS)
    left_date = day_of(left_day or left_time)
    right_date = day_of(right_day or right_time)

    # an earlier time is on no later day, unless the days come from other columns
    days_back = 0 if left_day is None and right_day is None and lead >= 0 else max_days

    def grouped_keys(columns: Sequence[str]) -> list[Column]:
        return [F.col(c).alias(n) for c, n in zip(columns, names)]

    wanted = left.select(*grouped_keys(left_keys), left_date.alias("__day"), cut.alias("__at"))
    value_type = right.schema[value].dataType
    questions = wanted.dropna().select(
        "*",
        F.lit(True).alias("__asked"),
        F.lit(False).alias("__seen"),
        F.lit(None).cast(value_type).alias("__value"),
    )
    answers = (
        right.select(
            *grouped_keys(right_keys),
            right_date.alias("__own_day"),
            F.unix_micros(F.col(right_time)).alias("__at"),
            F.col(value).alias("__value"),
        )
        .dropna(subset=[*names, "__own_day", "__at"])
        .select(
            *names,
            F.explode(
                F.sequence(F.date_sub("__own_day", days_back), F.date_add("__own_day", max_days))
            ).alias("__day"),
            "__at",
            F.lit(False).alias("__asked"),
            F.lit(True).alias("__seen"),
            "__value",
        )
    )
    instants = (
        questions.unionByName(answers)
        .groupBy(*names, "__day", "__at")
        .agg(*[F.max(c).alias(c) for c in ("__asked", "__seen", "__value")])
        .withColumn(
            "__slice", F.col("__at") - F.pmod(F.col("__at"), F.lit(slice_seconds * MICROS))
        )
    )

    across = (
        Window.partitionBy(*names, "__day")
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = (
        Window.partitionBy(*names, "__day", "__slice")
        .orderBy("__at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def reading(at: Column, of: Column) -> Column:
        return F.when(at.isNotNull(), F.struct(at.alias("at"), of.alias("value")))

    seen_at = F.when(F.col("__seen"), F.col("__at"))
    carried = (
        instants.groupBy(*names, "__day", "__slice")
        .agg(
            F.max("__asked").alias("__asked"),
            F.max(seen_at).alias("at"),
            F.max_by("__value", seen_at).alias("value"),
        )
        .withColumn("__read", F.max(reading(F.col("at"), F.col("value"))).over(across))
        .filter(F.col("__asked") & F.col("__read").isNotNull())
        .select(
            *names,
            "__day",
            "__slice",
            (F.col("__slice") - 1).alias("__at"),
            F.lit(False).alias("__asked"),
            "__read",
        )
    )
    points = instants.select(
        *names, "__day", "__slice", "__at", "__asked",
        reading(seen_at, F.col("__value")).alias("__read"),
    ).unionByName(carried)
    found = (
        points.withColumn("__found", F.max("__read").over(inside))
        .filter("__asked")
        .select(*names, "__day", "__at", F.col("__found.value").alias(out))
    )
    kept = [c for c in left.columns if c != out]
    keyed = left.select(
        *kept, *grouped_keys(left_keys), left_date.alias("__day"), cut.alias("__at")
    )
    joined = left_join_spread(keyed, found, [*names, "__day", "__at"])
    return joined.select(*kept, out)


def join_back(detail: DataFrame, aggregates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of group results to the rows they were computed from."""
    return left_join_spread(detail, aggregates, keys)


def keep_top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose ``key`` is one of the ``k`` most frequent (ties by key)."""
    top = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), key)
        .limit(k)
        .select(key)
    )
    return df.join(F.broadcast(top), key, "left_semi")


def aligned_counts(
    keys: DataFrame, key: str, tables: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Row counts of several tables over the same key set, 0 where absent.

    ``tables`` maps an output column to a frame and its key column.
    """
    result = keys.select(key).distinct()
    for name, (frame, column) in tables.items():
        counts = frame.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias(name))
        result = result.join(counts, key, "left").withColumn(
            name, F.coalesce(name, F.lit(0).cast("bigint"))
        )
    return result
