"""Sessions: rows of an entity that follow each other without a long gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skylattice.operators.windows import DAY
from skylattice.session import materialize


def number_sessions(
    df: DataFrame,
    entity: str,
    time: str,
    gap: int,
    ties: Sequence[str],
    value: str | None = None,
    chunk: int = DAY,
) -> DataFrame:
    """Add ``session_no``, ``session_start``, ``leg`` and, with ``value``, ``carried``.

    A row begins a session if the entity's row before is more than ``gap``
    seconds older, or there is none. Sessions of an entity count from 1, so do the
    legs of a session. ``carried`` is the sum of ``value`` over the session up to
    and with the row, null counting nothing. Rows at the same instant are ordered
    by ``ties``. Rows without entity or time get nulls.

    A window partition is one time chunk of one entity. What the earlier chunks
    hand on (rows, sum, last time, sessions, the last session's beginning) is
    summed up over one row per entity and chunk, so an entity with any share of
    the rows is spread over its chunks.
    """
    added = ["session_no", "session_start", "leg", *(["carried"] if value else [])]
    kept = [c for c in df.columns if c not in added]
    number = F.coalesce(F.col(value), F.lit(0)) if value else F.lit(0)
    has_key = F.col(entity).isNotNull() & F.col(time).isNotNull()
    micros = F.unix_micros(F.col(time))
    rows = df.where(has_key).select(
        *kept, F.col(entity).alias("__e"), micros.alias("__t"), number.alias("__v"),
        F.floor(micros / F.lit(chunk * 1_000_000)).alias("__chunk"),
    )
    keys = ["__e", "__chunk"]
    order = ["__t", *ties]
    inside = Window.partitionBy(*keys).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("__e").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    stored = materialize(rows, "timed")

    def handed_on(aggs: dict[str, Column], carried: dict[str, Column], source: DataFrame) -> DataFrame:
        """Per entity and chunk what the chunks before it come to."""
        return source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]).select(
            *keys, *[c.alias(n) for n, c in carried.items()]
        )

    nothing = F.lit(0).cast("long")
    first = handed_on(
        {"__n": F.count(F.lit(1)), "__s": F.sum("__v"), "__last": F.max("__t")},
        {
            "__rows": F.coalesce(F.sum("__n").over(earlier), nothing),
            "__sum": F.coalesce(F.sum("__s").over(earlier), F.lit(0)),
            "__before": F.max("__last").over(earlier),
        },
        stored,
    )
    previous = F.coalesce(F.lag("__t").over(inside), F.col("__before"))
    begins = previous.isNull() | (F.col("__t") - previous > F.lit(gap * 1_000_000))
    placed = stored.join(first, keys).select(
        *stored.columns,
        begins.alias("__begins"),
        (F.col("__rows") + F.row_number().over(inside)).alias("__row"),
        (F.col("__sum") + F.sum("__v").over(so_far)).alias("__total"),
    )
    # rows rise, so the latest beginning is the greatest
    mark = F.when(F.col("__begins"), F.struct("__row", (F.col("__total") - F.col("__v")).alias("total"), "__t"))
    placed = materialize(placed.withColumn("__mark", mark), "placed")
    second = handed_on(
        {"__n": F.count_if(F.col("__begins")), "__m": F.max("__mark")},
        {
            "__sessions": F.coalesce(F.sum("__n").over(earlier), nothing),
            "__open": F.max("__m").over(earlier),
        },
        placed,
    )
    begun = F.coalesce(F.max("__mark").over(so_far), F.col("__open"))
    found = placed.join(second, keys).select(
        *kept,
        (F.col("__sessions") + F.sum(F.col("__begins").cast("long")).over(so_far)).alias("session_no"),
        begun.alias("__at"),
        "__row",
        "__total",
    )
    legs = [F.timestamp_micros("__at.__t").alias("session_start"), (F.col("__row") - F.col("__at.__row") + 1).alias("leg")]
    if value:
        legs.append((F.col("__total") - F.col("__at.total")).alias("carried"))
    out = found.select(*kept, "session_no", *legs)
    types = dict(out.dtypes)
    without = df.where(~has_key).select(*kept, *[F.lit(None).cast(types[c]).alias(c) for c in added])
    return out.unionByName(without)


def session_summary(
    df: DataFrame, entity: str, time: str, gap: int, measures: dict[str, Column] | None = None
) -> DataFrame:
    """One row per session: entity, ``session_start``, ``session_end`` (its last row), ``n_legs`` and ``measures``.

    The built-in session window, which merges partial sessions before the
    shuffle; it also works on a stream with a watermark on ``time``. Here a gap of
    exactly ``gap`` seconds ends no session, as in ``number_sessions``.
    """
    # a session window ends a session at a gap of its own length; times are whole microseconds
    window = F.session_window(F.col(time), f"{gap} seconds 1 microseconds")
    grouped = df.where(F.col(entity).isNotNull() & F.col(time).isNotNull()).groupBy(entity, window.alias("__w"))
    named = [c.alias(n) for n, c in (measures or {}).items()]
    out = grouped.agg(F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_legs"), *named)
    rest = [c for c in out.columns if c not in (entity, "__w")]
    return out.select(entity, F.col("__w.start").alias("session_start"), *rest)
