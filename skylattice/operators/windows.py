"""Trailing sums and one-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skylattice.session import left_join_spread

DAY = 86_400


def trailing_sum(
    df: DataFrame,
    entity: str,
    time: str,
    value: str,
    out: str,
    start: int = DAY,
    end: int = 3 * 3600,
    chunk: int = DAY,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: sum of ``value`` over ``[time - start, time - end]`` seconds.

    Both ends count, time is taken in whole seconds, and an empty window or a
    row without entity or time gives 0. ``source`` is a frame holding the rows of
    ``df`` (or more) to take the sums from, so that ``df`` is worked out once.

    Whole numbers are exact. Floating values must be finite and come out with the
    rounding of a difference of two sums.

    Rows are first summed per entity and second. Each sum stays in the time chunk
    of its second and is copied to the later chunks whose rows can see it. Inside
    a chunk the answer is the difference of two running totals, up to either end
    of the window, each kept up in one pass over the sorted seconds. A window
    partition is one chunk of one entity, so it holds at most ``start + chunk``
    distinct seconds, however many rows the entity has.
    """
    second = F.unix_seconds(F.col(time))
    per_second = (
        (df if source is None else source)
        .select(F.col(entity).alias("__e"), second.alias("__s"), F.col(value).alias("__v"))
        .dropna(subset=["__e", "__s"])
        .groupBy("__e", "__s")
        .agg(F.sum("__v").alias("__v"))
    )
    s, v = F.col("__s"), F.col("__v")
    zero = F.lit(0).cast(per_second.schema["__v"].dataType)
    first, last = F.floor(s / F.lit(chunk)), F.floor((s + F.lit(start)) / F.lit(chunk))
    # a sum of nothing is not worth copying
    chunks = F.sequence(first, F.when(F.coalesce(v, zero) != zero, last).otherwise(first))
    copies = per_second.select("*", first.alias("__own"), F.explode(chunks).alias("__chunk"))

    def total_until(seconds_before: int) -> Column:
        upto = (
            Window.partitionBy("__e", "__chunk")
            .orderBy("__s")
            .rangeBetween(Window.unboundedPreceding, -seconds_before)
        )
        return F.coalesce(F.sum("__v").over(upto), zero)

    sums = (
        copies.withColumn(out, total_until(end) - total_until(start + 1))
        .filter(F.col("__chunk") == F.col("__own"))
        .select("__e", "__s", out)
    )
    kept = [c for c in df.columns if c != out]
    keyed = df.select(*kept, F.col(entity).alias("__e"), second.alias("__s"))
    return left_join_spread(keyed, sums, ["__e", "__s"]).select(
        *kept, F.coalesce(out, zero).alias(out)
    )


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key combination: the one with the greatest ``order``.

    Equal ``order`` values are decided by the remaining columns; null is the
    smallest order, and null keys form a group. ``columns`` names those wanted,
    other ones are not read. The greatest order is a hash aggregation over the
    keys and ``order``; only rows that have it are compared whole.
    """
    wanted = list(columns or df.columns)
    rows = df.select(*dict.fromkeys([*keys, order, *wanted]))
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    newest = rows.groupBy(*named).agg(F.max(order).alias("__newest"))
    at = F.col(order).eqNullSafe(F.col("__newest"))
    for i, k in enumerate(keys):
        at = at & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    rest = [c for c in rows.columns if c not in (*keys, order)]
    return (
        rows.join(newest, at, "left_semi")
        .groupBy(*keys)
        .agg(F.max(F.struct(order, *rest)).alias("latest"))
        .select(*keys, "latest.*")
        .select(*wanted)
    )
