"""Sketches per day that answer for any period without reading the rows again.

Distinct counts come from HyperLogLog, distinct counts of one period without
another from theta sketches, quantiles from KLL sketches. All merge without loss
against a sketch of the whole period, up to the error stated here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 12
KLL_K = 400


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error that a distinct count stays within in 997 of 1000 cases."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def theta_error(lg_k: int = LG_K) -> float:
    """The same of a theta sketch, relative to the union of its operands."""
    return 3 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Difference in rank that a quantile stays within in 99 of 100 cases."""
    return 2.446 / k**0.9433


def daily_sketches(
    df: DataFrame,
    time: str,
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    by: Sequence[str] = (),
    lg_k: int = LG_K,
    kll_k: int = KLL_K,
) -> DataFrame:
    """One row per day (and ``by``): rows, ``hll_``, ``theta_`` and ``kll_`` sketches as bytes.

    Nulls, and NaN in ``quantiles``, are left out of a sketch. Rows without time
    have a day of their own, null. One hash aggregation with bounded buffers; the
    result is a few KB per day, to be stored as any table.
    """
    sketched: list[Column] = []
    for c in distinct:
        value = F.col(c).cast("string") if dict(df.dtypes)[c] not in ("string", "int", "bigint") else F.col(c)
        sketched += [
            F.hll_sketch_agg(value, F.lit(lg_k)).alias(f"hll_{c}"),
            F.theta_sketch_agg(value, F.lit(lg_k)).alias(f"theta_{c}"),
        ]
    for c in quantiles:
        number = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        sketched.append(F.kll_sketch_agg_double(number, F.lit(kll_k)).alias(f"kll_{c}"))
    return df.groupBy(F.to_date(time).alias("day"), *by).agg(F.count(F.lit(1)).alias("n_rows"), *sketched)


def period_estimates(
    sketches: DataFrame,
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    by: Sequence[str] = (),
    at: Sequence[float] = (0.25, 0.5, 0.75),
    lg_k: int = LG_K,
) -> DataFrame:
    """``n_rows``, ``distinct_<c>`` and ``quantiles_<c>`` over the rows of ``daily_sketches`` given.

    Choose the period with a filter on ``day``. The error is that of
    ``distinct_error`` and ``rank_error``, however many days are merged.
    """
    merged: list[Column] = [F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in distinct]
    merged += [F.kll_merge_agg_double(F.col(f"kll_{c}")).alias(f"kll_{c}") for c in quantiles]
    grouped = sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *merged)
    ranks = F.array(*[F.lit(float(p)) for p in at])
    return grouped.select(
        *by,
        "n_rows",
        *[F.hll_sketch_estimate(f"hll_{c}").alias(f"distinct_{c}") for c in distinct],
        *[F.kll_sketch_get_quantile_double(F.col(f"kll_{c}"), ranks).alias(f"quantiles_{c}") for c in quantiles],
    )


def newly_seen(sketches: DataFrame, column: str, before: Column, during: Column) -> DataFrame:
    """``n_new``: about how many values ``column`` has in the days of ``during`` and not in those of ``before``."""
    merged = sketches.agg(
        F.theta_union_agg(F.when(before, F.col(f"theta_{column}"))).alias("old"),
        F.theta_union_agg(F.when(during, F.col(f"theta_{column}"))).alias("new"),
    )
    return merged.select(F.theta_sketch_estimate(F.theta_difference("new", "old")).alias("n_new"))
