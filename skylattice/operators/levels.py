"""Aggregates on several levels of a hierarchy at once, and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

TOTAL = "all"


def rollup_levels(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """The levels of a hierarchy, from all keys to none."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_levels(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All sets of keys, from all to none."""
    sets = [tuple(k for i, k in enumerate(keys) if chosen >> i & 1) for chosen in range(1 << len(keys))]
    return sorted(sets, key=lambda s: (-len(s), s))


def level_statistics(
    df: DataFrame, levels: Sequence[Sequence[str]], measures: Mapping[str, str] | None = None, parents: Mapping[str, str] | None = None
) -> DataFrame:
    """``n_rows`` and, per measure, N, Sum, Min, Max and Avg on every level; one pass over the rows.

    ``levels`` are sets of key columns, ``measures`` maps a name to a column.
    ``level`` names a row's keys, ``level_id`` has a bit for each key that is
    rolled up, the first key in the highest bit; so a null of the data, which
    keeps its row, is told from a rolled-up one. Rows are first reduced to one per
    combination of all keys, and only these are expanded to the levels, so the
    number of levels multiplies groups, not rows. ``parents`` maps a key to one
    that it decides; the parent is then kept wherever the key is.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    if parents:
        levels = [_closed(level, parents) for level in levels]
        keys = list(dict.fromkeys([*keys, *(k for level in levels for k in level)]))
    measures = dict(measures or {})
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for name, c in measures.items():
        number = F.col(c).cast("double")
        aggs += [F.count(number).alias(f"N_{name}"), F.sum(number).alias(f"Sum_{name}")]
        aggs += [F.min(number).alias(f"Min_{name}"), F.max(number).alias(f"Max_{name}")]
    finest = df.groupBy(*keys).agg(*aggs)
    again = [F.sum("n_rows").alias("n_rows")]
    for name in measures:
        again += [F.sum(f"N_{name}").alias(f"N_{name}"), F.sum(f"Sum_{name}").alias(f"Sum_{name}")]
        again += [F.min(f"Min_{name}").alias(f"Min_{name}"), F.max(f"Max_{name}").alias(f"Max_{name}")]
    sets = [[F.col(k) for k in level] for level in dict.fromkeys(tuple(sorted(x, key=keys.index)) for x in levels)]
    grouped = finest.groupingSets(sets, *keys).agg(F.grouping_id().alias("level_id"), *again)
    named = F.array_compact(
        F.array(
            *[
                F.when(F.shiftright("level_id", len(keys) - 1 - i).bitwiseAND(F.lit(1)) == 0, F.lit(k))
                for i, k in enumerate(keys)
            ]
        )
    )
    label = F.when(F.size(named) == 0, F.lit(TOTAL)).otherwise(F.array_join(named, "+"))
    means = [F.try_divide(F.col(f"Sum_{m}"), F.col(f"N_{m}")).alias(f"Avg_{m}") for m in measures]
    rest = [c for c in grouped.columns if c not in (*keys, "level_id")]
    return grouped.select(*keys, label.alias("level"), "level_id", *rest, *means)


def _closed(level: Sequence[str], parents: Mapping[str, str]) -> list[str]:
    out = list(level)
    for k in out:
        if k in parents and parents[k] not in out:
            out.append(parents[k])
    return out


def pivoted(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: str, how: str = "sum") -> DataFrame:
    """One row per ``rows`` and a column per value of ``column``, named after it.

    ``values`` are listed, so that no job looks for them and the columns are
    fixed; others are left out. Sum, count, min, max and avg are possible.
    """
    column_of = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}[how]
    return df.groupBy(*rows).agg(
        *[column_of(F.when(F.col(column).eqNullSafe(F.lit(v)), F.col(measure))).alias(str(v)) for v in values]
    )
