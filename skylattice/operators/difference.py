"""What differs between two versions of a table, row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skylattice.session import broadcast_if_small, materialize

BEFORE, AFTER = "before", "after"


def _plain(df: DataFrame, c: str) -> Column:
    """A value of which equal ones hash alike: no negative zero."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(col == 0, F.lit(0.0)).otherwise(col.cast("double"))
    return col


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with 128 bits of each row; a null is told from every value."""
    seen = [x for c in columns for x in (F.col(f"`{c}`").isNull(), _plain(df, c))]
    return df.withColumns(
        {"__h1": F.xxhash64(F.lit(1), *seen), "__h2": F.xxhash64(F.lit("second"), *seen)}
    )


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of either table that the other has fewer of, with ``n_before`` and ``n_after``.

    The same as ``EXCEPT ALL`` both ways in one pass: rows are counted by 128
    bits of their values, so only those bits cross the cluster, and just the rows
    that differ are fetched again. Nulls are equal to nulls and NaN to NaN. Columns are
    compared by name; both tables need the same ones, none of a map type.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(after.columns))}")
    one, two = _hashed(before, columns), _hashed(after.select(*before.columns), columns)
    bits = ["__h1", "__h2"]
    sides = one.select(*bits, F.lit(1).alias("__b"), F.lit(0).alias("__a")).unionByName(
        two.select(*bits, F.lit(0).alias("__b"), F.lit(1).alias("__a"))
    )
    counts = (
        sides.groupBy(*bits)
        .agg(F.sum("__b").alias("n_before"), F.sum("__a").alias("n_after"))
        .where("n_before <> n_after")
    )
    changed = materialize(counts, "differences")
    # a row is fetched from the table that has more of it, once
    few = broadcast_if_small(changed)
    found = (
        one.join(few.where("n_before > n_after"), bits)
        .unionByName(two.join(few.where("n_before < n_after"), bits))
        .dropDuplicates(bits)
    )
    return found.select(*columns, "n_before", "n_after")


def row_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and kind of change: added, removed or changed.

    Columns: the keys, ``kind``, ``n_rows``, ``changed_columns`` and the values
    as structs ``before`` and ``after``. A key with one differing row on each
    side has changed, in the columns named; where repeats leave more, they are
    removed and added, a row per distinct value with its number. A null key is a
    key like any other.
    """
    keys = list(keys)
    rest = [c for c in before.columns if c not in keys]
    rows = multiset_difference(before, after)
    values = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(None).alias("none"))
    rows = rows.select(*keys, values.alias("__v"), (F.col("n_after") - F.col("n_before")).alias("__n"))
    per_key = rows.groupBy(*keys).agg(
        F.count_if(F.col("__n") > 0).alias("__plus"),
        F.count_if(F.col("__n") < 0).alias("__minus"),
        F.max(F.abs("__n")).alias("__most"),
    )
    same = None
    for k in keys:
        equal = F.col(f"r.`{k}`").eqNullSafe(F.col(f"k.`{k}`"))
        same = equal if same is None else same & equal
    marked = rows.alias("r").join(per_key.alias("k"), same).select(
        *[F.col(f"r.`{k}`").alias(k) for k in keys], "__v", "__n",
        ((F.col("__plus") == 1) & (F.col("__minus") == 1) & (F.col("__most") == 1)).alias("__pair"),
    )
    pick = lambda sign: F.max(F.when(F.signum(F.col("__n").cast("double")) == sign, F.col("__v")))
    pairs = marked.where("__pair").groupBy(*keys).agg(pick(-1).alias(BEFORE), pick(1).alias(AFTER))
    names = [
        F.when(~F.col(BEFORE)[c].eqNullSafe(F.col(AFTER)[c]), F.lit(c)) for c in rest
    ]
    differing = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    changed = pairs.select(
        *keys, F.lit("changed").alias("kind"), F.lit(1).cast("long").alias("n_rows"),
        differing.alias("changed_columns"), BEFORE, AFTER,
    )
    gone = F.col("__n") < 0
    others = marked.where("not __pair").select(
        *keys,
        F.when(gone, F.lit("removed")).otherwise(F.lit("added")).alias("kind"),
        F.abs("__n").cast("long").alias("n_rows"),
        F.array().cast("array<string>").alias("changed_columns"),
        F.when(gone, F.col("__v")).alias(BEFORE),
        F.when(~gone, F.col("__v")).alias(AFTER),
    )
    return changed.unionByName(others)
