"""Co-moments per slice of time, merged into the statistics of any fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def co_moments(df: DataFrame, columns: Sequence[str], slice_by: str) -> DataFrame:
    """``slice_by, column_a, column_b, n, mean_a, mean_b, co``, a row per slice and pair a <= b.

    ``co`` is the sum of the products of deviations from the slice's means. Rows
    with a null or NaN in any of the columns are left out, as in
    ``stats.correlation_matrix``. One hash aggregation, one pass over the rows;
    what it gives has slices times pairs rows, whatever the rows were.
    """
    columns = list(columns)
    number = {c: F.col(c).cast("double") for c in columns}
    whole = df.select(F.col(slice_by), *[number[c].alias(c) for c in columns])
    for c in columns:
        whole = whole.where(F.col(c).isNotNull() & ~F.isnan(c))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    grouped = whole.groupBy(slice_by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)],
    )
    at = {c: i for i, c in enumerate(columns)}
    rows = [
        F.struct(
            F.lit(a).alias("column_a"),
            F.lit(b).alias("column_b"),
            F.col("n"),
            F.col(f"m{at[a]}").alias("mean_a"),
            F.col(f"m{at[b]}").alias("mean_b"),
            (F.col(f"c{k}") * F.col("n")).alias("co"),
        )
        for k, (a, b) in enumerate(pairs)
    ]
    return grouped.select(slice_by, F.inline(F.array(*rows)))


def merge_moments(blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The co-moments of all slices of a group together: the columns of ``co_moments`` without the slice.

    Slices differ in their means; each adds ``n`` times the product of its
    deviations from the means of all, so nothing cancels.
    """
    keys = [*by, "column_a", "column_b"]
    group = Window.partitionBy(*keys)
    overall = lambda m: F.sum(F.col("n") * F.col(m)).over(group) / F.sum("n").over(group)
    return (
        blocks.withColumns({"__a": overall("mean_a"), "__b": overall("mean_b")})
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("__n"),
            F.max("__a").alias("mean_a"),
            F.max("__b").alias("mean_b"),
            F.sum(
                F.col("co") + F.col("n") * (F.col("mean_a") - F.col("__a")) * (F.col("mean_b") - F.col("__b"))
            ).alias("co"),
        )
        .withColumnRenamed("__n", "n")
    )


def correlations_of(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column_a, column_b, correlation`` for every ordered pair, from merged co-moments.

    1 for a column with itself, null where a column does not vary.
    """
    own = moments.where("column_a = column_b").select(
        *by, F.col("column_a").alias("__c"), F.col("co").alias("__co")
    )
    swapped = [F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "co"]
    both = moments.select(*by, "column_a", "column_b", "co").unionByName(
        moments.where("column_a <> column_b").select(*by, *swapped)
    )
    for side in ("a", "b"):
        named = own.withColumnsRenamed({"__c": f"column_{side}", "__co": f"__{side}"})
        both = both.join(named, [*by, f"column_{side}"])
    value = F.try_divide(F.col("co"), F.sqrt("__a") * F.sqrt("__b"))
    same = F.col("column_a") == F.col("column_b")
    return both.select(*by, "column_a", "column_b", F.when(same & (F.col("__a") > 0), 1.0).otherwise(value).alias("correlation"))


def deviations_of(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column_name, n, mean, stddev`` (of the sample), as a scaler learns them."""
    return moments.where("column_a = column_b").select(
        *by,
        F.col("column_a").alias("column_name"),
        "n",
        F.col("mean_a").alias("mean"),
        F.sqrt(F.try_divide(F.col("co"), F.col("n") - 1)).alias("stddev"),
    )


def moments_of_folds(blocks: DataFrame, slice_by: str, folds: DataFrame) -> DataFrame:
    """Merged co-moments of every fold; ``folds`` has (fold_id, first, last) with the slices each takes in.

    Slice rows alone are dealt to the folds, which are few and become literals, without
    a join; the rows of the data are not read again.
    """
    kind, members = folds.schema["fold_id"].dataType, []
    for fold in folds.select("fold_id", "first", "last").collect():
        inside = (F.col(slice_by) >= F.lit(fold["first"])) & (F.col(slice_by) <= F.lit(fold["last"]))
        members.append(F.when(inside, F.struct(F.lit(fold["fold_id"]).cast(kind).alias("fold_id"))))
    if not members:
        dealt = blocks.limit(0).withColumn("fold_id", F.lit(None).cast(kind))
    else:
        dealt = blocks.select("*", F.inline(F.array_compact(F.array(*members))))
    return merge_moments(dealt.drop(slice_by), ["fold_id"])
