"""What filters do in every order they may be applied, by Lehmer ranks and difference arrays.

A row's mask says which of the filters it fails. In a given order the row goes
at the first filter of its mask. So the orders in which filter f removes it at
step k are those that begin with k - 1 filters outside the mask and f next; all
orders with one such beginning have consecutive ranks in lexicographic (Lehmer)
order. A mask's removals are therefore a few intervals of ranks per step. Rows
are counted per part and mask, the counts are added where an interval begins and
taken off behind its end, and a running sum over the ranks gives the totals of
every order. Nothing but the counts depends on the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skylattice.session import broadcast_if_small

SPACE = r"[\x20\x09-\x0D]+"


def lehmer_rank(order: Sequence[int]) -> int:
    """The place of a permutation of 0, 1, ... in lexicographic order."""
    n = len(order)
    return sum(
        sum(later < x for later in order[i + 1 :]) * factorial(n - 1 - i) for i, x in enumerate(order)
    )


def removal_intervals(n: int) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, filter, start, end): ranks in which ``filter`` removes rows of ``mask`` at ``step``."""
    out = []
    for mask in range(1, 1 << n):
        outside = [f for f in range(n) if not mask >> f & 1]
        for before in range(len(outside) + 1):
            wide = factorial(n - before - 1)
            for lead in permutations(outside, before):
                for f in range(n):
                    if mask >> f & 1:
                        rest = [x for x in range(n) if x not in lead and x != f]
                        start = lehmer_rank([*lead, f, *rest])
                        out.append((mask, before + 1, f, start, start + wide))
    return out


def _orders(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(filter_order, step, filter, rank) for all orders."""
    n = len(names)
    rows = [
        ("".join(names[f] for f in order), step, f, rank)
        for rank, order in enumerate(permutations(range(n)))
        for step, f in enumerate(order, 1)
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, rank int")


def audit(
    counts: DataFrame, names: Sequence[str], part_col: str = "part", measures: Sequence[str] = ("rows",)
) -> DataFrame:
    """One row per part, order of the filters ``names`` and step, zeros included.

    ``counts`` has (``part_col``, mask, measures): any number of rows per part and
    mask; bit f of ``mask`` says that filter f fails. The first measure counts
    rows. Columns: ``filter_order``, ``step``, kept (after the step), removed,
    redundant (failing, removed before), unique_fails (failing this filter only),
    lost_<measure> for the other measures, and shapley (removed by the step's
    filter, summed over all orders). Null parts are a part of their own. An
    empty table gives no row. There are n! orders, so n is 8 at most.

    Rows meet in (part, mask) before they are shuffled; what follows has at most
    2^n rows per part. The order tables depend on n alone.
    """
    n = len(names)
    if n > 8:
        raise ValueError("more than 8 filters have too many orders")
    spark = counts.sparkSession
    first, *others = measures
    sums = [F.sum(m).cast("long").alias(m) for m in measures]
    by_mask = counts.groupBy(F.col(part_col).alias("__part"), "mask").agg(*sums)
    fails = lambda f: F.col("mask").bitwiseAND(F.lit(1 << f)) != 0
    totals = by_mask.groupBy("__part").agg(
        F.sum(first).alias("__all"),
        F.array(*[F.sum(F.when(fails(f), F.col(first)).otherwise(0)) for f in range(n)]).alias("__failing"),
        F.array(
            *[F.sum(F.when(F.col("mask") == (1 << f), F.col(first)).otherwise(0)) for f in range(n)]
        ).alias("__alone"),
    )
    intervals = F.broadcast(
        spark.createDataFrame(removal_intervals(n), "mask int, step int, filter int, start int, end int")
    )
    ends = F.explode(
        F.array(
            F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")),
            F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")),
        )
    )
    steps = (
        by_mask.withColumn("mask", F.col("mask").cast("int"))
        .join(intervals, "mask")
        .select("__part", "step", *measures, ends.alias("at"))
        .groupBy("__part", "step", "at.rank")
        .agg(*[F.sum(F.col(m) * F.col("at.sign")).alias(m) for m in measures])
    )
    cells = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(n)))
    )
    grid = cells.join(F.broadcast(_orders(spark, names)), ["rank", "step"])
    at_rank = grid.join(
        steps.withColumnsRenamed({m: f"__d_{m}" for m in measures}).withColumnRenamed("__part", "__p"),
        F.col("__part").eqNullSafe(F.col("__p")) & (grid.step == steps.step) & (grid.rank == steps.rank),
        "left",
    ).select(grid["*"], *[f"__d_{m}" for m in measures])
    along = Window.partitionBy("__part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = at_rank.select(
        "__part", "filter_order", "step", "filter", "rank", "__all", "__failing", "__alone",
        *[F.sum(F.coalesce(f"__d_{m}", F.lit(0))).over(along).alias(f"__r_{m}") for m in measures],
    )
    so_far = Window.partitionBy("__part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    of_filter = Window.partitionBy("__part", "filter")
    gone = F.sum(f"__r_{first}").over(so_far)
    failing = F.get("__failing", F.col("filter"))
    return removed.select(
        F.col("__part").alias(part_col),
        "filter_order",
        "step",
        (F.col("__all") - gone).alias("kept"),
        F.col(f"__r_{first}").alias("removed"),
        # a row that fails a filter goes at its step or went before
        (failing - F.col(f"__r_{first}")).alias("redundant"),
        F.get("__alone", F.col("filter")).alias("unique_fails"),
        *[F.col(f"__r_{m}").alias(f"lost_{m}") for m in others],
        F.sum(f"__r_{first}").over(of_filter).alias("shapley"),
    )


def mask_of(failures: Sequence[Column]) -> Column:
    """The number with bit f set where failure f holds; a null failure does not hold."""
    out = F.lit(0)
    for f, fails in enumerate(failures):
        out = out + F.when(fails, F.lit(1 << f)).otherwise(F.lit(0))
    return out


def text_failures(text: Column, least_words: int = 100, distinct_percent: int = 80, upper_percent: int = 10) -> list[Column]:
    """Too few words, too few distinct words, too many capitals, symbols; of whole texts."""
    pieces = F.split(text, SPACE)
    n_words = F.size(pieces) - F.size(F.filter(pieces, lambda w: w == ""))
    n_distinct = F.size(F.array_distinct(pieces)) - F.array_contains(pieces, "").cast("int")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        n_words < least_words,
        100 * n_distinct.cast("long") < distinct_percent * n_words.cast("long"),
        100 * capitals.cast("long") > upper_percent * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]


def counted_masks(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    failures=text_failures,
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """(part, mask, rows and one count per flag): the counts that ``audit`` takes.

    The last filter fails where a smaller id anywhere has the very same text
    (SHA-256 of the bytes). A null text is empty, a null part the empty string; a
    null id is not smaller than any and has no smaller one. Rows that repeat an id
    count each; they are no smaller id for each other. ``flags`` maps a measure to
    a column of ``labels``, where 1 in any of an id's rows marks it. Columns other
    than the named ones are not read; an empty table gives no row.

    Copies of a text have one mask before the last filter, so they are counted
    per text and part before anything is compared: a text that a third of all
    rows share costs one row per task.
    """
    flags = flags or {"good": "quality", "toxic": "toxic"}
    marks = [f"__f_{m}" for m in flags]
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
    )
    checks = failures(F.col("__text"))
    last = 1 << len(checks)
    narrow = rows.select("__id", "part", F.sha2("__text", 256).alias("__key"), mask_of(checks).alias("__mask"))
    marked = labels.groupBy(F.col(id_col).alias("__id")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"__f_{m}") for m, c in flags.items()]
    )
    per_id = (
        narrow.join(broadcast_if_small(marked), "__id", "left")
        .select("__id", "part", "__key", "__mask", *[F.coalesce(m, F.lit(False)).alias(m) for m in marks])
        .groupBy("__id", "part", "__key", "__mask", *marks)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    alike = per_id.groupBy("__key", "part", "__mask", *marks).agg(
        F.min("__id").alias("__low"),
        F.min_by("__n", "__id").alias("__n_low"),
        F.sum(F.when(F.col("__id").isNull(), F.col("__n")).otherwise(0)).alias("__n_null"),
        F.sum("__n").alias("__n"),
    )
    lowest = F.min("__low").over(Window.partitionBy("__key"))
    passing = F.coalesce(
        F.when(F.col("__low") == F.col("__lowest"), F.col("__n_low")).otherwise(0), F.lit(0)
    ) + F.col("__n_null")
    split = (
        alike.withColumn("__lowest", lowest)
        .withColumn("__pass", passing)
        .select(
            "part",
            *marks,
            F.explode(
                F.array(
                    F.struct(F.col("__mask").alias("mask"), F.col("__pass").alias("n")),
                    F.struct(
                        (F.col("__mask") + last).alias("mask"), (F.col("__n") - F.col("__pass")).alias("n")
                    ),
                )
            ).alias("x"),
        )
    )
    return split.groupBy("part", "x.mask").agg(
        F.sum("x.n").alias("rows"),
        *[F.sum(F.when(F.col(f"__f_{m}"), F.col("x.n")).otherwise(0)).alias(m) for m in flags],
    )
