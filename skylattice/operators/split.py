"""Year splits, holdouts and blocked time folds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from skylattice.functions.temporal import day_of

TRAIN, VALIDATION = "train", "val"


class Block(NamedTuple):
    """Training days ``[start, train_end)`` and validation days ``[train_end, end)``."""

    start: date
    train_end: date
    end: date


def block_splits(
    first: date, last: date, train_days: int, val_days: int, overlap: bool = True
) -> list[Block]:
    """Consecutive blocks that end no later than ``last``.

    With ``overlap`` the next block starts where the training days end, so the
    validation days are trained on next; otherwise it starts after them.
    """
    blocks: list[Block] = []
    start = first
    while True:
        train_end = start + timedelta(days=train_days)
        end = train_end + timedelta(days=val_days)
        if end > last:
            return blocks
        blocks.append(Block(start, train_end, end))
        start = train_end if overlap else end


def assign_folds(df: DataFrame, day: str, blocks: Sequence[Block]) -> DataFrame:
    """One row per row and fold it belongs to, with ``fold_id`` and ``role``.

    The few blocks are literals, so folding is a projection without a join; a
    row in no block is left out.
    """
    if not blocks:
        raise ValueError("no blocks to assign rows to")
    d = day_of(day)
    members = []
    for i, block in enumerate(blocks):
        start, train_end, end = (F.lit(x) for x in block)
        for role, lo, hi in [(TRAIN, start, train_end), (VALIDATION, train_end, end)]:
            member = F.struct(F.lit(i).alias("fold_id"), F.lit(role).alias("role"))
            members.append(F.when((d >= lo) & (d < hi), member))
    return df.select("*", F.inline(F.array_compact(F.array(*members))))


def year_split(df: DataFrame, year: str, cut: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the year ``cut`` and rows from it on."""
    return df.filter(F.col(year) < cut), df.filter(F.col(year) >= cut)


def trailing_holdout(df: DataFrame, day: str, days: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rows up to ``days`` before the last day, and the rows after that."""
    last = df.agg(F.max(day_of(day)).alias("last")).first()["last"]
    if last is None:
        return df, df.limit(0)
    cut = F.lit(last - timedelta(days=days))
    return df.filter(day_of(day) <= cut), df.filter(day_of(day) > cut)


def drop_bookkeeping(
    df: DataFrame,
    columns: Sequence[str] = ("date_index", "log_date_index", "normalized_log_weight"),
) -> DataFrame:
    """Drop helper columns that are no model input."""
    return df.drop(*columns)


def stitch_folds(
    folds: DataFrame, row_id: Sequence[str], holdout: DataFrame | None = None
) -> DataFrame:
    """All training rows, the last validation block and a holdout, each row once.

    Rows are recognised by ``row_id``, not by their features.
    """
    last = folds.agg(F.max("fold_id").alias("last")).first()["last"]
    used = folds.filter((F.col("role") == TRAIN) | (F.col("fold_id") == F.lit(last)))
    rows = used.drop("fold_id", "role")
    if holdout is not None:
        rows = rows.unionByName(holdout.select(*rows.columns))
    return rows.dropDuplicates(list(row_id))
