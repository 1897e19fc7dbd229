"""Removal of repeated lines by overlapping windows of consecutive lines.

Every window of three consecutive lines is hashed, equal windows are found over
all documents, and each occurrence but the first marks its three lines. Marked
positions of overlapping windows are merged and the lines go. Only DataFrame
functions are used: lines never leave their document, the shuffles carry hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skylattice.session import broadcast_if_small, materialize

#: ``[^\x20\x09-\x0D]``: a character of a word.
INK = r"[^\x20\x09-\x0D]"


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """128 bits that name a row by its id and text; never null."""
    return [
        F.xxhash64(id_col, text_col).alias("__k1"),
        F.xxhash64(F.lit(7), F.col(id_col), F.col(text_col)).alias("__k2"),
    ]


def _lines(text_col: str) -> Column:
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")


def line_windows(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """One row per window: its document's keys, position and 128-bit hash."""
    marks = F.transform(
        F.col("__lines"),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), x.rlike(INK).alias("ink")
        ),
    )
    n = F.greatest(F.size("__marks") - F.lit(size - 1), F.lit(0))
    zipped = F.arrays_zip(*(F.slice("__marks", F.lit(i + 1), n).alias(f"l{i}") for i in range(size)))
    part = lambda i, x: F.col(f"__w.l{i}.{x}")
    return (
        docs.select(F.col(id_col).alias("__id"), *_row_keys(id_col, text_col), _lines(text_col).alias("__lines"))
        .select("__id", "__k1", "__k2", marks.alias("__marks"))
        .where(F.size("__marks") >= size)
        .select("__id", "__k1", "__k2", F.posexplode(zipped).alias("__pos", "__w"))
        .where(reduce(lambda a, b: a | b, (part(i, "ink") for i in range(size))))
        .select(
            F.struct("__id", "__k1", "__k2", "__pos").alias("__at"),
            F.xxhash64(*(part(i, "a") for i in range(size))).alias("__h1"),
            F.xxhash64(*(part(i, "b") for i in range(size))).alias("__h2"),
        )
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with repeated lines removed from the text, plus ``n_lines`` and ``n_removed``.

    A window is ``size`` consecutive ``\\n``-separated lines of one document, one
    of which has a word at least. Of all equal windows the first by (id, row
    hash, position) stays; the lines of the others are removed, and what is left
    is joined by ``\\n``. Windows are judged on the input. A document that loses
    all its lines keeps its row with an empty text.

    Null text counts as one empty line and gives an empty text. A null id sorts
    before all others. Rows with the same id and text are one document and share
    its result. Texts of fewer than ``size`` lines stay as they are. Columns of
    ``docs`` stay; its own ``n_lines`` and ``n_removed`` are replaced.

    The aggregation combines a window's occurrences before its shuffle, and the
    join has one row per window on the right, so a hot window is split by
    adaptive execution. What goes is written to the checkpoint folder, one row
    per document that changes; if its measured size allows a broadcast, no text
    is shuffled at all.
    """
    found = line_windows(docs, id_col, text_col, size)
    first = (
        found.groupBy("__h1", "__h2")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    later = materialize(
        found.join(first, ["__h1", "__h2"])
        .where(~F.col("__at").eqNullSafe(F.col("__first")))
        .groupBy(F.col("__at.__k1").alias("__k1"), F.col("__at.__k2").alias("__k2"))
        .agg(F.collect_set("__at.__pos").alias("__starts")),
        "later_windows",
    )
    covered = F.array_distinct(
        F.flatten(F.transform("__starts", lambda s: F.sequence(s, s + F.lit(size - 1))))
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__covered"))
    kept = F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.when(F.col("__covered").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept)
    return (
        docs.select(*others, *_row_keys(id_col, text_col))
        .join(broadcast_if_small(later), ["__k1", "__k2"], "left")
        .withColumn("__covered", covered)
        .withColumn("__lines", _lines(text_col))
        .select(
            *(text.alias(c) if c == text_col else F.col(c) for c in others),
            F.size("__lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("__covered"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
