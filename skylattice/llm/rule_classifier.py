"""Quality classifier: a sparse ensemble of rules over text statistics.

A small forest is grown on a bounded sample of labelled rows. Every path from a
root to a node is a rule, a conjunction of ranges of statistics. A logistic
model with an L1 penalty weighs the rules and leaves most of them out. What
remains is one Spark column expression, so scoring is a projection of the
statistics without Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from skylattice.llm import chunks as ch
from skylattice.llm.language_id import remainder
from skylattice.llm.quality_rules import SYMBOLS, counts
from skylattice.session import materialize


def _bytes(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


UPPER = _bytes(bytes(range(65, 91)))
DIGIT = _bytes(bytes(range(48, 58)))
STOP = _bytes(b".,;:?")
SHOUT = _bytes(b"!")
BAR = _bytes(b"|")
FEED = _bytes(b"\n")

STATISTICS = [
    "n_words", "n_bytes", "mean_word", "longest_word", "symbols", "repeated_lines", "repeated_words",
    "distinct_words", "upper", "digits", "stops", "shouts", "bars", "wide", "mean_line", "spaces",
]


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """``STATISTICS`` of every text, as shares of its words, bytes or lines; zeros for an empty one."""
    base = counts(data, offsets, 8)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    words = base["n_words"].astype(float)
    per = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    count = lambda table: ch.counts_between(table[data], offsets[:-1], offsets[1:])
    starts, ends, doc = ch.words(data, offsets)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, (ends - starts).astype(float))
    hashed = ch.span_hashes(data, starts, ends)
    order = np.lexsort((hashed, doc))
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc[order]) != 0) | (hashed[order][1:] != hashed[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=n)
    lines = count(FEED) + 1.0
    return [
        words,
        size,
        per(base["word_chars"], words),
        longest,
        per(base["n_symbols"], words),
        per(base["n_dup_lines"], lines),
        per(base["n_repeat_words"], words),
        per(distinct, words),
        per(count(UPPER), size),
        per(count(DIGIT), size),
        per(count(STOP), words),
        per(count(SHOUT), words),
        per(count(BAR), words),
        per(ch.counts_between(data >= 128, offsets[:-1], offsets[1:]), size),
        words / lines,
        per(count(ch.SPACE), size),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``STATISTICS`` of every row, over its whole text; null text is empty."""
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ch.chunked(batch, text_col):
                found = text_statistics(*ch.text_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(np.asarray(x, float)) for x in found)], [id_col, *STATISTICS]
                )

    id_type = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{x} double" for x in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """``low < statistic <= high`` for every range, sorted by statistic."""

    ranges: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        tests = []
        for name, low, high in self.ranges:
            if low > -np.inf:
                tests.append(F.col(name) > float(low))
            if high < np.inf:
                tests.append(F.col(name) <= float(high))
        return reduce(lambda a, b: a & b, tests).cast("double")


def tree_rules(root, names: Sequence[str]) -> list[Rule]:
    """A rule for every node below the root of a fitted tree."""
    found: list[Rule] = []

    def walk(node, ranges: dict[str, tuple[float, float]]) -> None:
        if ranges:
            found.append(Rule(tuple((k, *ranges[k]) for k in sorted(ranges))))
        if node.subtreeDepth() == 0:
            return
        name, threshold = names[node.split().featureIndex()], node.split().threshold()
        low, high = ranges.get(name, (-np.inf, np.inf))
        walk(node.leftChild(), {**ranges, name: (low, min(high, threshold))})
        walk(node.rightChild(), {**ranges, name: (max(low, threshold), high)})

    walk(root, {})
    return found


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; ``column`` is the probability of label 1."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = reduce(lambda a, b: a + b, (r.column() * F.lit(w) for r, w in self.weights), F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(
    rows: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    max_rows: int = 20_000,
    trees: int = 20,
    depth: int = 4,
    penalty: float = 0.001,
    seed: int = 7,
) -> Ensemble:
    """Learn an ensemble from rows of statistics with a 0/1 label.

    At most ``max_rows`` rows are used, drawn by a hash of their id; null labels
    teach nothing. With fewer than two labels the score is constant: the label
    there is, or one half.
    """
    labelled = rows.where(F.col(label_col).isNotNull()).withColumn("__label", F.col(label_col).cast("double"))
    bounded = labelled.orderBy(F.xxhash64(id_col), id_col).limit(max_rows).select("__label", *STATISTICS)
    sample = materialize(bounded.repartition(8), "sample")
    seen = {r[0] for r in sample.select("__label").distinct().collect()}
    if len(seen) < 2:
        share = next(iter(seen), 0.5)
        return Ensemble(float(np.clip(40 * (share - 0.5), -20, 20)), ())
    table = VectorAssembler(inputCols=STATISTICS, outputCol="__x").transform(sample)
    forest = RandomForestClassifier(
        labelCol="__label", featuresCol="__x", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=seed,
    ).fit(table)
    rules = sorted({r for t in forest.trees for r in tree_rules(t._call_java("rootNode"), STATISTICS)}, key=lambda r: r.ranges)
    if not rules:
        share = sample.agg(F.avg("__label")).first()[0]
        return Ensemble(float(np.log(share / (1 - share))), ())
    marked = sample.select("__label", array_to_vector(F.array(*(r.column() for r in rules))).alias("__r"))
    model = LogisticRegression(
        labelCol="__label", featuresCol="__r", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100
    ).fit(materialize(marked, "rules"))
    weights = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w != 0.0]
    return Ensemble(float(model.intercept), tuple(weights))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    held_out: int = 0,
    threshold: float = 0.3,
    **options,
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Labels are learned from the folds other than ``held_out`` only, and the
    score is a function of the text alone. Null and empty texts have all
    statistics zero and are scored like any other. Of several labels of an id
    the largest counts; labels without a document and documents without a label
    are fine. Rows that repeat are scored alike.
    """
    stats = materialize(statistics(docs, id_col, text_col), "statistics")
    known = (
        labels.where(F.col(id_col).isNotNull() & (remainder(id_col, folds) != held_out))
        .groupBy(id_col)
        .agg(F.max(label_col).alias("__quality"))
    )
    ensemble = fit(stats.join(known, id_col), "__quality", id_col, **options)
    score = ensemble.column()
    return stats.select(id_col, (remainder(id_col, folds) == held_out).alias("held_out"), score.alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
