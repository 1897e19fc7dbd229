"""Classification metrics and their aggregation over folds and seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from skylattice.operators.ranks import CELL_ROWS, running_totals
from skylattice.session import persisted

METRIC_SCHEMA = (
    "model string, seed bigint, fold_id int, split string, metric string, value double"
)


def confusion(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), counts: str | None = None
) -> DataFrame:
    """``by, label, prediction, n_rows``: one row per occurring combination.

    ``counts`` names the column that says how many rows one of ``df`` stands for.
    """
    return df.groupBy(
        *by,
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg((F.count(F.lit(1)) if counts is None else F.sum(counts)).alias("n_rows"))


def classification_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    by: Sequence[str] = (),
    positive: float = 1.0,
    counts: str | None = None,
) -> DataFrame:
    """Accuracy, support-weighted precision, recall and F1, and the F1 of ``positive``.

    One counting pass; everything after it works on the few label-prediction
    combinations. A class never predicted has precision 0. ``counts`` is that of
    :func:`confusion`.
    """
    by = list(by)
    cells = confusion(df, label, prediction, by, counts)
    n, hit = F.col("n_rows"), F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("support"),
            zero.alias("predicted"),
            F.when(hit, n).otherwise(zero).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("support"),
            n.alias("predicted"),
            zero.alias("hits"),
        ),
    )
    classes = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    # 2pr / (p + r) in counts
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("predicted"))
    support = F.col("support")
    total = F.sum(support)
    return classes.groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * support) / total).alias("weighted_precision"),
        (F.sum(recall * support) / total).alias("weighted_recall"),
        (F.sum(f1 * support) / total).alias("weighted_f1"),
        F.max(F.when(F.col("class") == positive, f1)).alias("binary_f1"),
    )


def area_under_roc(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``by, auc``: chance that a positive row scores above a negative one, ties half.

    A group with rows of one class only has no area.
    """
    totals = running_totals(
        df,
        score,
        {
            "pos": F.count_if(F.col(label) == 1),
            "neg": F.count_if(F.col(label) == 0),
        },
        by,
        cell_rows,
    )
    below = F.col("neg_upto") - F.col("neg") / 2
    return totals.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("pos") * below), F.max("pos_all") * F.max("neg_all")
        ).alias("auc")
    )


def score_counts(
    predictions: DataFrame, label: str, counts: str | None = None
) -> dict[str, float]:
    """F1, weighted precision and recall of a prediction frame, in one counting pass.

    ``f1`` is the support-weighted one. ``counts`` is that of :func:`confusion`.
    """
    row = classification_metrics(predictions, label, "prediction", counts=counts).first()
    return {
        "f1": row["weighted_f1"],
        "weightedPrecision": row["weighted_precision"],
        "weightedRecall": row["weighted_recall"],
    }


def score_predictions(predictions: DataFrame, label: str) -> dict[str, float]:
    """F1, weighted precision and recall, and area under ROC of a prediction frame.

    ``f1`` is the support-weighted one. The area is that of the whole curve, a
    point per distinct score. The predictions are worked out once for both.
    """
    score = vector_to_array("rawPrediction")[1].alias("score")
    return score_rows(predictions.select(label, "prediction", score), label)


def score_rows(scored: DataFrame, label: str) -> dict[str, float]:
    """Those of :func:`score_predictions` from the ``prediction`` and ``score`` of every row.

    Rows are counted per label, prediction and score first, so only distinct
    scores are kept meanwhile and sorted for the area.
    """
    counted = scored.groupBy(label, "prediction", "score").agg(F.count(F.lit(1)).alias("__n"))
    with persisted(counted) as (cells,):
        area = BinaryClassificationEvaluator(
            labelCol=label,
            rawPredictionCol="score",
            weightCol="__n",
            metricName="areaUnderROC",
            numBins=0,
        )
        return {**score_counts(cells, label, "__n"), "areaUnderROC": area.evaluate(cells)}


def score_metric(predictions: DataFrame, label: str, metric: str) -> float:
    """One metric of :func:`score_predictions`; only the area needs the scores sorted."""
    if metric == "areaUnderROC":
        return score_predictions(predictions, label)[metric]
    return score_counts(predictions, label)[metric]


def mean_metrics(metrics: DataFrame) -> DataFrame:
    """``model, split, metric, value``: mean over folds, then over seeds."""
    per_seed = metrics.groupBy("model", "split", "metric", "seed").agg(
        F.avg("value").alias("value")
    )
    return per_seed.groupBy("model", "split", "metric").agg(F.avg("value").alias("value"))


def metric_series(metrics: DataFrame, metric: str, split: str) -> DataFrame:
    """``model, seed, fold_id, value`` of one metric on one split."""
    return metrics.filter((F.col("metric") == metric) & (F.col("split") == split)).select(
        "model", "seed", "fold_id", "value"
    )


def compare_models(metrics: DataFrame, metric: str, splits: Sequence[str]) -> DataFrame:
    """One row per model with its mean ``metric`` on every split."""
    means = mean_metrics(metrics).filter(F.col("metric") == metric)
    return means.groupBy("model").pivot("split", list(splits)).agg(F.max("value"))
