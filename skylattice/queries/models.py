"""Metrics, and classifiers trained over time folds."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import evaluate as E, models as L, prep as M, split as S
from skylattice.queries.registry import query, stored_once
from skylattice.queries.tables import table
from skylattice.session import materialize, scratch_path
from skylattice.sources.readers import fold_ids, read_folds
from skylattice.sources.writers import write_folds

LABEL, WEIGHT = "label", "combined_weight"
CATEGORICAL = ["o_orderpriority", "l_linestatus"]
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
HOLDOUT_FROM = date(2001, 1, 1)


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a rule for a prediction and the price for a score."""
    return table(spark, sf_dir, "lineitem").select(
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("double").alias(LABEL),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
        F.col("l_extendedprice").alias("score"),
    )


@query("confusion_metrics", """
WITH s AS (SELECT l_linestatus, l_returnflag = 'R' AS y, l_quantity > 25 AS p FROM lineitem),
c AS (
  SELECT l_linestatus, cls, count(*) FILTER (y = cls) AS support,
         count(*) FILTER (p = cls) AS predicted, count(*) FILTER (y = cls AND p = cls) AS hits
  FROM s, (VALUES (TRUE), (FALSE)) AS v(cls) GROUP BY l_linestatus, cls),
m AS (
  SELECT *, hits / predicted AS pr, hits / support AS rc,
         2 * (hits / predicted) * (hits / support) / (hits / predicted + hits / support) AS f1
  FROM c)
SELECT l_linestatus, round(sum(hits) / sum(support), 8) AS accuracy,
       round(sum(pr * support) / sum(support), 8) AS weighted_precision,
       round(sum(rc * support) / sum(support), 8) AS weighted_recall,
       round(sum(f1 * support) / sum(support), 8) AS weighted_f1,
       round(max(f1) FILTER (cls), 8) AS binary_f1
FROM m GROUP BY l_linestatus
""")
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = E.classification_metrics(
        scored_lines(spark, sf_dir), LABEL, "prediction", by=["l_linestatus"]
    )
    names = [c for c in metrics.columns if c != "l_linestatus"]
    return metrics.select("l_linestatus", *[F.round(c, 8).alias(c) for c in names])


@query("auc", """
WITH s AS (
  SELECT l_linestatus, l_returnflag = 'R' AS y,
         rank() OVER w + (count(*) OVER (PARTITION BY l_linestatus, l_extendedprice) - 1) / 2.0::DOUBLE
           AS r
  FROM lineitem WINDOW w AS (PARTITION BY l_linestatus ORDER BY l_extendedprice)),
t AS (SELECT l_linestatus, sum(r) FILTER (y) AS ranks, count(*) FILTER (y) AS pos,
             count(*) FILTER (NOT y) AS neg FROM s GROUP BY l_linestatus)
SELECT l_linestatus, round((ranks - pos * (pos + 1) / 2) / (pos * neg), 8) AS auc FROM t
""")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = E.area_under_roc(scored_lines(spark, sf_dir), LABEL, "score", by=["l_linestatus"])
    return areas.withColumn("auc", F.round("auc", 8))


def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metrics of the rule: flag as model, line number as seed, year as fold."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        F.col("l_linestatus").alias("model"),
        F.col("l_linenumber").cast("bigint").alias("seed"),
        F.year("l_shipdate").alias("fold_id"),
        F.when(F.col("l_tax") < 0.04, "train").otherwise("val").alias("split"),
        F.lit("f1").alias("metric"),
    ).agg(F.avg("l_discount").alias("value"))


RULE_SQL = """
m AS (
  SELECT l_linestatus AS model, CAST(l_linenumber AS BIGINT) AS seed,
         CAST(year(l_shipdate) AS INT) AS fold_id,
         CASE WHEN l_tax < 0.04 THEN 'train' ELSE 'val' END AS split,
         avg(l_discount) AS value
  FROM lineitem GROUP BY ALL),
s AS (SELECT model, split, seed, avg(value) AS value FROM m GROUP BY ALL),
a AS (SELECT model, split, avg(value) AS value FROM s GROUP BY ALL)
"""


@query("fold_seed_mean", f"""
WITH {RULE_SQL} SELECT model, split, 'f1' AS metric, round(value, 8) AS value FROM a
""")
def fold_seed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.mean_metrics(rule_metrics(spark, sf_dir)).withColumn("value", F.round("value", 8))


@query("metric_series", f"""
WITH {RULE_SQL}
SELECT model, seed, fold_id, round(value, 8) AS value FROM m WHERE split = 'val'
""")
def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = E.metric_series(rule_metrics(spark, sf_dir), "f1", "val")
    return series.withColumn("value", F.round("value", 8))


@query("compare_models", f"""
WITH {RULE_SQL}
SELECT model, round(max(value) FILTER (split = 'train'), 8) AS train,
       round(max(value) FILTER (split = 'val'), 8) AS val FROM a GROUP BY model
""")
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = E.compare_models(rule_metrics(spark, sf_dir), "f1", ["train", "val"])
    return table_.select("model", *[F.round(c, 8).alias(c) for c in ("train", "val")])


def model_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Weighted training rows and holdout rows with scaled feature vectors, made once."""
    return stored_once(spark, sf_dir, "model_table", lambda: build_model_table(spark, sf_dir))


def build_model_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linestatus",
        *NUMERIC,
        (F.col("l_returnflag") == "R").cast("double").alias(LABEL),
    )
    # read by every fit below
    joined = materialize(lines.join(orders, "l_orderkey"), "labelled_lines")
    cut = F.lit(HOLDOUT_FROM)
    train = joined.filter(F.to_date("o_orderdate") < cut)
    fitted = M.fit_features(train, CATEGORICAL, NUMERIC)

    def vectors(rows: DataFrame) -> DataFrame:
        named = M.name_scaled(fitted.transform(rows))
        return named.select("l_orderkey", "o_orderdate", LABEL, "scaledFeatures")

    weighted = M.add_weights(vectors(train), LABEL, "o_orderdate")
    held = vectors(joined.filter(F.to_date("o_orderdate") >= cut))
    return S.drop_bookkeeping(weighted), held


def model_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folds, stored once for all learners."""

    def build() -> DataFrame:
        train, _ = model_table(spark, sf_dir)
        blocks = S.block_splits(date(1995, 1, 1), HOLDOUT_FROM, 500, 180)
        return stored_folds(spark, S.assign_folds(train, "o_orderdate", blocks))

    return stored_once(spark, sf_dir, "model_folds", build)


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows held back, stored by the first learner that scores them."""
    return stored_once(
        spark, sf_dir, "holdout", lambda: materialize(model_table(spark, sf_dir)[1], "holdout")
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows before the holdout, stored by the first learner that takes them whole."""
    return stored_once(
        spark, sf_dir, "training_rows", lambda: materialize(model_table(spark, sf_dir)[0], "training_rows")
    )


def stored_folds(spark: SparkSession, folds: DataFrame) -> DataFrame:
    """Folds written one directory per part, so a fold reads only its own rows."""
    path = scratch_path(spark, "folds")
    write_folds(folds, path)
    return read_folds(spark, path)


FOLD_SQL = """
rows AS (
  SELECT CAST(o_orderdate AS DATE) AS day, l_returnflag = 'R' AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
b AS (SELECT CAST(i AS INT) AS fold_id, DATE '1995-01-01' + CAST(i * 500 AS INT) AS a
      FROM range(4) AS r(i)),
parts AS (
  SELECT fold_id, CASE WHEN day < a + 500 THEN 'train' ELSE 'val' END AS split, y
  FROM rows JOIN b ON day >= a AND day < a + 680
  UNION ALL
  SELECT fold_id, 'holdout', y FROM rows, b WHERE day >= DATE '2001-01-01'),
counted AS (
  SELECT fold_id, split, count(*) AS n_rows, count(*) FILTER (y) AS n_positive
  FROM parts GROUP BY ALL)
"""


def facts(run: L.FoldRun, weight: bool) -> DataFrame:
    """What was scored by every model, and whether its metrics agree with its predictions.

    ``agrees``: F1 and area under ROC, worked out again from the predictions by
    other means, are those of the run. ``balanced``: on the training rows the
    weighted residuals of a logistic model sum to nothing, as they do at its
    optimum.
    """
    scored = [
        frame.select(
            F.lit(-1 if seed is None else seed).cast("bigint").alias("seed"),
            F.lit(fold_id).alias("fold_id"),
            F.lit(split).alias("split"),
            F.col(LABEL).alias("y"),
            "prediction",
            "score",
            "chance",
            (
                F.col(WEIGHT) if weight and split == S.TRAIN else F.lit(None).cast("double")
            ).alias("w"),
        )
        for (seed, fold_id, split), frame in run.scored.items()
    ]
    by = ["seed", "fold_id", "split"]
    kept = reduce(DataFrame.unionByName, scored)
    sure = (F.col("y") == 1) & (F.col("prediction") == 1)
    counted = kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("y") == 1).alias("n_positive"),
        F.count_if(F.col("prediction") == 1).alias("predicted"),
        F.count_if(sure).alias("hits"),
        F.sum(F.col("w") * (F.col("y") - F.col("chance"))).alias("residual"),
        F.sum("w").alias("weights"),
    )
    told = (
        run.metrics.withColumn("seed", F.coalesce("seed", F.lit(-1)))
        .groupBy(*by)
        .pivot("metric", ["f1", "areaUnderROC"])
        .agg(F.max("value"))
    )
    area = E.area_under_roc(kept, "y", "score", by)
    n, positive, hits = F.col("n_rows"), F.col("n_positive"), F.col("hits")
    negative = n - positive
    missed = n - positive - F.col("predicted") + hits
    first = F.coalesce(F.try_divide(2 * hits, positive + F.col("predicted")), F.lit(0.0))
    second = F.coalesce(F.try_divide(2 * missed, negative + n - F.col("predicted")), F.lit(0.0))
    f1 = (positive * first + negative * second) / n
    return counted.join(told, by).join(area, by).select(
        F.when(F.col("seed") >= 0, F.col("seed")).alias("seed"),
        "fold_id",
        "split",
        "n_rows",
        "n_positive",
        ((F.abs(F.col("f1") - f1) < 1e-9) & (F.abs(F.col("areaUnderROC") - F.col("auc")) < 1e-9)).alias("agrees"),
        (F.abs(F.col("residual") / F.col("weights")) < 1e-3).alias("balanced"),
    )


def learner_sql(seeds: str, balanced: str = "CAST(NULL AS BOOLEAN)") -> str:
    return f"""
WITH {FOLD_SQL}
SELECT CAST(seed AS BIGINT) AS seed, fold_id, split, n_rows, n_positive, TRUE AS agrees,
       {balanced} AS balanced
FROM counted, (VALUES {seeds}) AS s(seed)
"""


LOGISTIC_SQL = learner_sql("(NULL)", "CASE WHEN split = 'train' THEN TRUE END")


@query("logreg_folds", LOGISTIC_SQL)
def logreg_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds, held = model_folds(spark, sf_dir), holdout(spark, sf_dir)
    factory = L.logistic(LABEL, "scaledFeatures", WEIGHT, maxIter=100)
    run = L.fit_over_folds(
        folds, factory, LABEL, "logistic", holdout=held, parallelism=4, stored=True, keep=[WEIGHT]
    )
    return facts(run, weight=True)


# entries of the vector: one per category but the unknown one, then the numbers
ENTRIES_SQL = f"""
(SELECT count(DISTINCT o_orderpriority) + count(DISTINCT l_linestatus) + {len(NUMERIC)}
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '2001-01-01')
"""


@query("lasso_select", f"""
SELECT CAST(i AS INT) AS fold_id, {ENTRIES_SQL} AS n_entries, CAST(0 AS BIGINT) AS n_kept_by_force,
       TRUE AS refit_uses_kept
FROM range(4) AS r(i)
""")
def lasso_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Select by L1, then fit again on the names kept.

    A penalty above the largest gradient (at most 0.5 per unit of a scaled
    entry's mean size) leaves no coefficient; a small one leaves the features
    that the second fit is sliced to.
    """
    folds, held = model_folds(spark, sf_dir), holdout(spark, sf_dir)
    force = L.fit_over_folds(
        folds, L.lasso(LABEL, "scaledFeatures", WEIGHT, reg=1e3, maxIter=20), LABEL, "force",
        parallelism=4, stored=True,
    )
    small = L.lasso(LABEL, "scaledFeatures", WEIGHT, reg=0.001, maxIter=20)
    run = L.fit_over_folds(folds, small, LABEL, "lasso", parallelism=4, stored=True)
    names = L.selected_features(run, folds, "scaledFeatures") or NUMERIC
    sliced = M.slice_features(folds, names, "scaledFeatures")
    refit = L.fit_over_folds(
        sliced, L.logistic(LABEL, "Features", WEIGHT, maxIter=20), LABEL, "refit",
        holdout=M.slice_features(held, names, "scaledFeatures"), parallelism=4, stored=True,
    )
    forced = L.feature_weights(force, folds, "scaledFeatures").groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.count_if(F.col("value") != 0).alias("n_kept_by_force"),
    )
    sizes = spark.createDataFrame(
        [(fold, model.numFeatures == len(names)) for (_, fold), model in refit.models.items()],
        "fold_id int, refit_uses_kept boolean",
    )
    return forced.join(sizes, "fold_id")


@query("logreg_sliced", LOGISTIC_SQL)
def logreg_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on a named part of the feature vector."""
    folds, held = model_folds(spark, sf_dir), holdout(spark, sf_dir)
    sliced, rest = (M.slice_features(x, NUMERIC, "scaledFeatures") for x in (folds, held))
    factory = L.logistic(LABEL, "Features", WEIGHT, maxIter=100)
    run = L.fit_over_folds(
        sliced, factory, LABEL, "logistic_numeric", holdout=rest, parallelism=4, stored=True, keep=[WEIGHT]
    )
    return facts(run, weight=True)


def learner(spark: SparkSession, sf_dir: str, factory, name: str, seeds) -> DataFrame:
    """Facts about one learner over all folds, scored on both parts and the holdout."""
    folds, held = model_folds(spark, sf_dir), holdout(spark, sf_dir)
    run = L.fit_over_folds(
        folds, factory, LABEL, name, seeds=seeds, holdout=held, parallelism=4, stored=True, keep=[]
    )
    return facts(run, weight=False)


FOREST = dict(numTrees=5, maxDepth=5, featureSubsetStrategy="auto")
BOOSTED = dict(maxIter=5, stepSize=0.1, featureSubsetStrategy="all")


@query("rf_folds", learner_sql("(5), (33)"))
def rf_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    factory = L.random_forest(LABEL, "scaledFeatures", WEIGHT, **FOREST)
    return learner(spark, sf_dir, factory, "random_forest", [5, 33])


@query("gbt_folds", learner_sql("(5)"))
def gbt_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    factory = L.boosted_trees(LABEL, "scaledFeatures", WEIGHT, **BOOSTED)
    return learner(spark, sf_dir, factory, "gbt", [5])


@query("mlp_folds", learner_sql("(1234)"))
def mlp_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = model_folds(spark, sf_dir)
    layers = L.perceptron_layers(L.vector_size(folds, "scaledFeatures"), [17, 11])
    factory = L.perceptron(LABEL, "scaledFeatures", layers, maxIter=20, blockSize=128)
    return learner(spark, sf_dir, factory, "mlp", [1234])


PREDICTIONS_SQL = """
SELECT CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'train' ELSE 'test' END AS split,
       l_orderkey, count(*) AS n_rows, count(*) FILTER (l_returnflag = 'R') AS n_positive,
       TRUE AS in_range
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
"""


def final_predictions(spark: SparkSession, sf_dir: str, factory, name: str, seed: int):
    """One model on all training rows: the prediction frames, per order, and the model."""
    train, held = training_rows(spark, sf_dir), holdout(spark, sf_dir)
    metrics, predictions, model = L.fit_once(
        train, factory, LABEL, name, {"test": held}, seed=seed, stored=True, keep=["l_orderkey"]
    )
    chance = vector_to_array("probability")[1]
    decided = F.col("prediction") == (chance > 0.5).cast("double")
    parts = [
        frame.withColumn("fine", chance.between(0, 1) & (decided | (F.abs(chance - 0.5) < 1e-9)))
        .groupBy(F.lit(split).alias("split"), "l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(LABEL) == 1).alias("n_positive"),
            F.bool_and("fine").alias("in_range"),
        )
        for split, frame in predictions.items()
    ]
    return parts[0].unionByName(parts[1]), metrics, model, train


@query("final_mlp", PREDICTIONS_SQL)
def final_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions of one network, fitted once on all training rows."""
    train = training_rows(spark, sf_dir)
    layers = L.perceptron_layers(L.vector_size(train, "scaledFeatures"))
    factory = L.perceptron(LABEL, "scaledFeatures", layers, maxIter=20, blockSize=128)
    return final_predictions(spark, sf_dir, factory, "mlp_final", 1234)[0]


IMPORTANCE_SQL = f"""
SELECT 'importance' AS fact, CAST({ENTRIES_SQL} AS DOUBLE) AS n, 1.0::DOUBLE AS total
UNION ALL
SELECT 'train', count(*), count(*) FILTER (l_returnflag = 'R')
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '2001-01-01'
UNION ALL
SELECT 'test', count(*), count(*) FILTER (l_returnflag = 'R')
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '2001-01-01'
"""


def final_trees(spark: SparkSession, sf_dir: str, factory, name: str) -> DataFrame:
    """Importances of a final tree model by feature, and the rows it scored on either side."""
    predicted, _, model, train = final_predictions(spark, sf_dir, factory, name, 5)
    run = L.FoldRun(None, {(5, 0): model})
    named = L.feature_weights(run, train, "scaledFeatures")
    importance = named.agg(
        F.count("name").cast("double").alias("n"), F.round(F.sum("value"), 6).alias("total")
    ).select(F.lit("importance").alias("fact"), "n", "total")
    scored = predicted.groupBy(F.col("split").alias("fact")).agg(
        F.sum("n_rows").cast("double").alias("n"), F.sum("n_positive").cast("double").alias("total")
    )
    return importance.unionByName(scored)


@query("final_rf", IMPORTANCE_SQL)
def final_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    factory = L.random_forest(LABEL, "scaledFeatures", WEIGHT, **FOREST)
    return final_trees(spark, sf_dir, factory, "rf_final")


@query("final_gbt", IMPORTANCE_SQL)
def final_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    factory = L.boosted_trees(LABEL, "scaledFeatures", WEIGHT, **BOOSTED)
    return final_trees(spark, sf_dir, factory, "gbt_final")


@query("grid_search", f"""
WITH {FOLD_SQL}
SELECT maxIter AS max_iter, regParam AS reg_param, n AS n_validation, TRUE AS is_mean_of_folds
FROM (VALUES (10), (20)) AS a(maxIter), (VALUES (0.001::DOUBLE), (0.01::DOUBLE)) AS b(regParam),
     (SELECT sum(n_rows) AS n FROM counted WHERE split = 'val')
""".replace("sum(n_rows) AS n", "CAST(sum(n_rows) AS BIGINT) AS n"))
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of a grid, and whether its value is the mean over the folds."""
    folds = model_folds(spark, sf_dir)
    options = dict(labelCol=LABEL, featuresCol="scaledFeatures", weightCol=WEIGHT, elasticNetParam=1.0)
    model = LogisticRegression(**options)
    grid = (
        ParamGridBuilder()
        .addGrid(model.regParam, [0.001, 0.01])
        .addGrid(model.maxIter, [10, 20])
        .build()
    )
    found = L.grid_search(folds, model, grid, LABEL, parallelism=4, stored=True, with_folds=True).collect()
    n = folds.filter(F.col("role") == S.VALIDATION).count()
    rows = []
    for r in found:
        point = {p.name: v for p, v in grid[r["point"]].items()}
        mean = sum(r["fold_values"]) / len(fold_ids(folds))
        rows.append((point["maxIter"], point["regParam"], n, abs(mean - r["mean_value"]) < 1e-9))
    ordered = [r["mean_value"] for r in found]
    if ordered != sorted(ordered, reverse=True):
        raise AssertionError("points are not in order of their value")
    return spark.createDataFrame(
        rows, "max_iter int, reg_param double, n_validation bigint, is_mean_of_folds boolean"
    )


# What the learners found. Their numbers are beyond SQL; tests hold them against
# predictors that need no learning.


def lasso_grid(model: LogisticRegression) -> list[dict]:
    return (
        ParamGridBuilder()
        .addGrid(model.regParam, [0.0005, 0.001, 0.01, 0.05])
        .addGrid(model.maxIter, [10, 20])
        .build()
    )


def lasso_estimator() -> LogisticRegression:
    options = dict(labelCol=LABEL, featuresCol="scaledFeatures", weightCol=WEIGHT, elasticNetParam=1.0)
    return LogisticRegression(**options)


@query("fold_metrics")
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric of every learner by seed, fold and part: training, validation, holdout."""
    folds, held = model_folds(spark, sf_dir), holdout(spark, sf_dir)
    layers = L.perceptron_layers(L.vector_size(folds, "scaledFeatures"), [17, 11])
    learners = {
        "logistic": (L.logistic(LABEL, "scaledFeatures", WEIGHT, maxIter=100), [None]),
        "lasso": (L.lasso(LABEL, "scaledFeatures", WEIGHT, reg=0.001, maxIter=20), [None]),
        "random_forest": (L.random_forest(LABEL, "scaledFeatures", WEIGHT, **FOREST), [5]),
        "gbt": (L.boosted_trees(LABEL, "scaledFeatures", WEIGHT, **BOOSTED), [5]),
        "mlp": (L.perceptron(LABEL, "scaledFeatures", layers, maxIter=20, blockSize=128), [1234]),
    }
    runs = [
        L.fit_over_folds(folds, factory, LABEL, name, seeds=seeds, holdout=held, parallelism=4, stored=True).metrics
        for name, (factory, seeds) in learners.items()
    ]
    return reduce(DataFrame.unionByName, runs)


@query("kept_features")
def kept_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of an L1 model and importances of a forest by fold and feature; which L1 keeps in any fold."""
    folds = model_folds(spark, sf_dir)
    small = L.lasso(LABEL, "scaledFeatures", WEIGHT, reg=0.001, maxIter=20)
    run = L.fit_over_folds(folds, small, LABEL, "lasso", parallelism=4, stored=True)
    forest = L.fit_over_folds(
        folds, L.random_forest(LABEL, "scaledFeatures", WEIGHT, **FOREST), LABEL, "random_forest", [5], parallelism=4, stored=True
    )
    names = L.selected_features(run, folds, "scaledFeatures")
    coefficients = L.feature_weights(run, folds, "scaledFeatures").select(
        "fold_id", "name", F.col("value").alias("coefficient")
    )
    importances = L.feature_weights(forest, folds, "scaledFeatures").select(
        "fold_id", "name", F.col("value").alias("importance")
    )
    kept = F.col("name").isin(names) if names else F.lit(False)
    return coefficients.join(importances, ["fold_id", "name"]).withColumn("kept", kept)


@query("grid_points")
def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of a grid with their means and the value of every fold, best first."""
    model = lasso_estimator()
    return L.grid_search(
        model_folds(spark, sf_dir), model, lasso_grid(model), LABEL, parallelism=4, stored=True, with_folds=True
    )


@query("halving_search")
def halving_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grid by rounds over more and more folds."""
    model = lasso_estimator()
    return L.successive_halving(model_folds(spark, sf_dir), model, lasso_grid(model), LABEL, first=2, parallelism=4, stored=True)


@query("final_prediction_rows")
def final_prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's label, prediction and probability by a network fitted once."""
    train, held = model_table(spark, sf_dir)
    layers = L.perceptron_layers(L.vector_size(train, "scaledFeatures"))
    factory = L.perceptron(LABEL, "scaledFeatures", layers, maxIter=20, blockSize=128)
    _, predictions, _ = L.fit_once(
        train, factory, LABEL, "mlp_final", {"test": held}, seed=1234, keep=["l_orderkey"]
    )
    parts = [
        frame.select(
            F.lit(split).alias("split"),
            "l_orderkey",
            LABEL,
            "prediction",
            vector_to_array("probability")[1].alias("probability"),
        )
        for split, frame in predictions.items()
    ]
    return reduce(DataFrame.unionByName, parts)
