"""Weights, folds, encodings, graph ranks, metrics and training."""

from datetime import date, timedelta

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from skylattice.operators import (
    aggregates as A,
    evaluate as E,
    graph as G,
    models as L,
    prep as M,
    split as S,
    stats as X,
)
from skylattice.sources.readers import read_folds
from skylattice.sources.writers import write_folds


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    got = {r["y"]: r["weight"] for r in M.class_weight(df, "y").collect()}
    assert got == {1: 0.75, 0: 0.25}


def test_recency_weights_run_from_low_to_high(spark):
    days = [date(2015, 1, 1), date(2015, 3, 1), date(2018, 12, 31)]
    df = spark.createDataFrame([(d, 1) for d in days], "d date, y int")
    got = [r["normalized_log_weight"] for r in M.recency_weight(df, "d").orderBy("d").collect()]
    assert got[0] == pytest.approx(0.3) and got[2] == pytest.approx(1.0) and 0.3 < got[1] < 1.0
    both = M.add_weights(df, "y", "d").collect()
    assert all(r["combined_weight"] == r["weight"] * r["normalized_log_weight"] for r in both)


def test_block_arithmetic():
    assert len(S.block_splits(date(2015, 1, 1), date(2018, 12, 31), 272, 100)) == 5
    assert len(S.block_splits(date(2015, 1, 1), date(2018, 9, 22), 252, 100)) == 5
    disjoint = S.block_splits(date(2015, 1, 1), date(2018, 12, 31), 200, 92, overlap=False)
    assert len(disjoint) == 5
    assert all(a.end == b.start for a, b in zip(disjoint, disjoint[1:]))


def test_folds_train_before_they_validate(spark):
    df = spark.range(900).select(F.date_add(F.lit(date(2015, 1, 1)), F.col("id").cast("int")).alias("d"))
    blocks = S.block_splits(date(2015, 1, 1), date(2017, 6, 1), 200, 90)
    ends = S.assign_folds(df, "d", blocks).groupBy("fold_id").agg(
        F.max(F.when(F.col("role") == "train", F.col("d"))).alias("t"),
        F.min(F.when(F.col("role") == "val", F.col("d"))).alias("v"),
        F.count(F.lit(1)).alias("n"),
    ).collect()
    assert len(ends) == len(blocks)
    assert all(r["t"] < r["v"] and r["n"] == 290 for r in ends)


def test_holdout_is_the_last_days(spark):
    df = spark.range(300).select(F.date_add(F.lit(date(2015, 1, 1)), F.col("id").cast("int")).alias("d"))
    early, late = S.trailing_holdout(df, "d", 100)
    assert (early.count(), late.count()) == (200, 100)


def test_stitched_rows_are_unique(spark):
    df = spark.range(900).select("id", F.date_add(F.lit(date(2015, 1, 1)), F.col("id").cast("int")).alias("d"))
    folds = S.assign_folds(df, "d", S.block_splits(date(2015, 1, 1), date(2017, 6, 1), 200, 90))
    _, held = S.trailing_holdout(df, "d", 100)
    rows = S.stitch_folds(folds, ["id"], held)
    assert rows.count() == rows.select("id").distinct().count()


def test_index_ties_and_one_hot_width(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "k string")
    model = M.fit_category_index(df, ["k"], handle_invalid="error")
    assert list(model.labels) == ["b", "a", "c"]
    fitted = M.fit_features(df, ["k"], [], handle_invalid="error")
    assert L.vector_size(fitted.transform(df), "features") == 2


def test_features_are_sliced_by_name(spark):
    df = spark.createDataFrame([("a", 1.0, 4.0), ("b", 2.0, 8.0)], "k string, x double, y double")
    out = M.fit_features(df, ["k"], ["x", "y"]).transform(df)
    names = [r["name"] for r in M.feature_names(out).collect()]
    assert names[-2:] == ["x", "y"]
    sliced = M.slice_features(out, ["y"], "scaledFeatures", named_by="features")
    got = sliced.select(vector_to_array("Features")[0].alias("v"), "y").collect()
    assert got[0]["v"] / got[1]["v"] == pytest.approx(0.5)
    with pytest.raises(ValueError, match="no such features: z"):
        M.slice_features(out, ["z"], "features")


def test_ranks_sum_to_the_vertices(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("d", "a")], "src string, dst string")
    ranks = {r["id"]: r["pagerank"] for r in G.page_rank(edges, tol=1e-6).collect()}
    assert sum(ranks.values()) == pytest.approx(4.0)
    # c swallows rank: the scaled solution of r = 0.15 + 0.85 * inflow
    raw = {"d": 0.15}
    raw["a"] = 0.15 + 0.85 * raw["d"]
    raw["b"] = 0.15 + 0.85 * raw["a"] / 2
    raw["c"] = 0.15 + 0.85 * (raw["b"] + raw["a"] / 2)
    for name, value in raw.items():
        assert ranks[name] == pytest.approx(value * 4 / sum(raw.values()), rel=1e-4)


def test_rank_without_broadcast(spark, monkeypatch):
    edges = spark.createDataFrame([(i % 7, (i * i + 3) % 11) for i in range(50)], "src int, dst int")
    few = {r["id"]: r["pagerank"] for r in G.page_rank(edges).collect()}
    monkeypatch.setattr(G, "fits_broadcast", lambda df, *bounds: False)
    many = {r["id"]: r["pagerank"] for r in G.page_rank(edges).collect()}
    assert few == pytest.approx(many)


def test_rank_rounds(spark, monkeypatch):
    edges = spark.createDataFrame([(i, (i + 1) % 30) for i in range(30)] + [(0, 7)], "src int, dst int")
    whole = {r["id"]: r["pagerank"] for r in G.page_rank(edges, tol=1e-4).collect()}
    for n in (1, 3, 12):
        again = G.page_rank(edges, tol=1e-4, rounds_per_checkpoint=n).collect()
        assert {r["id"]: r["pagerank"] for r in again} == pytest.approx(whole)
    with pytest.raises(RuntimeError, match="within 3 rounds"):
        G.page_rank(edges, tol=1e-9, max_rounds=3)
    df = edges.selectExpr("src AS o", "dst AS d")
    with pytest.raises(RuntimeError, match="within 2 rounds"):
        G.with_page_rank(df, "o", "d", tol=1e-9, max_rounds=2)
    monkeypatch.setattr(G, "SMALL_GRAPH", 0)
    assert {r["id"]: r["pagerank"] for r in G.page_rank(edges, tol=1e-4).collect()} == pytest.approx(whole)


def test_rank_uses_earlier_rows_only(spark):
    df = spark.createDataFrame(
        [("a", "b", 1), ("b", "a", 1), ("a", "z", 9), ("z", "a", 9)], "o string, d string, y int"
    )
    got = {(r["o"], r["d"]): r["pagerank"] for r in
           G.with_page_rank(df, "o", "d", as_of=("y", 5)).collect()}
    assert got[("z", "a")] is None and got[("a", "b")] == pytest.approx(1.0)


def test_weighted_and_binary_f1_differ(spark):
    pairs = list(zip([1.0, 0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 1.0, 0.0]))
    df = spark.createDataFrame(pairs, "label double, prediction double")
    got = E.classification_metrics(df, "label", "prediction").first()
    assert got["weighted_f1"] == pytest.approx(0.6)
    assert got["binary_f1"] == pytest.approx(0.5)


def test_metrics_agree_with_the_evaluators(spark):
    rows = [
        (float(i % 3 == 0), float((i * 7) % 5 == 0), Vectors.dense([1.0 - s, s]), s)
        for i in range(200)
        for s in [((i * 37) % 50) / 50]
    ]
    df = spark.createDataFrame(rows, ["label", "prediction", "rawPrediction", "score"])
    got = E.score_predictions(df, "label")
    for name in ("f1", "weightedPrecision", "weightedRecall"):
        wanted = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(df)
        assert got[name] == pytest.approx(wanted)
    area = BinaryClassificationEvaluator(labelCol="label").evaluate(df)
    assert got["areaUnderROC"] == pytest.approx(area)
    for cell_rows in (4, 1000):
        exact = E.area_under_roc(df, "label", "score", cell_rows=cell_rows).first()["auc"]
        assert exact == pytest.approx(area)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,), (None,)], "x double")
    got = [(r["bin"], r["n_rows"]) for r in A.histogram(df, "x", 4).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 1), (2, 0), (3, 1)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r["n_rows"] for r in A.histogram(same, "x", 4).collect()) == 2
    assert A.histogram(df.limit(0), "x", 4).count() == 0


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, -4.0), (3.0, 5.0, -6.0)], "y double, c double, x double")
    got = {r["column_name"]: r["correlation"] for r in
           X.label_correlation(df, "y", ["c", "x"]).collect()}
    assert got["c"] is None and got["x"] < -0.9
    matrix = X.correlation_matrix(df, ["y", "x"])
    assert [(r["column_a"], r["column_b"]) for r in X.correlated_pairs(matrix, 0.9).collect()] == [("x", "y")]
    assert X.weak_columns(X.label_correlation(df, "y", ["c", "x"])) == ["c"]


@pytest.fixture(scope="module")
def folds(spark):
    rows = [
        (float(i % 4 == 0), float(i % 4 == 0) * 3 + (i * 13 % 7) / 7, (i * 29 % 11) / 11,
         date(2015, 1, 1) + timedelta(days=i % 400))
        for i in range(1600)
    ]
    df = spark.createDataFrame(rows, "label double, x double, noise double, d date")
    made = M.fit_features(df, [], ["x", "noise"]).transform(df)
    weighted = M.add_weights(made, "label", "d")
    return S.assign_folds(weighted, "d", S.block_splits(date(2015, 1, 1), date(2016, 2, 1), 120, 60))


def test_models_over_folds_and_seeds(folds):
    factory = L.random_forest("label", "scaledFeatures", "combined_weight", numTrees=2, maxDepth=3)
    run = L.fit_over_folds(folds, factory, "label", "rf", seeds=[1, 2], parallelism=2)
    n_folds = len({k[1] for k in run.models})
    assert run.metrics.count() == 2 * n_folds * 2 * 4
    means = E.mean_metrics(run.metrics).filter("metric = 'f1' AND split = 'val'").first()
    assert means["value"] > 0.95
    assert L.feature_weights(run, folds).filter("name = 'x'").agg(F.min("value")).first()[0] > 0.5


def test_penalty_keeps_the_telling_feature(folds):
    run = L.fit_over_folds(
        folds, L.lasso("label", "scaledFeatures", "combined_weight", reg=0.05), "label", "lasso"
    )
    assert L.selected_features(run, folds) == ["x"]
    assert L.selected_features(run, folds, fold_id=0) == ["x"]


def test_grid_is_ranked(folds):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import ParamGridBuilder

    model = LogisticRegression(featuresCol="scaledFeatures", elasticNetParam=1.0, maxIter=10)
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 100.0]).build()
    got = L.grid_search(folds, model, grid, "label").collect()
    assert got[0]["params"] == "regParam=0.01" and got[0]["mean_value"] > got[1]["mean_value"]


def test_trees_take_scaled_dummies_for_numbers(spark):
    # rare categories are scaled far above 1
    rows = [("rare" if i % 50 == 0 else "often", float(i % 2), date(2015, 1, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, label double, d date")
    named = M.name_scaled(M.fit_features(df, ["k"], []).transform(df))
    kinds = {r["kind"] for r in M.feature_names(named, "scaledFeatures").collect()}
    assert kinds == {"numeric"}
    factory = L.random_forest("label", "scaledFeatures", numTrees=2)
    metrics, predictions, _ = L.fit_once(named, factory, "label", "rf", {}, seed=1)
    assert metrics.count() == 4 and predictions["train"].count() == 300


def test_folds_need_blocks(spark):
    with pytest.raises(ValueError, match="no blocks"):
        S.assign_folds(spark.createDataFrame([(date(2015, 1, 1),)], "d date"), "d", [])


def test_area_is_that_of_the_whole_curve(spark):
    from skylattice.operators.evaluate import area_under_roc, score_predictions
    from pyspark.ml.functions import array_to_vector

    n = 6000
    rows = spark.range(n).select(
        (F.col("id") % 7 < F.col("id") * 7 / n).cast("double").alias("y"),
        (F.col("id") / n).alias("s"),
        (F.col("id") > n / 2).cast("double").alias("prediction"),
    )
    raw = rows.withColumn("rawPrediction", array_to_vector(F.array(-F.col("s"), F.col("s"))))
    exact = area_under_roc(rows, "y", "s").first()["auc"]
    assert score_predictions(raw, "y")["areaUnderROC"] == pytest.approx(exact, abs=1e-12)


def test_a_grid_by_f1_sorts_no_scores(folds, monkeypatch):
    model = LogisticRegression()
    grid = ParamGridBuilder().addGrid(model.regParam, [0.0, 0.5]).build()
    whole = L.grid_search(folds, model, grid, "label", with_folds=True).collect()

    def refuse(*args, **options):
        raise AssertionError("no area was asked for")

    monkeypatch.setattr(E, "BinaryClassificationEvaluator", refuse)
    assert L.grid_search(folds, model, grid, "label", with_folds=True).collect() == whole


def test_stored_folds_are_not_cached_again(spark, folds, tmp_path, monkeypatch):
    write_folds(folds, str(tmp_path / "folds"))
    kept = read_folds(spark, str(tmp_path / "folds"))
    factory = L.logistic("label", "features")
    cached = L.fit_over_folds(kept, factory, "label", "lr")

    def refuse(*frames):
        raise AssertionError("a fold was cached")

    monkeypatch.setattr(L, "persisted", refuse)
    again = L.fit_over_folds(kept, factory, "label", "lr", stored=True)
    assert sorted(again.metrics.collect()) == sorted(cached.metrics.collect())


def test_scores_are_those_of_the_evaluators(spark):
    rows = [(float(i % 2), float(i % 3 == 0), Vectors.dense([-i * 0.5, (i * 7 % 5) * 0.5])) for i in range(20)]
    df = spark.createDataFrame(rows, ["label", "prediction", "rawPrediction"])
    got = E.score_predictions(df, "label")
    area = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    assert got["areaUnderROC"] == area == E.score_metric(df, "label", "areaUnderROC")
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert got["f1"] == E.score_metric(df, "label", "f1") == pytest.approx(f1)


def test_only_distinct_scores_are_sorted_for_the_area(spark, monkeypatch):
    rows = [(float(i % 5 < i % 4), float(i % 4 > 1), Vectors.dense([-(i % 4) * 1.0, (i % 4) * 1.0])) for i in range(400)]
    df = spark.createDataFrame(rows, ["label", "prediction", "rawPrediction"])
    area = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    seen = []

    class Spy(BinaryClassificationEvaluator):
        def evaluate(self, dataset, params=None):
            seen.append(dataset.count())
            return super().evaluate(dataset, params)

    monkeypatch.setattr(E, "BinaryClassificationEvaluator", Spy)
    got = E.score_predictions(df, "label")
    assert got["areaUnderROC"] == pytest.approx(area, abs=1e-12) and got["f1"] == pytest.approx(f1)
    assert len(seen) == 1 and seen[0] <= 8


@pytest.mark.parametrize("factory", [L.logistic("label", "scaledFeatures"), L.random_forest("label", "scaledFeatures", numTrees=2)])
def test_folds_beyond_the_memory_are_trained_one_by_one(spark, folds, tmp_path, monkeypatch, factory):
    write_folds(folds, str(tmp_path / "folds"))
    kept = read_folds(spark, str(tmp_path / "folds"))
    assert L._folds_at_once(kept, factory(None), 4) == 4
    rows = kept.filter("role = 'train'").groupBy("fold_id").count().agg(F.max("count")).first()[0]
    trees = isinstance(factory(None), L.RandomForestClassifier)
    size = rows * (4 * 2 + 128 if trees else 8 * 2 + 16)  # two entries a row
    monkeypatch.setattr(L, "_cache_room", lambda _: 2 * size)
    assert L._folds_at_once(kept, factory(None), 4) == 2
    monkeypatch.setattr(L, "_cache_room", lambda _: size - 1)

    def refuse(*args):
        raise AssertionError("more than one fold at a time")

    monkeypatch.setattr(L, "ThreadPool", refuse)
    run = L.fit_over_folds(kept, factory, "label", "m", [5], parallelism=4, stored=True)
    assert run.metrics.count() == 4 * 2 * len(run.models) and len(run.models) > 1


def test_kept_scores_are_worked_out_once(spark, folds):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    factory = L.logistic("label", "scaledFeatures", maxIter=5)
    held = spark.range(40).select((F.col("id") % 2).cast("double").alias("label"), "id").mapInArrow(
        count, "label double, id long"
    )
    held = M.name_scaled(M.fit_features(folds, [], ["x", "noise"], features="f2", scaled="s2").transform(
        held.withColumns({"x": F.col("id") * 0.1, "noise": F.lit(0.5)})
    ), "f2", "s2").withColumnRenamed("s2", "scaledFeatures")
    run = L.fit_over_folds(folds, factory, "label", "m", holdout=held, keep=["id", "combined_weight"])
    counted = {key: frame.count() for key, frame in run.scored.items()}
    n = len(run.models)
    assert made.value == 40 * n and sum(c for (_, _, s), c in counted.items() if s == L.HOLDOUT) == 40 * n
    assert run.scored[(None, 0, L.HOLDOUT)].columns == ["id", "label", "prediction", "score", "chance"]
    assert run.scored[(None, 0, "train")].columns[:2] == ["combined_weight", "label"]
    plain = L.fit_over_folds(folds, factory, "label", "m", holdout=held)
    assert plain.scored is None
    told = [{(r.fold_id, r.split, r.metric): r.value for r in x.metrics.collect()} for x in (run, plain)]
    assert told[0] == pytest.approx(told[1], abs=1e-9)
