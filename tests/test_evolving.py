"""Sessions, co-moments, updated ranks and halving on small frames; the learners' results."""

import datetime as dt
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from skylattice.operators import graph, models, moments, sessions, stats
from skylattice.queries import QUERIES, evolving

T0 = dt.datetime(2024, 3, 1)
SF_DIR = "/root/testdata/sf0.01"


def brute_sessions(rows, gap):
    out, state = {}, {}
    for tail, t, i, delay in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1], r[2])):
        last, no, start, leg, carried = state.get(tail, (None, 0, None, 0, 0))
        if last is None or (t - last).total_seconds() > gap:
            no, start, leg, carried = no + 1, t, 0, 0
        state[tail] = (t, no, start, leg + 1, carried + (delay or 0))
        out[i] = (no, start, leg + 1, carried + (delay or 0))
    return out


@pytest.mark.parametrize("chunk", [86_400, 3_000])
def test_sessions_match_a_walk_over_the_rows(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice(["N1", "N2"]), T0 + dt.timedelta(seconds=rng.randrange(60) * 1800), i, rng.choice([None, 5, -2])) for i in range(60)]
    rows += [("N3", T0 + dt.timedelta(seconds=600 * i), 100 + i, 1) for i in range(300)]  # one session over days
    rows += [("N1", rows[0][1] + dt.timedelta(microseconds=1), 900, 7), (None, T0, 901, 1), ("N1", None, 902, 1)]
    df = spark.createDataFrame(rows, "tail string, time timestamp, id long, delay long").repartition(3)
    got = sessions.number_sessions(df, "tail", "time", 3600, ["id"], "delay", chunk).collect()
    assert len(got) == len(rows)
    found = {r.id: (r.session_no, r.session_start, r.leg, r.carried) for r in got if r.id not in (901, 902)}
    assert found == brute_sessions(rows, 3600)
    assert {(r.session_no, r.leg) for r in got if r.id in (901, 902)} == {(None, None)}
    summary = sessions.session_summary(df, "tail", "time", 3600, {"delay": F.sum("delay")}).collect()
    last = {}
    for tail, t, i, _ in sorted((r for r in rows[:-2]), key=lambda r: (r[0], r[1], r[2])):
        no, start, leg, carried = found[i]
        last[tail, start] = (t, leg, carried)
    assert {(r.tail, r.session_start): (r.session_end, r.n_legs, r.delay or 0) for r in summary} == last


def test_no_window_over_a_whole_entity(spark):
    df = spark.createDataFrame([("N1", T0, 1)], "tail string, time timestamp, id long")
    plan = sessions.number_sessions(df, "tail", "time", 60, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        if "Window [" in line and "__row" in line:
            assert "__chunk" in line


COLUMNS = ["a", "b", "c"]


def numbers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = rng.gauss(1e6, 1)
        rows.append((i % 10, x, 2 * x + rng.gauss(0, 1), 5.0))
    rows += [(3, None, 1.0, 2.0), (4, float("nan"), 1.0, 2.0)]
    return spark.createDataFrame(rows, "day int, a double, b double, c double")


def test_blocks_give_the_matrix_of_any_fold_with_one_scan(spark):
    df = numbers(spark)
    clean = df.where("not isnan(a) and a is not null")
    blocks = moments.co_moments(df, COLUMNS, "day")
    folds = spark.createDataFrame([(0, 0, 3), (1, 2, 9), (2, 5, 5)], "fold_id int, first int, last int")
    merged = moments.moments_of_folds(blocks, "day", folds)
    got = {(r.fold_id, r.column_a, r.column_b): r.correlation for r in moments.correlations_of(merged, ["fold_id"]).collect()}
    spread = {(r.fold_id, r.column_name): r for r in moments.deviations_of(merged, ["fold_id"]).collect()}
    for fold, first, last in [(0, 0, 3), (1, 2, 9), (2, 5, 5)]:
        part = clean.where(F.col("day").between(first, last))
        for r in stats.correlation_matrix(part, ["a", "b"]).collect():
            assert abs(got[fold, r.column_a, r.column_b] - r.correlation) < 1e-9
        assert got[fold, "a", "c"] is None and got[fold, "c", "c"] is None
        exact = part.agg(F.count("a").alias("n"), F.avg("b").alias("m"), F.stddev_samp("b").alias("s")).first()
        mine = spread[fold, "b"]
        assert mine.n == exact.n and abs(mine.mean - exact.m) < 1e-8 and abs(mine.stddev - exact.s) < 1e-8
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("Relation") <= 2  # the rows once, the folds once


def ranked(df):
    return {r.id: r.pagerank for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_updated_ranks_are_those_of_a_fresh_run(spark, seed):
    rng = random.Random(seed)
    pairs = {(rng.randrange(60), rng.randrange(80)) for _ in range(400)}
    gone = set(rng.sample(sorted(pairs), 6))
    new = {(rng.randrange(60), rng.randrange(90)) for _ in range(6)}
    make = lambda ps: spark.createDataFrame(sorted(ps), "src long, dst long")
    old = graph.page_rank(make(pairs), tol=1e-5)
    changed = make((pairs - gone) | new)
    fresh = ranked(graph.page_rank(changed, tol=1e-6))
    got, rounds = graph.update_page_rank(old, changed, tol=1e-6)
    mine = ranked(got)
    assert set(mine) == set(fresh) and max(abs(mine[i] - fresh[i]) for i in fresh) < 1e-4
    nothing = spark.createDataFrame([], "id long, pagerank double")
    _, from_nothing = graph.update_page_rank(nothing, changed, tol=1e-4)
    _, from_old = graph.update_page_rank(old, changed, tol=1e-4)
    assert from_old <= from_nothing
    again, none = graph.update_page_rank(spark.createDataFrame(list(mine.items()), "id long, pagerank double"), changed, tol=1e-4)
    assert none == 0 and max(abs(ranked(again)[i] - mine[i]) for i in mine) < 1e-4


def test_updated_ranks_of_no_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    old = spark.createDataFrame([(1, 1.0)], "id long, pagerank double")
    assert graph.update_page_rank(old, none)[0].count() == 0


def test_halving_finds_the_best_point_with_fewer_fits(spark, monkeypatch):
    rng = random.Random(1)
    rows = []
    for fold in range(4):
        for i in range(120):
            x = rng.gauss(0, 1)
            rows.append((fold, "train" if i < 80 else "val", x, rng.gauss(0, 1), float(x + rng.gauss(0, 0.3) > 0)))
    df = spark.createDataFrame(rows, "fold_id int, role string, x double, z double, label double")
    folds = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    model = LogisticRegression(labelCol="label", featuresCol="features", elasticNetParam=1.0)
    grid = [{model.regParam: v} for v in (0.9, 0.6, 0.4, 0.0)]
    fits = []
    real = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, data: fits.append(1) or real(self, data))
    found = models.successive_halving(folds, model, grid, "label").collect()
    halved = len(fits)
    fits.clear()
    best = models.grid_search(folds, model, grid, "label", with_folds=True).first()
    assert halved < len(fits) == 16
    winner = [r for r in found if r.n_folds == 4 and r.kept]
    assert len(winner) == 1 and (winner[0].point, winner[0].params) == (best.point, best.params)
    assert abs(winner[0].mean_value - best.mean_value) < 1e-12
    assert [(r.round, r.n_folds) for r in found] == [(0, 1)] * 4 + [(1, 2)] * 2 + [(2, 4)]
    assert abs(sum(best.fold_values) / 4 - best.mean_value) < 1e-12


def test_results_of_the_learners(spark):
    metrics = QUERIES["fold_metrics"](spark, SF_DIR).collect()
    assert len(metrics) == 5 * 4 * 3 * 4 and all(0 <= r.value <= 1 for r in metrics)
    value = {(r.model, r.fold_id, r.split, r.metric): r.value for r in metrics}
    # trees fit their training rows better than chance; labels do not depend on the inputs here
    assert all(value["gbt", f, "train", "areaUnderROC"] > 0.55 for f in range(4))
    kept = QUERIES["kept_features"](spark, SF_DIR).collect()
    by_name = {}
    for r in kept:
        by_name.setdefault(r.name, []).append((r.coefficient, r.kept))
    assert all(any(c != 0 for c, _ in rows) == rows[0][1] for rows in by_name.values())
    assert abs(sum(r.importance for r in kept) - 4) < 1e-6
    grid = QUERIES["grid_points"](spark, SF_DIR).collect()
    halving = QUERIES["halving_search"](spark, SF_DIR).collect()
    winner = [r for r in halving if r.n_folds == 4 and r.kept]
    assert len(grid) == 8 and abs(winner[0].mean_value - grid[0].mean_value) < 1e-12
    rows = QUERIES["final_prediction_rows"](spark, SF_DIR)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    told = rows.agg(
        F.count("*").alias("n"), F.min("probability").alias("lo"), F.max("probability").alias("hi"),
        F.avg((F.col("prediction") == (F.col("probability") > 0.5).cast("double")).cast("double")).alias("decided"),
    ).first()
    assert told.n == lines and 0 <= told.lo <= told.hi <= 1 and told.decided > 0.999


def counted(df):
    """``df`` and an accumulator of the rows worked out."""
    made = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), made


@pytest.mark.parametrize("small", [0, 100_000])
def test_links_of_a_ranking_are_worked_out_once(spark, monkeypatch, small):
    monkeypatch.setattr(graph, "SMALL_GRAPH", small)
    rows = [(i % 7, i % 11) for i in range(60)] + [(None, 3), (4, None)]
    edges, made = counted(spark.createDataFrame(rows, "src long, dst long"))
    ranks = {r["id"]: r["pagerank"] for r in graph.page_rank(edges, tol=1e-6).collect()}
    assert made.value == 62
    # the null end counts as one of twelve, without a rank
    assert ranks.pop(None) is None
    assert set(ranks) == set(range(11)) and sum(ranks.values()) == pytest.approx(12)


def test_trades_are_worked_out_once_for_both_rankings(spark, monkeypatch):
    rows = [(i, 1, i % 13, i % 40) for i in range(300)]
    trades, made = counted(spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, origin long, dest long"))
    monkeypatch.setattr(evolving, "trades", lambda *_: trades)
    assert evolving.pagerank_update(spark, "").count() == 40
    assert made.value == 300


def test_a_final_model_scores_stored_rows_once(spark):
    rows = [(i, float(i % 2), float(i % 7)) for i in range(80)]
    plain = spark.createDataFrame(rows, "key long, label double, x double")
    vectors = VectorAssembler(inputCols=["x"], outputCol="v").transform(plain)
    train, held = vectors.where("key < 60"), vectors.where("key >= 60")
    test, made = counted(held.drop("v"))
    test = VectorAssembler(inputCols=["x"], outputCol="v").transform(test)
    factory = models.logistic("label", "v", maxIter=5)
    once = models.fit_once(train, factory, "label", "m", {"test": test}, stored=True, keep=["key"])
    found = [tuple(r) for r in once[1]["test"].select("key", "label", "prediction").orderBy("key").collect()]
    assert made.value == 20
    twice = models.fit_once(train, factory, "label", "m", {"test": held})
    assert found == [tuple(r) for r in twice[1]["test"].select("key", "label", "prediction").orderBy("key").collect()]
    scores = [{(r["split"], r["metric"]): r["value"] for r in run[0].collect()} for run in (once, twice)]
    assert len(scores[0]) == 8 and scores[0] == pytest.approx(scores[1])
