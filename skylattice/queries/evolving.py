"""Sessions, co-moments of folds and ranks of a graph that changes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import graph, moments, sessions
from skylattice.queries.registry import query
from skylattice.queries.stats import RANK_TOL, rank_sql, trades
from skylattice.queries.tables import table
from skylattice.session import materialize

GAP = 6 * 3600

SESSIONS_SQL = f"""
ordered AS (
  SELECT *, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
flagged AS (
  SELECT *, CASE WHEN before IS NULL OR epoch_us(ts) - before > {GAP}000000 THEN 1 ELSE 0 END AS begins
  FROM ordered),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM flagged)
"""


@query("session_legs", f"""
WITH {SESSIONS_SQL}
SELECT event_id, user_id, CAST(session_no AS BIGINT) AS session_no,
       CAST(epoch_us(min(ts) OVER s) // 1000000 AS BIGINT) AS session_start,
       row_number() OVER (s ORDER BY ts, event_id) AS leg,
       round(sum(coalesce(value, 0)) OVER (s ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS carried
FROM numbered WINDOW s AS (PARTITION BY user_id, session_no)
""")
def session_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as legs of sessions with gaps of six hours, and the value carried along."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    found = sessions.number_sessions(events, "user_id", "ts", GAP, ["event_id"], "value")
    return found.select(
        "event_id",
        "user_id",
        "session_no",
        F.unix_seconds("session_start").alias("session_start"),
        F.col("leg").cast("long").alias("leg"),
        F.round("carried", 4).alias("carried"),
    )


@query("session_summary", f"""
WITH {SESSIONS_SQL}
SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS first_us, CAST(epoch_us(max(ts)) AS BIGINT) AS last_us,
       count(*) AS n_legs, count(*) FILTER (event_type = 'error') AS n_errors
FROM numbered GROUP BY user_id, session_no
""")
def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    measures = {"n_errors": F.count_if(F.col("event_type") == "error")}
    found = sessions.session_summary(events, "user_id", "ts", GAP, measures)
    return found.select(
        "user_id",
        F.unix_micros("session_start").alias("first_us"),
        F.unix_micros("session_end").alias("last_us"),
        "n_legs",
        "n_errors",
    )


COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: First days and lengths of the folds' training parts, which overlap.
FOLD_DAYS = [(i, date(1995, 1, 1) + timedelta(days=400 * i), 900) for i in range(4)]
FOLD_VALUES = ", ".join(f"({i}, DATE '{a}', DATE '{a + timedelta(days=n - 1)}')" for i, a, n in FOLD_DAYS)
FOLDED_SQL = f"""
days(fold_id, a, b) AS (VALUES {FOLD_VALUES}),
folded AS (SELECT fold_id, l.* FROM lineitem l JOIN days ON CAST(l_shipdate AS DATE) BETWEEN a AND b)
"""


def fold_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-moments of every fold, from one pass that keeps a block per day."""
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    blocks = materialize(moments.co_moments(lines, COLUMNS, "day"), "moments")
    folds = spark.createDataFrame(
        [(i, a, a + timedelta(days=n - 1)) for i, a, n in FOLD_DAYS], "fold_id int, first date, last date"
    )
    return moments.moments_of_folds(blocks, "day", folds)


def fold_corr_sql() -> str:
    pairs = [
        f"SELECT fold_id, '{a}' AS column_a, '{b}' AS column_b, "
        + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 8)")
        + " AS correlation FROM folded GROUP BY fold_id"
        for a in COLUMNS
        for b in COLUMNS
    ]
    return f"WITH {FOLDED_SQL} " + " UNION ALL ".join(pairs)


@query("fold_correlations", fold_corr_sql())
def fold_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = moments.correlations_of(fold_moments(spark, sf_dir), ["fold_id"])
    return found.withColumn("correlation", F.round("correlation", 8))


@query("fold_deviations", f"WITH {FOLDED_SQL} " + " UNION ALL ".join(
    f"SELECT fold_id, '{c}' AS column_name, count(*) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev FROM folded GROUP BY fold_id" for c in COLUMNS
))
def fold_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = moments.deviations_of(fold_moments(spark, sf_dir), ["fold_id"])
    return found.select(
        "fold_id", "column_name", "n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev")
    )


# every change is passed on here, however small
EXACT_RANK_SQL = rank_sql().replace(f"WHERE delta > {RANK_TOL}", "")


@query("pagerank_update", f"{EXACT_RANK_SQL} SELECT id, round(pagerank, 6) AS pagerank FROM ranks")
def pagerank_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of the trades, brought up to date from those of a graph with other edges."""
    # stored: read by both graphs
    edges = materialize(graph.route_edges(trades(spark, sf_dir), "origin", "dest").select("src", "dst"), "edges")
    changed = F.pmod(F.xxhash64("src", "dst"), F.lit(50)) == 0
    lost = edges.where(~changed)
    wrong = edges.where(changed).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    before = graph.page_rank(lost.unionByName(wrong), tol=RANK_TOL)
    ranks, _ = graph.update_page_rank(before, edges, tol=1e-10)
    return ranks.withColumn("pagerank", F.round("pagerank", 6))
