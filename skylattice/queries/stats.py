"""Correlations, feature choice and the route graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import graph as G, stats as S
from skylattice.queries.joins import line_routes
from skylattice.queries.registry import query
from skylattice.queries.tables import table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FEATURES = [*MEASURES, "Avg_net", "Max_gross"]


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label and two columns derived from the price."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        *MEASURES,
        (price * (1 - F.col("l_discount"))).alias("Avg_net"),
        (price * (1 + F.col("l_tax"))).alias("Max_gross"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
    )


FEATURES_SQL = """
f AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) AS "Avg_net",
         l_extendedprice * (1 + l_tax) AS "Max_gross",
         CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END AS label
  FROM lineitem)
"""
LABEL_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, corr(label, \"{c}\") AS correlation FROM f" for c in FEATURES
)
MATRIX_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr(\"{a}\", \"{b}\") AS correlation FROM f"
    for a in FEATURES
    for b in FEATURES
)


@query("label_corr", f"""
WITH {FEATURES_SQL}
SELECT column_name, round(correlation, 6) AS correlation FROM ({LABEL_CORR_SQL})
""")
def label_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.label_correlation(line_features(spark, sf_dir), "label", FEATURES)
    return found.withColumn("correlation", F.round("correlation", 6))


@query("corr_matrix", f"""
WITH {FEATURES_SQL}
SELECT column_a, column_b, round(correlation, 6) AS correlation FROM ({MATRIX_SQL})
""")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = S.correlation_matrix(line_features(spark, sf_dir), FEATURES)
    return matrix.withColumn("correlation", F.round("correlation", 6))


@query("corr_pairs", f"""
WITH {FEATURES_SQL}
SELECT column_a, column_b, round(correlation, 6) AS correlation FROM ({MATRIX_SQL})
WHERE abs(correlation) > 0.95 AND column_a < column_b
""")
def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = S.correlation_matrix(line_features(spark, sf_dir), FEATURES)
    pairs = S.correlated_pairs(matrix, 0.95)
    return pairs.withColumn("correlation", F.round("correlation", 6))


@query("collapsible_columns", f"""
WITH {FEATURES_SQL},
p AS (SELECT * FROM ({MATRIX_SQL}) WHERE abs(correlation) > 0.95 AND column_a <> column_b)
SELECT DISTINCT column_a AS column_name FROM p
WHERE starts_with(column_a, 'Max') OR starts_with(column_a, 'Min')
""")
def collapsible_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = S.correlation_matrix(line_features(spark, sf_dir), FEATURES)
    names = S.collapsible_columns(matrix, 0.95)
    return spark.createDataFrame([(n,) for n in names], "column_name string")


@query("low_corr", f"""
WITH {FEATURES_SQL}
SELECT column_name FROM ({LABEL_CORR_SQL})
WHERE abs(correlation) < 0.01 AND column_name <> 'l_tax'
""")
def low_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.label_correlation(line_features(spark, sf_dir), "label", FEATURES)
    names = S.weak_columns(found, 0.01, keep=["l_tax"])
    return spark.createDataFrame([(n,) for n in names], "column_name string")


ROUTES_SQL = """
routes AS (
  SELECT s_nationkey AS src, c_nationkey AS dst FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey)
"""


@query("route_edges", f"""
WITH {ROUTES_SQL} SELECT src, dst, count(*) AS relationship FROM routes GROUP BY src, dst
""")
def route_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.route_edges(line_routes(spark, sf_dir), "origin", "dest")


@query("route_vertices", f"""
WITH {ROUTES_SQL} SELECT src AS id FROM routes UNION SELECT dst FROM routes
""")
def route_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.vertices(G.route_edges(line_routes(spark, sf_dir), "origin", "dest"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier number as origin and customer number as destination of a line.

    Both number ranges start at 0, so low numbers occur on both ends, the graph
    has cycles, and high customer numbers have no way on.
    """
    return line_routes(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("origin"),
        F.col("o_custkey").alias("dest"),
    )


RANK_ROUNDS = 12
RANK_TOL = 0.0001


def rank_sql() -> str:
    """The rank rounds written out; rounds after the last change add nothing."""
    steps = [
        """e AS (
  SELECT DISTINCT l_suppkey AS src, o_custkey AS dst
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
d AS (SELECT src, count(*) AS degree FROM e GROUP BY src),
v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
r0 AS (SELECT id, 0.15::DOUBLE AS rank, 0.15::DOUBLE AS delta FROM v)"""
    ]
    for i in range(RANK_ROUNDS):
        steps.append(f"""g{i} AS (
  SELECT dst AS id, sum(delta / degree) * (1.0::DOUBLE - 0.15::DOUBLE) AS gain
  FROM e JOIN d USING (src) JOIN r{i} ON r{i}.id = e.src WHERE delta > {RANK_TOL} GROUP BY dst),
r{i + 1} AS (
  SELECT id, rank + coalesce(gain, 0) AS rank, coalesce(gain, 0) AS delta
  FROM r{i} LEFT JOIN g{i} USING (id))""")
    return f"WITH {', '.join(steps)}, ranks AS (" + (
        f"SELECT id, rank * count(*) OVER () / sum(rank) OVER () AS pagerank FROM r{RANK_ROUNDS})"
    )


@query("pagerank", f"{rank_sql()} SELECT id, round(pagerank, 8) AS pagerank FROM ranks")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = G.route_edges(trades(spark, sf_dir), "origin", "dest")
    ranks = G.page_rank(edges, tol=RANK_TOL)
    return ranks.withColumn("pagerank", F.round("pagerank", 8))


@query("pagerank_join_back", f"""
{rank_sql()}
SELECT l_orderkey, l_linenumber, l_suppkey AS origin, round(pagerank, 8) AS pagerank
FROM lineitem LEFT JOIN ranks ON id = l_suppkey
""")
def pagerank_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = G.with_page_rank(trades(spark, sf_dir), "origin", "dest", tol=RANK_TOL)
    return ranked.select(
        "l_orderkey", "l_linenumber", "origin", F.round("pagerank", 8).alias("pagerank")
    )
