"""Counts, sums, histograms and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import aggregates as A
from skylattice.queries.registry import query
from skylattice.queries.tables import table


def flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        "l_suppkey",
        "l_extendedprice",
    )


@query("label_balance", """
SELECT count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS positives,
       count(*) FILTER (l_returnflag <> 'R') AS negatives,
       round(count(*) FILTER (l_returnflag = 'R') * 100 / count(*), 8) AS positive_pct,
       round(count(*) FILTER (l_returnflag <> 'R') * 100 / count(*), 8) AS negative_pct
FROM lineitem
""")
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = A.label_balance(flagged_lines(spark, sf_dir), "label")
    return balance.select(
        "total",
        "positives",
        "negatives",
        F.round("positive_pct", 8).alias("positive_pct"),
        F.round("negative_pct", 8).alias("negative_pct"),
    )


@query("group_count", "SELECT l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY l_suppkey")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("group_sum", """
SELECT o_custkey, o_orderpriority, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_custkey, o_orderpriority
""")
def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    sums = A.group_sum(orders, ["o_custkey", "o_orderpriority"], "o_totalprice", "total")
    return sums.withColumn("total", F.round("total", 2))


@query("top_k_sum", """
SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS n_returns
FROM lineitem GROUP BY l_suppkey ORDER BY n_returns DESC, l_suppkey LIMIT 10
""")
def top_k_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = A.group_sum(flagged_lines(spark, sf_dir), ["l_suppkey"], "label", "n_returns")
    return A.top_k(sums, 10, "n_returns", "l_suppkey")


@query("top_k_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def top_k_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return A.top_k(orders, 10, "o_totalprice", "o_orderkey")


@query("column_range", """
SELECT min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max,
       count(l_extendedprice) AS l_extendedprice_n FROM lineitem
""")
def column_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.column_range(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("value_counts_date", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n_rows
FROM orders GROUP BY 1
""")
def value_counts_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = A.value_counts(table(spark, sf_dir, "orders"), F.to_date("o_orderdate"), "day")
    return counts.withColumn("day", F.col("day").cast("string"))


@query("value_counts_hour", """
SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n_rows FROM events GROUP BY 1
""")
def value_counts_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.value_counts(table(spark, sf_dir, "events"), F.hour("ts"), "hour")


@query("count_of_counts", """
SELECT n AS n_rows, count(*) AS n_keys
FROM (SELECT count(*) AS n FROM events GROUP BY user_id) GROUP BY n
""")
def count_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.count_of_counts(table(spark, sf_dir, "events"), "user_id")


def histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""
WITH s AS (SELECT {column} AS x FROM {source}),
e AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM s),
c AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INT) AS bin, count(*) AS n
      FROM s, e GROUP BY 1),
b AS (SELECT CAST(unnest(range({bins})) AS INT) AS bin)
SELECT b.bin, round(lo + b.bin * w, 8) AS lower, round(lo + (b.bin + 1) * w, 8) AS upper,
       coalesce(n, 0) AS n_rows
FROM b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin"""


def rounded_edges(bins: DataFrame) -> DataFrame:
    return bins.withColumns(
        {"lower": F.round("lower", 8), "upper": F.round("upper", 8)}
    )


@query("histogram", histogram_sql("events", "value", 20))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_edges(A.histogram(table(spark, sf_dir, "events"), "value", 20))


@query("label_histogram", histogram_sql(
    "lineitem", "CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END", 2
))
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_edges(A.histogram(flagged_lines(spark, sf_dir), "label", 2))
