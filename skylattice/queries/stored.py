"""Stored statistics, sketches, differences, levels and co-located tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import difference, incremental, levels, sketches
from skylattice.queries.joins import KEYS_SQL, TWO_HOURS, views
from skylattice.queries.registry import query
from skylattice.queries.tables import table
from skylattice.session import materialize, scratch_path
from skylattice.sources import colocated


@query("incremental_bucket_statistics", f"""
WITH {KEYS_SQL}
SELECT user_id, CAST(time_key AS BIGINT) AS time_key, max(view_value) AS "Max_view_value",
       min(view_value) AS "Min_view_value", round(avg(view_value), 8) AS "Avg_view_value",
       count(view_value) AS "N_view_value", arg_max(view_id, view_ts) AS "Last_view_id"
FROM v GROUP BY user_id, time_key
""")
def incremental_bucket_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views in three batches that overlap in time, the second one twice."""
    path = scratch_path(spark, "buckets")
    seen = views(spark, sf_dir)
    for number in (0, 1, 1, 2):
        batch = seen.where(F.pmod(F.xxhash64("view_id"), F.lit(3)) == number)
        partials = incremental.partial_statistics(
            batch, "user_id", "view_ts", ["view_value"], TWO_HOURS, latest=["view_id"]
        )
        incremental.upsert_statistics(partials, path, "user_id", "view_ts", ["view_value"], number)
    stored = spark.read.parquet(path)
    done = incremental.finished_statistics(stored, "user_id", ["view_value"])
    more = stored.select("user_id", "time_key", "N_view_value", "Last_view_id")
    return done.join(more, ["user_id", "time_key"]).select(
        "user_id",
        F.unix_seconds("time_key").alias("time_key"),
        "Max_view_value",
        "Min_view_value",
        F.round("Avg_view_value", 8).alias("Avg_view_value"),
        "N_view_value",
        "Last_view_id",
    )


VERSIONS_SQL = """
old_rows AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
  WHERE o_orderkey % 40 = 0),
new_rows AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 62 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 31 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 7)
"""


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders with some repeated, and a later version with changes, gaps and keys lost."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    key = F.col("o_orderkey")
    after = orders.where(key % 50 != 7).select(
        F.when(key % 97 != 0, key).alias("o_orderkey"),
        "o_custkey",
        F.when(key % 62 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 31 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority",
    )
    return orders.unionAll(orders.where(key % 40 == 0)), after


@query("row_difference", f"""
WITH {VERSIONS_SQL},
gone AS (SELECT * FROM old_rows EXCEPT ALL SELECT * FROM new_rows),
come AS (SELECT * FROM new_rows EXCEPT ALL SELECT * FROM old_rows)
SELECT *, CAST(-count(*) AS BIGINT) AS n_more FROM gone GROUP BY ALL
UNION ALL
SELECT *, CAST(count(*) AS BIGINT) AS n_more FROM come GROUP BY ALL
""")
def row_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = difference.multiset_difference(*versions(spark, sf_dir))
    return found.withColumn("n_more", F.col("n_after") - F.col("n_before")).drop("n_before", "n_after")


@query("row_changes", f"""
WITH {VERSIONS_SQL},
gone AS (SELECT *, count(*) AS n FROM (SELECT * FROM old_rows EXCEPT ALL SELECT * FROM new_rows) GROUP BY ALL),
come AS (SELECT *, count(*) AS n FROM (SELECT * FROM new_rows EXCEPT ALL SELECT * FROM old_rows) GROUP BY ALL),
per_key AS (
  SELECT o_orderkey, sum(g) AS n_gone, sum(c) AS n_come, max(n) AS most
  FROM (SELECT o_orderkey, 1 AS g, 0 AS c, n FROM gone UNION ALL SELECT o_orderkey, 0, 1, n FROM come)
  GROUP BY o_orderkey),
pairs AS (SELECT o_orderkey AS k FROM per_key WHERE n_gone = 1 AND n_come = 1 AND most = 1)
SELECT g.o_orderkey, 'changed' AS kind, CAST(1 AS BIGINT) AS n_rows,
       concat_ws(',', CASE WHEN g.o_custkey IS DISTINCT FROM c.o_custkey THEN 'o_custkey' END,
                 CASE WHEN g.o_orderstatus IS DISTINCT FROM c.o_orderstatus THEN 'o_orderstatus' END,
                 CASE WHEN g.o_totalprice IS DISTINCT FROM c.o_totalprice THEN 'o_totalprice' END,
                 CASE WHEN g.o_orderpriority IS DISTINCT FROM c.o_orderpriority THEN 'o_orderpriority' END) AS changed,
       g.o_totalprice AS old_price, c.o_totalprice AS new_price
FROM pairs, gone g, come c
WHERE g.o_orderkey IS NOT DISTINCT FROM k AND c.o_orderkey IS NOT DISTINCT FROM k
UNION ALL
SELECT o_orderkey, 'removed', n, '', o_totalprice, NULL FROM gone
WHERE NOT EXISTS (SELECT 1 FROM pairs WHERE k IS NOT DISTINCT FROM gone.o_orderkey)
UNION ALL
SELECT o_orderkey, 'added', n, '', NULL, o_totalprice FROM come
WHERE NOT EXISTS (SELECT 1 FROM pairs WHERE k IS NOT DISTINCT FROM come.o_orderkey)
""")
def row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = difference.row_changes(*versions(spark, sf_dir), ["o_orderkey"])
    return found.select(
        "o_orderkey",
        "kind",
        "n_rows",
        F.array_join("changed_columns", ",").alias("changed"),
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
    )


#: Days after the first one that the periods of ``sketched_periods`` begin and end at.
PERIODS = [(i, i + 3 * j) for i, j in zip(range(10), [1, 2, 3, 4, 5, 6, 7, 8, 9, 10])]


def periods_sql() -> str:
    rows = ", ".join(f"({a}, {b})" for a, b in PERIODS)
    return f"""
WITH days AS (SELECT CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events) AS d FROM events),
periods(first_day, last_day) AS (VALUES {rows})
SELECT CAST(first_day AS INTEGER) AS first_day, CAST(last_day AS INTEGER) AS last_day, count(*) AS n_rows,
       TRUE AS users_within, TRUE AS median_within, TRUE AS new_users_within
FROM periods JOIN days ON d BETWEEN first_day AND last_day GROUP BY ALL
"""


@query("sketched_periods", periods_sql())
def sketched_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten periods answered from stored sketches; whether each is within its bound of the exact answer."""
    events = table(spark, sf_dir, "events")
    stored = materialize(
        sketches.daily_sketches(events, "ts", distinct=["user_id"], quantiles=["value"]), "sketches"
    )
    begin = stored.agg(F.min("day").alias("d")).first()["d"]
    numbered = stored.withColumn("__d", F.datediff("day", F.lit(begin)))
    exact_rows = events.select("user_id", "value", F.datediff(F.to_date("ts"), F.lit(begin)).alias("__d"))
    out = None
    for first, last in PERIODS:
        inside = F.col("__d").between(first, last)
        got = sketches.period_estimates(numbered.where(inside), ["user_id"], ["value"], at=[0.5])
        new = sketches.newly_seen(numbered, "user_id", F.col("__d") < first, inside)
        median = got.select(F.col("quantiles_value")[0].alias("m"))
        old_users = exact_rows.where(F.col("__d") < first).select("user_id").distinct()
        users = exact_rows.where(inside).select("user_id").distinct()
        fresh = users.join(old_users, "user_id", "left_anti").agg(F.count(F.lit(1)).alias("x_new"))
        exact = exact_rows.where(inside).agg(
            F.count_distinct("user_id").alias("x_users"),
            F.avg((F.col("value") < median.scalar()).cast("double")).alias("below"),
            F.avg((F.col("value") <= median.scalar()).cast("double")).alias("upto"),
        )
        # one row each, of different columns
        figures = got.select("n_rows", "distinct_user_id")
        for frame in (exact, new, fresh):
            figures = figures.unionByName(frame, allowMissingColumns=True)
        row = (
            figures.agg(*[F.max(c).alias(c) for c in figures.columns]).select(
                F.lit(first).alias("first_day"),
                F.lit(last).alias("last_day"),
                "n_rows",
                (F.abs(F.col("distinct_user_id") - F.col("x_users")) <= sketches.distinct_error() * F.col("x_users")).alias("users_within"),
                (
                    (F.col("below") <= 0.5 + sketches.rank_error()) & (F.col("upto") >= 0.5 - sketches.rank_error())
                ).alias("median_within"),
                (F.abs(F.col("n_new") - F.col("x_new")) <= sketches.theta_error() * (F.col("x_users") + F.col("x_new") + 1)).alias("new_users_within"),
            )
        )
        out = row if out is None else out.unionAll(row)
    return out


@query("level_statistics", """
SELECT r_name, n_name, c_mktsegment,
       CASE WHEN grouping(r_name) = 0 AND grouping(n_name) = 0 AND grouping(c_mktsegment) = 0 THEN 'r_name+n_name+c_mktsegment'
            WHEN grouping(r_name) = 0 AND grouping(n_name) = 0 THEN 'r_name+n_name'
            WHEN grouping(r_name) = 0 AND grouping(c_mktsegment) = 0 THEN 'r_name+c_mktsegment'
            WHEN grouping(r_name) = 0 THEN 'r_name' WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment'
            ELSE 'all' END AS level,
       CAST(grouping_id(r_name, n_name, c_mktsegment) AS BIGINT) AS level_id,
       count(*) AS n_rows, min(c_acctbal) AS "Min_balance", max(c_acctbal) AS "Max_balance",
       round(avg(c_acctbal), 6) AS "Avg_balance"
FROM (SELECT CASE WHEN n_name = 'NATION_3' OR c_custkey % 11 = 0 THEN NULL ELSE n_name END AS n_name, r_name,
             c_mktsegment, c_acctbal, c_custkey
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
GROUP BY GROUPING SETS ((r_name, n_name, c_mktsegment), (r_name, n_name), (r_name, c_mktsegment), (r_name),
                        (c_mktsegment), ())
""")
def level_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances from nation and segment up to all customers; some nations are null in the data."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    unknown = (F.col("n_name") == "NATION_3") | (F.col("c_custkey") % 11 == 0)
    rows = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("r_name", F.when(~unknown, F.col("n_name")).alias("n_name"), "c_mktsegment", "c_acctbal")
    )
    wanted = [["r_name", "n_name", "c_mktsegment"], ["n_name"], ["r_name", "c_mktsegment"], ["r_name"], ["c_mktsegment"], []]
    found = levels.level_statistics(rows, wanted, {"balance": "c_acctbal"}, parents={"n_name": "r_name"})
    return found.select(
        "r_name", "n_name", "c_mktsegment", "level", "level_id", "n_rows", "Min_balance", "Max_balance",
        F.round("Avg_balance", 6).alias("Avg_balance"),
    )


@query("pivot_by_month", """
SELECT o_orderpriority, round(sum(o_totalprice) FILTER (month(o_orderdate) = 1), 2) AS "1",
       round(sum(o_totalprice) FILTER (month(o_orderdate) = 6), 2) AS "6",
       round(sum(o_totalprice) FILTER (month(o_orderdate) = 12), 2) AS "12"
FROM orders GROUP BY o_orderpriority
""")
def pivot_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    wide = levels.pivoted(orders, ["o_orderpriority"], "month", [1, 6, 12], "o_totalprice")
    return wide.select("o_orderpriority", *[F.round(f"`{m}`", 2).alias(m) for m in ("1", "6", "12")])


@query("colocated_join", """
SELECT o_orderkey, o_custkey, count(l_linenumber) AS n_lines, round(sum(l_extendedprice), 2) AS price
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
""")
def colocated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their lines, stored by order; the join and the sum need no shuffle."""
    run, names = uuid.uuid4().hex, {}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice"
    )
    for kind, df in (("orders", orders), ("lines", lines)):
        names[kind] = f"{kind}_{run}"
        colocated.write_colocated(df, names[kind], ["o_orderkey"], 8, path=scratch_path(spark, kind))
    joined = colocated.colocated_join(
        *[colocated.read_colocated(spark, names[k]) for k in ("orders", "lines")], ["o_orderkey"]
    )
    return joined.groupBy("o_orderkey", "o_custkey").agg(
        F.count("l_linenumber").alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )
