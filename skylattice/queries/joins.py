"""Bucket, as-of, nearest, lookup and graph-free join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import joins as J
from skylattice.operators.windows import dedupe_latest, trailing_sum
from skylattice.queries.registry import query
from skylattice.queries.tables import table

TWO_HOURS = 7_200


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'view'").select(
        "user_id",
        F.col("ts").alias("view_ts"),
        F.col("event_id").alias("view_id"),
        F.col("value").alias("view_value"),
    )


KEYS_SQL = """
p AS (
  SELECT event_id, user_id, ts,
         (epoch_us(ts) - 7200000000) // 7200000000 * 7200 AS time_key
  FROM events WHERE event_type = 'purchase'),
v AS (
  SELECT user_id, event_id AS view_id, value AS view_value, ts AS view_ts,
         (epoch_us(ts) + 7199999999) // 7200000000 * 7200 AS time_key
  FROM events WHERE event_type = 'view')
"""


@query("bucket_join_latest", f"""
WITH {KEYS_SQL},
last AS (
  SELECT user_id, time_key, arg_max(view_id, view_ts) AS view_id,
         arg_max(view_value, view_ts) AS view_value
  FROM v GROUP BY user_id, time_key)
SELECT p.event_id, p.user_id, CAST(p.time_key AS BIGINT) AS time_key,
       last.view_id, last.view_value
FROM p LEFT JOIN last USING (user_id, time_key)
""")
def bucket_join_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = J.latest_per_bucket(views(spark, sf_dir), "user_id", "view_ts", TWO_HOURS)
    joined = J.bucket_join(
        purchases(spark, sf_dir), last, "user_id", "ts", TWO_HOURS, lead=TWO_HOURS
    )
    return joined.select(
        "event_id",
        "user_id",
        F.unix_seconds("time_key").alias("time_key"),
        "view_id",
        "view_value",
    )


@query("bucket_join_stats", f"""
WITH {KEYS_SQL},
stats AS (
  SELECT user_id, time_key, max(view_value) AS hi, min(view_value) AS lo,
         avg(view_value) AS mean
  FROM v GROUP BY user_id, time_key)
SELECT p.event_id, p.user_id, CAST(p.time_key AS BIGINT) AS time_key,
       hi AS "Max_view_value", lo AS "Min_view_value", round(mean, 8) AS "Avg_view_value"
FROM p LEFT JOIN stats USING (user_id, time_key)
""")
def bucket_join_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = J.bucket_statistics(
        views(spark, sf_dir), "user_id", "view_ts", ["view_value"], TWO_HOURS
    )
    joined = J.bucket_join(
        purchases(spark, sf_dir), stats, "user_id", "ts", TWO_HOURS, lead=TWO_HOURS
    )
    return joined.select(
        "event_id",
        "user_id",
        F.unix_seconds("time_key").alias("time_key"),
        "Max_view_value",
        "Min_view_value",
        F.round("Avg_view_value", 8).alias("Avg_view_value"),
    )


@query("bucket_stats_join_back", """
WITH v AS (
  SELECT event_id, user_id, value,
         (epoch_us(ts) + 10799999999 - 7200000000) // 10800000000 * 10800 + 7200 AS time_key
  FROM events),
stats AS (
  SELECT user_id, time_key, max(value) AS hi, min(value) AS lo, avg(value) AS mean
  FROM v GROUP BY user_id, time_key)
SELECT event_id, user_id, CAST(time_key AS BIGINT) AS time_key, hi AS "Max_value",
       lo AS "Min_value", round(mean, 8) AS "Avg_value"
FROM v JOIN stats USING (user_id, time_key)
""")
def bucket_stats_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    width, offset = 3 * 3600, 2 * 3600
    stats = J.bucket_statistics(events, "user_id", "ts", ["value"], width, offset)
    keyed = events.withColumn(J.TIME_KEY, J.bucket_ceil(F.col("ts"), width, offset))
    return J.join_back(keyed, stats, ["user_id", J.TIME_KEY]).select(
        "event_id",
        "user_id",
        F.unix_seconds(J.TIME_KEY).alias("time_key"),
        "Max_value",
        "Min_value",
        F.round("Avg_value", 8).alias("Avg_value"),
    )


ASOF_SQL = """
prev AS (
  SELECT p.event_id, arg_max(v.value, v.ts) AS previous_value
  FROM events p JOIN events v
    ON v.user_id = p.user_id
   AND epoch_us(p.ts) - 7200000000 > epoch_us(v.ts)
   AND abs(date_diff('day', CAST(v.ts AS DATE), CAST(p.ts AS DATE))) <= 1
  WHERE p.event_type = 'purchase' AND v.event_type = 'view'
  GROUP BY p.event_id)
"""


@query("asof_previous", f"""
WITH {ASOF_SQL}
SELECT p.event_id, p.user_id, prev.previous_value
FROM events p LEFT JOIN prev USING (event_id)
WHERE p.event_type = 'purchase'
""")
def asof_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.asof_previous(
        purchases(spark, sf_dir),
        views(spark, sf_dir),
        ["user_id"],
        ["user_id"],
        "ts",
        "view_ts",
        "view_value",
        "previous_value",
        lead=TWO_HOURS,
    ).select("event_id", "user_id", "previous_value")


def errors_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        (F.col("event_type") == "error").cast("int").alias("is_error"),
    )


def trailing_sql(entity: str, flag: str = "CAST(event_type = 'error' AS INT)") -> str:
    return f"""
  SELECT event_id, {entity},
         CAST(coalesce(sum({flag}) OVER (
           PARTITION BY {entity} ORDER BY CAST(epoch_us(ts) // 1000000 AS BIGINT)
           RANGE BETWEEN 86400 PRECEDING AND 10800 PRECEDING), 0) AS BIGINT) AS trailing
  FROM events"""


@query("trailing_sum_entity", trailing_sql("user_id"))
def trailing_sum_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = errors_flagged(spark, sf_dir)
    return trailing_sum(flagged, "user_id", "ts", "is_error", "trailing").select(
        "event_id", "user_id", "trailing"
    )


@query("trailing_sum_group", trailing_sql("event_type", "CAST(user_id % 10 = 0 AS INT)"))
def trailing_sum_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "event_type",
        (F.col("user_id") % 10 == 0).cast("int").alias("is_tenth"),
    )
    return trailing_sum(flagged, "event_type", "ts", "is_tenth", "trailing").select(
        "event_id", "event_type", "trailing"
    )


@query("enriched_events", f"""
WITH {KEYS_SQL}, {ASOF_SQL},
last AS (
  SELECT user_id, time_key, arg_max(view_value, view_ts) AS view_value,
         max(view_value) AS hi, min(view_value) AS lo
  FROM v GROUP BY user_id, time_key),
trail AS ({trailing_sql("user_id")})
SELECT p.event_id, p.user_id, last.view_value, last.hi AS "Max_view_value",
       last.lo AS "Min_view_value", prev.previous_value, trail.trailing
FROM p LEFT JOIN last USING (user_id, time_key)
LEFT JOIN prev ON prev.event_id = p.event_id
LEFT JOIN trail ON trail.event_id = p.event_id
""")
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with its latest earlier bucket, as-of value and error count."""
    seen = views(spark, sf_dir)
    per_bucket = J.bucket_statistics(
        seen, "user_id", "view_ts", ["view_value"], TWO_HOURS, latest=["view_value"]
    )
    enriched = J.asof_previous(
        purchases(spark, sf_dir), seen, ["user_id"], ["user_id"], "ts", "view_ts",
        "view_value", "previous_value", lead=TWO_HOURS,
    )
    enriched = trailing_sum(
        enriched, "user_id", "ts", "is_error", "trailing", source=errors_flagged(spark, sf_dir)
    )
    joined = J.bucket_join(enriched, per_bucket, "user_id", "ts", TWO_HOURS, lead=TWO_HOURS)
    return joined.select(
        "event_id",
        "user_id",
        "view_value",
        "Max_view_value",
        "Min_view_value",
        "previous_value",
        "trailing",
    )


def suppliers_by_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_nationkey", F.abs("s_acctbal").alias("distance"), "s_suppkey"
    )


@query("nearest_per_key", """
SELECT s_nationkey, abs(s_acctbal) AS distance, s_suppkey FROM supplier
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(s_acctbal), s_suppkey) = 1
""")
def nearest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.nearest_per_key(suppliers_by_distance(spark, sf_dir), "s_nationkey", "distance")


@query("nearest_lookup", """
WITH near AS (
  SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(s_acctbal), s_suppkey) = 1)
SELECT c_custkey, s_suppkey FROM customer LEFT JOIN near ON c_nationkey = s_nationkey
""")
def nearest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup table with repeated keys, reduced to one row a key before it is joined."""
    places = suppliers_by_distance(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    try:
        J.lookup_enrich(customers, places, "c_nationkey", "s_nationkey")
    except ValueError:
        places = J.nearest_per_key(places, "s_nationkey", "distance", columns=["s_nationkey", "s_suppkey"])
    joined = J.lookup_enrich(customers, places, "c_nationkey", "s_nationkey")
    return joined.select("c_custkey", "s_suppkey")


@query("nearest_with_ties", """
SELECT p_brand, p_size, p_partkey FROM part
QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size) = 1
""")
def nearest_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_partkey")
    nearest = J.nearest_per_key(parts, "p_brand", "p_size", keep_ties=True)
    return nearest.select("p_brand", "p_size", "p_partkey")


@query("lookup_enrich", """
SELECT s_suppkey, s_nationkey, n_name, n_regionkey
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3
""")
def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").filter("n_regionkey < 3")
    supplier = table(spark, sf_dir, "supplier")
    return J.lookup_enrich(supplier, nation, "s_nationkey", "n_nationkey").select(
        "s_suppkey", "s_nationkey", "n_name", "n_regionkey"
    )


@query("role_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey,
       o.n_name AS origin_n_name, o.n_regionkey AS origin_n_regionkey,
       d.n_name AS dest_n_name, d.n_regionkey AS dest_n_regionkey
FROM lineitem l
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation o ON o.n_nationkey = s_nationkey
LEFT JOIN nation d ON d.n_nationkey = c_nationkey
""")
def role_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    routes = line_routes(spark, sf_dir)
    both = J.role_join(routes, nation, "dest", "n_nationkey", "dest_")
    both = J.role_join(both, nation, "origin", "n_nationkey", "origin_")
    return both.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        "origin_n_name",
        "origin_n_regionkey",
        "dest_n_name",
        "dest_n_regionkey",
    )


def line_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the supplier nation as origin, the customer nation as dest."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origin")
    )
    destinations = orders.join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "dest"
    )
    return lines.join(destinations, "l_orderkey").join(supplier, "l_suppkey")


@query("keep_top_keys", """
SELECT event_id, user_id, value FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id
                  ORDER BY count(*) DESC, user_id LIMIT 15)
""")
def keep_top_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return J.keep_top_keys(events, "user_id", 15).select("event_id", "user_id", "value")


@query("two_sided_counts", """
SELECT n_nationkey,
       (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers,
       (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers
FROM nation
""")
def two_sided_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.aligned_counts(
        table(spark, sf_dir, "nation"),
        "n_nationkey",
        {
            "n_customers": (table(spark, sf_dir, "customer"), "c_nationkey"),
            "n_suppliers": (table(spark, sf_dir, "supplier"), "s_nationkey"),
        },
    )


@query("dedupe_latest", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
       epoch_us(max(o_orderdate)) // 1000000 AS last_order
FROM orders GROUP BY o_custkey
""")
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    return dedupe_latest(orders, ["o_custkey"], "o_orderdate").select(
        "o_custkey",
        "o_orderkey",
        "o_totalprice",
        F.unix_seconds("o_orderdate").alias("last_order"),
    )
