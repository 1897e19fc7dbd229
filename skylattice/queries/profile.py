"""Profiles and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import profile as P
from skylattice.operators.ranks import exact_quantiles
from skylattice.queries.registry import query
from skylattice.queries.tables import OTHERS, SCHEMAS, stored_table, table
from skylattice.session import scratch_path


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls, NaN and sentinel text put in by rule."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 17 == 0, F.lit(float("nan")))
        .when(key % 19 != 0, F.col("o_totalprice"))
        .alias("o_totalprice"),
        F.when(key % 11 == 0, F.lit(""))
        .when(key % 13 == 0, F.lit("None given"))
        .when(key % 23 == 0, F.lit("NULL"))
        .when(key % 5 != 0, F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.when(key % 200 == 0, F.col("o_orderstatus")).alias("o_note"),
    )


MESSY_SQL = """
messy AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 17 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'None given'
         WHEN o_orderkey % 23 = 0 THEN 'NULL'
         WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderkey % 200 = 0 THEN o_orderstatus END AS o_note
  FROM orders)
"""

MESSY_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_totalprice": "double",
    "o_orderpriority": "string",
    "o_note": "string",
}


def missing_sql(conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{MESSY_TYPES[c]}' AS data_type, "
        f"CAST(count(*) FILTER ({condition}) AS BIGINT) AS n_missing, "
        f"round(count(*) FILTER ({condition}) / count(*) * 100, 8) AS missing_pct FROM messy"
        for c, condition in conditions.items()
    )


NULLS = {c: f"{c} IS NULL" for c in MESSY_TYPES}
NULLS_OR_NAN = {**NULLS, "o_totalprice": "o_totalprice IS NULL OR isnan(o_totalprice)"}
SENTINELS = {
    **NULLS_OR_NAN,
    **{
        c: f"{c} IS NULL OR {c} = '' OR contains({c}, 'None') OR contains({c}, 'NULL')"
        for c in ("o_orderpriority", "o_note")
    },
}


def rounded(profile: DataFrame) -> DataFrame:
    return profile.withColumn("missing_pct", F.round("missing_pct", 8))


@query("null_profile", f"WITH {MESSY_SQL} {missing_sql(NULLS)}")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.null_profile(messy_orders(spark, sf_dir)))


@query("null_or_nan_profile", f"WITH {MESSY_SQL} {missing_sql(NULLS_OR_NAN)}")
def null_or_nan_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.null_profile(messy_orders(spark, sf_dir), treat_nan=True))


@query("null_profile_sentinels", f"WITH {MESSY_SQL} {missing_sql(SENTINELS)}")
def null_profile_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = messy_orders(spark, sf_dir)
    return rounded(P.null_profile(messy, treat_nan=True, sentinels=["None", "NULL"]))


@query("missing_proportion", f"""
WITH {MESSY_SQL}
SELECT column_name, round(missing_pct / 100, 2) AS proportion FROM ({missing_sql(NULLS)})
WHERE column_name IN ('o_custkey', 'o_totalprice')
""")
def missing_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.missing_proportion(messy_orders(spark, sf_dir), ["o_custkey", "o_totalprice"])


@query("first_values", f"""
WITH {MESSY_SQL}
SELECT 'o_orderpriority' AS column_name,
       (SELECT o_orderpriority FROM messy WHERE o_orderpriority IS NOT NULL
        ORDER BY o_orderkey LIMIT 1) AS first_value
UNION ALL
SELECT 'o_note', (SELECT o_note FROM messy WHERE o_note IS NOT NULL ORDER BY o_orderkey LIMIT 1)
""")
def first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = messy_orders(spark, sf_dir)
    return P.first_values(messy, ["o_orderpriority", "o_note"], "o_orderkey")


@query("dup_profile", """
WITH k AS (SELECT count(*) AS n FROM lineitem),
d AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT 'Total Row Count' AS metric, CAST(k.n AS BIGINT) AS value FROM k
UNION ALL SELECT 'Distinct Row Count', d.n FROM d
UNION ALL SELECT 'Duplicate Row Count', k.n - d.n FROM k, d
""")
def dup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return P.duplicate_profile(lines)


@query("table_sizes", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INT) AS n_columns FROM {t}"
    for t in [*SCHEMAS, *OTHERS]
))
def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table_sizes({t: stored_table(spark, sf_dir, t) for t in [*SCHEMAS, *OTHERS]})


@query("stored_bytes", """
SELECT CAST(1 AS BIGINT) AS n_files, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS n_bytes FROM customer
""")
def stored_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a text file with one customer name a line."""
    path = scratch_path(spark, "names")
    table(spark, sf_dir, "customer").select("c_name").coalesce(1).write.text(path)
    return P.stored_bytes(spark, path)


@query("estimated_bytes", """
SELECT 'orders' AS table_name, TRUE AS wide_exceeds_narrow, count(*) AS n_rows FROM orders
""")
def estimated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The optimizer expects less of one column than of all."""
    orders = stored_table(spark, sf_dir, "orders")
    narrow = P.estimated_bytes(orders.select("o_orderkey"))
    wide = P.estimated_bytes(orders)
    return orders.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("orders").alias("table_name"), F.lit(wide > narrow > 0).alias("wide_exceeds_narrow"), "n_rows"
    )


@query("column_sources", """
SELECT column_name, CASE WHEN column_name LIKE 'o!_%' ESCAPE '!' THEN 'orders'
                         WHEN column_name LIKE 'l!_%' ESCAPE '!' THEN 'lineitem'
                         ELSE 'created' END AS source
FROM (DESCRIBE SELECT *, 1 AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
""")
def column_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which table each column of a join comes from."""
    orders, lines = (stored_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("n_lines", F.lit(1))
    return P.column_sources(joined, {"orders": orders, "lineitem": lines})


@query("assert_columns", "SELECT n_name, n_regionkey FROM nation")
def assert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that has the required columns passes as it is; another one does not."""
    nation = stored_table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    try:
        P.assert_columns(nation, ["n_name", "n_population"])
    except ValueError:
        return P.assert_columns(nation, ["n_name", "n_regionkey"])
    raise AssertionError("a missing column was not noticed")


@query("schema_diff", """
SELECT column_name, bool_or(table_name = 'orders') AS in_orders,
       bool_or(table_name = 'order_lines') AS in_order_lines,
       bool_or(table_name = 'labelled') AS in_labelled
FROM (
  SELECT column_name, 'orders' AS table_name FROM (DESCRIBE orders)
  UNION ALL SELECT column_name, 'order_lines' FROM (
    DESCRIBE SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  UNION ALL SELECT column_name, 'labelled' FROM (
    DESCRIBE SELECT *, o_orderstatus = 'F' AS label FROM orders))
GROUP BY column_name
""")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stored_table(spark, sf_dir, "orders")
    lines = stored_table(spark, sf_dir, "lineitem")
    return P.schema_diff(
        {
            "orders": orders,
            "order_lines": lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")),
            "labelled": orders.withColumn("label", F.col("o_orderstatus") == "F"),
        }
    )


SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("summary_statistics", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in SUMMARY_COLUMNS
))
def summary_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = P.summary_statistics(table(spark, sf_dir, "lineitem"), SUMMARY_COLUMNS)
    return stats.select(
        "column_name",
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.col("min").cast("double").alias("min"),
        F.col("max").cast("double").alias("max"),
    )


@query("numeric_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, TRUE AS median_in_bounds FROM lineitem"
    for c in ["l_quantity", "l_extendedprice"]
))
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, deviation, and whether the approximate median keeps its rank bound."""
    columns, accuracy = ["l_quantity", "l_extendedprice"], 10_000
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    summary = P.numeric_summary(lines, columns, accuracy)
    bounds = None
    for c in columns:
        ends = exact_quantiles(lines, c, [0.5 - 1 / accuracy, 0.5 + 1 / accuracy]).select(
            F.lit(c).alias("column_name"), "q0", "q1"
        )
        bounds = ends if bounds is None else bounds.unionByName(ends)
    return summary.join(bounds, "column_name").select(
        "column_name",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.col("median").between(F.col("q0"), F.col("q1")).alias("median_in_bounds"),
    )


RANKED_EVENTS = """
r AS (
  SELECT event_type, value,
         row_number() OVER (PARTITION BY event_type ORDER BY value) AS i,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM events WHERE value > 0)
"""


def at_rank(p: float) -> str:
    return f"max(value) FILTER (i = greatest(CAST(ceil({p} * n) AS BIGINT), 1))"


@query("box_stats", f"""
WITH {RANKED_EVENTS}
SELECT event_type, max(n) AS n, {at_rank(0.0)} AS low, {at_rank(0.25)} AS q1,
       {at_rank(0.5)} AS median, {at_rank(0.75)} AS q3, {at_rank(1.0)} AS high
FROM r GROUP BY event_type
""")
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.box_statistics(table(spark, sf_dir, "events"), "event_type", "value")


@query("exact_quantiles", f"""
WITH {RANKED_EVENTS}
SELECT event_type, max(n) AS n, {at_rank(0.01)} AS q0, {at_rank(0.333)} AS q1,
       {at_rank(0.999)} AS q2
FROM r GROUP BY event_type
""")
def grouped_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles per group over many small value ranges."""
    events = table(spark, sf_dir, "events").filter("value > 0")
    return exact_quantiles(
        events, "value", [0.01, 0.333, 0.999], by=["event_type"], cell_rows=500
    )


@query("iqr_outliers", """
WITH r AS (
  SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events),
q AS (
  SELECT max(value) FILTER (i = CAST(ceil(0.25 * n) AS BIGINT)) AS q1,
         max(value) FILTER (i = CAST(ceil(0.75 * n) AS BIGINT)) AS q3 FROM r)
SELECT count(*) AS n_outliers, min(value) AS min_outlier, max(value) AS max_outlier
FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
""")
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = P.iqr_outliers(table(spark, sf_dir, "events").select("value"), "value")
    return outside.agg(
        F.count(F.lit(1)).alias("n_outliers"),
        F.min("value").alias("min_outlier"),
        F.max("value").alias("max_outlier"),
    )
