"""Deduplication, typing, filters and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import clean as C
from skylattice.queries.profile import MESSY_SQL, messy_orders
from skylattice.queries.registry import query
from skylattice.queries.tables import table


@query("drop_sparse", f"""
WITH {MESSY_SQL}
SELECT o_orderkey, o_custkey, CASE WHEN isnan(o_totalprice) THEN -1 ELSE o_totalprice END
       AS o_totalprice, o_orderpriority FROM messy
""")
def drop_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = C.drop_sparse(messy_orders(spark, sf_dir))
    return kept.withColumn(
        "o_totalprice",
        F.when(F.isnan("o_totalprice"), F.lit(-1.0)).otherwise(F.col("o_totalprice")),
    )


@query("dedupe_full", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.dedupe_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query("reshape_columns", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
""")
def reshape_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reshape_columns(
        table(spark, sf_dir, "orders"),
        drop=["o_orderstatus", "no_such_column"],
        rename={"o_orderkey": "order_id", "o_custkey": "customer_id"},
        keep=["order_id", "customer_id", "o_orderstatus"],
    )


# no number, no number though the JVM reads one, and a number
SUFFIXES = ["s", "d", "f", "e1"]


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every column as text, some numbers with stray letters."""
    key, k = F.col("event_id"), F.get_json_object("props", "$.k")
    suffix = F.element_at(F.array(*[F.lit(x) for x in SUFFIXES]), (key % 10 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        k.alias("whole"),
        F.col("value").cast("string").alias("number"),
        F.when(key % 10 < 4, F.concat(k, suffix)).when(key % 11 != 0, k).alias("dirty"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(key % 9 == 0, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("day"),
        "event_type",
    )


TEXT_SQL = """
texts AS (
  SELECT event_id, json_extract_string(props, '$.k') AS whole,
         CAST(value AS VARCHAR) AS number,
         CASE WHEN event_id % 10 < 4
              THEN json_extract_string(props, '$.k') || (['s', 'd', 'f', 'e1'])[event_id % 10 + 1]
              WHEN event_id % 11 <> 0 THEN json_extract_string(props, '$.k') END AS dirty,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment,
         CASE WHEN event_id % 9 = 0 THEN strftime(ts, '%d/%m/%Y')
              ELSE strftime(ts, '%Y-%m-%d') END AS day,
         event_type
  FROM events)
"""
TEXT_COLUMNS = ["whole", "number", "dirty", "moment", "event_type"]
TYPE_PATTERNS = {
    "int": r"[0-9]+",
    "bigint": r"[0-9]+",
    "double": r"[0-9]+(\.[0-9]+)?(e[0-9]+)?",
    "timestamp": r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
}


@query("infer_types", f"WITH {TEXT_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type_name, "
    f"round(avg(CASE WHEN regexp_full_match({c}, '{p}') THEN 1.0 ELSE 0.0 END) "
    f"FILTER ({c} IS NOT NULL), 8) AS rate FROM texts"
    for c in TEXT_COLUMNS for t, p in TYPE_PATTERNS.items()
))
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = C.type_rates(text_events(spark, sf_dir), TEXT_COLUMNS)
    return rates.withColumn("rate", F.round("rate", 8))


@query("typed_cast", f"""
WITH {TEXT_SQL}
SELECT event_id, CAST(whole AS INT) AS whole, CAST(number AS DOUBLE) AS number,
       TRY_CAST(dirty AS DOUBLE) AS dirty,
       epoch_us(CAST(moment AS TIMESTAMP)) // 1000000 AS moment,
       CASE WHEN event_id % 9 <> 0 THEN CAST(CAST(day AS DATE) AS VARCHAR) END AS day
FROM texts
""")
def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = text_events(spark, sf_dir)
    types = C.infer_types(texts, ["whole", "number", "moment"])
    typed = C.typed_cast(texts, {**types, "dirty": "double"})
    return typed.select(
        "event_id",
        "whole",
        "number",
        "dirty",
        F.unix_seconds("moment").alias("moment"),
        C.coerce_date(F.col("day")).cast("string").alias("day"),
    )


@query("regex_keep", """
SELECT p_partkey, label FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type END AS label FROM part)
WHERE regexp_full_match(label, '[A-Za-z0-9]+')
""")
def regex_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_type"))
    parts = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    return C.keep_matching(parts, "label", C.ALPHANUMERIC)


@query("regex_decimal", f"""
WITH {TEXT_SQL} SELECT event_id, dirty FROM texts
WHERE regexp_full_match(dirty, '\\d+(\\.\\d+)?')
""")
def regex_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = text_events(spark, sf_dir).select("event_id", "dirty")
    return C.keep_matching(texts, "dirty", C.DECIMAL)


@query("regex_date", f"""
WITH {TEXT_SQL} SELECT event_id, day FROM texts WHERE event_id % 9 <> 0
""")
def regex_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = text_events(spark, sf_dir).select("event_id", "day")
    return C.keep_matching(texts, "day", C.ISO_DATE)


@query("null_rows", f"""
WITH {MESSY_SQL}
SELECT o_orderkey, o_custkey, coalesce(o_orderpriority, '') AS o_orderpriority FROM messy
WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
""")
def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = C.drop_null_rows(messy_orders(spark, sf_dir), ["o_custkey", "o_totalprice"])
    return C.fill_missing(whole, {"o_orderpriority": ""}).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )


@query("fill_numbers", f"""
WITH {MESSY_SQL}
SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey,
       CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) THEN -1.0::DOUBLE ELSE o_totalprice END
         AS o_totalprice,
       o_orderpriority
FROM messy
""")
def fill_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One number for all numeric columns; text keeps its nulls, NaN counts as missing."""
    return C.fill_missing(messy_orders(spark, sf_dir), -1).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


@query("keep_labelled", f"""
WITH {MESSY_SQL} SELECT o_orderkey, o_custkey FROM messy WHERE o_custkey IS NOT NULL
""")
def keep_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = messy_orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    return C.keep_labelled(labelled, "o_custkey")


@query("row_filter", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE year(o_orderdate) = 1995 AND month(o_orderdate) < 4
  AND o_orderstatus IN ('O', 'F') AND o_totalprice > 0
""")
def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a date range instead of year() and month() lets the scan skip row groups
    first = F.lit("1995-01-01").cast("timestamp")
    end = F.lit("1995-04-01").cast("timestamp")
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < end))
        .filter(F.col("o_orderstatus").isin("O", "F") & (F.col("o_totalprice") > 0))
        .select("o_orderkey", "o_totalprice")
    )


@query("row_sample", """
SELECT event_type, count(*) AS n_events, CAST(0 AS BIGINT) AS n_repeated,
       CAST(0 AS BIGINT) AS n_strangers, TRUE AS share_is_close
FROM events GROUP BY event_type
""")
def row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type: sampled rows are rows of the table, none twice, and about the share asked for."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    drawn = C.sample_rows(events, 0.1, seed=1).groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))
    both = events.withColumn("known", F.lit(True)).join(drawn, "event_id", "full")
    taken = F.count("times")
    expected = F.lit(0.1) * F.count("known")
    return (
        both.groupBy("event_type")
        .agg(
            F.count("known").alias("n_events"),
            F.count_if(F.col("times") > 1).alias("n_repeated"),
            F.count_if(F.col("known").isNull()).alias("n_strangers"),
            (F.abs(taken - expected) <= 5 * F.sqrt(expected) + 5).alias("share_is_close"),
        )
    )


@query("hash_sample", """
SELECT event_id, user_id FROM events
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 12) AS BIGINT) % 1000000 < 100000
""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return C.sample_by_key(events, ["event_id"], 0.1)


@query("impute_mean", """
WITH o AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS price,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 50 AS INT) END AS quantity
  FROM orders),
m AS (SELECT avg(price) AS price, avg(quantity) AS quantity FROM o
      WHERE o_orderdate < TIMESTAMP '1999-01-01')
SELECT o_orderkey, round(coalesce(o.price, m.price), 4) AS price,
       coalesce(o.quantity, CAST(trunc(m.quantity) AS INT)) AS quantity,
       CAST(year(o_orderdate) AS INT) AS "YEAR"
FROM o, m
""")
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.when(key % 6 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 4 != 0, (F.col("o_custkey") % 50).cast("int")).alias("quantity"),
    )
    train = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
    filled = C.impute_mean(orders, train, ["price", "quantity"])
    return C.year_from_date(filled, "o_orderdate").select(
        "o_orderkey", F.round("price", 4).alias("price"), "quantity", "YEAR"
    )
