"""Encoding, scaling, weights, splits and folds."""

from __future__ import annotations

from datetime import date

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators import prep as M, split as S
from skylattice.queries.registry import query
from skylattice.queries.tables import table

RANKED_TYPES = """
ranked AS (
  SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx
  FROM part GROUP BY p_type)
"""


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_type")


@query("index_categories", f"""
WITH {RANKED_TYPES}
SELECT p_partkey, p_type, CAST(idx AS DOUBLE) AS p_type_indexed FROM part JOIN ranked USING (p_type)
""")
def index_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = part_types(spark, sf_dir)
    return M.fit_category_index(parts, ["p_type"]).transform(parts)


@query("one_hot", f"""
WITH {RANKED_TYPES},
n AS (SELECT count(*) AS n FROM ranked)
SELECT p_partkey, CAST(n - 1 AS INT) AS width,
       CAST(CASE WHEN idx < n - 1 THEN idx ELSE -1 END AS INT) AS hot
FROM part JOIN ranked USING (p_type), n
""")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = part_types(spark, sf_dir)
    indexed = M.fit_category_index(parts, ["p_type"], handle_invalid="error").transform(parts)
    encoder = OneHotEncoder(inputCols=["p_type_indexed"], outputCols=["p_type_dummy"])
    dummy = encoder.fit(indexed).transform(indexed).withColumn(
        "dummy", vector_to_array("p_type_dummy")
    )
    return dummy.select(
        "p_partkey",
        F.size("dummy").alias("width"),
        (F.array_position("dummy", F.lit(1.0)) - 1).cast("int").alias("hot"),
    )


CUT_SQL = "TIMESTAMP '1999-01-01'"
NUMERIC = ["l_quantity", "l_discount", "l_tax"]


def scaled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an assembled and a scaled vector, fitted on early lines."""
    lines = table(spark, sf_dir, "lineitem")
    train = lines.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp"))
    return M.fit_features(train, ["l_linestatus"], NUMERIC).transform(lines)


@query("scale_std", f"""
WITH s AS (
  SELECT stddev_samp(l_quantity) AS q, stddev_samp(l_discount) AS d, stddev_samp(l_tax) AS t
  FROM lineitem WHERE l_shipdate < {CUT_SQL})
SELECT l_orderkey, l_linenumber, round(l_quantity / q, 6) AS l_quantity,
       round(l_discount / d, 6) AS l_discount, round(l_tax / t, 6) AS l_tax
FROM lineitem, s
""")
def scale_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scaled_lines(spark, sf_dir)
    numbers = M.slice_features(
        scaled, NUMERIC, "scaledFeatures", out="numbers", named_by="features"
    ).withColumn("numbers", vector_to_array("numbers"))
    return numbers.select(
        "l_orderkey",
        "l_linenumber",
        *[F.round(F.col("numbers")[i], 6).alias(c) for i, c in enumerate(NUMERIC)],
    )


@query("feature_names", f"""
WITH r AS (
  SELECT l_linestatus, row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS i
  FROM lineitem WHERE l_shipdate < {CUT_SQL} GROUP BY l_linestatus),
n AS (SELECT count(*) AS n FROM r)
SELECT CAST(i AS INT) AS idx, 'l_linestatus_dummy_' || l_linestatus AS name,
       'binary' AS kind FROM r
UNION ALL
SELECT CAST(n + j AS INT), c, 'numeric'
FROM n, (VALUES (0, 'l_quantity'), (1, 'l_discount'), (2, 'l_tax')) AS v(j, c)
""")
def feature_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.feature_names(scaled_lines(spark, sf_dir))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


WEIGHTS_SQL = """
o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus = 'F' AS label FROM orders),
w AS (SELECT count(*) FILTER (NOT label) / count(*) AS neg, min(d) AS lo, max(d) AS hi FROM o),
weights AS (
  SELECT o_orderkey, CASE WHEN label THEN neg ELSE 1 - neg END AS weight,
         CAST(date_diff('day', lo, d) AS INT) AS date_index,
         ln(date_diff('day', lo, d) + 1) AS log_date_index,
         ln(date_diff('day', lo, d) + 1) / ln(date_diff('day', lo, hi) + 1) * 0.7 + 0.3 AS recency
  FROM o, w)
"""


@query("class_weight", f"""
WITH {WEIGHTS_SQL} SELECT o_orderkey, round(weight, 8) AS weight FROM weights
""")
def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = M.class_weight(dated_orders(spark, sf_dir), "label")
    return weighted.select("o_orderkey", F.round("weight", 8).alias("weight"))


@query("recency_weight", f"""
WITH {WEIGHTS_SQL}
SELECT o_orderkey, date_index, round(log_date_index, 8) AS log_date_index,
       round(recency, 8) AS normalized_log_weight FROM weights
""")
def recency_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = M.recency_weight(dated_orders(spark, sf_dir), "o_orderdate")
    return weighted.select(
        "o_orderkey",
        "date_index",
        F.round("log_date_index", 8).alias("log_date_index"),
        F.round("normalized_log_weight", 8).alias("normalized_log_weight"),
    )


@query("combined_weight", f"""
WITH {WEIGHTS_SQL}
SELECT o_orderkey, round(weight * recency, 8) AS combined_weight FROM weights
""")
def combined_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = M.add_weights(dated_orders(spark, sf_dir), "label", "o_orderdate")
    return S.drop_bookkeeping(weighted).select(
        "o_orderkey", F.round("combined_weight", 8).alias("combined_weight")
    )


@query("drop_bookkeeping", f"""
WITH {WEIGHTS_SQL}
SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS o_orderdate,
       CAST(o_orderstatus = 'F' AS INT) AS label, round(weight, 8) AS weight,
       round(weight * recency, 8) AS combined_weight
FROM weights JOIN orders USING (o_orderkey)
""")
def drop_bookkeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column that is left beside the weights."""
    weighted = M.add_weights(dated_orders(spark, sf_dir), "label", "o_orderdate")
    return S.drop_bookkeeping(weighted).withColumns(
        {
            "o_orderdate": F.unix_seconds("o_orderdate"),
            "weight": F.round("weight", 8),
            "combined_weight": F.round("combined_weight", 8),
        }
    )


@query("slice_by_index", """
SELECT l_orderkey, l_linenumber, l_discount, l_quantity FROM lineitem
""")
def slice_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entries of the assembled vector, by place and in the order asked for."""
    lines = scaled_lines(spark, sf_dir)
    places = {a["name"]: a["idx"] for _, a in M.vector_attributes(lines, "features")}
    wanted = [places["l_discount"], places["l_quantity"]]
    part = M.slice_by_index(lines, wanted, "features", out="part")
    entries = vector_to_array("part")
    return part.select(
        "l_orderkey", "l_linenumber", entries[0].alias("l_discount"), entries[1].alias("l_quantity")
    )


@query("category_table", f"""
SELECT o_custkey, CAST(row_number() OVER (ORDER BY n DESC, o_custkey) - 1 AS DOUBLE) AS idx
FROM (SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, count(*) AS n FROM orders GROUP BY ALL)
""")
def category_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category numbers of a column with many values."""
    return M.category_table(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey")


FIRST, LAST = date(1995, 1, 1), date(2001, 8, 1)


def folds_sql(train_days: int, val_days: int, step: int) -> str:
    """Folds from arithmetic on the day number, not from a list of blocks."""
    return f"""
WITH o AS (SELECT o_orderkey, date_diff('day', DATE '{FIRST}', CAST(o_orderdate AS DATE)) AS d
           FROM orders),
f AS (SELECT CAST(unnest(range(100)) AS INT) AS fold_id),
b AS (SELECT fold_id, fold_id * {step} AS a FROM f
      WHERE fold_id * {step} + {train_days + val_days} <= date_diff('day', DATE '{FIRST}',
                                                                    DATE '{LAST}'))
SELECT o_orderkey, fold_id, CASE WHEN d < a + {train_days} THEN 'train' ELSE 'val' END AS role
FROM o JOIN b ON d >= a AND d < a + {train_days + val_days}"""


@query("block_folds", folds_sql(272, 100, 272))
def block_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = S.block_splits(FIRST, LAST, 272, 100)
    orders = dated_orders(spark, sf_dir)
    return S.assign_folds(orders, "o_orderdate", blocks).select("o_orderkey", "fold_id", "role")


@query("block_folds_disjoint", folds_sql(200, 92, 292))
def block_folds_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = S.block_splits(FIRST, LAST, 200, 92, overlap=False)
    orders = dated_orders(spark, sf_dir)
    return S.assign_folds(orders, "o_orderdate", blocks).select("o_orderkey", "fold_id", "role")


@query("trailing_holdout", """
WITH c AS (SELECT max(CAST(o_orderdate AS DATE)) - 100 AS cut FROM orders)
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= cut THEN 'train' ELSE 'val' END AS role
FROM orders, c
""")
def trailing_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = S.trailing_holdout(dated_orders(spark, sf_dir), "o_orderdate", 100)
    return early.select("o_orderkey", F.lit("train").alias("role")).unionByName(
        late.select("o_orderkey", F.lit("val").alias("role"))
    )


@query("year_split", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1999 THEN 'train' ELSE 'test' END AS role
FROM orders
""")
def year_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dated_orders(spark, sf_dir).withColumn("YEAR", F.year("o_orderdate"))
    train, test = S.year_split(orders, "YEAR", 1999)
    return train.select("o_orderkey", F.lit("train").alias("role")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("role"))
    )


@query("stitch_folds", f"""
WITH folds AS ({folds_sql(272, 100, 272)}),
last AS (SELECT max(fold_id) AS fold_id FROM folds),
held AS (SELECT o_orderkey FROM orders
         WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 100)
SELECT o_orderkey FROM folds, last WHERE role = 'train' OR folds.fold_id = last.fold_id
UNION SELECT o_orderkey FROM held
""")
def stitch_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dated_orders(spark, sf_dir)
    folds = S.assign_folds(orders, "o_orderdate", S.block_splits(FIRST, LAST, 272, 100))
    _, held = S.trailing_holdout(orders, "o_orderdate", 100)
    return S.stitch_folds(folds, ["o_orderkey"], held).select("o_orderkey")
