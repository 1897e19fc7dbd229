"""Round trips through the sinks and sources."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators.profile import null_profile
from skylattice.operators.split import TRAIN, VALIDATION, assign_folds, block_splits
from skylattice.queries.prep import FIRST, LAST, dated_orders, folds_sql
from skylattice.queries.registry import query
from skylattice.queries.tables import SCHEMAS, table
from skylattice.session import persisted, scratch_path
from skylattice.sources import readers, writers


@query("parquet_round_trip", """
SELECT p_partkey, p_name, p_size, p_retailprice FROM part
""")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part")
    writers.write_parquet(table(spark, sf_dir, "part"), path)
    stored = readers.read_parquet(spark, path, SCHEMAS["part"])
    return stored.select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("csv_round_trip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, SCHEMAS["customer"])


@query("gzip_csv_as_text", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR)
       AS c_nationkey, c_mktsegment FROM customer
""")
def gzip_csv_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer")
    customer = table(spark, sf_dir, "customer").drop("c_acctbal")
    customer.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_text_csv(spark, path, columns=customer.columns, partitions=8)


@query("partitioned_write", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       strftime(o_orderdate, '%Y-%m-01') AS order_month
FROM orders
""")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in one directory per month, read back."""
    path = scratch_path(spark, "orders")
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("o_orderdate"), F.trunc(day, "month").alias("order_month")
    )
    writers.write_partitioned(orders, path, ["order_month"])
    stored = spark.read.parquet(path)
    return stored.select(
        "o_orderkey", *[F.col(c).cast("string").alias(c) for c in ("o_orderdate", "order_month")]
    )


@query("folds_round_trip", f"""
SELECT o_orderkey, fold_id, role FROM ({folds_sql(272, 100, 272)})
""")
def folds_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds written by part, and every part read back on its own."""
    path = scratch_path(spark, "folds")
    blocks = block_splits(FIRST, LAST, 272, 100)
    folds = assign_folds(dated_orders(spark, sf_dir), "o_orderdate", blocks)
    writers.write_folds(folds, path)
    stored = readers.read_folds(spark, path)
    parts = [
        readers.fold_part(stored, i, role).select(
            "o_orderkey", F.lit(i).alias("fold_id"), F.lit(role).alias("role")
        )
        for i in readers.fold_ids(stored)
        for role in (TRAIN, VALIDATION)
    ]
    return reduce(DataFrame.unionByName, parts)


@query("numbered_folds", f"""
SELECT o_orderkey, fold_id, role FROM ({folds_sql(272, 100, 272)})
""")
def numbered_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds written to a directory per number and role, and read back together."""
    path = scratch_path(spark, "numbered")
    blocks = block_splits(FIRST, LAST, 272, 100)
    folds = assign_folds(dated_orders(spark, sf_dir), "o_orderdate", blocks)
    for i in range(len(blocks)):
        for role in (TRAIN, VALIDATION):
            writers.write_parquet(readers.fold_part(folds, i, role), f"{path}/{role}_{i}_df")
    return readers.read_numbered_folds(spark, path).select("o_orderkey", "fold_id", "role")


@query("stored_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")
))
def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile built on the first call and read back on the second."""
    path = scratch_path(spark, "profile")

    def build() -> DataFrame:
        return null_profile(table(spark, sf_dir, "orders"))

    readers.load_or_build(spark, path, build)
    return readers.load_or_build(spark, path, build).select("column_name", "n_missing")


@query("stored_row_count", "SELECT count(*) AS n_rows FROM supplier")
def stored_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "supplier")
    n = writers.write_and_count(table(spark, sf_dir, "supplier"), path)
    return spark.createDataFrame([(n,)], "n_rows bigint")


@query("persisted_profile", """
SELECT n_rows, n_customers FROM (SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers
                                 FROM orders WHERE o_totalprice > 1000)
""")
def persisted_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two figures of one filtered table, which is kept while both are taken."""
    dear = table(spark, sf_dir, "orders").filter("o_totalprice > 1000").select("o_custkey")
    with persisted(dear) as (kept,):
        n_rows = kept.count()
        n_customers = kept.agg(F.count_distinct("o_custkey")).first()[0]
    return spark.createDataFrame([(n_rows, n_customers)], "n_rows bigint, n_customers bigint")


@query("view_for_sql", """
SELECT n_regionkey, count(*) AS n_nations FROM nation GROUP BY n_regionkey
""")
def view_for_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"nation_{uuid.uuid4().hex}"
    table(spark, sf_dir, "nation").createOrReplaceTempView(view)
    try:
        return spark.sql(
            f"SELECT n_regionkey, count(*) AS n_nations FROM {view} GROUP BY n_regionkey"
        )
    finally:
        spark.catalog.dropTempView(view)
