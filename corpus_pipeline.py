"""From raw documents to packed sequences, one operator a stage.

Quality rules drop documents, line dedup shortens texts, SimHash keeps one
document of each group of near copies, decontamination drops documents with a
benchmark window, and packing lays the rest out in sequences. Every stage works
on all rows its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from skylattice.session import materialize
from skylattice.sources.readers import read_parquet


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three-line windows; ``n_chars`` follows the text."""
    shorter = line_dedup.dedup_lines(docs, size=3)
    changed = F.col("n_removed") > 0
    return shorter.withColumn(
        "n_chars",
        F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")),
    ).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    items = read_parquet(spark, f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items, size=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        capacity=1024,
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_free),
    ("packing", packed),
]

#: Compression, XXH64 and tokenizers are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again but the last."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
