"""Readers and writers."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skylattice import session
from skylattice.operators.split import TRAIN, VALIDATION
from skylattice.sources import readers, schemas, writers


def test_parquet_refuses_to_overwrite_unasked(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_and_count(spark.range(5), path) == 5
    with pytest.raises(AnalysisException):
        writers.write_parquet(spark.range(3), path)
    assert writers.write_and_count(spark.range(3), path, overwrite=True) == 3


def test_partitioned_write_replaces_only_its_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    writers.write_partitioned(df, path, ["k"])
    writers.write_partitioned(spark.createDataFrame([(9, "b")], "id int, k string"), path, ["k"])
    got = {(r["id"], r["k"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "a"), (9, "b")}


def test_build_runs_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(4)

    assert readers.load_or_build(spark, path, build).count() == 4
    assert readers.load_or_build(spark, path, build).count() == 4
    assert len(calls) == 1


def test_other_errors_do_not_build(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        readers.load_or_build(spark, str(tmp_path / "t"), lambda: spark.range(4)).count()
    assert (tmp_path / "t" / "part.parquet").read_text() == "no parquet"


def test_numbered_fold_directories(spark, tmp_path):
    for i in (0, 1, 10):
        spark.range(i + 1).write.parquet(str(tmp_path / f"train_{i}_df"))
        spark.range(i + 2).write.parquet(str(tmp_path / f"val_{i}_df"))
    folds = readers.read_numbered_folds(spark, str(tmp_path))
    assert readers.fold_ids(folds) == [0, 1, 10]
    assert readers.fold_part(folds, 10, TRAIN).count() == 11
    assert readers.fold_part(folds, 1, VALIDATION).count() == 3


def test_one_fold_reads_one_directory(spark, tmp_path, capsys):
    path = str(tmp_path / "folds")
    df = spark.range(100).select(
        "id", (F.col("id") % 3).cast("int").alias("fold_id"), F.lit(TRAIN).alias("role")
    )
    writers.write_folds(df, path)
    part = readers.fold_part(readers.read_folds(spark, path), 1, TRAIN)
    assert part.columns == ["id"] and part.count() == 33
    part.explain("formatted")
    assert "PartitionFilters: [isnotnull(fold_id" in capsys.readouterr().out


def test_text_csv_with_header(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x"), (2, None)], "a int, b string").coalesce(1).write.option(
        "header", True
    ).option("compression", "gzip").csv(path)
    df = readers.read_text_csv(spark, path, partitions=3)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert df.rdd.getNumPartitions() == 3 and df.count() == 2


def test_source_schemas_parse(spark):
    for schema in (schemas.FLIGHTS, schemas.WEATHER, schemas.STATIONS, schemas.AIRPORTS):
        assert spark.createDataFrame([], schema).count() == 0


def test_persisted_frames_are_released(spark):
    df = spark.range(10)
    with session.persisted(df) as (kept,):
        assert kept.is_cached
    assert not df.is_cached


def test_broadcast_needs_a_measured_bound(spark):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("t"))
    assert session.fits_broadcast(df)
    assert not session.fits_broadcast(df, max_rows=99)
    assert not session.fits_broadcast(df, max_bytes=1000)


def test_materialized_frames_keep_vector_names(spark):
    from skylattice.operators.prep import feature_names, fit_features, name_scaled

    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, x double")
    named = name_scaled(fit_features(df, ["k"], ["x"]).transform(df))
    stored = session.materialize(named)
    assert [r["name"] for r in feature_names(stored, "scaledFeatures").collect()][-1] == "x"


def test_scratch_tables_go_with_their_scope(spark):
    import os

    with session.scratch_scope(spark) as made:
        stored = session.materialize(spark.range(10), "numbers")
        assert stored.count() == 10
        folders = [p.removeprefix("file:") for p in made]
        assert folders and all(os.path.isdir(f) for f in folders)
    assert not any(os.path.exists(f) for f in folders)


def test_shared_tables_outlive_a_scope(spark):
    from skylattice.queries.registry import stored_once

    def build():
        return session.materialize(spark.range(3), "shared")

    with session.scratch_scope(spark) as made:
        assert stored_once(spark, "nowhere", "shared", build).count() == 3
        assert not made
    assert stored_once(spark, "nowhere", "shared", build).count() == 3


def test_package_uses_no_local_temporary_folder():
    from pathlib import Path

    import skylattice

    sources = Path(skylattice.__file__).parent.rglob("*.py")
    assert not [p for p in sources if "tempfile" in p.read_text() or "localCheckpoint" in p.read_text()]
