"""Session helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

_open_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share.

    It is the session's checkpoint folder, else the one that
    ``spark.checkpoint.dir`` names. A local session without either uses its
    warehouse; a cluster without either is an error, because executors do not
    share a local disk. What is written there goes when the application ends.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        sc.setCheckpointDir(folder)
        path = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return sc.getCheckpointDir()


def _delete(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the intermediate tables written inside the block when it ends.

    Frames that read them are of no use afterwards, so write results inside.
    """
    made: list[str] = []
    token = _open_scope.set(made)
    try:
        yield made
    finally:
        _open_scope.reset(token)
        for folder in made:
            _delete(spark, folder)


@contextmanager
def outside_scopes() -> Iterator[None]:
    """What is written inside the block stays until the application ends."""
    token = _open_scope.set(None)
    try:
        yield
    finally:
        _open_scope.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``, for small state that a loop carries from round to round."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` in the checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    made = _open_scope.get()
    if made is not None:
        made.append(folder)
    return f"{folder}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the checkpoint folder and continue from there.

    For results that are read more than once: they are computed one time, later
    passes read only their columns, and a lost executor costs a file read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block a query's shuffle files go when the query ends.

    Otherwise they stay until the driver happens to collect the plan, so a flow of
    many stored steps holds the shuffles of all of them on disk.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def distil(
    spark: SparkSession, build: Callable[[], DataFrame], name: str, row_id: str | None = None
) -> DataFrame:
    """Store what ``build`` makes; the tables and shuffles it wrote on the way go then.

    ``row_id`` names a column to add that tells the stored rows apart.
    """
    path = scratch_path(spark, name)
    with shuffles_dropped(spark), scratch_scope(spark):
        df = build()
        if row_id is not None:
            df = df.withColumn(row_id, F.monotonically_increasing_id())
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, keys: Sequence[str] = ()) -> Row:
    """``n`` rows, ``b`` bytes as text and, if ``keys`` are given, ``k`` distinct ones; one job."""
    figures = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b"),
    ]
    if keys:
        figures.append(F.count_distinct(F.struct(*keys)).alias("k"))
    return df.agg(*figures).first()


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the measured rows and text-encoded bytes are within the bounds."""
    size = measured(df)
    return size["n"] <= max_rows and size["b"] <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within the bounds.

    A larger table is returned unmarked, so the join falls back to a shuffle
    join, whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def left_join_spread(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left equi-join on ``keys`` that does not pile null keys into one task.

    A null key matches nothing, yet a shuffle would send every such row to the
    same partition. An extra key, 0 on both sides for real keys and a hash of
    ``spread_by`` for null keys, spreads them. By default the hash takes every
    plain column; name some, an identifier for instance, where later steps want
    few columns read. It depends on row values only, so a retried task repeats it.
    """
    keys = list(keys)
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    if spread_by is None:
        spread_by = [f.name for f in left.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in spread_by or keys])
    salted_left = left.withColumn(
        "__spread", F.when(has_null, spread).otherwise(F.lit(0).cast("bigint"))
    )
    # always 0, but not as a literal: the optimizer would take a literal out of the join keys
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))
    salted_right = right.withColumn("__spread", zero)
    joined = salted_left.join(salted_right, keys + ["__spread"], "left")
    added = [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *added)


def repeated_keys(dim: DataFrame, keys: Sequence[str], at_most: int = 5) -> list[tuple]:
    """Some of the key values that occur more than once, none if keys are unique."""
    rows = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return [tuple(r[k] for k in keys) for r in rows.limit(at_most).collect()]


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    unique: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Left equi-join of a dimension, broadcast when its measured size allows it.

    The dimension is stored first, so measuring it does not work it out twice;
    say ``stored`` if it is read from a stored table as it is. With ``unique`` a
    repeated key, which would multiply fact rows, is an error.
    """
    if not stored:
        dim = materialize(dim, "dimension")
    size = measured(dim, keys if unique else ())
    if unique and size["k"] < size["n"]:
        found = repeated_keys(dim, keys)
        raise ValueError(f"lookup keys {list(keys)} are not unique: {found}")
    if size["n"] <= max_rows and size["b"] <= max_bytes:
        added = [c for c in dim.columns if c not in keys]
        joined = fact.join(F.broadcast(dim), list(keys), "left")
        return joined.select(*fact.columns, *added)
    return left_join_spread(fact, dim, keys)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep ``frames`` in memory or on disk inside the block."""
    kept = tuple(f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames)
    try:
        yield kept
    finally:
        for f in kept:
            f.unpersist(blocking=True)
