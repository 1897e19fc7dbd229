"""Encoding, scaling and row weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from skylattice.functions.temporal import day_of
from skylattice.session import lookup_join, materialize

def _check_categories(train: DataFrame, columns: Sequence[str], most: int | None) -> None:
    """Raise when a column has more than ``most`` values (None: any number is fine)."""
    if most is None:
        return
    counts = train.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if counts[c] > most]
    if wide:
        raise ValueError(f"too many categories in {', '.join(wide)}")


def fit_category_index(
    train: DataFrame,
    columns: Sequence[str],
    handle_invalid: str = "keep",
    max_categories: int | None = None,
) -> StringIndexerModel:
    """Category numbers by falling frequency, ties in alphabetical order.

    The model holds every value on the driver. ``max_categories`` makes wider
    columns an error; for those there are :func:`category_table`, which stays
    distributed, and :func:`hash_categories`, which needs no table.
    """
    _check_categories(train, columns, max_categories)
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_indexed" for c in columns],
        handleInvalid=handle_invalid,
    ).fit(train)


def category_table(train: DataFrame, column: str) -> DataFrame:
    """``column, idx``: the numbers of :func:`fit_category_index` as a table of any width.

    Values are counted and sorted by range; a value's number is its place in its
    partition after the rows of the partitions before it, so no task sees them all.
    """
    counted = (
        train.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias(column))
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.desc("__n"), column)
    )
    placed = materialize(counted.withColumn("__part", F.spark_partition_id()), "categories")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.desc("__n"), column)) - 1
    return (
        placed.join(F.broadcast(starts), "__part")  # one row per sort partition
        .select(column, (F.col("__start") + place).cast("double").alias("idx"))
    )


def index_by_table(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_indexed`` from category tables; null for unknown values."""
    for column, numbers in tables.items():
        keyed = df.withColumn("__value", F.col(column).cast("string"))
        renamed = numbers.select(
            F.col(column).alias("__value"), F.col("idx").alias(f"{column}_indexed")
        )
        df = lookup_join(keyed, renamed, ["__value"]).drop("__value")
    return df


def hash_categories(
    df: DataFrame, columns: Sequence[str], size: int, out: str = "hashed"
) -> DataFrame:
    """Add a vector of ``size`` entries that columns of any width are hashed into."""
    text = df.withColumns({f"__{c}": F.col(c).cast("string") for c in columns})
    hasher = FeatureHasher(
        inputCols=[f"__{c}" for c in columns], outputCol=out, numFeatures=size
    )
    return hasher.transform(text).drop(*[f"__{c}" for c in columns])


def feature_stages(
    categorical: Sequence[str],
    numeric: Sequence[str],
    handle_invalid: str = "keep",
    features: str = "features",
    scaled: str | None = "scaledFeatures",
) -> Pipeline:
    """Index, one-hot encode, assemble and scale.

    The last category is dropped, and columns are divided by their sample
    standard deviation without centring. Fit it on training rows only.
    """
    categorical, numeric = list(categorical), list(numeric)
    stages: list = []
    if categorical:
        stages += [
            StringIndexer(
                inputCols=categorical,
                outputCols=[f"{c}_indexed" for c in categorical],
                handleInvalid=handle_invalid,
            ),
            OneHotEncoder(
                inputCols=[f"{c}_indexed" for c in categorical],
                outputCols=[f"{c}_dummy" for c in categorical],
            ),
        ]
    stages.append(
        VectorAssembler(
            inputCols=[*[f"{c}_dummy" for c in categorical], *numeric],
            outputCol=features,
            handleInvalid="keep",
        )
    )
    if scaled is not None:
        stages.append(
            StandardScaler(inputCol=features, outputCol=scaled, withStd=True, withMean=False)
        )
    return Pipeline(stages=stages)


def fit_features(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    max_categories: int | None = None,
    **options,
) -> PipelineModel:
    """Fit :func:`feature_stages` on the training rows.

    ``max_categories`` is that of :func:`fit_category_index`.
    """
    if categorical:
        _check_categories(train, categorical, max_categories)
    return feature_stages(categorical, numeric, **options).fit(train)


def feature_names(df: DataFrame, vector: str = "features") -> DataFrame:
    """``idx, name, kind`` of every entry of an assembled vector."""
    return df.sparkSession.createDataFrame(
        [(a["idx"], a["name"], kind) for kind, a in vector_attributes(df, vector)],
        "idx int, name string, kind string",
    ).orderBy("idx")


def vector_attributes(df: DataFrame, vector: str) -> list[tuple[str, dict]]:
    """Kind and attribute of every vector entry, from the column metadata."""
    groups = df.schema[vector].metadata["ml_attr"]["attrs"]
    return [(kind, attribute) for kind, group in groups.items() for attribute in group]


def name_scaled(
    df: DataFrame, features: str = "features", scaled: str = "scaledFeatures"
) -> DataFrame:
    """Give the scaled vector the entry names and drop the unscaled one.

    All entries become numeric: a scaled 0/1 entry is no longer binary, and trees
    would take it for a category.
    """
    entries = sorted((a["idx"], a["name"]) for _, a in vector_attributes(df, features))
    attributes = [{"idx": i, "name": name} for i, name in entries]
    names = {"ml_attr": {"attrs": {"numeric": attributes}, "num_attrs": len(attributes)}}
    return df.withMetadata(scaled, names).drop(features)


def slice_features(
    df: DataFrame,
    names: Sequence[str],
    vector: str,
    out: str = "Features",
    named_by: str | None = None,
) -> DataFrame:
    """Keep the vector entries called ``names``.

    Names come from the metadata of ``named_by`` (a scaled vector carries none
    of its own), which must be laid out like ``vector``.
    """
    positions = {a["name"]: a["idx"] for _, a in vector_attributes(df, named_by or vector)}
    absent = [n for n in names if n not in positions]
    if absent:
        raise ValueError(f"no such features: {', '.join(absent)}")
    indices = sorted(positions[n] for n in names)
    return VectorSlicer(inputCol=vector, outputCol=out, indices=indices).transform(df)


def slice_by_index(
    df: DataFrame, indices: Sequence[int], vector: str, out: str = "Features"
) -> DataFrame:
    """Keep the vector entries at ``indices``."""
    return VectorSlicer(inputCol=vector, outputCol=out, indices=list(indices)).transform(df)


def add_weights(
    df: DataFrame,
    label: str,
    day: str,
    low: float = 0.3,
    high: float = 1.0,
    train: DataFrame | None = None,
) -> DataFrame:
    """Add class, recency and combined weights.

    ``weight`` is the share of negatives for positive rows and its complement
    for the others. ``normalized_log_weight`` grows from ``low`` to ``high``
    with the logarithm of the days since the first one. ``combined_weight`` is
    their product. All figures come from one pass over ``train`` (``df``).
    """
    stats = (train if train is not None else df).agg(
        _negative_share(label),
        F.min(day_of(day)).alias("first"),
        F.max(day_of(day)).alias("last"),
    ).first()
    return _recency(_class(df, label, stats["negatives"]), day, stats, low, high).withColumn(
        "combined_weight", F.col("weight") * F.col("normalized_log_weight")
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` alone."""
    share = df.agg(_negative_share(label)).first()
    return _class(df, label, share["negatives"])


def recency_weight(df: DataFrame, day: str, low: float = 0.3, high: float = 1.0) -> DataFrame:
    """Add ``date_index``, ``log_date_index`` and ``normalized_log_weight`` alone."""
    ends = df.agg(
        F.min(day_of(day)).alias("first"), F.max(day_of(day)).alias("last")
    ).first()
    return _recency(df, day, ends, low, high)


def _negative_share(label: str) -> Column:
    rows = F.count(F.lit(1))
    return F.try_divide(F.count_if(F.col(label) == 0), rows).alias("negatives")


def _class(df: DataFrame, label: str, negatives: float | None) -> DataFrame:
    if negatives is None:
        return df.withColumn("weight", F.lit(None).cast("double"))
    return df.withColumn(
        "weight", F.when(F.col(label) == 1, F.lit(negatives)).otherwise(F.lit(1 - negatives))
    )


def _recency(df: DataFrame, day: str, ends, low: float, high: float) -> DataFrame:
    # the logarithm of the index is smallest on the first day (0) and largest on the last
    span = F.log(F.datediff(F.lit(ends["last"]), F.lit(ends["first"])) + F.lit(1.0))
    indexed = df.withColumn(
        "date_index", F.datediff(day_of(day), F.lit(ends["first"]))
    ).withColumn("log_date_index", F.log(F.col("date_index") + F.lit(1.0)))
    if ends["first"] == ends["last"]:
        return indexed.withColumn("normalized_log_weight", F.lit(high))
    return indexed.withColumn(
        "normalized_log_weight",
        F.col("log_date_index") / span * F.lit(high - low) + F.lit(low),
    )
