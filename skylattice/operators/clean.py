"""Row and column cleaning, typing and imputation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import Column, DataFrame, functions as F

from skylattice.functions.casting import NUMBER, WHOLE, text_to
from skylattice.functions.temporal import day_of
from skylattice.operators.profile import null_profile

ALPHANUMERIC = r"^[A-Za-z0-9]+$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
DIGITS = r"^[0-9]+$"
DECIMAL = r"^\d+(\.\d+)?$"

CANDIDATE_TYPES = ("int", "bigint", "double", "timestamp")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column."""
    return df.dropDuplicates()


def sparse_columns(df: DataFrame, threshold: float = 99.0) -> list[str]:
    """Columns with at least ``threshold`` percent nulls."""
    rows = null_profile(df).filter(F.col("missing_pct") >= threshold).collect()
    return [r["column_name"] for r in rows]


def drop_sparse(
    df: DataFrame, threshold: float = 99.0, source: DataFrame | None = None
) -> DataFrame:
    """Drop the columns with at least ``threshold`` percent nulls.

    ``source`` is the frame whose nulls count, where ``df`` has only part of its rows.
    """
    return df.drop(*sparse_columns(df if source is None else source, threshold))


def reshape_columns(
    df: DataFrame,
    drop: Sequence[str] = (),
    keep: Sequence[str] | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Drop, then rename, then keep columns; names that do not exist are skipped."""
    result = df.drop(*drop).withColumnsRenamed(rename or {})
    if keep is None:
        return result
    return result.select(*[c for c in keep if c in result.columns])


def typed_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes null."""
    text = {c for c, t in df.dtypes if t == "string"}
    return df.withColumns(
        {
            c: text_to(c, t) if c in text else F.expr(f"try_cast(`{c}` AS {t})")
            for c, t in types.items()
        }
    )


def _number_level(column: str) -> Column:
    """3 for text that fits int, 2 for bigint, 1 for double only, else null."""
    text = F.col(f"`{column}`")

    def fits(type_name: str) -> Column:
        return F.expr(f"try_cast(`{column}` AS {type_name})").isNotNull()

    whole = F.when(fits("int"), 3).when(fits("bigint"), 2).when(fits("double"), 1)
    return F.when(text.rlike(WHOLE), whole).when(text.rlike(NUMBER) & fits("double"), 1)


def type_rates(
    df: DataFrame, columns: Sequence[str] | None = None, batch: int = 25
) -> DataFrame:
    """``column_name, type_name, rate``: share of non-null text that casts.

    One aggregation for every ``batch`` columns; rows are not multiplied, and a
    text is cast to the wider types only if it does not fit a narrower one. A
    column without values has no rows in the result.
    """
    columns = list(columns or [c for c, t in df.dtypes if t == "string"])
    levels = {"int": 3, "bigint": 2, "double": 1}
    parts = []
    for start in range(0, len(columns), batch):
        mine = columns[start : start + batch]
        aggregates, rows = [], []
        for i, c in enumerate(mine):
            level, value = _number_level(c), F.col(f"`{c}`")
            counts = {t: F.count_if(level >= low) for t, low in levels.items()}
            counts["timestamp"] = F.count(text_to(c, "timestamp"))
            aggregates += [F.count(value).alias(f"n{i}")]
            aggregates += [counts[t].alias(f"{t}{i}") for t in CANDIDATE_TYPES]
            rows += [
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("type_name"),
                    F.try_divide(F.col(f"{t}{i}"), F.col(f"n{i}")).alias("rate"),
                )
                for t in CANDIDATE_TYPES
            ]
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts).filter(F.col("rate").isNotNull())


def infer_types(
    df: DataFrame, columns: Sequence[str] | None = None, min_rate: float = 0.5
) -> dict[str, str]:
    """The type of each column that at least ``min_rate`` of its values fit.

    Every value counts, not just the first one, and the type is the narrowest
    that loses none of the numbers: a few stray texts, such as a suffix on a
    measure, become null in the cast. Columns that stay text, and columns
    without values, are absent.
    """
    chosen: dict[str, str] = {}
    rates: dict[tuple[str, str], float] = {
        (r["column_name"], r["type_name"]): r["rate"] for r in type_rates(df, columns).collect()
    }
    for c in dict.fromkeys(name for name, _ in rates):
        best = max(rates[(c, t)] for t in CANDIDATE_TYPES)
        if best >= min_rate and best > 0:
            chosen[c] = next(t for t in CANDIDATE_TYPES if rates[(c, t)] == best)
    return chosen


def coerce_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of a text in a fixed format, null when it does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def keep_labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows whose label is not null."""
    return df.filter(F.col(label).isNotNull())


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in ``columns``."""
    return df.dropna(subset=list(columns))


def fill_missing(
    df: DataFrame, values: dict[str, object] | float | str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace nulls by a constant per column, or by one for all columns of its type."""
    if isinstance(values, dict):
        return df.fillna(values)
    return df.fillna(values, subset=None if columns is None else list(columns))


def keep_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text matches the whole pattern."""
    return df.filter(F.col(column).cast("string").rlike(pattern))


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Random rows without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Rows of a fixed share of the keys; the same keys on every run and engine.

    The share is taken from the first 48 bits of the MD5 of the joined key text.
    """
    steps = 1_000_000
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return df.filter(number % steps < round(fraction * steps))


def fit_mean_imputer(train: DataFrame, columns: Sequence[str]) -> ImputerModel:
    """Means of the numeric columns of the training rows."""
    return Imputer(
        strategy="mean", inputCols=list(columns), outputCols=list(columns)
    ).fit(train)


def impute_mean(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of ``df`` with the means of ``train``.

    Integer columns keep their type, their mean is truncated.
    """
    return fit_mean_imputer(train, columns).transform(df)


def year_from_date(df: DataFrame, day: str, out: str = "YEAR") -> DataFrame:
    """Replace ``out`` by the year of ``day``."""
    return df.withColumn(out, F.year(day_of(day)))
