"""From the feature table to weighted, scaled training, validation and test rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from skylattice.operators.clean import fit_mean_imputer, year_from_date
from skylattice.operators.prep import (
    add_weights,
    fit_features,
    name_scaled,
    vector_attributes,  # noqa: F401  (names of the inputs, for callers)
)
from skylattice.operators.profile import numeric_columns
from skylattice.operators.split import (
    assign_folds,
    block_splits,
    trailing_holdout,
    year_split,
)
from skylattice.operators.stats import (
    collapsible_columns,
    correlation_matrix,
    label_correlation,
    weak_columns,
)
from skylattice.plans.columns import CATEGORICAL, LABEL
from skylattice.session import materialize

DELAY = "DEP_DELAY"
DAY = "FL_DATE"
# never an input: the label and the delay it is made from
NO_INPUT = [LABEL, DELAY]
# inputs that are not compared by correlation
NOT_COMPARED = ["OP_CARRIER_FL_NUM", "YEAR", "MONTH", "DAY_OF_WEEK"]


class ModelTables(NamedTuple):
    """Model rows, the stages fitted on the training rows, and what was left out."""

    train: DataFrame
    validation: DataFrame
    test: DataFrame
    features: PipelineModel
    empty: list[str]


def columns_with_values(train: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have a value in some row; one aggregation."""
    if not columns:
        return []
    counts = train.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def choose_features(
    train: DataFrame,
    strong: float = 0.95,
    weak: float = 0.01,
    keep: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> list[str]:
    """Numeric columns left after dropping extremes of averages and weak ones.

    The columns are compared with the departure delay. Those of ``NOT_COMPARED``
    stay without being compared, and those of ``keep`` are never weak.
    """
    columns = list(columns or numeric_columns(train, NO_INPUT))
    compared = [c for c in columns if c not in NOT_COMPARED]
    matrix = correlation_matrix(train, compared)
    dropped = set(collapsible_columns(matrix, strong)) - set(keep)
    rest = [c for c in compared if c not in dropped]
    dropped.update(weak_columns(label_correlation(train, DELAY, rest), weak, keep))
    return [c for c in columns if c not in dropped]


def prepare_model_tables(
    flights: DataFrame,
    test_year: int = 2019,
    holdout_days: int = 100,
    keep: Sequence[str] = (),
    categorical: Sequence[str] = CATEGORICAL,
    drop: Sequence[str] = (),
    carry: Sequence[str] = (),
    stored: bool = False,
) -> ModelTables:
    """Split, impute, select, encode, scale and weight.

    The rows before ``test_year`` without their last ``holdout_days`` are the
    training rows. Means, the choice of columns, category numbers, deviations
    and weights are taken from them alone, and neither label nor delay is
    imputed or used as a feature. Columns without a value there are left out and
    named in the result. ``drop`` names further columns to leave out, ``keep``
    those that correlation never drops, and ``carry`` those that come along
    beside the vector. Rows are stored, because every fit reads them, unless
    ``stored`` says that they are read from storage already; they are taken as
    they are, so remove repeated rows while they still have an identifier.
    """
    carried = [c for c in dict.fromkeys([DAY, "YEAR", LABEL, *carry])]
    rows = year_from_date(flights.drop(*drop), DAY)
    if not stored:
        rows = materialize(rows, "model_rows")
    before, _ = year_split(rows, "YEAR", test_year)
    early, _ = trailing_holdout(before, DAY, holdout_days)
    numeric = [c for c in numeric_columns(rows, NO_INPUT) if c not in categorical]
    valued = columns_with_values(early, numeric)
    present = columns_with_values(early, [c for c in categorical if c in rows.columns])
    imputer = fit_mean_imputer(early, valued)
    chosen = choose_features(imputer.transform(early), keep=keep, columns=valued)

    def inputs(part: DataFrame) -> DataFrame:
        originals = part.select("*", *[F.col(c).alias(f"__{c}") for c in carried])
        texts = {c: F.col(c).cast("string") for c in present}
        return imputer.transform(originals).withColumns(texts)

    fitted = fit_features(inputs(early), present, chosen)

    def vectors(part: DataFrame) -> DataFrame:
        named = name_scaled(fitted.transform(inputs(part)))
        return named.select(*[F.col(f"__{c}").alias(c) for c in carried], "scaledFeatures")

    train, test = year_split(rows, "YEAR", test_year)
    first, late = trailing_holdout(train, DAY, holdout_days)
    empty = [c for c in [*numeric, *categorical] if c in rows.columns and c not in (*valued, *present)]
    return ModelTables(
        add_weights(vectors(first), LABEL, DAY), vectors(late), vectors(test), fitted, empty
    )


def model_folds(
    train: DataFrame, first: date, last: date, train_days: int = 252, val_days: int = 100
) -> DataFrame:
    """Training rows in overlapping blocks of time."""
    return assign_folds(train, DAY, block_splits(first, last, train_days, val_days))
