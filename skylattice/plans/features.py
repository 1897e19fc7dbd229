"""Derived features of enriched flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.functions.dims import with_region
from skylattice.functions.holidays import days_to_nearest_holiday
from skylattice.functions.temporal import hhmm_hour
from skylattice.operators.clean import drop_null_rows, infer_types, typed_cast
from skylattice.operators.joins import asof_previous
from skylattice.operators.windows import trailing_sum
from skylattice.plans.columns import LABEL, LEAKAGE, STATION_RENAMES, UNINFORMATIVE
from skylattice.session import materialize, shuffles_dropped

HOUR = 3600
DEPARTURE = "sched_depart_date_time_UTC"


def clean_flights(enriched: DataFrame, min_rate: float = 0.5, stored: bool = False) -> DataFrame:
    """Rename, drop leakage columns and unlabelled rows, and type text columns.

    The rows are stored before their types are inferred, so that the joins they
    come from are worked out once; say ``stored`` if they are read from storage as
    they are.
    """
    named = enriched.withColumnsRenamed(STATION_RENAMES).drop(*LEAKAGE)
    labelled = drop_null_rows(named, [LABEL])
    text = [
        c for c, t in labelled.dtypes
        if t == "string" and c not in ("TAIL_NUM", "FL_DATE", "STATION")
    ]
    if not text:
        return labelled
    kept = labelled if stored else materialize(labelled, "labelled")
    return typed_cast(kept, infer_types(kept, text, min_rate))


def derive_features(flights: DataFrame, row_id: str | None = None) -> DataFrame:
    """Add the delay history, holiday, hour and region features; rows stay as they are.

    The flights are stored first, with a number per row, unless ``row_id`` names a
    column of flights read from storage that tells the rows apart; that column is
    dropped. Every history is taken from the stored rows. Only the columns it asks
    for pass through its joins and shuffles, the whole rows are joined once.
    """
    late = F.col(LABEL).cast("int").alias("__late")
    if row_id is None:
        row_id = "__row"
        numbered = flights.withColumn(row_id, F.monotonically_increasing_id())
        flights = materialize(numbered, "clean_flights")
    base = flights.select("*", late)
    asked = ["TAIL_NUM", "ORIGIN_AIRPORT_ID", "ORIGIN", "FL_DATE", DEPARTURE]
    result = asof_previous(
        base.select(row_id, *asked),
        base,
        ["TAIL_NUM", "ORIGIN_AIRPORT_ID"],
        ["TAIL_NUM", "DEST_AIRPORT_ID"],
        DEPARTURE,
        DEPARTURE,
        "DEP_DELAY",
        "previous_flight_delay",
        lead=2 * HOUR,
        left_day="FL_DATE",
        right_day="FL_DATE",
    )
    for entity, out in [
        ("TAIL_NUM", "Plane_Delays_last_24H"),
        ("ORIGIN", "airport_delays_in_previous_24_hours"),
    ]:
        result = trailing_sum(result, entity, DEPARTURE, "__late", out, source=base)
    history = [c for c in result.columns if c not in asked]
    spark = flights.sparkSession
    with shuffles_dropped(spark):
        histories = materialize(result.select(*history), "histories")
    added = [c for c in history if c != row_id]
    plain = [c for c in flights.columns if c not in (row_id, *added)]
    result = flights.join(histories, row_id).select(*plain, *[histories[c] for c in added])
    result = with_region(result, "ORIGIN_STATE_ABR")
    result = days_to_nearest_holiday(result, "FL_DATE", source=base)
    return result.withColumn("CRS_DEP_HOUR", hhmm_hour(F.col("CRS_DEP_TIME"))).withColumn(
        "CRS_ARR_HOUR", hhmm_hour(F.col("CRS_ARR_TIME"))
    )


def drop_uninformative(flights: DataFrame) -> DataFrame:
    """Drop text, identifier and time columns that are no model input."""
    return flights.drop(*UNINFORMATIVE)
