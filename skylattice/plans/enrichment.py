"""Flights joined to airports, stations, route ranks and earlier weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skylattice.functions.casting import text_to
from skylattice.functions.dims import with_time_zone
from skylattice.functions.temporal import day_of, local_timestamp, local_to_utc, shifted
from skylattice.operators.clean import dedupe_rows, drop_sparse, keep_labelled
from skylattice.operators.graph import with_page_rank
from skylattice.operators.joins import (
    bucket_join,
    bucket_statistics,
    lookup_enrich,
    nearest_per_key,
    role_join,
)
from skylattice.operators.windows import dedupe_latest
from skylattice.plans.columns import LABEL
from skylattice.session import broadcast_if_small, materialize
from skylattice.sources.schemas import WEATHER_CODES, WEATHER_MEASURES

HOUR = 3600


def nearest_stations(stations: DataFrame, airports: DataFrame) -> DataFrame:
    """The weather station closest to each airport, with the airport's codes.

    Airport lists repeat codes (closed fields). There is one row per airport
    identifier, and one per ``iata_code``: that of the closest station.
    """
    nearest = nearest_per_key(stations, "neighbor_call", "distance_to_neighbor")
    known = dedupe_latest(airports.filter("ident IS NOT NULL"), ["ident"], "iata_code")
    both = lookup_enrich(nearest, known, "neighbor_call", "ident")
    return nearest_per_key(both, "iata_code", "distance_to_neighbor")


def locate_flights(flights: DataFrame, places: DataFrame, stored: bool = False) -> DataFrame:
    """Flights with the station columns of both ends and the departure in UTC.

    A flight from a state without a known time zone has no ``depart_UTC``.
    ``stored`` says that ``places`` is read from storage as it is.
    """
    both = role_join(flights, places, "DEST", "iata_code", "dest_station_", stored=stored)
    both = role_join(both, places, "ORIGIN", "iata_code", "origin_station_", stored=stored)
    zoned = with_time_zone(both, "ORIGIN_STATE_ABR")
    local = local_timestamp(day_of("FL_DATE"), F.col("CRS_DEP_TIME"))
    utc = local_to_utc(local, F.col("time_zone"))
    return zoned.withColumn("depart_UTC", utc).withColumn(
        "Depart_2hrs_before", shifted(F.col("depart_UTC"), -2 * HOUR)
    )


def weather_per_bucket(
    weather: DataFrame,
    measures: Sequence[str] = WEATHER_MEASURES,
    width: int = 2 * HOUR,
    offset: int = 0,
) -> DataFrame:
    """Latest reading and measure statistics per station and bucket."""
    timed = weather.withColumn("DATE", text_to("DATE", "timestamp"))
    present = [m for m in measures if m in weather.columns and m not in WEATHER_CODES]
    latest = [c for c in weather.columns if c not in ("STATION", "DATE")]
    return bucket_statistics(timed, "STATION", "DATE", present, width, offset, latest=latest)


def _distinct(rows: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Distinct rows with the wanted columns."""
    distinct = dedupe_rows(rows)
    return distinct if columns is None else distinct.select(*columns)


def enrich_flights(
    flights: DataFrame,
    weather: DataFrame,
    stations: DataFrame,
    airports: DataFrame,
    width: int = 2 * HOUR,
    offset: int = 0,
    sparse_threshold: float = 99.0,
    rank_as_of: tuple[str, object] | None = ("YEAR", 2019),
    lead: int = 2 * HOUR,
    flight_columns: Sequence[str] | None = None,
    weather_columns: Sequence[str] | None = None,
    max_rounds: int = 200,
) -> DataFrame:
    """One row per labelled flight of a known origin station, with its weather.

    Weather is never newer than ``lead`` seconds before the departure. Route
    ranks come from flights before ``rank_as_of`` (the test year), so that later
    routes leak nothing; None takes all flights. The column lists say what to
    carry; rows equal in every column of the source count once, whatever is
    carried.
    """
    # read several times from here on: profile, route graph and join
    flights = drop_sparse(materialize(_distinct(flights, flight_columns), "flights"), sparse_threshold)
    ranked = with_page_rank(flights, "ORIGIN", "DEST", as_of=rank_as_of, max_rounds=max_rounds)
    places = materialize(nearest_stations(stations, airports), "places")
    located = locate_flights(keep_labelled(ranked, LABEL), places, stored=True)
    located = located.filter(F.col("origin_station_station_id").isNotNull())
    # no flight looks up the readings of a station that is no airport's; equal rows are
    # of one station, so all distinct readings are only counted and not stored
    asked = places.filter("iata_code IS NOT NULL").select(F.col("station_id").alias("STATION"))
    looked_up = weather.join(broadcast_if_small(asked.distinct()), "STATION", "left_semi")
    readings = drop_sparse(
        materialize(_distinct(looked_up, weather_columns), "weather"),
        sparse_threshold,
        source=_distinct(weather, weather_columns),
    )
    per_bucket = materialize(
        weather_per_bucket(readings, width=width, offset=offset), "buckets"
    )
    keyed = located.withColumn("STATION", F.col("origin_station_station_id"))
    # the located flights are wide, they are shuffled only if the buckets are many
    return bucket_join(
        keyed, broadcast_if_small(per_bucket), "STATION", "depart_UTC", width, lead, offset
    )
