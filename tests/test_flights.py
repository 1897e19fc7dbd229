"""The flight plans on a few hand-written rows."""

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skylattice.plans import enrichment, features
from skylattice.session import distil, ensure_checkpoint_dir, materialize
from skylattice.sources import schemas


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def flights(spark):
    def flight(number, day, hhmm, origin, dest, ids, tail, delay, state="CA"):
        late = None if delay is None else float(delay >= 15)
        return (number, day, hhmm, origin, dest, *ids, state, tail, delay, late)

    rows = [
        flight(1, "2015-06-01", 1430, "LAX", "SFO", (1, 2), "N1", 20.0),
        flight(2, "2015-06-01", 1930, "SFO", "LAX", (2, 1), "N1", 0.0),
        flight(2, "2015-06-01", 1930, "SFO", "LAX", (2, 1), "N1", 0.0),  # a copy
        flight(3, "2015-06-02", 700, "LAX", "SFO", (1, 2), "N1", 40.0),
        flight(4, "2015-06-01", 1430, "LAX", "SFO", (1, 2), None, None),  # no label
        flight(5, "2015-06-01", 1430, "SFO", "LAX", (2, 1), "N2", 5.0, "ZZ"),  # no zone
        flight(6, "2015-06-01", 1430, "JFK", "LAX", (3, 1), "N3", 5.0),  # no station
    ]
    return spark.createDataFrame(
        rows,
        "OP_CARRIER_FL_NUM int, FL_DATE string, CRS_DEP_TIME int, ORIGIN string, DEST string, "
        "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, ORIGIN_STATE_ABR string, TAIL_NUM string, "
        "DEP_DELAY double, DEP_DEL15 double",
    )


@pytest.fixture(scope="module")
def enriched(spark, flights):
    weather = spark.createDataFrame(
        [
            ("S1", "2015-06-01T19:10:00", "9"),
            ("S1", "2015-06-01T19:10:00", "9"),  # a copy
            ("S1", "2015-06-01T19:50:00", "10s"),
            ("S1", "2015-06-01T20:30:00", "50"),  # fresher than the lead allows
            ("S9", "2015-06-01T19:10:00", "99"),  # not the nearest station
        ],
        "STATION string, DATE string, HourlyWindSpeed string",
    )
    stations = spark.createDataFrame(
        [("S1", "KLAX", 1.0), ("S9", "KLAX", 5.0), ("S2", "KSFO", 2.0), ("S3", "KSFO", 2.0)],
        "station_id string, neighbor_call string, distance_to_neighbor double",
    )
    airports = spark.createDataFrame(
        [("KLAX", "large", "US-CA", "LAX"), ("KSFO", "large", "US-CA", "SFO"),
         ("KJFK", "large", "US-NY", "JFK")],
        schemas.AIRPORTS,
    )
    return enrichment.enrich_flights(
        flights, weather, stations, airports, rank_as_of=None
    ).cache()


def test_one_row_per_labelled_flight_with_station(enriched):
    assert sorted(r["OP_CARRIER_FL_NUM"] for r in enriched.collect()) == [1, 2, 3, 5]


def test_weather_respects_station_and_lead(enriched):
    rows = {r["OP_CARRIER_FL_NUM"]: r for r in enriched.collect()}
    first = rows[1]  # departs 14:30 in Los Angeles, 21:30 UTC, so the key is 18:00
    assert first["depart_UTC"] == at("2015-06-01 21:30:00")
    assert first["time_key"] == at("2015-06-01 18:00:00")
    assert first["Max_HourlyWindSpeed"] is None
    assert first["origin_station_station_id"] == "S1"
    assert first["dest_station_station_id"] == "S2"
    assert rows[5]["depart_UTC"] is None and rows[5]["time_key"] is None


def test_latest_and_statistics_of_the_bucket(spark, enriched):
    weather = spark.createDataFrame(
        [("S1", "2015-06-01T17:10:00", "9"), ("S1", "2015-06-01T17:50:00", "10s")],
        "STATION string, DATE string, HourlyWindSpeed string",
    )
    bucket = enrichment.weather_per_bucket(weather).first()
    assert bucket["time_key"] == at("2015-06-01 18:00:00")
    assert (bucket["HourlyWindSpeed"], bucket["Max_HourlyWindSpeed"]) == ("10s", 9.0)


def test_delay_history(enriched):
    cleaned = features.clean_flights(enriched)
    assert "depart_UTC" not in cleaned.columns
    ready = cleaned.withColumn("CRS_ARR_TIME", cleaned["CRS_DEP_TIME"])
    rows = {r["OP_CARRIER_FL_NUM"]: r for r in features.derive_features(ready).collect()}
    assert rows.keys() == {1, 2, 3, 5}
    # the aircraft came to SFO with flight 1 and to LAX with flight 2
    assert rows[2]["previous_flight_delay"] == 20.0
    assert rows[3]["previous_flight_delay"] == 0.0
    assert rows[1]["previous_flight_delay"] is None
    # flight 1 was late and lies 3 to 24 hours before flights 2 and 3
    assert rows[2]["Plane_Delays_last_24H"] == 1
    assert rows[3]["Plane_Delays_last_24H"] == 1
    assert rows[3]["airport_delays_in_previous_24_hours"] == 1
    assert rows[5]["airport_delays_in_previous_24_hours"] == 0
    assert rows[5]["region"] == "Unknown" and rows[1]["region"] == "West"
    assert rows[3]["CRS_DEP_HOUR"] == 7
    assert rows[1]["days_to_nearest_holiday"] == 7  # Memorial Day 2015-05-25


def test_a_code_of_two_airports_gives_one_row(spark, flights):
    weather = spark.createDataFrame([], schemas.WEATHER)
    stations = spark.createDataFrame(
        [("S1", "KLAX", 1.0), ("S2", "KSFO", 2.0), ("S8", "XLAX", 0.5), ("S9", "YLAX", 7.0)],
        "station_id string, neighbor_call string, distance_to_neighbor double",
    )
    airports = spark.createDataFrame(
        [("KLAX", "large", "US-CA", "LAX"), ("KSFO", "large", "US-CA", "SFO"),
         ("XLAX", "closed", "US-CA", "LAX"), ("YLAX", "closed", "US-CA", "LAX"),
         ("YLAX", "closed", "US-CA", None)],
        schemas.AIRPORTS,
    )
    out = enrichment.enrich_flights(flights, weather, stations, airports, rank_as_of=None).collect()
    numbers = [r["OP_CARRIER_FL_NUM"] for r in out]
    assert sorted(numbers) == [1, 2, 3, 5]
    assert {r["origin_station_station_id"] for r in out if r["ORIGIN"] == "LAX"} == {"S8"}


def test_wall_clocks_do_not_depend_on_the_session_zone(spark):
    from pyspark.sql import functions as F

    from skylattice.functions.temporal import local_timestamp, local_to_utc

    rows = [("2015-03-08", 230, "America/Chicago"), ("2015-07-01", 5, "America/New_York"),
            ("2015-11-01", 130, "America/New_York"), ("2015-12-31", 2400, "Pacific/Honolulu"),
            ("2015-12-31", 2360, "UTC"), ("2015-12-31", 100, None)]
    df = spark.createDataFrame(rows, "d string, t int, z string")
    utc = local_to_utc(local_timestamp(F.to_date("d"), F.col("t")), F.col("z"))

    def seconds():
        return [r[0] for r in df.select(F.unix_seconds(utc)).collect()]

    here = seconds()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert seconds() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert here[1] == 1435723500 and here[4] is None and here[5] is None


def test_inputs_come_from_training_rows_alone(spark):
    """Columns empty there are left out, validation rows teach nothing, equal rows all stay."""
    from pyspark.sql import functions as F

    from skylattice.plans import modeling

    rows = spark.range(900).select(
        F.date_format(F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 300).cast("int")), "yyyy-MM-dd").alias("FL_DATE"),
        F.lit(1).alias("MONTH"),
        (F.col("id") % 300 % 2).cast("double").alias("DEP_DEL15"),
        (F.col("id") % 300 % 50).cast("double").alias("DEP_DELAY"),
        F.when(F.col("id") % 300 > 250, 1.0).alias("late_only"),
        F.lit(None).cast("double").alias("never"),
        F.when(F.col("id") % 300 < 200, (F.col("id") % 300 % 50).cast("double")).otherwise(1e6).alias("x"),
        F.lit("A").alias("OP_UNIQUE_CARRIER"),
    )
    later = rows.withColumn("FL_DATE", F.lit("2019-02-03"))
    tables = modeling.prepare_model_tables(rows.unionByName(later), keep=["x"], carry=["x"])
    assert set(tables.empty) == {"late_only", "never"}
    assert [tables.train.count(), tables.validation.count(), tables.test.count()] == [600, 300, 900]
    names = [a["name"] for _, a in modeling.vector_attributes(tables.train, "scaledFeatures")]
    assert {"YEAR", "MONTH", "x"} <= set(names) and not {"DEP_DELAY", "DEP_DEL15"} & set(names)
    place = names.index("x")
    row = tables.train.filter("x = 10").first()
    assert row["scaledFeatures"][place] == pytest.approx(10 / (sum((i - 24.5) ** 2 for i in range(50)) * 12 / 599) ** 0.5, rel=1e-6)


def test_only_readings_of_airport_stations_are_summed(spark, flights, monkeypatch):
    weather = spark.createDataFrame(
        [("S1", "2015-06-01T17:10:00", "9"), ("S1", "2015-06-01T17:10:00", "9"),
         ("S9", "2015-06-01T17:10:00", "99"), (None, "2015-06-01T17:10:00", "7")],
        "STATION string, DATE string, HourlyWindSpeed string",
    )
    stations = spark.createDataFrame(
        [("S1", "KLAX", 1.0), ("S9", "KLAX", 5.0)],
        "station_id string, neighbor_call string, distance_to_neighbor double",
    )
    airports = spark.createDataFrame([("KLAX", "large", "US-CA", "LAX")], schemas.AIRPORTS)
    seen, whole = [], enrichment.weather_per_bucket
    monkeypatch.setattr(
        enrichment, "weather_per_bucket", lambda w, **o: seen.append(w) or whole(w, **o)
    )
    rows = enrichment.enrich_flights(flights, weather, stations, airports, rank_as_of=None).collect()
    assert [r["STATION"] for r in seen[0].collect()] == ["S1"]
    assert {r["OP_CARRIER_FL_NUM"]: r["Max_HourlyWindSpeed"] for r in rows} == {1: 9.0, 3: None}


def test_joins_are_worked_out_once_for_the_types(enriched, monkeypatch):
    seen, infer = [], features.infer_types
    monkeypatch.setattr(
        features, "infer_types", lambda df, *rest: seen.append(df) or infer(df, *rest)
    )
    cleaned = features.clean_flights(enriched)
    assert cleaned.count() == 4
    # read from the stored rows, not from the cached joins of the fixture
    assert len(seen[0].inputFiles()) > 0 and "parquet" in seen[0].inputFiles()[0]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "InMemoryTableScan" not in plan


def test_whole_rows_pass_one_shuffle(spark, enriched):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ready = features.clean_flights(enriched.withColumn("CRS_ARR_TIME", F.lit(1100)))
        derived = features.derive_features(ready)
        text = derived._sc._jvm.PythonSQLUtils.explainString(derived._jdf.queryExecution(), "formatted")
        exchanges = re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: (.*)$", text, re.M)
        assert sum("CRS_ARR_TIME#" in columns for columns in exchanges) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "__row" not in derived.columns and derived.count() == 4


def test_nulls_of_all_distinct_readings_make_a_column_sparse(spark, flights):
    readings = [("S1", "2015-06-01T17:10:00", "9", "rare")] * 5
    readings += [("S7", f"2015-06-{1 + i % 28:02d}T{i % 24:02d}:10:00", f"{i}", None) for i in range(150)]
    weather = spark.createDataFrame(readings, "STATION string, DATE string, HourlyWindSpeed string, Remark string")
    stations = spark.createDataFrame(
        [("S1", "KLAX", 1.0), ("S2", "KSFO", 2.0)],
        "station_id string, neighbor_call string, distance_to_neighbor double",
    )
    airports = spark.createDataFrame(
        [("KLAX", "large", "US-CA", "LAX"), ("KSFO", "large", "US-CA", "SFO")], schemas.AIRPORTS
    )
    rows = enrichment.enrich_flights(flights, weather, stations, airports, rank_as_of=None)
    assert "Remark" not in rows.columns and "Max_HourlyWindSpeed" in rows.columns
    assert rows.filter("HourlyWindSpeed IS NOT NULL").count() == 1


def test_steps_before_a_distilled_table_leave_nothing_on_disk(spark):
    def tables():
        folder = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {p.name for p in Path(folder).glob("*/*") if p.is_dir()}

    def build():
        numbers = materialize(spark.range(1000).select((F.col("id") % 7).alias("k")), "numbers_before")
        return numbers.groupBy("k").agg(F.count("*").alias("n"))

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    rows = distil(spark, build, "counts_after", row_id="row_id")
    assert rows.select("row_id").distinct().count() == 7 and rows.agg(F.sum("n")).first()[0] == 1000
    assert "counts_after" in tables() and "numbers_before" not in tables()
    assert spark.conf.get(setting) == before
