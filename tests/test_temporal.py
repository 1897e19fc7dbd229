"""Clock times, buckets, zones and holidays at their edges."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skylattice.functions import dims, temporal as T
from skylattice.functions.casting import text_to
from skylattice.functions.holidays import days_to_nearest_holiday, federal_holidays

HOUR = 3600


def at(text):
    return datetime.fromisoformat(text)


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values))
    return rows.select(column).first()[0]


@pytest.mark.parametrize(
    "departure, key",
    [
        ("2015-06-01 21:30:00", "2015-06-01 18:00:00"),  # two hours before is 19:30
        ("2015-06-01 20:00:00", "2015-06-01 18:00:00"),
        ("2015-06-01 01:59:59", "2015-05-31 22:00:00"),
    ],
)
def test_floor_key_two_hours_before(spark, departure, key):
    ts = T.bucket_floor(T.shifted(F.col("t"), -2 * HOUR), 2 * HOUR)
    assert one(spark, ts, t=at(departure)) == at(key)


@pytest.mark.parametrize(
    "reading, key",
    [
        ("2015-06-01 23:10:00", "2015-06-02 00:00:00"),
        ("2015-12-31 23:10:00", "2016-01-01 00:00:00"),
        ("2015-06-01 02:59:00", "2015-06-01 04:00:00"),
        ("2015-06-01 02:00:00", "2015-06-01 02:00:00"),
        ("2015-06-01 02:00:00.000001", "2015-06-01 04:00:00"),
    ],
)
def test_ceil_key_carries_the_date(spark, reading, key):
    assert one(spark, T.bucket_ceil(F.col("t"), 2 * HOUR), t=at(reading)) == at(key)


def test_three_hour_buckets_reach_into_the_day_before(spark):
    ts = T.bucket_floor(T.shifted(F.col("t"), -3 * HOUR), 3 * HOUR, 2 * HOUR)
    assert one(spark, ts, t=at("2015-06-02 03:30:00")) == at("2015-06-01 23:00:00")


@pytest.mark.parametrize(
    "hhmm, text",
    [(5, "00:05"), (30, "00:30"), (930, "09:30"), (2359, "23:59"), (0, "00:00")],
)
def test_small_clock_numbers(spark, hhmm, text):
    local = T.local_timestamp(F.lit(date(2015, 6, 1)), F.col("x"))
    assert one(spark, local, x=hhmm) == at(f"2015-06-01 {text}:00")
    assert one(spark, T.hhmm_hour(F.col("x")), x=hhmm) == int(text[:2])
    assert one(spark, T.hhmm_minute(F.col("x")), x=hhmm) == int(text[3:])


def test_midnight_and_nonsense_clock_numbers(spark):
    local = T.local_timestamp(F.lit(date(2015, 6, 1)), F.col("x"))
    assert one(spark, local, x=2400) == at("2015-06-02 00:00:00")
    assert one(spark, local, x=1275) is None
    assert one(spark, local, x=2500) is None
    assert one(spark, local, x=-5) is None


def test_parts_that_name_no_instant_are_null(spark):
    ts = T.timestamp_from_parts(F.col("y"), F.col("m"), F.col("d"), F.col("h"))
    assert one(spark, ts, y=2015, m=2, d=28, h=7) == at("2015-02-28 07:00:00")
    assert one(spark, ts, y=2015, m=2, d=30, h=7) is None


def test_unknown_zone_is_null_and_counted(spark):
    df = spark.createDataFrame(
        [("CA", at("2015-07-01 10:00:00")), ("ZZ", at("2015-07-01 10:00:00")), (None, None)],
        "state string, local_ts timestamp",
    )
    zoned = dims.with_time_zone(df, "state").withColumn(
        "utc", T.local_to_utc(F.col("local_ts"), F.col("time_zone"))
    )
    got = {r["state"]: r["utc"] for r in zoned.collect()}
    assert got == {"CA": at("2015-07-01 17:00:00"), "ZZ": None, None: None}
    lost = {r["state"]: r["n_rows"] for r in
            dims.unmapped_counts(df, "state", dims.STATE_ZONES).collect()}
    assert lost == {"ZZ": 1, None: 1}


def test_clock_time_skipped_by_daylight_saving(spark):
    # 02:30 does not exist on this day; the offset before the change applies
    utc = T.local_to_utc(F.col("t"), F.lit("America/Chicago"))
    assert one(spark, utc, t=at("2015-03-08 02:30:00")) == at("2015-03-08 08:30:00")


def test_recode_keeps_or_replaces_unmapped(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    kept = dims.recode(df, "k", {"a": "x"}, "out", keep_unmapped=True)
    assert {r["k"]: r["out"] for r in kept.collect()} == {"a": "x", "b": "b"}
    assert {r["k"]: r["region"] for r in dims.with_region(df, "k").collect()} == {
        "a": "Unknown", "b": "Unknown"
    }


def test_holiday_edges(spark):
    days = [date(2017, 7, 4), date(2017, 7, 5), date(2018, 12, 31), date(2019, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["days_to_nearest_holiday"] for r in
           days_to_nearest_holiday(df, "d").collect()}
    assert got == dict(zip(days, [0, 1, 1, 0]))


def test_observed_holidays():
    days = federal_holidays(2015, 2022)
    assert date(2015, 7, 3) in days and date(2015, 7, 4) in days  # Saturday
    assert date(2017, 1, 2) in days  # New Year on Sunday
    assert date(2021, 12, 31) in days  # New Year 2022 on Saturday
    assert date(2020, 6, 19) not in days and date(2021, 6, 18) in days
    assert date(2016, 11, 24) in days and date(2018, 5, 28) in days


def test_holidays_of_an_empty_table(spark):
    df = spark.createDataFrame([], "d date")
    assert days_to_nearest_holiday(df, "d").collect() == []


@pytest.mark.parametrize(
    "text, type_name, value",
    [
        ("10", "int", 10),
        (" 7 ", "int", 7),
        ("10s", "int", None),
        ("6.5", "int", None),
        ("99999999999", "int", None),
        ("6.5", "double", 6.5),
        (".5", "double", 0.5),
        ("-1e3", "double", -1000.0),
        ("T", "double", None),
        ("10s", "double", None),
        ("2015-06-01T07:30:00", "timestamp", at("2015-06-01 07:30:00")),
        ("2015", "timestamp", None),
        ("x-y", "timestamp", None),
    ],
)
def test_text_casts(spark, text, type_name, value):
    assert one(spark, text_to("x", type_name), x=text) == value
