"""Clock times, zones, regions and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.functions import dims, temporal as T
from skylattice.functions.holidays import days_to_nearest_holiday
from skylattice.queries.registry import query
from skylattice.queries.tables import table

STATES = ["CA", "NY", "TX", "AZ", "HI", "AK", "IL", "FL", "CO", "PR", "GU", "IN", "XX"]
STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
ZONE_ROWS = ", ".join(f"('{s}', '{dims.STATE_ZONES[s]}')" for s in STATES if s != "XX")
REGION_ROWS = ", ".join(f"('{s}', '{dims.STATE_REGIONS[s]}')" for s in STATES if s != "XX")


def order_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as departures: a date, an hhmm clock time and a state code."""
    state = F.element_at(
        F.array(*[F.lit(s) for s in STATES]),
        (F.col("o_custkey") % len(STATES) + 1).cast("int"),
    )
    hhmm = (F.col("o_orderkey") % 24) * 100 + F.col("o_custkey") % 60
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        hhmm.cast("int").alias("hhmm"),
        state.alias("state"),
    )


@query("local_to_utc", f"""
WITH zones(state, zone) AS (VALUES {ZONE_ROWS}),
d AS (
  SELECT o_orderkey, [{STATE_LIST}][o_custkey % {len(STATES)} + 1] AS state,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT))
                     + to_minutes(CAST(o_custkey % 60 AS INT)) AS local_ts
  FROM orders),
u AS (
  SELECT d.*, zone, timezone('UTC', timezone(zone, local_ts)) AS utc
  FROM d LEFT JOIN zones USING (state)),
e AS (
  -- of two instants with the same clock time the earlier one is meant
  SELECT *, CASE WHEN timezone(zone, timezone('UTC', utc - INTERVAL 1 HOUR)) = local_ts
                 THEN utc - INTERVAL 1 HOUR ELSE utc END AS first_utc
  FROM u)
SELECT o_orderkey, state, zone AS time_zone,
       epoch_us(local_ts) // 1000000 AS local_seconds,
       epoch_us(first_utc) // 1000000 AS utc_seconds,
       epoch_us(first_utc) // 1000000 - 7200 AS two_hours_before,
       CAST(year(first_utc) AS INT) AS utc_year, CAST(month(first_utc) AS INT) AS utc_month,
       CAST(day(first_utc) AS INT) AS utc_day, CAST(hour(first_utc) AS INT) AS utc_hour
FROM e
""")
def local_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = order_departures(spark, sf_dir).withColumn(
        "local_ts", T.local_timestamp(F.col("o_orderdate"), F.col("hhmm"))
    )
    zoned = dims.with_time_zone(departures, "state").withColumn(
        "utc", T.local_to_utc(F.col("local_ts"), F.col("time_zone"))
    )
    return zoned.select(
        "o_orderkey",
        "state",
        "time_zone",
        F.unix_seconds("local_ts").alias("local_seconds"),
        F.unix_seconds("utc").alias("utc_seconds"),
        F.unix_seconds(T.shifted(F.col("utc"), -7200)).alias("two_hours_before"),
        *T.calendar_parts(F.col("utc"), "utc"),
    )


@query("hhmm_hour", """
SELECT event_id, CAST(h // 100 AS INT) AS hour, CAST(h % 100 AS INT) AS minute
FROM (SELECT event_id, (event_id % 24) * 100 + user_id % 60 AS h FROM events)
""")
def hhmm_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hhmm = ((F.col("event_id") % 24) * 100 + F.col("user_id") % 60).cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", T.hhmm_hour(hhmm).alias("hour"), T.hhmm_minute(hhmm).alias("minute")
    )


@query("time_buckets", """
SELECT event_id,
       (epoch_us(ts) - 7200000000) // 10800000000 * 10800 + 7200 AS bucket_start,
       (epoch_us(ts) - 7200000000 + 10799999999) // 10800000000 * 10800 + 7200 AS bucket_end,
       epoch_us(make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0)) // 1000000
         AS full_hour,
       concat(event_type, CAST(user_id AS VARCHAR)) AS composite_key
FROM events
""")
def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, width, offset = F.col("ts"), 3 * 3600, 2 * 3600
    full_hour = T.timestamp_from_parts(F.year(ts), F.month(ts), F.day(ts), F.hour(ts))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_seconds(T.bucket_floor(ts, width, offset)).alias("bucket_start"),
        F.unix_seconds(T.bucket_ceil(ts, width, offset)).alias("bucket_end"),
        F.unix_seconds(full_hour).alias("full_hour"),
        T.composite_key(F.col("event_type"), F.col("user_id")).alias("composite_key"),
    )


@query("region_recode", f"""
WITH regions(state, region) AS (VALUES {REGION_ROWS})
SELECT o_orderkey, state, coalesce(region, 'Unknown') AS region
FROM (SELECT o_orderkey, [{STATE_LIST}][o_custkey % {len(STATES)} + 1] AS state FROM orders)
LEFT JOIN regions USING (state)
""")
def region_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = order_departures(spark, sf_dir).select("o_orderkey", "state")
    return dims.with_region(departures, "state").select("o_orderkey", "state", "region")


@query("unmapped_states", f"""
SELECT state, count(*) AS n_rows
FROM (SELECT [{STATE_LIST}][o_custkey % {len(STATES)} + 1] AS state FROM orders)
WHERE state = 'XX' GROUP BY state
""")
def unmapped_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = order_departures(spark, sf_dir).select("state")
    return dims.unmapped_counts(departures, "state", dims.STATE_ZONES)


HOLIDAY_SQL = """
y AS (SELECT unnest(range(1993, 2004)) AS yr),
fixed AS (
  SELECT make_date(yr, m, d) AS h
  FROM y, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) AS f(m, d)),
observed AS (
  SELECT h FROM fixed
  UNION SELECT h - 1 FROM fixed WHERE isodow(h) = 6
  UNION SELECT h + 1 FROM fixed WHERE isodow(h) = 7),
floating AS (
  SELECT d AS h FROM (
    SELECT CAST(unnest(generate_series(DATE '1993-01-01', DATE '2003-12-31',
                                       INTERVAL 1 DAY)) AS DATE) AS d)
  WHERE (isodow(d) = 1 AND (
           (month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21)
           OR (month(d) = 5 AND day(d) BETWEEN 25 AND 31)
           OR (month(d) = 9 AND day(d) <= 7)
           OR (month(d) = 10 AND day(d) BETWEEN 8 AND 14)))
     OR (isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28)),
holidays AS (SELECT h FROM observed UNION SELECT h FROM floating)
"""


@query("days_to_holiday", f"""
WITH {HOLIDAY_SQL},
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
near AS (SELECT d, min(abs(date_diff('day', h, d))) AS days FROM days, holidays GROUP BY d)
SELECT o_orderkey, CAST(days AS INT) AS days_to_nearest_holiday
FROM orders JOIN near ON CAST(o_orderdate AS DATE) = d
""")
def days_to_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return days_to_nearest_holiday(orders, "o_orderdate").select(
        "o_orderkey", "days_to_nearest_holiday"
    )
