"""The flight plans, run on flights, weather, stations and airports made of the test tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators.prep import vector_attributes
from skylattice.plans import enrichment, features, modeling
from skylattice.queries.registry import query, stored_once
from skylattice.queries.tables import table
from skylattice.queries.temporal import (
    HOLIDAY_SQL,
    REGION_ROWS,
    STATE_LIST,
    STATES,
    ZONE_ROWS,
)
from skylattice.session import distil



def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a flight from its customer's nation; some rows occur twice."""
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    dest = (nation * nation + key % 3) % 25
    delay = F.floor("o_totalprice") % 90 - 15
    day = F.col("o_orderdate")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    rows = table(spark, sf_dir, "orders").join(customer, "o_custkey").select(
        key.alias("OP_CARRIER_FL_NUM"),
        F.date_format(day, "yyyy-MM-dd").alias("FL_DATE"),
        F.year(day).alias("YEAR"),
        F.month(day).alias("MONTH"),
        F.dayofweek(day).alias("DAY_OF_WEEK"),
        ((key % 24) * 100 + F.col("o_custkey") % 60).cast("int").alias("CRS_DEP_TIME"),
        ((key % 23) * 100 + F.col("o_custkey") % 50).cast("int").alias("CRS_ARR_TIME"),
        F.concat(F.lit("A"), nation).alias("ORIGIN"),
        F.concat(F.lit("A"), dest).alias("DEST"),
        nation.alias("ORIGIN_AIRPORT_ID"),
        dest.cast("int").alias("DEST_AIRPORT_ID"),
        F.element_at(F.array(*[F.lit(s) for s in STATES]), nation % len(STATES) + 1).alias(
            "ORIGIN_STATE_ABR"
        ),
        F.when(key % 37 != 0, F.concat(F.lit("N"), F.col("o_custkey") % 20)).alias("TAIL_NUM"),
        F.substring("o_orderpriority", 1, 1).alias("OP_UNIQUE_CARRIER"),
        F.when(key % 41 != 0, delay.cast("double")).alias("DEP_DELAY"),
        F.when(key % 41 != 0, (delay >= 15).cast("double")).alias("DEP_DEL15"),
        (F.col("o_totalprice") / 200).alias("DISTANCE"),
    )
    return rows.unionByName(rows.filter(F.col("OP_CARRIER_FL_NUM") % 50 == 0))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a reading of the station named by its supplier."""
    hour = F.col("l_shipdate") + F.make_dt_interval(
        F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_orderkey") % 60).cast("int")
    )
    wind = F.col("l_quantity").cast("int").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("STATION"),
        F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.when(F.col("l_linenumber") == 7, F.concat(wind, F.lit("s"))).otherwise(wind).alias(
            "HourlyWindSpeed"
        ),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("HourlyVisibility"),
        F.concat(F.lit("BKN:07 "), F.col("l_linenumber") * 10).alias("HourlySkyConditions"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a station near its nation's airport, and farther off the closed ones."""
    near = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("station_id"),
        F.concat(F.lit("K"), "s_nationkey").alias("neighbor_call"),
        F.abs("s_acctbal").alias("distance_to_neighbor"),
        (F.col("s_suppkey") % 90).cast("double").alias("neighbor_lat"),
        (-F.col("s_suppkey") % 180).cast("double").alias("neighbor_lon"),
    )
    return near.unionByName(
        near.withColumns(
            {
                "neighbor_call": F.concat(F.lit("X"), "neighbor_call"),
                "distance_to_neighbor": F.col("distance_to_neighbor") + 1e6,
            }
        )
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as an airport; some codes are also those of a closed field far off."""
    open_fields = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("K"), "n_nationkey").alias("ident"),
        F.concat(F.lit("type_"), F.col("n_nationkey") % 3).alias("type"),
        F.concat(F.lit("R"), "n_regionkey").alias("iso_region"),
        F.concat(F.lit("A"), "n_nationkey").alias("iata_code"),
    )
    closed = open_fields.filter("iata_code IN ('A1', 'A3', 'A8')").withColumns(
        {"ident": F.concat(F.lit("X"), "ident"), "type": F.lit("closed")}
    )
    return open_fields.unionByName(closed)


FLIGHTS_SQL = f"""
zones(state, zone) AS (VALUES {ZONE_ROWS}),
base AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_custkey, c_nationkey AS org,
         o_totalprice / 200 AS distance,
         (c_nationkey * c_nationkey + o_orderkey % 3) % 25 AS dst,
         [{STATE_LIST}][c_nationkey % {len(STATES)} + 1] AS state,
         CASE WHEN o_orderkey % 37 <> 0 THEN 'N' || (o_custkey % 20) END AS tail,
         CASE WHEN o_orderkey % 41 <> 0 THEN CAST(floor(o_totalprice) % 90 - 15 AS DOUBLE) END
           AS delay,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT))
                     + to_minutes(CAST(o_custkey % 60 AS INT)) AS local_ts
  FROM orders JOIN customer ON c_custkey = o_custkey),
timed AS (
  SELECT base.*, zone, CAST(delay >= 15 AS INT) AS late,
         timezone('UTC', timezone(zone, local_ts)) AS u
  FROM base LEFT JOIN zones USING (state)),
f AS (
  SELECT * EXCLUDE (u),
         epoch_us(CASE WHEN timezone(zone, timezone('UTC', u - INTERVAL 1 HOUR)) = local_ts
                       THEN u - INTERVAL 1 HOUR ELSE u END) // 1000000 AS utc
  FROM timed)
"""

NEAREST_SQL = """
near AS (
  SELECT s_nationkey, 'S' || s_suppkey AS station FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_nationkey
                             ORDER BY abs(s_acctbal), 'S' || s_suppkey) = 1)
"""

READINGS_SQL = """
readings AS (
  SELECT DISTINCT 'S' || l_suppkey AS station,
         epoch_us(l_shipdate) // 1000000 + (l_partkey % 24) * 3600 + (l_orderkey % 60) * 60 AS t,
         CAST(CAST(l_quantity AS INT) AS VARCHAR)
           || CASE WHEN l_linenumber = 7 THEN 's' ELSE '' END AS wind,
         CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) AS vis,
         'BKN:07 ' || (l_linenumber * 10) AS sky
  FROM lineitem),
buckets AS (
  SELECT station, (t + 7199) // 7200 * 7200 AS key, max(TRY_CAST(wind AS DOUBLE)) AS hi,
         min(TRY_CAST(wind AS DOUBLE)) AS lo, avg(TRY_CAST(wind AS DOUBLE)) AS mean,
         arg_max(wind, (t, wind, vis, sky)) AS wind, arg_max(vis, (t, wind, vis, sky)) AS vis,
         arg_max(sky, (t, wind, vis, sky)) AS sky
  FROM readings GROUP BY ALL)
"""


# the first year of test flights; ranks are taken from the years before
TEST_YEAR = 2000


def route_rank_sql(rounds: int) -> str:
    steps = [
        f"""e AS MATERIALIZED (SELECT DISTINCT org AS src, dst FROM base WHERE year(day) < {TEST_YEAR}),
d AS MATERIALIZED (SELECT src, count(*) AS degree FROM e GROUP BY src),
r0 AS MATERIALIZED (SELECT id, 0.15::DOUBLE AS rank, 0.15::DOUBLE AS delta
                    FROM (SELECT src AS id FROM e UNION SELECT dst FROM e))"""
    ]
    for i in range(rounds):
        steps.append(f"""g{i} AS MATERIALIZED (
  SELECT dst AS id, sum(delta / degree) * (1.0::DOUBLE - 0.15::DOUBLE) AS gain
  FROM e JOIN d USING (src) JOIN r{i} ON r{i}.id = e.src WHERE delta > 0.01 GROUP BY dst),
r{i + 1} AS MATERIALIZED (
  SELECT id, rank + coalesce(gain, 0) AS rank, coalesce(gain, 0) AS delta
  FROM r{i} LEFT JOIN g{i} USING (id))""")
    steps.append(
        "ranks AS (SELECT id, rank * count(*) OVER () / sum(rank) OVER () AS pagerank "
        f"FROM r{rounds})"
    )
    return ",\n".join(steps)


@query("flight_enrichment", f"""
WITH {FLIGHTS_SQL}, {NEAREST_SQL}, {READINGS_SQL}, {route_rank_sql(40)}
SELECT f.id AS "OP_CARRIER_FL_NUM", o.station AS origin_station_station_id,
       d.station AS dest_station_station_id, 'K' || f.dst AS dest_station_ident, zone AS time_zone,
       utc AS depart_seconds, round(pagerank, 8) AS pagerank,
       b.hi AS "Max_HourlyWindSpeed", b.lo AS "Min_HourlyWindSpeed",
       round(b.mean, 8) AS "Avg_HourlyWindSpeed", b.wind AS "HourlyWindSpeed",
       b.vis AS "HourlyVisibility", b.sky AS "HourlySkyConditions"
FROM f JOIN near o ON o.s_nationkey = f.org
LEFT JOIN near d ON d.s_nationkey = f.dst
LEFT JOIN ranks ON ranks.id = f.org
LEFT JOIN buckets b ON b.station = o.station AND b.key = (utc - 7200) // 7200 * 7200
WHERE f.delay IS NOT NULL
""")
def flight_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select(
        "OP_CARRIER_FL_NUM",
        "origin_station_station_id",
        "dest_station_station_id",
        "dest_station_ident",
        "time_zone",
        F.unix_seconds("depart_UTC").alias("depart_seconds"),
        F.round("pagerank", 8).alias("pagerank"),
        "Max_HourlyWindSpeed",
        "Min_HourlyWindSpeed",
        F.round("Avg_HourlyWindSpeed", 8).alias("Avg_HourlyWindSpeed"),
        "HourlyWindSpeed",
        "HourlyVisibility",
        "HourlySkyConditions",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights and readings enriched, with route ranks as of the test year."""
    return enrichment.enrich_flights(
        flights(spark, sf_dir),
        weather(spark, sf_dir),
        stations(spark, sf_dir),
        airports(spark, sf_dir),
        rank_as_of=("YEAR", TEST_YEAR),
    )


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched flights, cleaned and with all features; stored once for the queries below.

    Of the steps before it, no more is kept than the next one reads.
    """

    def build() -> DataFrame:
        rows = distil(spark, lambda: enriched(spark, sf_dir), "enriched", row_id="row_id")
        cleaned = features.clean_flights(rows, stored=True)
        return features.derive_features(cleaned, row_id="row_id")

    return stored_once(spark, sf_dir, "derived_flights", lambda: distil(spark, build, "derived"))


TRAILING = """
CAST(coalesce(sum(late) OVER (PARTITION BY {entity} ORDER BY utc
  RANGE BETWEEN 86400 PRECEDING AND 10800 PRECEDING), 0) AS BIGINT)"""


FEATURES_SQL = f"""
regions(state, region) AS (VALUES {REGION_ROWS}),
k AS (SELECT f.*, near.station FROM f JOIN near ON s_nationkey = org WHERE delay IS NOT NULL),
{HOLIDAY_SQL},
off AS (
  SELECT d, CAST(min(abs(date_diff('day', h, d))) AS INT) AS days
  FROM (SELECT DISTINCT day AS d FROM k), holidays GROUP BY d),
previous AS (
  SELECT a.id, arg_max(b.delay, (b.utc, b.delay)) AS delay
  FROM k a JOIN k b ON a.tail = b.tail AND a.org = b.dst AND a.utc - 7200 > b.utc
   AND abs(date_diff('day', b.day, a.day)) <= 1
  GROUP BY a.id),
plane AS (SELECT id, {TRAILING.format(entity="tail")} AS n FROM k
          WHERE tail IS NOT NULL AND utc IS NOT NULL),
place AS (SELECT id, {TRAILING.format(entity="org")} AS n FROM k WHERE utc IS NOT NULL)
"""


@query("flight_features", f"""
WITH {FLIGHTS_SQL}, {NEAREST_SQL}, {FEATURES_SQL}
SELECT k.id AS "OP_CARRIER_FL_NUM", off.days AS days_to_nearest_holiday, previous.delay AS previous_flight_delay,
       CAST(k.id % 24 AS INT) AS "CRS_DEP_HOUR", CAST(k.id % 23 AS INT) AS "CRS_ARR_HOUR",
       coalesce(region, 'Unknown') AS region,
       coalesce(plane.n, 0) AS "Plane_Delays_last_24H",
       coalesce(place.n, 0) AS airport_delays_in_previous_24_hours
FROM k JOIN off ON off.d = k.day LEFT JOIN previous USING (id) LEFT JOIN regions USING (state)
LEFT JOIN plane ON plane.id = k.id LEFT JOIN place ON place.id = k.id
""")
def flight_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir).select(
        "OP_CARRIER_FL_NUM",
        "days_to_nearest_holiday",
        "previous_flight_delay",
        "CRS_DEP_HOUR",
        "CRS_ARR_HOUR",
        "region",
        "Plane_Delays_last_24H",
        "airport_delays_in_previous_24_hours",
    )


PARTS_SQL = f"""
cut AS (SELECT max(day) - 100 AS cut FROM k WHERE year(day) < {TEST_YEAR}),
w AS (SELECT count(*) FILTER (late = 0) / count(*) AS neg, min(day) AS lo, max(day) AS hi
      FROM k, cut WHERE day <= cut.cut AND year(day) < {TEST_YEAR}),
parts AS (
  SELECT id, day, late,
         CASE WHEN year(day) >= {TEST_YEAR} THEN 'test' WHEN day <= cut THEN 'train'
              ELSE 'val' END AS part,
         CASE WHEN day <= cut AND year(day) < {TEST_YEAR}
              THEN (CASE WHEN late = 1 THEN neg ELSE 1 - neg END)
           * (ln(date_diff('day', lo, day) + 1) / ln(date_diff('day', lo, hi) + 1) * 0.7 + 0.3)
         END AS weight
  FROM k, cut, w)
"""

# inputs whose imputed and scaled values are checked: column, value in SQL, whether whole
CHECKED = [
    ("DISTANCE", "k.distance", False),
    ("YEAR", "year(k.day)", False),
    ("MONTH", "month(k.day)", False),
    ("HourlyWindSpeed", "TRY_CAST(b.wind AS INT)", True),
    ("Avg_HourlyWindSpeed", "b.mean", False),
    ("HourlyVisibility", "TRY_CAST(b.vis AS INT)", True),
    ("previous_flight_delay", "previous.delay", False),
    ("Plane_Delays_last_24H", "coalesce(plane.n, 0)", False),
    ("days_to_nearest_holiday", "off.days", False),
    ("pagerank", "ranks.pagerank", False),
]


def scaled_sql() -> str:
    """Values by name, filled with training means and divided by training deviations."""
    raw = ", ".join(f'CAST({sql} AS DOUBLE) AS "{name}"' for name, sql, _ in CHECKED)
    means = ", ".join(
        (f'trunc(avg("{n}"))' if whole else f'avg("{n}")') + f' AS "{n}"' for n, _, whole in CHECKED
    )
    filled = ", ".join(f'coalesce(v."{n}", m."{n}") AS "{n}"' for n, _, _ in CHECKED)
    spread = ", ".join(f'stddev_samp("{n}") AS "{n}"' for n, _, _ in CHECKED)
    scaled = ", ".join(f'round(x."{n}" / s."{n}", 6) AS "{n}"' for n, _, _ in CHECKED)
    return f"""
v AS (
  SELECT parts.*, {raw}
  FROM k JOIN parts ON parts.id = k.id JOIN off ON off.d = k.day
  LEFT JOIN previous ON previous.id = k.id LEFT JOIN plane ON plane.id = k.id
  LEFT JOIN ranks ON ranks.id = k.org
  LEFT JOIN buckets b ON b.station = k.station AND b.key = (k.utc - 7200) // 7200 * 7200),
m AS (SELECT {means} FROM v WHERE part = 'train'),
x AS (SELECT v.id, v.day, v.part, v.late, v.weight, {filled} FROM v, m),
s AS (SELECT {spread} FROM x WHERE part = 'train')
SELECT x.id AS "OP_CARRIER_FL_NUM", x.part, CAST(x.late AS DOUBLE) AS "DEP_DEL15",
       round(x.weight, 6) AS combined_weight, {scaled},
       CASE WHEN x.part = 'train' THEN (
         SELECT count(*) FROM range(5) r(i)
         WHERE x.day >= DATE '1995-01-01' + CAST(i * 252 AS INT)
           AND x.day < DATE '1995-01-01' + CAST(i * 252 + 352 AS INT)) ELSE 0 END AS n_folds
FROM x, s"""


def model_tables(spark: SparkSession, sf_dir: str) -> modeling.ModelTables:
    """Training, validation and test rows of the derived flights."""
    rows = features.drop_uninformative(derived(spark, sf_dir))
    return modeling.prepare_model_tables(
        rows,
        test_year=TEST_YEAR,
        keep=[name for name, _, _ in CHECKED],
        carry=["OP_CARRIER_FL_NUM"],
        stored=True,
    )


def parts_of(tables: modeling.ModelTables) -> DataFrame:
    """All model rows, with the part each belongs to; only training rows weigh."""
    nothing = F.lit(None).cast("double")
    return reduce(
        DataFrame.unionByName,
        [
            frame.select(
                "OP_CARRIER_FL_NUM",
                F.lit(part).alias("part"),
                "DEP_DEL15",
                (F.col("combined_weight") if part == "train" else nothing).alias("combined_weight"),
                "scaledFeatures",
            )
            for part, frame in (
                ("train", tables.train),
                ("val", tables.validation),
                ("test", tables.test),
            )
        ],
    )


@query("flight_model_tables", f"""
WITH {FLIGHTS_SQL}, {NEAREST_SQL}, {FEATURES_SQL}, {PARTS_SQL}
SELECT part, count(*) AS n_rows, CAST(sum(late) AS BIGINT) AS n_late,
       round(sum(weight), 4) AS weight
FROM parts GROUP BY part
""")
def flight_model_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_of(model_tables(spark, sf_dir)).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("DEP_DEL15") == 1).alias("n_late"),
        F.round(F.sum("combined_weight"), 4).alias("weight"),
    )


@query(
    "flight_pipeline",
    f"WITH {FLIGHTS_SQL}, {NEAREST_SQL}, {READINGS_SQL}, {route_rank_sql(40)}, {FEATURES_SQL}, "
    f"{PARTS_SQL}, {scaled_sql()}",
)
def flight_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow from raw tables to folds: every row's part, weight, inputs and folds."""
    tables = model_tables(spark, sf_dir)
    places = {a["name"]: a["idx"] for _, a in vector_attributes(tables.train, "scaledFeatures")}
    entries = vector_to_array("scaledFeatures")
    rows = parts_of(tables).select(
        "OP_CARRIER_FL_NUM",
        "part",
        "DEP_DEL15",
        F.round("combined_weight", 6).alias("combined_weight"),
        *[F.round(entries[places[name]], 6).alias(name) for name, _, _ in CHECKED],
    )
    folds = modeling.model_folds(tables.train, date(1995, 1, 1), date(1998, 9, 22))
    counted = folds.groupBy("OP_CARRIER_FL_NUM").agg(F.count(F.lit(1)).alias("n_folds"))
    return rows.join(counted, "OP_CARRIER_FL_NUM", "left").withColumn(
        "n_folds", F.coalesce("n_folds", F.lit(0).cast("bigint"))
    )


@query("flight_folds", """
WITH rows AS (
  SELECT CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_orderkey % 41 <> 0),
b AS (SELECT CAST(i AS INT) AS fold_id, DATE '1995-01-01' + CAST(i * 252 AS INT) AS a
      FROM range(5) AS r(i))
SELECT fold_id, CASE WHEN day < a + 252 THEN 'train' ELSE 'val' END AS role, count(*) AS n_rows
FROM rows JOIN b ON day >= a AND day < a + 352 GROUP BY ALL
""")
def flight_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = flights(spark, sf_dir).distinct().filter("DEP_DEL15 IS NOT NULL")
    folds = modeling.model_folds(labelled, date(1995, 1, 1), date(1998, 9, 22))
    return folds.groupBy("fold_id", "role").agg(F.count(F.lit(1)).alias("n_rows"))
