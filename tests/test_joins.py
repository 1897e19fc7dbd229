"""Joins and windows at their edges, and against brute force with a hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skylattice.operators import joins as J
from skylattice.operators.windows import dedupe_latest, trailing_sum
from skylattice.session import left_join_spread

HOUR = 3600
START = datetime(2015, 6, 1)


def at(text):
    return datetime.fromisoformat(text)


def flights(spark, *times, entity="A"):
    rows = [(i, entity, at(t) if t else None) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "id int, e string, t timestamp")


def readings(spark, *rows):
    return spark.createDataFrame(
        [("A", at(t), v) for t, v in rows], "e string, rt timestamp, v double"
    )


def asof(left, right, **options):
    return {
        r["id"]: r["prev"]
        for r in J.asof_previous(
            left, right, ["e"], ["e"], "t", "rt", "v", "prev", lead=2 * HOUR, **options
        ).collect()
    }


def test_fresh_reading_is_not_attached(spark):
    left = flights(spark, "2015-06-01 04:10:00", "2015-06-01 06:10:00")
    per_bucket = J.latest_per_bucket(
        readings(spark, ("2015-06-01 02:59:00", 1.0)), "e", "rt", 2 * HOUR
    )
    got = J.bucket_join(left, per_bucket, "e", "t", 2 * HOUR, lead=2 * HOUR)
    assert {r["id"]: r["v"] for r in got.collect()} == {0: None, 1: 1.0}


def test_statistics_of_text_measures(spark):
    rows = [("S", at("2015-06-01 01:00:00"), v) for v in ("9", "10", "100", "10s", "T", "NaN", None)]
    df = spark.createDataFrame(rows, "s string, t timestamp, m string")
    got = J.bucket_statistics(df, "s", "t", ["m"], 2 * HOUR).first()
    assert (got["Max_m"], got["Min_m"]) == (100.0, 9.0)
    assert got["Avg_m"] == pytest.approx(119 / 3)


def test_latest_and_statistics_in_one_pass(spark):
    rows = readings(
        spark, ("2015-06-01 01:00:00", 5.0), ("2015-06-01 01:30:00", 3.0), ("2015-06-01 03:00:00", 1.0)
    )
    got = J.bucket_statistics(rows, "e", "rt", ["v"], 2 * HOUR, latest=["v"])
    first = got.filter(F.col("time_key") == F.lit(at("2015-06-01 02:00:00"))).first()
    assert (first["rt"], first["v"], first["Max_v"]) == (at("2015-06-01 01:30:00"), 3.0, 5.0)


def test_asof_takes_the_latest_of_several(spark):
    left = flights(spark, "2015-06-01 12:00:00")
    right = readings(spark, ("2015-06-01 08:00:00", 1.0), ("2015-06-01 09:00:00", 2.0))
    assert asof(left, right) == {0: 2.0}


def test_asof_boundary_is_strict(spark):
    left = flights(spark, "2015-06-01 12:00:00")
    assert asof(left, readings(spark, ("2015-06-01 10:00:00", 1.0))) == {0: None}
    assert asof(left, readings(spark, ("2015-06-01 09:59:59.999999", 1.0))) == {0: 1.0}


def test_asof_day_gap(spark):
    left = flights(spark, "2015-06-03 12:00:00")
    assert asof(left, readings(spark, ("2015-06-01 23:00:00", 1.0))) == {0: None}
    assert asof(left, readings(spark, ("2015-06-02 00:00:00", 1.0))) == {0: 1.0}


def test_asof_keeps_a_null_latest_value(spark):
    left = flights(spark, "2015-06-01 12:00:00")
    right = readings(spark, ("2015-06-01 08:00:00", 1.0), ("2015-06-01 09:00:00", None))
    assert asof(left, right) == {0: None}


def test_asof_keeps_rows_without_time_or_key(spark):
    left = flights(spark, None, "2015-06-01 12:00:00").unionByName(
        flights(spark, "2015-06-01 12:00:00", entity=None).withColumn("id", F.lit(7))
    )
    assert asof(left, readings(spark, ("2015-06-01 08:00:00", 1.0))) == {0: None, 1: 1.0, 7: None}


def random_events(n, seed):
    """Events of which a good third belong to one entity, some at the same instant."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        entity = "hot" if rnd.random() < 0.4 else f"e{rnd.randrange(6)}"
        micros = rnd.randrange(0, 4 * 86_400, 7) * 1_000_000 + rnd.choice([0, 0, 1, 500_000])
        rows.append((i, entity, START + timedelta(microseconds=micros), float(rnd.randrange(9))))
    return rows


@pytest.mark.parametrize("slice_seconds", [60, 7200])
def test_asof_against_brute_force(spark, slice_seconds):
    left, right = random_events(400, 1), random_events(500, 2)
    got = asof(
        spark.createDataFrame(left, "id int, e string, t timestamp, x double"),
        spark.createDataFrame(right, "rid int, e string, rt timestamp, v double"),
        slice_seconds=slice_seconds,
    )
    for i, e, t, _ in left:
        cut = t - timedelta(hours=2)
        seen = [
            (rt, v) for _, re, rt, v in right
            if re == e and rt < cut and abs((rt.date() - t.date()).days) <= 1
        ]
        assert got[i] == (max(seen)[1] if seen else None)


def trailing(df, **options):
    result = trailing_sum(df, "e", "t", "v", "s", **options)
    return {r["id"]: r["s"] for r in result.collect()}


@pytest.mark.parametrize("chunk", [86_400, 5_000])
def test_trailing_sum_against_brute_force(spark, chunk):
    rows = random_events(600, 3)
    got = trailing(
        spark.createDataFrame(rows, "id int, e string, t timestamp, v double"), chunk=chunk
    )
    for i, e, t, _ in rows:
        second = t.replace(microsecond=0)
        total = sum(
            v for _, oe, ot, v in rows
            if oe == e and 10_800 <= (second - ot.replace(microsecond=0)).total_seconds() <= 86_400
        )
        assert got[i] == total


def test_trailing_window_ends_count(spark):
    rows = [
        (0, "A", at("2015-06-01 12:00:00"), 1),
        (1, "A", at("2015-06-02 09:00:00"), 1),
        (2, "A", at("2015-06-02 12:00:00"), 1),
        (3, "A", at("2015-06-02 12:00:01"), 1),
    ]
    df = spark.createDataFrame(rows, "id int, e string, t timestamp, v int")
    assert trailing(df) == {0: 0, 1: 1, 2: 2, 3: 1}


def test_rows_without_time_do_not_see_each_other(spark):
    rows = [(0, "A", None, 1), (1, "A", None, 1), (2, None, START, 1)]
    df = spark.createDataFrame(rows, "id int, e string, t timestamp, v int")
    assert trailing(df) == {0: 0, 1: 0, 2: 0}


def test_nearest_station_ties(spark):
    rows = [("K", 5.0, "s2"), ("K", 5.0, "s1"), ("K", 9.0, "s0"), ("L", None, "s3")]
    df = spark.createDataFrame(rows, "k string, d double, s string")
    assert [r["s"] for r in J.nearest_per_key(df, "k", "d").collect()] == ["s1"]
    kept = J.nearest_per_key(df, "k", "d", keep_ties=True).collect()
    assert sorted(r["s"] for r in kept) == ["s1", "s2"]


def test_roles_carry_all_columns(spark):
    fact = spark.createDataFrame([(1, "x", "y"), (2, "z", None)], "id int, o string, d string")
    dim = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "code string, lat double")
    both = J.role_join(J.role_join(fact, dim, "d", "code", "dest_"), dim, "o", "code", "origin_")
    got = {r["id"]: (r["origin_lat"], r["dest_lat"], r["dest_code"]) for r in both.collect()}
    assert got == {1: (1.0, 2.0, "y"), 2: (None, None, None)}


def test_dedupe_is_a_total_order(spark):
    rows = [("a", START, 1), ("a", START, 3), ("a", START - timedelta(days=1), 9)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    assert [r["v"] for r in dedupe_latest(df, ["k"], "t").collect()] == [3]


def test_spread_join_shuffles_by_the_spread(spark):
    """Null keys must not meet in one partition, so the extra key has to survive planning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(1000).select(F.lit(None).cast("bigint").alias("k"), "id")
        right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
        joined = left_join_spread(left, right, ["k"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 1000
        assert len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_null_keys_spread_behind_constant_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(1500).select(
            F.lit(2015).alias("year"), F.lit(1).alias("quarter"), F.lit(1).alias("month"),
            F.lit(None).cast("bigint").alias("k"), "id",
        )
        right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
        sizes = left_join_spread(left, right, ["k"]).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_repeated_lookup_keys_are_noticed(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    dim = spark.createDataFrame([("a", 5), ("a", 6), ("b", 7)], "code string, v int")
    with pytest.raises(ValueError, match="not unique.*a"):
        J.lookup_enrich(fact, dim, "k", "code")
    with pytest.raises(ValueError):
        J.role_join(fact, dim, "k", "code", "p_")
    assert J.lookup_enrich(fact, dim, "k", "code", unique=False).count() == 3
    assert J.lookup_enrich(fact, dim.filter("v > 5"), "k", "code", max_rows=0).count() == 2


def test_latest_and_nearest_of_named_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 9), ("a", 2, "y", 8), ("a", 2, "z", 7), (None, None, "q", 1), (None, None, "p", 2)],
        "k string, t int, v string, w int",
    )
    got = {r["k"]: (r["t"], r["v"], r["w"]) for r in dedupe_latest(df, ["k"], "t").collect()}
    assert got == {"a": (2, "z", 7), None: (None, "q", 1)}
    assert dedupe_latest(df, ["k"], "t", columns=["k", "v"]).filter("k = 'a'").first().asDict() == {"k": "a", "v": "z"}
    assert J.nearest_per_key(df, "k", "t", columns=["v"]).collect()[0]["v"] == "x"


def test_hot_left_key_stays_whole(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id"
    )
    right = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = left_join_spread(left, right, ["k"])
    assert got.count() == 3000 and got.filter("w = k * 2").count() == 3000


def test_lookup_of_a_large_dimension(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 5), (None, 9)], "code string, v int")
    small = sorted(J.lookup_enrich(fact, dim, "k", "code").collect())
    large = sorted(J.lookup_enrich(fact, dim, "k", "code", max_rows=0).collect())
    assert small == large == [(1, "a", "a", 5), (2, None, None, None), (3, "z", None, None)]


def test_text_days_that_are_no_dates(spark):
    from skylattice.functions.holidays import days_to_nearest_holiday
    from skylattice.operators.prep import recency_weight
    from skylattice.operators.split import trailing_holdout

    df = spark.createDataFrame([("2017-07-04",), ("NA",), (None,)], "d string")
    got = {r["d"]: r["days_to_nearest_holiday"] for r in days_to_nearest_holiday(df, "d").collect()}
    assert got == {"2017-07-04": 0, "NA": None, None: None}
    assert recency_weight(df, "d").count() == 3
    assert [p.count() for p in trailing_holdout(df, "d")] == [0, 1]


def test_asof_with_days_of_their_own(spark):
    rows = [(1, "A", at("2015-06-02 02:00:00"), "2015-06-01"), (2, "A", at("2015-06-02 03:00:00"), "x")]
    left = spark.createDataFrame(rows, "id int, e string, t timestamp, d string")
    right = spark.createDataFrame(
        [("A", at("2015-06-01 23:00:00"), 4.0, "2015-06-02")], "e string, rt timestamp, v double, rd string"
    )
    # the other day is later, which only days of their own allow
    assert asof(left, right, left_day="d", right_day="rd") == {1: 4.0, 2: None}
