"""Incremental statistics, row differences, sketches, levels and co-located tables on small frames."""

import datetime as dt
import math
import random
from collections import Counter
from itertools import chain

import pytest
from pyspark.sql import functions as F

from skylattice.operators import difference, incremental, levels, sketches
from skylattice.operators import joins as J
from skylattice.session import scratch_path
from skylattice.sources import colocated

T0 = dt.datetime(2024, 3, 1)
READINGS = "station string, time timestamp, wind string, code long"


def readings(spark, seed, n, days):
    rng = random.Random(seed)
    rows = [
        (rng.choice("ABC"), T0 + dt.timedelta(seconds=rng.choice(days) * 86400 + rng.randrange(43200)), rng.choice(["1", "2.5", "x", None, "nan"]), seed * 10_000 + i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows + [(None, T0, "9", 0), ("A", None, "9", 0)], READINGS)


def upsert(path, df, number):
    partials = incremental.partial_statistics(df, "station", "time", ["wind"], 7200, latest=["code"])
    incremental.upsert_statistics(partials, path, "station", "time", ["wind"], number)


def files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_batches_merge_to_the_statistics_of_all_rows(spark):
    path = scratch_path(spark, "buckets")
    batches = [readings(spark, 1, 120, [0, 1, 2]), readings(spark, 2, 60, [1, 4]), readings(spark, 3, 60, [0])]
    upsert(path, batches[0], 0)
    first = files(spark, path)
    upsert(path, batches[1], 1)
    second = files(spark, path)
    # days 0 and 2 have no reading in the second batch; the last bucket may end on the next day
    assert {f for f in first if "2024-03-01" in f or "2024-03-03" in f} <= second
    assert not {f for f in first if "2024-03-02" in f} & second
    upsert(path, batches[2], 2)
    before = sorted(map(str, spark.read.parquet(path).collect()))
    kept = files(spark, path)
    upsert(path, batches[2], 2)  # a batch that is repeated changes nothing
    upsert(path, batches[1], 1)
    assert sorted(map(str, spark.read.parquet(path).collect())) == before and files(spark, path) == kept
    together = batches[0].unionByName(batches[1]).unionByName(batches[2])
    stats = J.bucket_statistics(together, "station", "time", ["wind"], 7200, latest=["code"])
    expected = {(r.station, r.time_key): (r.Max_wind, r.Min_wind, r.Avg_wind, r.code) for r in stats.collect()}
    stored = spark.read.parquet(path)
    last = {(r.station, r.time_key): r.Last_code for r in stored.collect()}
    done = incremental.finished_statistics(stored, "station", ["wind"]).collect()
    got = {(r.station, r.time_key): (r.Max_wind, r.Min_wind, r.Avg_wind, last[r.station, r.time_key]) for r in done}
    assert got == expected


def test_an_empty_batch_and_an_empty_table(spark):
    path = scratch_path(spark, "buckets")
    none = spark.createDataFrame([], READINGS)
    upsert(path, none, 0)
    upsert(path, readings(spark, 5, 20, [0]), 1)
    upsert(path, none, 2)
    n = spark.read.parquet(path).agg(F.sum("N_wind")).first()[0]
    assert n == readings(spark, 5, 20, [0]).where("station is not null and time is not null and wind in ('1', '2.5')").count()


ROW = "k long, a string, x double"


def plain(r):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)


def versions(seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([1, 2, 3, None]), rng.choice(["p", "", None]), rng.choice([0.0, 1.5, None, float("nan")]))
    one = [row() for _ in range(60)]
    two = one[:40] + [row() for _ in range(25)]
    return one, two


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_multiset_difference_is_except_all_both_ways(spark, seed):
    one, two = versions(seed)
    a, b = Counter(map(plain, one)), Counter(map(plain, two))
    expected = {r: (a[r], b[r]) for r in chain(a, b) if a[r] != b[r]}
    df1, df2 = spark.createDataFrame(one, ROW), spark.createDataFrame(two, ROW).select("x", "k", "a")
    rows = difference.multiset_difference(df1, df2).collect()
    assert {plain(r[:3]): (r.n_before, r.n_after) for r in rows} == expected and len(rows) == len(expected)
    assert difference.multiset_difference(df1, df1).count() == 0


def test_negative_zero_nulls_in_a_row_and_other_columns(spark):
    zero = spark.createDataFrame([(1, "a", 0.0)], ROW)
    assert difference.multiset_difference(zero, spark.createDataFrame([(1, "a", -0.0)], ROW)).count() == 0
    left = spark.createDataFrame([(None, "a", "b"), ("a", None, "b")], "x string, y string, z string")
    right = spark.createDataFrame([("a", "b", None), ("a", None, "b")], "x string, y string, z string")
    assert difference.multiset_difference(left, right).count() == 2
    with pytest.raises(ValueError, match="columns differ"):
        difference.multiset_difference(left, left.drop("z"))


def test_changes_name_the_columns(spark):
    one = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "n", 1.0), (5, "r", 1.0), (5, "r", 1.0), (6, "s", 1.0)]
    two = [(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (None, "m", None), (5, "r", 1.0), (6, "s", 1.0), (6, "s", 1.0), (6, "t", 1.0)]
    rows = difference.row_changes(spark.createDataFrame(one, ROW), spark.createDataFrame(two, ROW), ["k"]).collect()
    got = {(r.k, r.kind, r.n_rows, tuple(r.changed_columns), tuple(r.before or ()), tuple(r.after or ())) for r in rows}
    assert got == {
        (2, "changed", 1, ("x",), ("b", None), ("b", 2.0)),
        (None, "changed", 1, ("a", "x"), ("n", 1.0), ("m", None)),
        (3, "removed", 1, (), ("c", 3.0), ()),
        (4, "added", 1, (), (), ("d", 4.0)),
        (5, "removed", 1, (), ("r", 1.0), ()),
        (6, "added", 1, (), (), ("s", 1.0)),
        (6, "added", 1, (), (), ("t", 1.0)),
    }


def test_only_hashes_are_counted(spark):
    df = spark.range(5).select("id", F.lit("text").alias("wide"))
    sides = difference._hashed(df, df.columns).select("__h1", "__h2").groupBy("__h1", "__h2").count()
    plan = sides._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.split("\n") if "Exchange" in line]
    assert exchange and not any("wide" in line for line in exchange)


def test_sketches_of_days_answer_for_periods(spark):
    rows = spark.range(40_000).select(
        F.expr("timestamp'2024-03-01' + make_interval(0, 0, 0, cast(id % 12 as int))").alias("t"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("user"),
        F.when(F.col("id") % 100 == 0, F.lit(float("nan"))).otherwise(F.sqrt(F.col("id").cast("double"))).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit("x")).alias("g"),
    )
    stored = sketches.daily_sketches(rows, "t", ["user", "g"], ["v"], ["g"]).cache()
    assert stored.count() == 24
    for first, last in [(0, 0), (0, 5), (3, 11)]:
        day = lambda c: F.datediff(c, F.lit(dt.date(2024, 3, 1))).between(first, last)
        got = sketches.period_estimates(stored.where(day("day")), ["user", "g"], ["v"], ["g"], [0.1, 0.5, 0.9]).collect()
        exact = rows.where(day("t")).groupBy("g").agg(F.count_distinct("user").alias("u"), F.count("*").alias("n")).collect()
        users = {r.g: (r.u, r.n) for r in exact}
        for r in got:
            u, n = users[r.g]
            assert r.n_rows == n and abs(r.distinct_user - u) <= sketches.distinct_error() * u
            assert r.distinct_g == (1 if r.g else 0)
            values = sorted(x.v for x in rows.where(day("t") & F.col("g").eqNullSafe(r.g) & ~F.isnan("v")).select("v").collect())
            for p, q in zip([0.1, 0.5, 0.9], r.quantiles_v):
                rank = sum(v <= q for v in values) / len(values)
                assert abs(rank - p) <= sketches.rank_error() + 1 / len(values)
    new = sketches.newly_seen(stored, "user", F.dayofmonth("day") <= 6, F.dayofmonth("day") > 6).first().n_new
    old = {r.user for r in rows.where("dayofmonth(t) <= 6").select("user").distinct().collect()}
    fresh = {r.user for r in rows.where("dayofmonth(t) > 6").select("user").distinct().collect()}
    assert abs(new - len(fresh - old)) <= sketches.theta_error() * len(old | fresh)


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "t timestamp, u string, v double")
    stored = sketches.daily_sketches(none, "t", ["u"], ["v"])
    assert stored.count() == 0
    alone = spark.createDataFrame([(None, None, None)], "t timestamp, u string, v double")
    got = sketches.period_estimates(sketches.daily_sketches(alone, "t", ["u"]), ["u"]).first()
    assert (got.n_rows, got.distinct_u) == (1, 0)


def test_levels_tell_real_nulls_from_rolled_up_ones(spark):
    rows = [("x", "a", 1.0), ("x", None, 3.0), (None, None, 5.0), ("y", "a", None)]
    df = spark.createDataFrame(rows, "p string, q string, v double")
    got = levels.level_statistics(df, levels.rollup_levels(["p", "q"]), {"v": "v"}).collect()
    found = {(r.level, r.p, r.q): (r.n_rows, r.N_v, r.Sum_v, r.Avg_v) for r in got}
    assert found == {
        ("p+q", "x", "a"): (1, 1, 1.0, 1.0),
        ("p+q", "x", None): (1, 1, 3.0, 3.0),
        ("p+q", None, None): (1, 1, 5.0, 5.0),
        ("p+q", "y", "a"): (1, 0, None, None),
        ("p", "x", None): (2, 2, 4.0, 2.0),
        ("p", None, None): (1, 1, 5.0, 5.0),
        ("p", "y", None): (1, 0, None, None),
        ("all", None, None): (4, 3, 9.0, 3.0),
    }
    cube = levels.level_statistics(df, levels.cube_levels(["p", "q"])).collect()
    assert Counter(r.level for r in cube) == {"p+q": 4, "p": 3, "q": 2, "all": 1}
    assert {r.level: r.level_id for r in cube} == {"p+q": 0, "p": 1, "q": 2, "all": 3}


def test_rows_are_reduced_before_they_are_expanded(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("p"), (F.col("id") % 2).alias("q"))
    out = levels.level_statistics(df, levels.cube_levels(["p", "q"]))
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [i for i, line in enumerate(plan) if "Expand" in line]
    assert len(at) == 1 and "Aggregate" in plan[at[0] + 1]


def test_pivot_of_nothing_and_of_other_values(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0), ("b", None, 1.0)], "k string, m int, v double")
    got = {r.k: (r["1"], r["2"]) for r in levels.pivoted(df, ["k"], "m", [1, 2], "v").collect()}
    assert got == {"a": (2.0, None), "b": (None, None)}


def test_colocated_tables_join_without_a_shuffle(spark):
    left = spark.range(1000).select((F.col("id") % 300).alias("k"), F.col("id").alias("l"))
    right = spark.range(500).select((F.col("id") % 400).alias("k"), F.col("id").alias("r"))
    for name, df in (("left_rows", left), ("right_rows", right)):
        colocated.write_colocated(df, name, ["k"], 4, path=scratch_path(spark, name))
    one, two = (colocated.read_colocated(spark, n) for n in ("left_rows", "right_rows"))
    joined = colocated.colocated_join(one, two, ["k"])
    rows = Counter(map(tuple, joined.select("k", "l", "r").collect()))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows == Counter(map(tuple, left.join(right, "k", "left").select("k", "l", "r").collect()))
    summed = joined.groupBy("k").agg(F.count("r").alias("n"))
    assert "Exchange" not in summed._jdf.queryExecution().executedPlan().toString()
    colocated.write_colocated(left.limit(10), "left_rows", ["k"], 4, path=scratch_path(spark, "again"))
    assert colocated.read_colocated(spark, "left_rows").count() == 10
