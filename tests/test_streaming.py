"""Streams against their batch twins, late rows, restarts and the size of the state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skylattice.operators import joins as J
from skylattice.operators.windows import trailing_sum
from skylattice.session import scratch_path
from skylattice.streaming import buckets, run, trailing

READINGS = "station string, time timestamp, wind string, id long"
T0 = dt.datetime(2024, 3, 1)
HOUR = 3600


def at(seconds, micros=0):
    return T0 + dt.timedelta(seconds=seconds, microseconds=micros)


def arrive(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def readings(seed, hours, n):
    """Readings in order of arrival, up to half an hour out of order, some on a bucket's edge."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        second = rng.randrange(hours * HOUR)
        if i % 9 == 0:
            second -= second % (2 * HOUR)
        wind = rng.choice(["3", "4.5", "x", None, "7", "nan"])
        out.append((second + rng.randrange(1800), (rng.choice("ABC"), at(second, i % 2), wind, i)))
    return [row for _, row in sorted(out, key=lambda x: x[0])]


def batch_statistics(df):
    stats = J.bucket_statistics(df, "station", "time", ["wind"], 2 * HOUR)
    return {(r.station, r.time_key): (r.Max_wind, r.Min_wind, r.Avg_wind) for r in stats.collect()}


def stream_statistics(spark, path, delay="1 hour"):
    stream = run.read_files(spark, path, READINGS, 1)
    stats = buckets.stream_bucket_statistics(stream, "station", "time", ["wind"], 2 * HOUR, delay)
    return stats.drop(buckets.EVENT_TIME)


def stored(spark, path):
    rows = spark.read.parquet(path).collect()
    found = {(r.station, r.time_key): (r.Max_wind, r.Min_wind, r.Avg_wind) for r in rows}
    assert len(found) == len(rows)  # no bucket twice
    return found


def test_statistics_equal_batch_and_a_restart_repeats_nothing(spark):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    rows = readings(1, 30, 400) + [(None, at(5), "1", -1), ("A", None, "1", -2)]
    for a in (0, 100, 200):
        arrive(spark, source, rows[a : a + 100], READINGS)
    stats = stream_statistics(spark, source)
    first = run.run_available(stats, sink, state)
    assert first.rows_late == 0 and first.rows_read == 300 and first.batches >= 3
    before = stored(spark, sink)
    again = run.run_available(stats, sink, state)
    assert again.rows_read == 0 and stored(spark, sink) == before
    # what waited in the state of the first run is finished by the second
    arrive(spark, source, rows[300:], READINGS)
    arrive(spark, source, [("Z", at(40 * HOUR), "1", 9999)], READINGS)
    second = run.run_available(stats, sink, state)
    assert second.rows_read == 103 and second.rows_late == 0
    expected = batch_statistics(spark.createDataFrame(rows[:400], READINGS))
    assert stored(spark, sink) == expected and len(before) < len(expected)


def test_late_readings_are_left_out_and_counted(spark):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    on_time = [("A", at(i * 600), "2", i) for i in range(60)]
    late = [("A", at(60), "99", 100), ("A", at(120), "98", 101)]
    fits = [("A", at(59 * 600 - 1800), "50", 102)]
    arrive(spark, source, on_time[:50], READINGS)
    arrive(spark, source, on_time[50:], READINGS)  # gives the first buckets
    arrive(spark, source, late + fits, READINGS)
    arrive(spark, source, [("A", at(80 * HOUR), "1", 103)], READINGS)
    told = run.run_available(stream_statistics(spark, source), sink, state)
    # the two fall into one bucket, so one partial row of the aggregation is dropped
    assert told.rows_late == 1
    expected = batch_statistics(spark.createDataFrame(on_time + fits, READINGS))
    assert stored(spark, sink) == expected


FLIGHTS = "flight long, station string, departure timestamp"


def test_bucket_join_equals_batch(spark):
    weather, flown, sink, state = (scratch_path(spark, x) for x in ("w", "f", "out", "state"))
    rows = readings(2, 24, 300)
    rng = random.Random(5)
    flights = [(i, rng.choice("ABCD"), at(rng.randrange(26 * HOUR))) for i in range(200)]
    flights.sort(key=lambda r: r[2] + dt.timedelta(seconds=r[0] % 1800))
    odd = [(900, None, at(5 * HOUR)), (901, "A", None)]
    end_r, end_f = [("Z", at(90 * HOUR), "1", 9999)], [(9999, "Z", at(90 * HOUR))]
    for part in (rows[:150], rows[150:], end_r):
        arrive(spark, weather, part, READINGS)
    for part in (flights[:100], flights[100:] + odd, end_f):
        arrive(spark, flown, part, FLIGHTS)
    stats = buckets.stream_bucket_statistics(
        run.read_files(spark, weather, READINGS, 1), "station", "time", ["wind"], 2 * HOUR, "1 hour"
    )
    joined = buckets.stream_bucket_join(
        run.read_files(spark, flown, FLIGHTS, 1), stats, "station", "departure", 2 * HOUR, 2 * HOUR, "2 hours"
    )
    told = run.run_available(joined, sink, state)
    assert told.rows_late == 0
    got = {r.flight: (r.time_key, r.Max_wind, r.Avg_wind) for r in spark.read.parquet(sink).collect()}
    batch = J.bucket_join(
        spark.createDataFrame(flights + odd, FLIGHTS),
        J.bucket_statistics(spark.createDataFrame(rows, READINGS), "station", "time", ["wind"], 2 * HOUR),
        "station", "departure", 2 * HOUR, 2 * HOUR,
    )
    assert got == {r.flight: (r.time_key, r.Max_wind, r.Avg_wind) for r in batch.collect()}
    assert spark.read.parquet(sink).count() == 202
    assert told.state_rows[-1] <= 10


EVENTS = "id long, tail string, time timestamp, late int"


@pytest.mark.parametrize("files", [1, 3])
def test_trailing_sum_equals_batch_with_bounded_state(spark, files):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    rng = random.Random(files)
    rows = [(i, rng.choice(["N1", "N2", "N3"]), at(rng.randrange(20 * 86400)), rng.choice([0, 1, 1, None])) for i in range(900)]
    rows += [(900 + i, "N1", rows[i][2], 1) for i in range(20)]  # the same second again
    rows.sort(key=lambda r: r[2] + dt.timedelta(seconds=r[0] % 1800))
    odd = [(5000, None, at(9), 1), (5001, "N1", None, 1)]
    n = len(rows) // 9 + 1
    for a in range(0, len(rows), n):
        arrive(spark, source, rows[a : a + n] + (odd if a == 0 else []), EVENTS)
    stream = run.read_files(spark, source, EVENTS, files)
    sums = trailing.stream_trailing_sum(stream, "tail", "time", "late", "trailing", ["id", "time"], "1 hour")
    told = run.run_available(sums, sink, state)
    got = {r.id: (r.tail, r.time, r.trailing) for r in spark.read.parquet(sink).collect()}
    batch = trailing_sum(spark.createDataFrame(rows + odd, EVENTS), "tail", "time", "late", "trailing")
    assert got == {r.id: (r.tail, r.time, r.trailing) for r in batch.collect()}
    assert spark.read.parquet(sink).count() == len(rows) + 2 and told.rows_late == 0
    assert max(told.state_rows) <= 3


@pytest.mark.parametrize("kind, buckets", [("int", 1), ("int", 5), ("double", 3)])
def test_entities_of_a_bucket_do_not_mix(spark, kind, buckets):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    schema = f"id long, tail string, time timestamp, late {kind}"
    rng = random.Random(buckets)
    late = [0, 1, 2, None] if kind == "int" else [0.1, 1e17, float("nan"), None]
    rows = [(i, f"N{rng.randrange(12)}", at(rng.randrange(15 * 86400)), None) for i in range(900)]
    rows = [(*r[:3], rng.choice(late[:2] if r[1] != "N3" else late)) for r in rows]
    rows += [(1000, "gone", at(0), late[0])]
    rows.sort(key=lambda r: r[2] + dt.timedelta(seconds=r[0] % 1800))
    for a in range(0, len(rows), 151):
        arrive(spark, source, rows[a : a + 151], schema)
    told, got = [], []
    for n in (None, buckets):
        sums = trailing.stream_trailing_sum(
            run.read_files(spark, source, schema, 1), "tail", "time", "late", "trailing", ["id", "time"], "1 hour", buckets=n
        )
        told.append(run.run_available(sums, f"{sink}{n}", f"{state}{n}"))
        found = spark.read.parquet(f"{sink}{n}").collect()
        got.append({r.id: (r.tail, r.time, repr(r.trailing)) for r in found})
        assert len(found) == len(rows)
    assert got[0] == got[1]
    if kind == "int":
        batch = trailing_sum(spark.createDataFrame(rows, schema), "tail", "time", "late", "trailing")
        assert got[1] == {r.id: (r.tail, r.time, repr(r.trailing)) for r in batch.collect()}
    assert max(told[1].state_rows) <= buckets < max(told[0].state_rows)


def test_the_ring_is_cut_and_idle_entities_go(spark):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    for day in range(12):
        rows = [(day * 100 + i, "busy", at(day * 86400 + i * 600), 1) for i in range(100)]
        if day == 0:
            rows += [(7000 + i, f"idle{i}", at(i), 1) for i in range(50)]
        arrive(spark, source, rows, EVENTS)
    stream = run.read_files(spark, source, EVENTS, 1)
    sums = trailing.stream_trailing_sum(stream, "tail", "time", "late", "trailing", ["id"], "1 hour")
    told = run.run_available(sums, sink, state)
    assert told.state_rows[0] == 51 and told.state_rows[-1] == 1
    later = told.state_bytes[8:]
    assert max(later) < 1.5 * min(later)  # twelve days in, no more than after eight
    assert spark.read.parquet(sink).count() == 1250
    dropped = spark.read.parquet(sink).where("tail = 'busy'").agg(F.max("trailing")).first()[0]
    assert dropped == 86400 // 600 - 10800 // 600 or dropped <= 100


def test_restart_of_the_trailing_sum(spark):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    rows = [(i, "N1", at(i * 1200), i % 2) for i in range(200)]
    arrive(spark, source, rows[:90], EVENTS)
    make = lambda: trailing.stream_trailing_sum(
        run.read_files(spark, source, EVENTS, 1), "tail", "time", "late", "trailing", ["id"], "1 hour"
    )
    run.run_available(make(), sink, state)
    arrive(spark, source, rows[90:], EVENTS)
    run.run_available(make(), sink, state)
    assert run.run_available(make(), sink, state).rows_read == 0
    got = sorted((r.id, r.trailing) for r in spark.read.parquet(sink).collect())
    batch = trailing_sum(spark.createDataFrame(rows, EVENTS), "tail", "time", "late", "trailing")
    assert got == sorted((r.id, r.trailing) for r in batch.collect())


def test_floating_values_and_failures(spark):
    source, sink, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    arrive(spark, source, [(i, "N1", at(i * 3600), 0.5 * i) for i in range(40)], "id long, tail string, time timestamp, late double")
    stream = run.read_files(spark, source, "id long, tail string, time timestamp, late double")
    sums = trailing.stream_trailing_sum(stream, "tail", "time", "late", "trailing", ["id"], "1 hour")
    run.run_available(sums, sink, state)
    got = {r.id: r.trailing for r in spark.read.parquet(sink).collect()}
    assert got[30] == sum(0.5 * i for i in range(6, 28))
    bad = run.read_files(spark, source, "id long").select(F.raise_error(F.lit("broken row")).alias("x"))
    with pytest.raises(Exception, match="broken row"):
        run.run_available(bad.selectExpr("cast(x as string) x"), scratch_path(spark, "o"), scratch_path(spark, "s"))
