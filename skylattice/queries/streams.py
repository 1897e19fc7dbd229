"""Stream queries: tables replayed as files, the rows of the batch operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylattice.queries.joins import KEYS_SQL, TWO_HOURS, errors_flagged, purchases, trailing_sql, views
from skylattice.queries.registry import query
from skylattice.session import scratch_path
from skylattice.streaming import buckets, run, trailing

SLICES = 4
#: Rows of state that the users are dealt to.
BUCKETS = 1024
#: Rows are moved up to this many seconds in the order of arrival.
DISORDER = 3_600


def replayed(df: DataFrame, name: str, time: str, key: str) -> DataFrame:
    """``df`` as a stream in ``SLICES`` batches, out of order by up to ``DISORDER`` seconds.

    A row arrives at its time plus a delay that a hash of ``key`` decides. Slices
    are equal shares of the time from the first to the last arrival.
    """
    spark = df.sparkSession
    arrival: Column = F.unix_seconds(time) + F.pmod(F.xxhash64(key), F.lit(DISORDER))
    ends = df.agg(F.min(arrival).alias("a"), F.max(arrival).alias("b")).first()
    width = (ends["b"] - ends["a"]) // SLICES + 1 if ends["a"] is not None else 1
    at = F.floor((arrival - F.lit(ends["a"] or 0)) / F.lit(width)).cast("int")
    path = scratch_path(spark, name)
    run.write_slices(df, path, F.coalesce(at, F.lit(0)), SLICES)
    files = spark.read.parquet(path).inputFiles()
    return run.read_files(spark, path, df.schema, max(1, len(files) // SLICES))


def collected(stream: DataFrame, name: str) -> DataFrame:
    """The rows that a run over all files appends."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    run.run_available(stream, path, scratch_path(spark, f"{name}_state"))
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_bucket_statistics", f"""
WITH {KEYS_SQL}
SELECT user_id, CAST(time_key AS BIGINT) AS time_key, max(view_value) AS "Max_view_value",
       min(view_value) AS "Min_view_value", round(avg(view_value), 8) AS "Avg_view_value",
       count(view_value) AS "N_view_value"
FROM v
WHERE time_key * 1000000 < (SELECT max(epoch_us(view_ts)) - 7200000000 FROM v)
GROUP BY user_id, time_key
""")
def stream_bucket_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that are complete when the stream of views ends, two hours behind its newest."""
    stream = replayed(views(spark, sf_dir), "views", "view_ts", "view_id")
    stats = buckets.stream_bucket_statistics(
        stream, "user_id", "view_ts", ["view_value"], TWO_HOURS, delay="2 hours"
    )
    newest = views(spark, sf_dir).agg(F.max("view_ts")).first()[0]
    done = F.unix_micros("time_key") < F.unix_micros(F.lit(newest)) - F.lit(TWO_HOURS * 1_000_000)
    return collected(stats.drop(buckets.EVENT_TIME), "stats").where(done).select(
        "user_id",
        F.unix_seconds("time_key").alias("time_key"),
        "Max_view_value",
        "Min_view_value",
        F.round("Avg_view_value", 8).alias("Avg_view_value"),
        "N_view_value",
    )


@query("stream_bucket_join", f"""
WITH {KEYS_SQL},
stats AS (
  SELECT user_id, time_key, max(view_value) AS hi, min(view_value) AS lo, avg(view_value) AS mean
  FROM v GROUP BY user_id, time_key),
ends AS (SELECT least((SELECT max(epoch_us(view_ts)) FROM v), (SELECT max(time_key) * 1000000 FROM p)) AS least_end)
SELECT p.event_id, p.user_id, CAST(p.time_key AS BIGINT) AS time_key,
       hi AS "Max_view_value", lo AS "Min_view_value", round(mean, 8) AS "Avg_view_value"
FROM p LEFT JOIN stats USING (user_id, time_key)
WHERE p.time_key * 1000000 < (SELECT least_end - 4 * 3600000000 FROM ends)
""")
def stream_bucket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases joined to the views two hours before; those that the end of the streams settles."""
    bought, seen = purchases(spark, sf_dir), views(spark, sf_dir)
    stats = buckets.stream_bucket_statistics(
        replayed(seen, "views", "view_ts", "view_id"), "user_id", "view_ts", ["view_value"], TWO_HOURS, "2 hours"
    )
    joined = buckets.stream_bucket_join(
        replayed(bought, "purchases", "ts", "event_id"), stats, "user_id", "ts", TWO_HOURS, TWO_HOURS, "4 hours"
    )
    last_key = bought.agg(F.max(F.floor((F.unix_micros("ts") - 7_200_000_000) / 7_200_000_000))).first()[0]
    last_view = seen.agg(F.max(F.unix_micros("view_ts"))).first()[0]
    settled = min(last_view or 0, (last_key or 0) * 7_200_000_000) - 4 * 3_600_000_000
    return collected(joined, "joined").where(F.unix_micros("time_key") < settled).select(
        "event_id",
        "user_id",
        F.unix_seconds("time_key").alias("time_key"),
        "Max_view_value",
        "Min_view_value",
        F.round("Avg_view_value", 8).alias("Avg_view_value"),
    )


@query("stream_trailing_sum", trailing_sql("user_id"))
def stream_trailing_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``trailing_sum_entity``, from keyed state."""
    stream = replayed(errors_flagged(spark, sf_dir), "events", "ts", "event_id")
    sums = trailing.stream_trailing_sum(
        stream, "user_id", "ts", "is_error", "trailing", ["event_id"], delay="90 minutes", buckets=BUCKETS
    )
    return collected(sums, "trailing").select("event_id", "user_id", "trailing")
