"""Time expressions. Calendar parts are those of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def day_of(column: str) -> Column:
    """Date of a date, timestamp or text column, null for text that is no date."""
    return F.expr(f"try_cast(`{column}` AS DATE)")


def hhmm_hour(hhmm: Column) -> Column:
    """Hour of an integer like 930 (09:30)."""
    return ((hhmm - F.pmod(hhmm, F.lit(100))) / 100).cast("int")


def hhmm_minute(hhmm: Column) -> Column:
    """Minute of an integer like 930 (09:30)."""
    return F.pmod(hhmm, F.lit(100)).cast("int")


def local_timestamp(day: Column, hhmm: Column) -> Column:
    """The instant whose UTC clock shows a date and an hhmm integer.

    It is counted in seconds, so the session time zone plays no part. 2400 is
    midnight at the end of the day. Values that are no clock time give null.
    """
    hour, minute = hhmm_hour(hhmm), hhmm_minute(hhmm)
    valid = hhmm.between(0, 2400) & (minute < 60)
    days = F.unix_date(day.cast("date")).cast("bigint")
    return F.when(valid, F.timestamp_seconds(days * 86_400 + hour * 3600 + minute * 60))


def local_to_utc(local: Column, zone: Column) -> Column:
    """UTC instant of a wall clock given by :func:`local_timestamp`.

    Daylight saving follows the zone; the session time zone plays no part.
    """
    return F.to_utc_timestamp(local, zone)


def shifted(ts: Column, seconds: int) -> Column:
    """``ts`` moved by a whole number of seconds (negative is earlier)."""
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def timestamp_from_parts(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Timestamp at the full hour, null when the parts name no instant."""
    zero = F.lit(0)
    return F.try_make_timestamp(year, month, day, hour, zero, zero.cast("decimal(16,6)"))


def bucket_floor(ts: Column, width: int, offset: int = 0) -> Column:
    """Start of the ``width``-second bucket holding ``ts``.

    Buckets start at ``offset`` seconds after midnight UTC. The whole timestamp
    is rounded, so the bucket of 00:30 may lie on the day before.
    """
    micros = F.unix_micros(ts)
    past = F.pmod(micros - F.lit(offset * MICROS), F.lit(width * MICROS))
    return F.timestamp_micros(micros - past)


def bucket_ceil(ts: Column, width: int, offset: int = 0) -> Column:
    """First bucket start at or after ``ts``."""
    micros = F.unix_micros(ts)
    missing = F.pmod(F.lit(offset * MICROS) - micros, F.lit(width * MICROS))
    return F.timestamp_micros(micros + missing)


def composite_key(*cols: Column) -> Column:
    """Text key of several columns, null when any of them is."""
    return F.concat(*[c.cast("string") for c in cols])


def calendar_parts(ts: Column, prefix: str) -> list[Column]:
    """Year, month, day and hour columns named ``prefix_*``."""
    return [
        F.year(ts).alias(f"{prefix}_year"),
        F.month(ts).alias(f"{prefix}_month"),
        F.day(ts).alias(f"{prefix}_day"),
        F.hour(ts).alias(f"{prefix}_hour"),
    ]
