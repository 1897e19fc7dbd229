"""Distance in days to the nearest US federal holiday."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.functions.temporal import day_of
from skylattice.session import lookup_join

MONDAY, THURSDAY = 0, 3


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th given weekday of a month; n = -1 is the last one."""
    if n < 0:
        nxt = date(year + month // 12, month % 12 + 1, 1)
        return nxt - timedelta(days=(nxt.weekday() - weekday - 1) % 7 + 1)
    first = date(year, month, 1)
    return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))


def federal_holidays(first_year: int, last_year: int) -> list[date]:
    """Federal holidays, and the weekday they are observed on, in order.

    A holiday on Saturday is also observed on Friday, one on Sunday on Monday.
    """
    days: set[date] = set()
    for year in range(first_year, last_year + 1):
        fixed = [date(year, 1, 1), date(year, 7, 4), date(year, 11, 11), date(year, 12, 25)]
        if year >= 2021:
            fixed.append(date(year, 6, 19))
        for day in fixed:
            shift = {5: -1, 6: 1}.get(day.weekday(), 0)
            days.update({day, day + timedelta(days=shift)})
        days.update({
            _nth_weekday(year, 1, MONDAY, 3),
            _nth_weekday(year, 2, MONDAY, 3),
            _nth_weekday(year, 5, MONDAY, -1),
            _nth_weekday(year, 9, MONDAY, 1),
            _nth_weekday(year, 10, MONDAY, 2),
            _nth_weekday(year, 11, THURSDAY, 4),
        })
    return sorted(days)


def holiday_distances(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per calendar day: ``calendar_date, days_to_nearest_holiday``."""
    holidays = federal_holidays(first_year - 1, last_year + 1)
    gaps = spark.createDataFrame(
        list(zip(holidays, holidays[1:])), "holiday_from date, holiday_to date"
    )
    return gaps.select(
        F.explode(F.sequence("holiday_from", F.date_sub("holiday_to", 1))).alias("calendar_date"),
        "holiday_from",
        "holiday_to",
    ).select(
        "calendar_date",
        F.least(
            F.datediff("calendar_date", "holiday_from"),
            F.datediff("holiday_to", "calendar_date"),
        ).alias("days_to_nearest_holiday"),
    )


def days_to_nearest_holiday(
    df: DataFrame,
    day: str,
    out: str = "days_to_nearest_holiday",
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the days between ``day`` and the closest holiday before or after it.

    The distances are worked out once per calendar day of the years in the data
    (or of ``source``, a stored frame holding its rows) and joined back on the
    date.
    """
    year = F.year(day_of(day))
    years = (
        (df if source is None else source)
        .agg(F.min(year).alias("lo"), F.max(year).alias("hi"))
        .first()
    )
    if years["lo"] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    calendar = holiday_distances(df.sparkSession, years["lo"], years["hi"])
    calendar = calendar.withColumnRenamed("days_to_nearest_holiday", out)
    kept = [c for c in df.columns if c != out]
    dated = df.select(*kept, day_of(day).alias("calendar_date"))
    return lookup_join(dated, calendar, ["calendar_date"]).select(*kept, out)
