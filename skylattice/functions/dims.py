"""Fixed lookup dimensions and recoding by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# IANA time zone per US state or territory.
STATE_ZONES = {
    "AL": "America/Chicago", "AK": "America/Anchorage", "AZ": "America/Phoenix",
    "AR": "America/Chicago", "CA": "America/Los_Angeles", "CO": "America/Denver",
    "CT": "America/New_York", "DE": "America/New_York", "FL": "America/New_York",
    "GA": "America/New_York", "HI": "Pacific/Honolulu", "ID": "America/Boise",
    "IL": "America/Chicago", "IN": "America/Indiana/Indianapolis", "IA": "America/Chicago",
    "KS": "America/Chicago", "KY": "America/New_York", "LA": "America/Chicago",
    "ME": "America/New_York", "MD": "America/New_York", "MA": "America/New_York",
    "MI": "America/Detroit", "MN": "America/Chicago", "MS": "America/Chicago",
    "MO": "America/Chicago", "MT": "America/Denver", "NE": "America/Chicago",
    "NV": "America/Los_Angeles", "NH": "America/New_York", "NJ": "America/New_York",
    "NM": "America/Denver", "NY": "America/New_York", "NC": "America/New_York",
    "ND": "America/Chicago", "OH": "America/New_York", "OK": "America/Chicago",
    "OR": "America/Los_Angeles", "PA": "America/New_York", "RI": "America/New_York",
    "SC": "America/New_York", "SD": "America/Chicago", "TN": "America/Chicago",
    "TX": "America/Chicago", "UT": "America/Denver", "VT": "America/New_York",
    "VA": "America/New_York", "WA": "America/Los_Angeles", "WV": "America/New_York",
    "WI": "America/Chicago", "WY": "America/Denver", "VI": "America/St_Thomas",
    "AS": "Pacific/Pago_Pago", "GU": "Pacific/Guam", "MP": "Pacific/Saipan",
    "PR": "America/Puerto_Rico", "TT": "Pacific/Chatham",
}

# Geographic region per US state or territory.
STATE_REGIONS = {
    "AL": "Southeast", "AK": "West", "AZ": "West", "AR": "South", "CA": "West",
    "CO": "West", "CT": "Northeast", "DE": "Northeast", "FL": "Southeast",
    "GA": "Southeast", "HI": "West", "ID": "West", "IL": "Midwest", "IN": "Midwest",
    "IA": "Midwest", "KS": "Midwest", "KY": "South", "LA": "South", "ME": "Northeast",
    "MD": "Northeast", "MA": "Northeast", "MI": "Midwest", "MN": "Midwest",
    "MS": "South", "MO": "Midwest", "MT": "West", "NE": "Midwest", "NV": "West",
    "NH": "Northeast", "NJ": "Northeast", "NM": "West", "NY": "Northeast",
    "NC": "Southeast", "ND": "Midwest", "OH": "Midwest", "OK": "South", "OR": "West",
    "PA": "Northeast", "RI": "Northeast", "SC": "Southeast", "SD": "Midwest",
    "TN": "South", "TX": "South", "UT": "West", "VT": "Northeast", "VA": "Southeast",
    "WA": "West", "WV": "South", "WI": "Midwest", "WY": "West", "VI": "Atlantic",
    "AS": "Pacific", "GU": "Pacific", "MP": "Pacific", "PR": "Atlantic", "TT": "Pacific",
}

UNKNOWN_REGION = "Unknown"


def recode(
    df: DataFrame,
    column: str,
    mapping: dict,
    out: str,
    default: str | None = None,
    keep_unmapped: bool = False,
) -> DataFrame:
    """Add ``out``: ``column`` looked up in ``mapping``.

    A value without an entry becomes ``default``, or stays as it is with
    ``keep_unmapped``. The mapping is a literal table, so broadcasting it is
    bounded by the length of the Python dict.
    """
    key_type = df.schema[column].dataType.simpleString()
    rows = df.sparkSession.createDataFrame(
        list(mapping.items()), f"`{column}` {key_type}, __mapped string"
    )
    fallback = F.col(column).cast("string") if keep_unmapped else F.lit(default).cast("string")
    return (
        df.join(F.broadcast(rows), column, "left")
        .withColumn(out, F.coalesce("__mapped", fallback))
        .select(*[c for c in df.columns if c != out], out)
    )


def with_time_zone(df: DataFrame, state: str, out: str = "time_zone") -> DataFrame:
    """Time zone of a state code; a code without a zone gives null."""
    return recode(df, state, STATE_ZONES, out)


def with_region(df: DataFrame, state: str, out: str = "region") -> DataFrame:
    """Geographic region of a state code, ``Unknown`` without an entry."""
    return recode(df, state, STATE_REGIONS, out, default=UNKNOWN_REGION)


def unmapped_counts(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Rows per value of ``column`` that ``mapping`` does not cover."""
    known = F.col(column).isin(list(mapping))
    return (
        df.filter(F.col(column).isNull() | ~known)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
