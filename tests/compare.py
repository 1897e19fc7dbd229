"""Compare a Spark result with the rows DuckDB gives for its SQL twin."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "array<int>": "INTEGER[]",
    "array<double>": "DOUBLE[]",
}


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def differences(df, con, sql):
    """A text saying how the results differ, empty when they agree."""
    names = sorted(df.columns)
    types = dict(df.dtypes)
    relation = con.sql(sql)
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    if names != sorted(duck_types):
        return f"columns {names} != {sorted(duck_types)}"
    bad = {
        n: (types[n], duck_types[n]) for n in names if DUCK_TYPES.get(types[n]) != duck_types[n]
    }
    if bad:
        return f"types differ: {bad}"
    ours = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    order = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows, columns {names}; "
        f"only ours {list(extra.items())[:3]}; only sql {list(missing.items())[:3]}"
    )
