"""Registry filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skylattice.session import outside_scopes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_stored: dict[tuple, object] = {}


def stored_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """What ``build`` made and stored for these tables, the first time in an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        with outside_scopes():
            _stored[key] = build()
    return _stored[key]


ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL giving the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
