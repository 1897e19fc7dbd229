"""Registered queries over the test tables, each next to its SQL twin."""

from skylattice.queries import (  # noqa: F401  (importing registers the queries)
    joins,
    temporal,
    profile,
    cleaning,
    aggregates,
    stats,
    prep,
    models,
    storage,
    flights,
    streams,
    stored,
    evolving,
)
from skylattice.queries.registry import ORACLES, QUERIES  # noqa: F401
