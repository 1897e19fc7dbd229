"""The physical plans stay distributed and native."""

import contextlib
import io
import re

import pytest

from skylattice.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

LAZY = [
    name for name in QUERIES
    if not re.search(
        "folds$|logreg|lasso|mlp|final|grid|flight|round_trip|stored|partitioned|gzip|pagerank", name
    )
]


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_product_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoop"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["bucket_join_latest"](spark, SF_DIR))
    assert "EqualTo(event_type,purchase)" in text and "EqualTo(event_type,view)" in text
    assert "props" not in text


def test_asof_reads_the_instants_once(spark):
    df = QUERIES["asof_previous"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_windows_run_over_pieces_of_a_key(spark):
    asof = plan(QUERIES["asof_previous"](spark, SF_DIR))
    assert re.search(r"windowspecdefinition\(__k0#\d+L, __day#\d+, __slice#\d+L, __at", asof)
    sums = plan(QUERIES["trailing_sum_entity"](spark, SF_DIR))
    assert re.search(r"windowspecdefinition\(__e#\d+L, __chunk#\d+L, __s", sums)
    for text in (asof, sums):
        keys = re.findall(r"windowspecdefinition\(([^)]*?) ASC", text)
        assert keys and all(k.count(",") >= 2 for k in keys)


def test_statistics_hash_and_read_named_columns(spark):
    from skylattice.operators import joins as J
    from skylattice.queries.tables import table

    events = table(spark, SF_DIR, "events")
    stats = J.bucket_statistics(events, "user_id", "ts", ["value"], 7200)
    assert "SortAggregate" not in plan(stats)
    both = plan(J.bucket_statistics(events, "user_id", "ts", ["value"], 7200, latest=["event_id"]))
    assert "props" not in both and "event_type" not in both
    latest = plan(J.latest_per_bucket(events, "user_id", "ts", 7200, columns=["value"]))
    assert "props" not in latest and "event_type" not in latest
