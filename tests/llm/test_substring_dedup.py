from collections import Counter

import numpy as np
import pytest

import cases
import compare
from skylattice.llm import blocks as bl
from skylattice.llm import substring_dedup as sd
from skylattice.llm.queries import ORACLES, QUERIES


def brute(rows, size):
    """(doc_id, n_words, n_removed, sha256); rows are (doc_id, text)."""
    split = [cases.words(t) for _, t in rows]
    seen = Counter(tuple(ws[i : i + size]) for ws in split for i in range(len(ws) - size + 1))
    out = []
    for (doc, _), ws in zip(rows, split):
        gone = set()
        for i in range(len(ws) - size + 1):
            if seen[tuple(ws[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc, len(ws), len(gone), cases.sha(kept)))
    return out


def found(docs, size):
    rows = sd.remove_repeats(docs, size=size).collect()
    assert all(cases.sha(r.kept) == r.kept_sha256 for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize("size", [35, 5, 1])
def test_same_as_brute_force(spark, size, monkeypatch):
    # read when the plan is made, so it holds in the workers too
    monkeypatch.setattr(sd, "BLOCK_BYTES", 4000)
    docs = cases.documents(spark, size, 60)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, size) == sorted(brute(rows, size), key=str)


def test_narrow_sketch_loses_nothing(spark):
    docs = cases.documents(spark, 4, 40)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    narrow = sd.remove_repeats(docs, size=5, with_text=False, cells_per_window=1, range_bits=6).collect()
    assert sorted(map(tuple, narrow), key=str) == sorted(brute(rows, 5), key=str)


def test_sketch_overestimates():
    keys = [np.array([1, 5, 9]), np.array([5, 7]), np.array([9])]
    marks = [np.array([True, False, False]), np.array([False, False]), np.array([False])]
    assert [x.tolist() for x in bl.seen_in_two(keys, marks)] == [[True, True, True], [True, False], [True]]


def test_nulls_repeats_clashes_and_empty(spark):
    docs = cases.awkward(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, 35) == sorted(brute(rows, 35), key=str)
    assert sd.remove_repeats(cases.empty(spark)).count() == 0


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    name = "op2_substring_dedup"
    assert compare.differences(QUERIES[name](spark, d), compare.duck(d), ORACLES[name]) == ""


@pytest.mark.parametrize("k", [10, 11, 13])
def test_different_long_words_never_meet(spark, k):
    one, two = cases.alike_under_powers(k)
    same = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*same, one])), (2, " ".join([*same, two])), (3, " ".join([*same, one]))]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size=35, with_text=False).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 35, 2: 0, 3: 35}


def test_different_runs_of_two_words_never_meet(spark):
    one, two = (" ".join(x) for x in cases.alike_under_powers(11))
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    got = sd.remove_repeats(docs, size=2048, with_text=False).collect()
    assert [r.n_removed for r in got] == [0, 0]
