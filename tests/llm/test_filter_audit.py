from collections import Counter
from itertools import permutations

import pytest

import cases
import compare
from skylattice.llm import filter_audit as fa
from skylattice.llm.queries import ORACLES, QUERIES

LABELS = "doc_id long, quality int, toxic int, lang string"


def masks(rows):
    """The letters that each row fails; rows are (doc_id, text)."""
    out = []
    low = {}
    for d, t in rows:
        if d is not None:
            low[t or ""] = min(d, low.get(t or "", d))
    for d, t in rows:
        t = t or ""
        ws = cases.words(t)
        fails = {
            "A": len(ws) < 100,
            "B": 100 * len(set(ws)) < 80 * len(ws),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and low[t] < d,
        }
        out.append("".join(k for k, v in fails.items() if v))
    return out


def brute(rows, labels):
    """(part, order, step, kept, removed, redundant, unique, good, toxic, shapley); rows are (doc_id, text, lang)."""
    flags = {}
    for d, q, t in labels:
        old = flags.get(d, (False, False))
        flags[d] = (old[0] or q == 1, old[1] or t == 1)
    failing = masks([(d, t) for d, t, _ in rows])
    out = []
    for part in {lang or "" for *_, lang in rows}:
        own = [
            (m, flags.get(d, (False, False)) if d is not None else (False, False))
            for (d, _, lang), m in zip(rows, failing)
            if (lang or "") == part
        ]
        found, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                all_fail = sum(f in m for m, _ in own)
                found.append(
                    (order, step, len(left), len(gone), all_fail - len(gone), sum(m == f for m, _ in own),
                     sum(g for _, (g, _) in gone), sum(t for _, (_, t) in gone))
                )
                total[f] += len(gone)
        out += [(part, *x, total[x[0][x[1] - 1]]) for x in found]
    return sorted(out)


def found(docs, labels):
    rows = fa.audit(fa.counted_masks(docs, labels), "ABCDE", "part", ["rows", "good", "toxic"]).collect()
    return sorted(
        (r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.lost_good, r.lost_toxic, r.shapley)
        for r in rows
    )


def test_intervals_are_the_orders_that_remove_there():
    for n in (1, 2, 4):
        orders = list(permutations(range(n)))
        assert [fa.lehmer_rank(o) for o in orders] == list(range(len(orders)))
        at = Counter()
        for mask, step, f, start, end in fa.removal_intervals(n):
            for rank in range(start, end):
                assert orders[rank][step - 1] == f and mask >> f & 1
                assert not any(mask >> x & 1 for x in orders[rank][: step - 1])
                at[mask, rank] += 1
        assert set(at.values()) == {1} and len(at) == ((1 << n) - 1) * len(orders)


def test_same_as_brute_force(spark):
    extra = ["# BUY NOW " * 40, "LOUD TEXT", "LOUD TEXT", "quiet | text " * 60, "\t lead and trail \n"]
    docs = cases.documents(spark, 3, 80, extra)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    labels = [(d, d % 2, int(d % 5 == 0)) for d, _, _ in rows if d % 3] + [(4, 1, None), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame([(*x, "clash") for x in labels], LABELS)
    assert found(docs, table) == brute(rows, labels)


def test_nulls_repeats_clashes_and_empty(spark):
    docs = cases.awkward(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    none = spark.createDataFrame([], LABELS)
    assert found(docs, none) == brute(rows, [])
    assert found(cases.empty(spark), none) == []
    assert len(found(docs.where("doc_id = 1"), none)) == 600


def test_long_text_and_a_hot_text(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(i, long if i % 50 == 0 else "Same text", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(docs, spark.createDataFrame([], LABELS)) == brute(rows, [])


def test_one_filter_and_too_many(spark):
    counts = spark.createDataFrame([("x", 0, 3), ("x", 1, 2), (None, 1, 1)], "part string, mask int, rows long")
    got = sorted((r.part or "", r.kept, r.removed, r.unique_fails, r.shapley) for r in fa.audit(counts, "A").collect())
    assert got == [("", 0, 1, 1, 1), ("x", 3, 2, 2, 2)]
    with pytest.raises(ValueError):
        fa.audit(counts, "ABCDEFGHI")


def test_no_cross_join_and_query_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    name = "op12_filter_interaction_audit"
    df = QUERIES[name](spark, d)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert compare.differences(df, compare.duck(d), ORACLES[name]) == ""
