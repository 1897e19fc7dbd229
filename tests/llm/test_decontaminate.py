import cases
import compare
from skylattice.llm import decontaminate as dc
from skylattice.llm.queries import ORACLES, QUERIES


def items(spark, docs):
    long = next(t for t in cases.texts(1, 60) if len(cases.folded_words(t)) > 60)
    rows = [(1, " ".join(cases.folded_words(long)[5:30])), (2, "Edited"), (3, None), (4, ""), (10, "one TWO"), (10, "one TWO"), (5, long)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_same_as_brute_force(spark):
    docs = cases.documents(spark, 1, 60)
    bench = items(spark, docs)
    expected = cases.contamination(
        [tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()]
    )
    found = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in dc.contamination_report(docs, bench).collect()}
    assert found == expected
    assert any(hit for _, hit, _ in found.values())


def test_shards_agree_with_one_pass(spark, monkeypatch):
    docs = cases.documents(spark, 1, 40)
    bench = items(spark, docs)
    whole = sorted(map(tuple, dc.contamination_report(docs, bench).drop("items").collect()))
    monkeypatch.setattr(dc, "SHARD_WINDOWS", 7)
    assert sorted(map(tuple, dc.contamination_report(docs, bench).drop("items").collect())) == whole


def test_proximity_in_any_order(spark):
    docs = spark.createDataFrame([(1, "c x b y a"), (2, "a b"), (3, "c " + "z " * 40 + "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    index = dc.build_index(docs)
    near = dc.find_matches(index, bench, size=3, slop=4).where("kind = 'near'")
    rows = near.join(index.selectExpr("block", "posexplode(doc_id) as (row, doc_id)"), ["block", "row"]).collect()
    assert [(r.doc_id, r.start, r.length) for r in rows] == [(1, 0, 5)]


def near_items(rows, bench, size, slop):
    """doc_id -> items with a window whose words all lie around one of their places."""
    windows = []
    for item, text in bench:
        ws = cases.folded_words(text)
        n = min(size, len(ws))
        windows += [(str(item), set(ws[i : i + n]), n + slop) for i in range(len(ws) - n + 1) if n]
    out = {}
    for doc, text in rows:
        ws = cases.folded_words(text)
        out[doc] = sorted(
            {
                item
                for item, need, span in windows
                if need <= set(ws)
                and any(w in need and need <= set(ws[max(0, i - span) : i + span + 1]) for i, w in enumerate(ws))
            }
        )
    return out


def test_proximity_stays_in_its_document(spark):
    docs = spark.createDataFrame([(1, "z b"), (2, "a z z b"), (3, "b z z a"), (4, "a z"), (5, "a"), (6, "b")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b")], "item_id long, text string")
    report = dc.contamination_report(docs.coalesce(1), bench, size=2, slop=3)
    assert {r.doc_id for r in report.collect() if r.near_items} == {2, 3}
    assert report.where("contaminated").count() == 0


def test_proximity_matches_brute_force(spark):
    import random

    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30)))) for i in range(300)]
    bench = [(i, " ".join(rng.choice("abcdefghi") for _ in range(rng.randint(1, 8)))) for i in range(20)]
    expected = near_items(docs, bench, 5, 1)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    for parts in (1, 7):
        found = dc.contamination_report(d.repartition(parts), b, size=5, slop=1).collect()
        assert {r.doc_id: list(r.near_items) for r in found} == expected
        assert all(set(r["items"]) <= set(r.near_items) for r in found)
    assert any(expected.values()) and not all(expected.values())


def test_near_spans_match_brute_force(monkeypatch):
    """Every place with all words near it, whatever the size of the table and of the pieces."""
    import random

    import numpy as np

    rng = random.Random(6)
    for table, piece in ((1 << 20, 1 << 12), (1, 1), (64, 3)):
        monkeypatch.setattr(dc, "TABLE_BYTES", table)
        monkeypatch.setattr(dc, "STRETCHES", piece)
        texts = [[rng.choice("abcdefghijk") for _ in range(rng.choice([0, 3, 40, 200]))] for _ in range(30)]
        flat = [w for t in texts for w in t]
        doc = np.cumsum([0, *map(len, texts)])
        lists = [np.flatnonzero([w == x for w in flat]) for x in "abcdefghijk"]
        windows = [[rng.randrange(11) for _ in range(rng.randint(1, 6))] for _ in range(40)]
        padded = np.array([w + [-1] * (6 - len(w)) for w in windows])
        shared = dict(dc.shared_stretches(padded, lists, len(flat), 8))
        for i, w in enumerate(windows):
            span, expected = len(w) + 2, set()
            for d, t in enumerate(texts):
                for at in range(len(t)):
                    if lists[w[0]].size and t[at] in {"abcdefghijk"[x] for x in w}:
                        best = [
                            min((abs(p - at), p) for p in [*(q for q, x in enumerate(t) if x == "abcdefghijk"[y]), 10**6]) for y in set(w)
                        ]
                        if max(best)[0] <= span:
                            places = [int(doc[d]) + p for _, p in best]
                            expected.add((min(places), max(places) + 1))
            low, high = dc.near_spans(np.array(w), lists, doc, span, shared[i], 8) if i in shared else ([], [])
            assert list(zip(map(int, low), map(int, high))) == sorted(expected)


def test_proximity_query_has_the_exact_columns_of_op8(spark):
    d = "/root/testdata/sf0.01"
    exact, near = QUERIES["op8_benchmark_decontamination"](spark, d), QUERIES["op8_benchmark_proximity"](spark, d)
    assert sorted(map(tuple, near.select(exact.columns).collect())) == sorted(map(tuple, exact.collect()))
    assert near.where("contaminated AND NOT near").count() == 0


def test_nulls_repeats_and_empty(spark):
    docs = cases.awkward(spark)
    bench = items(spark, docs)
    assert dc.contamination_report(docs, bench).count() == docs.count()
    assert dc.contamination_report(cases.empty(spark), bench).count() == 0
    none = bench.limit(0)
    assert dc.contamination_report(docs, none).where("contaminated").count() == 0
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == dc.contamination_report(docs, bench).where("not contaminated").count()


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    name = "op8_benchmark_decontamination"
    assert compare.differences(QUERIES[name](spark, d), compare.duck(d), ORACLES[name]) == ""
