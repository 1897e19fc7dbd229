import random

import numpy as np
import pytest

import cases
from skylattice.llm import chunks as ch
from skylattice.llm import jaccard_join as jj
from skylattice.llm.count_tree import CountTree, counts_by_group, packed_point, unpacked_points
from skylattice.llm.queries import QUERIES

U64 = np.uint64


def shingles(text, size=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = cases.words(lowered)
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1)))


def similar(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def brute(rows, size=5, percent=80):
    """Sorted (doc_id, n_shingles, component_id); rows are (doc_id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    roots = cases.groups(sets, lambda a, b: similar(a, b, percent))
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(
        ((d, len(s), least.get(r) if s else d) for (d, _), s, r in zip(rows, sets, roots)), key=str
    )


def found(docs, size=5, percent=80, **more):
    return sorted((tuple(r) for r in jj.jaccard_components(docs, shingle=size, percent=percent, **more).collect()), key=str)


def edited(rng, ws, edits, vocabulary):
    ws = list(ws)
    for _ in range(edits):
        at = rng.randrange(len(ws) + 1)
        kind = rng.random()
        if kind < 0.4 and ws:
            ws[min(at, len(ws) - 1)] = rng.choice(vocabulary)
        elif kind < 0.7:
            ws.insert(at, rng.choice(vocabulary))
        elif ws:
            ws.pop(min(at, len(ws) - 1))
    return ws


def families(seed, n, longest=120, wide=60):
    """Texts with chains of edited copies, at and around the threshold, of all small sizes."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(wide)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            base = rng.choice(out)
            out.append(edited(rng, base, rng.randint(0, 1 + len(base) // 30), vocabulary))
        else:
            out.append([rng.choice(vocabulary) for _ in range(rng.randint(0, longest if rng.random() < 0.5 else 12))])
    return [" ".join(ws) for ws in out]


def test_sets_match_brute_force():
    rng = random.Random(3)
    texts = cases.texts(1, 40) + [" ".join(rng.choices("ab", k=k)) for k in range(12)] + ["A b C", "a B c"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    for size in (1, 3, 5):
        token, begin = jj.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, size)
        sets = [set(token[a:b].tolist()) for a, b in zip(begin[:-1], begin[1:])]
        expected = [shingles(t, size) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in expected]
        for i in range(len(texts)):
            for j in range(i):
                assert len(sets[i] & sets[j]) == len(expected[i] & expected[j])


@pytest.mark.parametrize("percent", [80, 90, 60])
def test_similar_sets_meet_in_a_cell(percent):
    rng = np.random.default_rng(percent)
    sets, pairs = [], []
    for n in [*range(1, 60), 75, 100, 150, 333, 700, 1500]:
        for _ in range(6):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            # as many swaps, or as many new ones, as the threshold lets through
            out = int(rng.integers(0, n + 1))
            more = int(rng.integers(0, n + 1))
            while 100 * (n - out) < percent * (n + more):
                out, more = max(0, out - 1), max(0, more - 1)
            b = np.concatenate([a[out:], rng.integers(0, 1 << 63, more, dtype=np.uint64)])
            pairs.append((len(sets), len(sets) + 1))
            sets += [np.sort(a), np.sort(b)]
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    cell, owner = jj.cells_of(np.concatenate(sets), begin, percent)
    cells = [set(cell[owner == i].tolist()) for i in range(len(sets))]
    assert all(cells[i] & cells[j] for i, j in pairs)
    # the cells of a set do not depend on the block it is in
    alone, _ = jj.cells_of(sets[-1], np.array([0, len(sets[-1])]), percent)
    assert set(alone.tolist()) == cells[-1]


def test_tree_leaves_every_similar_pair_and_few_others():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in rng.integers(1, 300, 500)]
    sets += [np.concatenate([s[: int(len(s) * rng.uniform(0.7, 1))], sets[0][:5]]) for s in sets[:400]]
    sets = [np.unique(s) for s in sets]
    points = np.array([counts_by_group(s, 64) for s in sets])
    tree = CountTree(points, 80)
    got = {(int(q), int(p)) for a, b, _ in tree.search(points) for q, p in zip(a, b)}
    as_sets = [set(s.tolist()) for s in sets]
    near = {(i, j) for i, x in enumerate(as_sets) for j, y in enumerate(as_sets) if similar(x, y)}
    assert near <= got and len(got) < 3 * len(near)
    assert list(CountTree(points[:0]).search(points[:0])) == []
    packed = [packed_point(p) for p in points]
    assert (unpacked_points(packed, 64) == points).all() and unpacked_points(packed, 64).dtype == np.uint8
    crowd = np.concatenate([points[:2], [[300] * 64]])
    assert (unpacked_points([packed_point(p) for p in crowd], 64) == crowd).all()
    one = [(q.tolist(), p.tolist()) for q, p, _ in CountTree(points[:1]).search(points[:1])]
    assert one == [([0], [0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    texts = families(seed, 260)
    docs = spark.createDataFrame([(i * 7 % 263, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs, block_bytes=6000) == brute(rows)


def test_other_thresholds_pieces_and_many_ranges(spark, monkeypatch):
    # read when the plan is made, so they hold in the workers too
    monkeypatch.setattr(jj, "FAN", 2)
    monkeypatch.setattr(jj, "PIECE", 7)
    monkeypatch.setattr(jj, "RANGE_CELLS", 512)
    monkeypatch.setattr(jj, "PIVOTS", 2)
    monkeypatch.setattr(jj, "LEADS", 1)
    texts = families(7, 200, 60, 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs, 2, 70, block_bytes=3000) == brute(rows, 2, 70)


def test_nulls_repeats_clashes_and_empty(spark):
    docs = cases.awkward(spark).unionByName(
        spark.createDataFrame([(None, "lone text of a null id", "x", "y", 1, "z", "w", 2)] * 2, cases.SCHEMA)
    )
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute(rows)
    assert jj.jaccard_components(cases.empty(spark)).count() == 0
    wordless = spark.createDataFrame([(1, ""), (2, " "), (3, None), (4, "")], "doc_id long, text string")
    assert found(wordless) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4)]


def test_long_texts_and_a_large_group_of_near_copies(spark):
    rng = random.Random(6)
    long = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:130_000])), (3, " ".join(long[:100_000]))]
    for i in range(1500):
        ws = list(base)
        ws[rng.randrange(120)] = f"x{i}"
        rows.append((10 + i, " ".join(ws)))
    got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    roots = {d: r for d, _, r in got}
    assert (roots[1], roots[2], roots[3]) == (1, 1, 3)
    assert {roots[d] for d in range(10, 1510)} == {10}


def test_a_pair_of_a_large_group_is_named_in_few_cells(spark):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(60):
        ws = list(base)
        for at in rng.sample(range(120), 1):
            ws[at] = f"x{i}_{at}"
        rows.append((i, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    marked = jj._firsts(jj._marked(docs, "doc_id", "text"))
    crowded = jj._crowded(jj._pack(marked, 5, 80, jj.BLOCK_BYTES))
    points = jj._points(marked, crowded, 5)
    alone = spark.createDataFrame([], "node long, root long")
    named = [tuple(r) for r in jj._open_pairs(crowded, points, alone, 80).collect()]
    sets = {r["node"]: set(np.frombuffer(r["tokens"], U64).tolist()) for r in points.collect()}
    near = {(a, b) for a in sets for b in sets if a > b and similar(sets[a], sets[b])}
    assert len(near) > 100 and near <= set(named)
    assert len(named) < 2 * len(set(named))


def test_pairs_met_before():
    cell, lists = 9, [[1, 5], [], [5, 7], [2], list(range(-23, 9))]
    rows = jj._padded(jj.pa.array(lists, jj.pa.list_(jj.pa.int64())), cell)
    q, p = (x.ravel() for x in np.indices((5, 5)))
    met = jj._met_before(rows, rows, q, p, cell).reshape(5, 5)
    assert met.tolist() == [[bool(set(x) & set(y)) for y in lists] for x in lists]


def test_query_covers_the_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_ngram_jaccard_join"](spark, d).collect()), key=str) == brute(rows)
