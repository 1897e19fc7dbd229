import random

import numpy as np
import pytest

import cases
from skylattice.llm import blocks as bl
from skylattice.llm import chunks as ch
from skylattice.llm import suffix_dedup as sd
from skylattice.llm import suffixes
from skylattice.llm.queries import QUERIES


def brute(rows, size):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by looking up every string; rows are (doc_id, text)."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        order = bl.NULL_ID if doc is None else doc
        for i in range(len(raw) - size + 1):
            key = raw[i : i + size]
            first[key] = min(first.get(key, order), order)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        order = bl.NULL_ID if doc is None else doc
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < order:
                gone[i : i + size] = [True] * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), sum(gone), spans, cases.sha(kept)))
    return out


def found(docs, size, **options):
    rows = sd.remove_repeats(docs, size=size, **options).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and cases.sha(bytes(r.kept)) == r.kept_sha256
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize("size", [50, 12, 3])
def test_same_as_brute_force(spark, size):
    docs = cases.documents(spark, size, 60)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, size, block_bytes=4000) == sorted(brute(rows, size), key=str)


def test_many_ranges_and_one_block(spark):
    docs = cases.documents(spark, 9, 80).coalesce(1)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, 50, range_bytes=500) == sorted(brute(rows, 50), key=str)


def test_few_letters_and_periods(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    texts += ["ab" * 300, "ba" * 200, "a" * 500, "a" * 51, "a" * 50, "a" * 49]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = [tuple(r) for r in docs.collect()]
    for size in (50, 8):
        assert found(docs, size, block_bytes=3000) == sorted(brute(rows, size), key=str)


def addresses(spark, n, seed=5):
    """Documents that share the head of an address, with other bytes on both sides of it, and a few whole passages."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghij 0123456789") for _ in range(k))
    passages = [word(120) for _ in range(3)]
    texts = [
        word(rng.randint(20, 60)) + "https://www.example.org/articles/" + word(rng.randint(20, 60)) + rng.choice([*passages, "", ""])
        for _ in range(n)
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("hot", [0, 1, 30, 10**9])
def test_hot_anchors_give_the_same(spark, hot):
    docs = addresses(spark, 300).union(cases.documents(spark, 4, 40).selectExpr("doc_id + 1000", "text"))
    rows = [tuple(r) for r in docs.collect()]
    for size in (50, 12):
        assert found(docs, size, hot=hot, block_bytes=5000, range_bytes=20000) == sorted(brute(rows, size), key=str)


def test_hot_anchor_is_dealt_over_ranges(spark):
    """No range has more than twice the median of what the ranges have, though one anchor is in every document."""
    docs = addresses(spark, 6000)
    blocks = bl.pack_blocks(bl.with_copies(docs, "doc_id", "text"), sd._bytes, 50, 60000)
    loads = {}
    for hot in (200, 10**9):
        sent = sd.surroundings(blocks, sd.repeated_anchors(blocks, 50, 3, hot), 50, 3).where("part <> -1").collect()
        load = {}
        for r in sent:
            kind = r.part >= 0
            load.setdefault(kind, {}).setdefault(r.part, []).append(len(bl.sorted_values(r["keys"], "<u8")))
        loads[hot] = {k: sorted(sum(x) for x in v.values()) for k, v in load.items()}
    assert list(loads[10**9]) == [True] and loads[10**9][True][-1] > 4 * loads[10**9][True][len(loads[10**9][True]) // 2]
    windows = loads[200][False]
    assert len(windows) == 32 and windows[-1] <= 2 * windows[16]


def test_nulls_repeats_clashes_and_empty(spark):
    docs = cases.awkward(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, 50) == sorted(brute(rows, 50), key=str)
    assert sd.remove_repeats(cases.empty(spark)).count() == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op1_suffix_array_dedup"](spark, d).collect()), key=str)
    assert got == sorted(brute(rows, 50), key=str)


@pytest.mark.parametrize("letters,shallow", [("ab", 8), ("ab", 16), ("abcdefgh", 8), ("a", 8), ("ab", 50)])
def test_suffixes_are_sorted(letters, shallow):
    rng = random.Random(3)
    stems = ["".join(rng.choice(letters) for _ in range(50)) for _ in range(40)]
    texts = [s[: (k := rng.randint(0, 50))] + "".join(rng.choice(letters) for _ in range(50 - k)) for s in stems for _ in range(20)]
    rows = np.array([list(t.encode()) for t in texts], np.uint8)
    order, number = suffixes.sort_suffixes(rows, shallow)
    ranked = [texts[i] for i in order]
    assert ranked == sorted(texts)
    names = {t: i for i, t in enumerate(sorted(set(texts)))}
    assert number.tolist() == [names[t] for t in texts]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(6)
    part = "".join(rng.choice("abc ") for _ in range(200))
    texts = ["xyz" * rng.randint(0, 9) + part + "q" * i for i in range(4)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    h, doc, place, first, many = sd.anchors(data, offsets, 50)
    windows = {}
    for a, d, p, f, m in zip(h, doc, place, first, many):
        for i in range(f, f + m):
            key = data[i : i + 50].tobytes()
            assert windows.setdefault(key, (a, p - i)) == (a, p - i)
            assert i + 50 <= offsets[d + 1]
    assert sum(many) == sum(max(0, len(t) - 49) for t in texts)
    assert ch.CHUNK_BYTES
