import random
import time
from itertools import combinations

import numpy as np

import cases
from skylattice.llm import simhash as sh
from skylattice.llm.components import components


def test_fingerprints_and_groups_match_brute_force(spark):
    docs = cases.documents(spark, 2, 80)
    rows = [(r.doc_id, cases.simhash(r.text)) for r in docs.orderBy("doc_id").collect()]
    roots = cases.groups([f for _, f in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    expected = {d: (f"{f:016x}", rows[k][0]) for (d, f), k in zip(rows, roots)}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.near_groups(docs).collect()}
    assert found == expected


def test_every_near_pair_meets_on_a_key():
    rng = random.Random(1)
    for distance, parts in ((3, 4), (2, 4), (4, 4), (3, 8), (6, 8)):
        base = [rng.getrandbits(64) for _ in range(300)]
        near = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, distance))) for b in base]
        a, _ = sh.chain_keys(np.array(base, np.uint64), parts, distance)
        b, _ = sh.chain_keys(np.array(near, np.uint64), parts, distance)
        assert (a == b).any(axis=1).all()
        assert sh.in_chain(np.array(base, np.uint64) ^ np.array(near, np.uint64), parts, distance).all()


def reached(fps, pairs):
    linked = set(pairs)
    return cases.groups(list(range(len(fps))), lambda a, b: (a, b) in linked or (b, a) in linked)


def test_links_of_crowded_buckets(monkeypatch):
    monkeypatch.setattr(sh, "CROWD", 8)
    rng = random.Random(4)
    for steps, bits, n in ((2, 26, 700), (5, 30, 700), (4, 12, 900), (3, 36, 300)):
        fps = [1 << 60]
        for _ in range(n):
            fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(bits), steps)))
        fps = sorted(set(fps))
        pairs = sh.bucket_links(np.array(fps, np.uint64), 4, 3)
        assert reached(fps, pairs) == cases.groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
        assert len(pairs) < len(fps)


def test_one_bucket_of_many_fingerprints_that_are_no_copies(spark):
    rng = random.Random(9)
    spread = [rng.getrandbits(36) for _ in range(40_000)]
    dense = [(1 << 50) | rng.getrandbits(17) for _ in range(20_000)]
    fps = np.unique(np.array([*spread, *dense], np.uint64))
    start = time.process_time()
    pairs = sh.bucket_links(fps, 4, 3)
    assert time.process_time() - start < 20
    low = np.arange(len(fps))
    for x, y in pairs:
        low[x] = y
    where = {int(f): i for i, f in enumerate(fps)}
    masks = [sum(1 << b for b in c) for k in (1, 2, 3) for c in combinations(range(36), k)]
    for i in rng.sample(range(len(fps)), 60):
        near = [where[f] for m in masks if (f := int(fps[i]) ^ m) in where]
        assert all(low[j] == low[i] for j in near)


def test_long_texts_are_read_in_stretches(monkeypatch):
    text = "Some  words\tof a longer\ntext, Écrit ".encode() * 50
    whole = [sh.fingerprint(t, n) for t in (text, b"one two", b"one", b" ", b"") for n in (1, 3)]
    assert whole[1] == cases.simhash(text.decode())
    for stretch in (1, 7, 64):
        monkeypatch.setattr(sh, "STRETCH", stretch)
        assert whole == [sh.fingerprint(t, n) for t in (text, b"one two", b"one", b" ", b"") for n in (1, 3)]


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in range(100, 160)} == {100} and found[201] == found[200] == 200


def test_nulls_repeats_and_empty(spark):
    docs = cases.awkward(spark)
    found = sh.near_groups(docs)
    assert found.count() == docs.count()
    blank = docs.where("text is null or trim(text) = ''").where("doc_id is not null").agg({"doc_id": "min"}).first()[0]
    assert found.where("doc_id is null and component_id is not null").count() >= 1
    assert found.where(f"fingerprint = '{'0' * 16}'").select("component_id").distinct().first()[0] == blank
    assert sh.near_groups(cases.empty(spark)).count() == 0
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sh.near_groups(kept).select("component_id", "fingerprint").distinct().count()
    assert sh.keep_one(cases.empty(spark)).count() == 0
