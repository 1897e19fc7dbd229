import math

import numpy as np
import pytest

import cases  # noqa: F401  (puts the folder of the repository on the path)
from skylattice.llm import whitening as wh
from skylattice.llm.queries import QUERIES

F = cases.F


def rotated(values, seed):
    """A matrix with these eigenvalues and its eigenvectors, to long double."""
    rng = np.random.default_rng(seed)
    n = len(values)
    q = np.eye(n, dtype=wh.WIDE)
    for _ in range(3):
        v = rng.integers(-5, 6, n).astype(wh.WIDE)
        v[0] += 11
        q = q - 2 * np.outer(v, v @ q) / (v @ v)
    return (q.T * np.array(values, wh.WIDE)) @ q, q.T


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 1],
        [4, 1 + 1e-7, 1, 1 - 1e-7, 0.5, 1e-6],  # a cluster that float32 cannot see
        [2, 1 + 3e-12, 1 + 2e-12, 1 + 1e-12, 1e-9],
        list(range(40, 0, -1)),
    ],
)
def test_refinement_goes_beyond_double(values):
    matrix, expected = rotated(values, 3)
    _, rough = np.linalg.eigh(matrix.astype(np.float32))
    found, vectors = wh.refine(matrix, rough[:, ::-1])
    assert np.abs(found - np.array(values, wh.WIDE)).max() < 1e-17 * len(values) * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17
    gap = min(a - b for a, b in zip(values, values[1:]))
    off = np.abs(np.abs(expected.T @ vectors) - np.eye(len(values))).max()
    assert off < 1e-17 * max(values) / gap
    assert np.abs(rough[:, ::-1].T @ expected).max() <= 1 + 1e-5


def test_equal_eigenvalues_and_no_variance():
    matrix, _ = rotated([3, 2, 2, 2, 0, 0], 5)
    _, rough = np.linalg.eigh(matrix.astype(np.float32))
    found, vectors = wh.refine(matrix, rough[:, ::-1])
    assert np.abs(found - np.array([3, 2, 2, 2, 0, 0])).max() < 1e-16
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16
    zero, same = wh.refine(np.zeros((3, 3), wh.WIDE), np.eye(3, dtype=np.float32))
    assert (zero == 0).all() and np.abs(same.T @ same - np.eye(3)).max() < 1e-17


def exact(rows):
    """What the contract asks for, by numpy; rows are (vec_id, vector)."""
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    x = np.array([v for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(v, sums))) for v in x.tolist()]
    centred = (n * x - sums).astype(wh.WIDE) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance.astype(np.float64))
    order = np.argsort(-values)
    white = centred.astype(np.float64) @ vectors[:, order] / np.sqrt(np.maximum(values[order], 1e-300))
    return kept, deviation, white, values[order] / np.trace(covariance)


def matches(spark, rows, got):
    kept, deviation, white, explained = exact(rows)
    by_id = {i: k for k, (i, _) in enumerate(kept)}
    k = min(8, white.shape[1])
    assert len(got) == k * len(kept)
    for r in got:
        at = by_id[r.vec_id]
        assert (r.n, r.deviation) == (len(kept), deviation[at])
        assert abs(abs(r.whitened) - abs(white[at][r.component - 1])) < 1e-8
        assert abs(r.explained - explained[r.component - 1]) <= 1e-10
        assert 0 <= r.identity_error < 1e-9


def test_query_matches_numpy(spark):
    d = "/root/testdata/sf0.01"
    rows = [
        (r.vec_id, r.embedding)
        for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()
        if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)
    ]
    matches(spark, rows, QUERIES["op13_embedding_whitening"](spark, d).collect())


def table(spark, folder, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n int, deviation string").repartition(
        2
    ).write.parquet(f"{folder}/embeddings.parquet")
    return QUERIES["op13_embedding_whitening"](spark, str(folder))


def test_nulls_repeats_clashes_and_odd_numbers(spark, tmp_path):
    rng = np.random.default_rng(1)
    base = [[float(c) for c in rng.normal(size=10).astype(np.float32)] for _ in range(40)]
    good = [(i, v) for i, v in enumerate(base)]
    odd = [
        (100, None), (101, [None] + base[0][1:]), (102, [float("nan")] + base[0][1:]),
        (103, [float("inf")] + base[0][1:]), (104, []), (105, base[0][:4]), (106, [1e30] + base[0][1:]),
    ]
    rows = [(i, v, 1, 2, "x") for i, v in good + odd]
    matches(spark, good, table(spark, tmp_path / "a", rows).collect())
    # a row that repeats counts each time, and a null id stays null
    again = table(spark, tmp_path / "b", rows + [(3, base[3], 1, 2, "x"), (None, base[4], 1, 2, "x")]).collect()
    assert len(again) == 42 * 8 and sum(r.vec_id is None for r in again) == 8
    assert {r.n for r in again} == {42}


def test_empty_one_row_and_no_variance(spark, tmp_path):
    assert table(spark, tmp_path / "a", []).count() == 0
    assert table(spark, tmp_path / "n", [(1, None, 1, 1, "x")]).count() == 0
    one = table(spark, tmp_path / "b", [(1, [1.0, 2.0], 1, 1, "x")] * 2).collect()
    assert {(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one} == {
        (1, 2, 0, 0.0, 0.0),
        (2, 2, 0, 0.0, 0.0),
    }
    flat = table(spark, tmp_path / "c", [(i, [1.0, float(i), 3.0], 1, 1, "x") for i in range(6)]).collect()
    assert {r.component: round(r.explained, 12) for r in flat} == {1: 1.0, 2: 0.0, 3: 0.0}
    assert all(r.whitened == 0 for r in flat if r.component > 1) and {r.identity_error < 1e-12 for r in flat} == {True}


def test_other_lengths_end_a_fit_and_doubles_need_no_scaling(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + 1e4
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, v array<double>")
    model = wh.fit(df, "v")
    white = np.array([r.w for r in model.transform(df, "v", 6, "w").collect()])
    assert np.abs(np.cov(white.T, bias=True) - np.eye(6)).max() < 1e-9
    assert model.identity_error(df, "v", 6) < 1e-9
    mixed = df.unionByName(spark.createDataFrame([(1, [1.0])], "id long, v array<double>"))
    with pytest.raises(Exception):
        wh.fit(mixed, "v")
