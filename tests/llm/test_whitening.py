"""Operator 13 against a dense eigensolver and exact integers."""

import math

import numpy as np
import pytest

from visitlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, k int, whitened string"


def slow_whiten(rows, components=32):
    """Deviations, eigenvalues, shares and whitened values of whole-number rows."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in row] for row in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviations, values, values / np.trace(v), centred @ (vectors / np.sqrt(values))


def test_whitening_matches_a_dense_solver(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").repartition(5)
    source = df.orderBy("vec_id").collect()
    n, deviations, values, shares, white = slow_whiten([r.embedding for r in source])
    rows = whitening.whiten_embeddings(df).collect()
    assert len(rows) == 32 * n and {r.n for r in rows} == {n}
    place = {r.vec_id: i for i, r in enumerate(source)}
    got = np.zeros((n, 32))
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviations[place[r.vec_id]]
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-10)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and 0 <= rows[0].identity_error < 1e-10


@pytest.mark.parametrize("values", [
    [9, 5, 5, 5, 1, 1e-3], [3] * 40, list(range(1, 60)), [2.0 ** -k for k in range(30)], [1e6] + [1 + 1e-7 * k for k in range(25)], [4, 0, 0, 0]])
def test_components_of_hard_spectra(values):
    rng = np.random.default_rng(3)
    d = len(values)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    want = sorted(values, reverse=True)[:32]
    want = [x for x in want if x > 1e-10 * max(values)]
    found, vectors = whitening.principal_components(v, 32)
    assert np.allclose(found, want, rtol=1e-9, atol=1e-12 * max(values)) and len(found) == len(want)
    assert np.abs(v @ vectors - vectors * found).max() <= 1e-12 * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-8


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1]:
            assert whitening.eigenvalues_above(a, shift) == (values > shift).sum()
    hollow = np.array([[0.0, 1.0], [1.0, 0.0]])  # no diagonal pivot at all
    assert whitening.eigenvalues_above(hollow, 0.0) == 1 and whitening.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


def test_missed_components_are_noticed():
    v = np.diag([5.0, 4.0, 3.0, 1.0])
    with pytest.raises(ArithmeticError):
        whitening.contour_components(v, 2.5, 5.5, 2, np.random.default_rng(0))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 0.25, -1.0], [1.5, 0.0, 2.0], [-0.5, 0.75, 0.125], [-0.5, 0.75, 0.125], [2.0, 2.0, 2.0]]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(None, good[0], 1, None), (2, good[2], 1, "x"), (90, None, 1, "x"), (91, [1.0, None, 2.0], 1, "x"),
            (92, [nan, 0.0, 1.0], 1, "x"), (93, [0.0, inf, 1.0], 1, "x"), (94, [], 1, "x"), (95, [1.0, 2.0], 1, "x"), (96, [-inf, 0.0, 0.0], None, "x")]
    kept = [*good, good[0], good[2]]
    n, deviations, values, shares, white = slow_whiten(kept)
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == 3 * n and {r.n for r in got} == {n}
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted(
        (i is None, i or 0, dev) for i, dev in zip([0, 1, 2, 3, 4, None, 2], deviations, strict=True))
    assert sorted({r.explained for r in got}, reverse=True) == pytest.approx(list(shares))
    assert sorted(abs(r.whitened) for r in got) == pytest.approx(sorted(np.abs(white).ravel()))
    assert whitening.whiten_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten_embeddings(spark.createDataFrame([(1, None, 1, "x")], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(5)], SCHEMA)
    assert whitening.whiten_embeddings(same).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0], 1, "x") for i in range(5)], SCHEMA)  # rank 1
    assert {r.component for r in whitening.whiten_embeddings(flat).collect()} == {1}


def test_large_deviations_stay_exact():
    x = np.array([[10 ** 9, -(10 ** 9)], [3, 4]], np.int64)
    model = whitening.Whitening(2, x.sum(axis=0), np.zeros(0), np.zeros((2, 0)), 0.0)
    want = [sum((2 * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0), strict=True)) for row in x]
    assert model.deviations(x) == want
    far = np.array([[1 << 40], [0]], np.int64)
    assert whitening.Whitening(2, far.sum(axis=0), np.zeros(0), np.zeros((1, 0)), 0.0).deviations(far) == [None, None]
