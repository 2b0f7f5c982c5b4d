import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfoot.llm.whitening import count_below, leading_eigenpairs, tridiagonalise, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def symmetric(kind):
    random_ = np.random.default_rng(4)
    if kind == "spread":
        a = random_.standard_normal((40, 40))
        return a @ a.T
    if kind == "tied":
        q = np.linalg.qr(random_.standard_normal((12, 12)))[0]
        return q @ np.diag([5.0] * 4 + [2.0] * 5 + [1.0, 0.5, 0.1]) @ q.T
    if kind == "close":
        q = np.linalg.qr(random_.standard_normal((20, 20)))[0]
        return q @ np.diag(3 + np.arange(20) * 1e-9) @ q.T
    if kind == "low rank":
        a = random_.standard_normal((15, 4))
        return a @ a.T
    if kind == "split":
        return np.kron(np.eye(5), np.array([[2.0, 1.0], [1.0, 2.0]]))
    if kind == "wide":
        return np.diag(10.0 ** -np.arange(0, 12.0))
    return {"one": np.array([[3.0]]), "two": np.array([[2.0, -1.0], [-1.0, 2.0]]), "diagonal": np.diag([1.0, 4.0, 2.0])}[kind]


@pytest.mark.parametrize("kind", ["spread", "tied", "close", "low rank", "split", "wide", "one", "two", "diagonal"])
def test_eigenpairs(kind):
    m = symmetric(kind)
    values, vectors = leading_eigenpairs(m, 32)
    expected = np.sort(np.linalg.eigvalsh(m))[::-1][: len(values)]
    size = np.abs(m).max()
    assert len(values) == (4 if kind == "low rank" else min(32, len(m)))
    assert np.abs(values - expected).max() <= 1e-13 * size * len(m)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() <= 1e-12
    assert np.abs(vectors @ m - values[:, None] * vectors).max() <= 1e-13 * size * len(m)


def test_no_eigenpairs_of_nothing():
    assert leading_eigenpairs(np.zeros((3, 3)), 2)[1].shape == (0, 3)
    assert leading_eigenpairs(np.zeros((0, 0)), 2)[1].shape == (0, 0)


def test_sign_counts():
    m = symmetric("spread")
    diagonal, off, _ = tridiagonalise(m)
    at = np.array([-1.0, 0.5, 10.0, 1e9])
    assert count_below(diagonal, off, at).tolist() == [(np.linalg.eigvalsh(m) < x).sum() for x in at]


def expected(vectors, components=32, scale=64):
    """Plain numpy: exact deviations, eigenpairs of the library."""
    x = np.floor(np.array(vectors, np.float64) * scale).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(axis=1), centred @ q / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(rows, out, d, components=32):
    deviation, whitened, explained = expected([r[1] for r in rows], components)
    k = min(components, d)
    got = {(r.vec_id, r.component): r for r in out}
    assert len(out) == len(rows) * k == len(got)
    w = np.array([[got[r[0], c].whitened for c in range(1, k + 1)] for r in rows])
    signs = np.sign((w * whitened).sum(axis=0))
    assert np.abs(w - whitened * signs).max() < 1e-7
    for r, dev in zip(rows, deviation.tolist(), strict=True):
        assert {int(got[r[0], c].deviation) for c in range(1, k + 1)} == {dev}
    for c in range(1, k + 1):
        assert abs(got[rows[0][0], c].explained - explained[c - 1]) <= 1e-9 * explained[c - 1]
    assert {r.n for r in out} == {len(rows)} and len({r.identity_error for r in out}) == 1
    error = np.abs(w.T @ w / len(w) - np.eye(k)).max()
    assert abs(out[0].identity_error - error) < 1e-9 and out[0].identity_error < 1e-9


def test_against_numpy(spark, checkpoint_folder):
    random_ = np.random.default_rng(3)
    values = random_.standard_normal((300, 40)) * np.linspace(1, 3, 40) + 5
    rows = [(i, [float(np.float32(v)) for v in r], 1) for i, r in enumerate(values)]
    odd = [(900, None, 1), (901, [*rows[0][1][:-1], None], 1), (902, [*rows[0][1][:-1], float("nan")], 1), (903, [float("inf")] * 40, 1), (904, [], 1), (905, [1.0] * 41, 1)]
    out = whiten(spark.createDataFrame(rows + odd, SCHEMA).repartition(5).withColumns({"n": F.lit(1), "x": F.lit("x"), "component": F.lit(0)}))
    check(rows, out.collect(), 40)
    check(rows, whiten(spark.createDataFrame(rows + odd, SCHEMA), components=3).collect(), 40, 3)


def test_does_not_depend_on_partitions(spark, checkpoint_folder):
    random.seed(2)
    rows = [(i, [random.gauss(0, 1) for _ in range(6)], 1) for i in range(200)]
    one, two = (sorted(map(tuple, whiten(spark.createDataFrame(rows, SCHEMA).repartition(p)).drop("identity_error").collect())) for p in (1, 7))
    assert [r[:4] for r in one] == [r[:4] for r in two]
    assert np.allclose([r[4:] for r in one], [r[4:] for r in two], rtol=0, atol=1e-12)


def test_edge_cases(spark, checkpoint_folder):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [0.5, 1.0], 1)] * 3, SCHEMA)).count() == 0
    repeated = [(1, [0.5, 1.0], 1), (1, [0.5, 1.0], 1), (None, [2.0, 1.5], None), (4, [0.0, -3.0], 2)]
    out = whiten(spark.createDataFrame(repeated, SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.component) for r in out) == [(-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    # Two whole dimensions of which one never changes: a single component.
    assert {r.component for r in whiten(spark.createDataFrame([(i, [float(i), 7.0], 1) for i in range(9)], SCHEMA)).collect()} == {1}


def test_large_numbers_stay_exact(spark, checkpoint_folder):
    random.seed(8)
    rows = [(i, [random.uniform(-3e9, 3e9) for _ in range(3)], 1) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: int(r.deviation) for r in whiten(frame, components=1).collect()}
    x = [[int(np.floor(v * 64)) + 1_000_000 for v in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert out == {i: sum((500 * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
