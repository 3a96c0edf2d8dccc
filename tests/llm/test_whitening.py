"""Whitening against numpy's own solver and exact integers."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n long, deviation string, v long"


def frame(spark, rows):
    """Vectors with extra columns whose names clash with those that the operator adds."""
    return spark.createDataFrame([(i, v, 9, 9, "x", 9) for i, v in rows], SCHEMA)


def usable(rows, dim):
    return [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]


def check(found, rows, dim, components=32):
    kept = usable(rows, dim)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(kept), x.sum(axis=0)
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    z = (n * x - sums).astype(float) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, dim)
    assert len(found) == n * count
    assert sorted((r.vec_id or -1, r.deviation) for r in found if r.component == 1) == sorted((i or -1, int(d)) for (i, _), d in zip(kept, deviations))
    assert {r.n for r in found} == {n}
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    alive = values > values.sum() * dim * 2.3e-16
    y = {}
    for k in range(count):
        assert by_component[k + 1][0].explained == pytest.approx(values[k] / values.sum(), rel=1e-9, abs=1e-13)
        got = {(r.vec_id, r.deviation): r.whitened for r in by_component[k + 1]}
        if not alive[k]:
            assert set(got.values()) == {None}
            continue
        y[k] = np.array([got[i, int(d)] for (i, _), d in zip(kept, deviations)])
        gaps = np.abs(np.delete(values, k) - values[k])
        if gaps.min(initial=np.inf) > 1e-6 * values[0]:
            want = z @ vectors[:, k] / np.sqrt(values[k])
            assert min(np.abs(y[k] - want).max(), np.abs(y[k] + want).max()) < 1e-6
    error = {r.identity_error for r in found}
    assert len(error) == 1
    if y:
        w = np.array(list(y.values()))
        real = np.abs(w @ w.T / n - np.outer(w.mean(axis=1), w.mean(axis=1)) - np.eye(len(w))).max()
        assert real < 1e-9 and error.pop() < 1e-9
    else:
        assert error == {None}


def vectors(seed, n, dim):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dim, dim)) * rng.exponential(1, dim)
    return [(k, [float(x) for x in row]) for k, row in enumerate(rng.standard_normal((n, dim)) @ mix)]


def test_odd_rows_and_order(spark):
    rows = vectors(1, 300, 40)
    rows += [(301, None), (302, []), (303, [None] * 40), (304, [float("nan")] + [0.0] * 39), (305, [float("inf")] * 40), (306, [1.0] * 7), (307, [3e30] * 40)]
    rows += [(5, rows[5][1]), (None, rows[6][1])] + [(400 + k, rows[7][1]) for k in range(150)]
    found = whitening.whiten(frame(spark, rows).repartition(6))
    check(found.collect(), [r for r in rows if r[0] != 307], 40)
    one, two = (whitening.fit(frame(spark, r).repartition(k).selectExpr("vec_id", "cast(embedding AS array<double>)")) for r, k in ((rows, 6), (rows[::-1], 3)))
    assert one.sums == two.sums and one.trace == two.trace
    assert (one.vectors == two.vectors).all() and (one.values == two.values).all()  # no bit differs


def test_few_rows_have_few_components(spark):
    rows = vectors(2, 5, 8)
    check(whitening.whiten(frame(spark, rows)).collect(), rows, 8)


def test_equal_rows_and_empty_tables(spark):
    found = whitening.whiten(frame(spark, [(k, [0.5, -0.25]) for k in range(4)])).collect()
    assert len(found) == 8 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in found} == {(None, 0.0, None, 0)}
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_large_entries_are_exact(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([1e16, 2e16, -5e15]), rng.uniform(-1, 1), rng.uniform(-1e9, 1e9)]) for k in range(50)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, rows)).where("component = 1").collect()}
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], object)
    want = ((len(rows) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert got == {k: int(w) if w < 10**38 else None for k, w in enumerate(want)}


@pytest.mark.parametrize("values", [
    [5, 3, 3, 3, 1, 1, 0.5], [1] * 7, [1, 1 + 1e-9, 1 + 2e-9, 0.3, 0.3 + 1e-12, 1e-9, 2e-9], [1e6, 1, 1e-6, 1e-9, 1e-10, 1e-11, 1e-12]])
def test_clustered_eigenvalues(values):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((7, 7)))[0].astype(whitening.WIDE)
    for _ in range(3):  # orthonormal in the wide type too
        q = q @ (1.5 * np.eye(7, dtype=whitening.WIDE) - 0.5 * (q.T @ q))
    true = np.array(values, whitening.WIDE)
    got, x = whitening.eigen((q * true) @ q.T)
    scale = float(true.max())
    assert np.abs(got - np.sort(true)[::-1]).max() < 1e-17 * scale * 100
    assert np.abs(x.T @ x - np.eye(7)).max() < 3e-18
    a = (q * true) @ q.T
    assert np.abs(a @ x - x * got).max() < 1e-17 * scale * 10
