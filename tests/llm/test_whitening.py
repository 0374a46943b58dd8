"""Whitening against numpy's eigendecomposition of the whole covariance."""

import numpy as np
import pytest

from tillroll.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n=300, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) @ np.diag(np.linspace(0.2, 1.5, dim))
    return [(i, [float(v) for v in np.float32(row)], i % 3) for i, row in enumerate(x)]


def fitted(rows):
    return np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in e] for _, e, _ in rows], object)


def check(rows, got, most=8):
    x = fitted(rows)
    n, total = len(x), x.sum(0)
    away = n * x - total
    y = away.astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    place = {i: k for k, (i, _, _) in enumerate(rows)}
    assert len(got) == n * min(most, x.shape[1])
    white = np.zeros((n, min(most, x.shape[1])))
    for r in got:
        k = place[r.vec_id]
        assert r.n == n and int(r.deviation) == sum(int(v) ** 2 for v in away[k])
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9
        white[k, r.component - 1] = r.whitened
    want = y @ vectors[:, :white.shape[1]] / np.sqrt(values[:white.shape[1]])
    sign = np.sign((white * want).sum(0))
    assert np.abs(white - want * sign).max() < 1e-7


def test_equal_to_a_full_decomposition(spark):
    rows = table()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(11)   # more tasks than one group of the tree
    check(rows, whitening.whiten(docs).collect())


def test_left_out_rows_copies_and_clashing_columns(spark):
    rows = table(60, 5)
    rows += [(100 + i, rows[0][1], 1) for i in range(40)]
    bad = [(900, None, 1), (901, [], 1), (902, [1.0, None, 0.0, 0.0, 0.0], 1), (903, [float("nan")] * 5, None),
           (904, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (905, [1.0, 2.0], 1), (906, [1e30, 0.0, 0.0, 0.0, 0.0], 1)]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows + bad], SCHEMA + ", n int, x long")
    check(rows, whitening.whiten(docs).collect())


def test_directions_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(20)], SCHEMA)
    got = whitening.whiten(same).collect()
    assert len(got) == 60 and {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in got} == {(None, 0.0, None, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(20)], SCHEMA)
    got = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-9
    assert whitening.whiten(same.where("vec_id < 0")).collect() == []
    assert {r.whitened for r in whitening.whiten(same.where("vec_id = 1")).collect()} == {None}


def test_exact_sums_past_64_bits(spark):
    rows = [(i, [float(2 ** 40 + 3 * i), float(-i)], 0) for i in range(8)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([[int(1024 * c) + 100000 for c in e] for _, e, _ in rows], object)
    away = len(x) * x - x.sum(0)
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(docs).collect()}
    assert got == {i: sum(int(v) ** 2 for v in away[i]) for i in range(8)}


@pytest.mark.parametrize("seed", range(4))
def test_rank_one_updates_and_combination(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, size=(90, 10)).astype(float)
    x[20:50] = x[3]
    a, b = whitening.Spectrum(10), whitening.Spectrum(10)
    for row in x[:55]:
        a.add(row)
    for row in x[55:]:
        b.add(row)
    a.combine(b)
    y = x - x.mean(0)
    assert np.abs(a.q @ np.diag(a.d) @ a.q.T - y.T @ y).max() < 1e-7
    assert np.abs(a.q.T @ a.q - np.eye(10)).max() < 1e-12
