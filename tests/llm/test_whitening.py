import math

import numpy as np
import pytest

from telemetry_engine.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "c") for i, v in rows],
                                 SCHEMA)


def reference(rows, k=4):
    """Rows and the leading pairs by a dense decomposition."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    return kept, n, sums, e[::-1][:k], u[:, ::-1][:, :k], np.trace(cov)


def made(n=300, d=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * np.linspace(1, 0.2, d)
    rows = [(i, list(v)) for i, v in enumerate(x.astype(np.float32))]
    rows += [(1000, rows[0][1]), (1000, rows[0][1]), (None, rows[1][1])]  # repeated rows and a null id
    return rows + [(2000, None), (2001, [None] * d), (2002, [float("nan")] + [0.0] * (d - 1)),
                   (2003, [float("inf")] + [0.0] * (d - 1))]


def check(spark, rows, k=4):
    got = whitening.whole(table(spark, rows))
    got = whitening.whitened(got, whitening.train(got)).collect()
    kept, n, sums, e, u, trace = reference([r for r in rows], k)
    assert len(got) == k * len(kept)
    expected = {}
    for i, x in kept:
        expected.setdefault(i, (sum((n * c - s) ** 2 for c, s in zip(x, sums)),
                                [((n * c - s) / n) for c, s in zip(x, sums)] @ u / np.sqrt(e)))
    sign = {c: next(np.sign(r["whitened"] * expected[r["vec_id"]][1][c - 1]) for r in got
                    if r["component"] == c and abs(r["whitened"]) > 0.1) for c in range(1, k + 1)}
    for r in got:
        deviation, white = expected[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation
        assert abs(r["whitened"] * sign[r["component"]] - white[r["component"] - 1]) < 1e-9
        assert abs(r["explained"] - e[r["component"] - 1] / trace) < 1e-12
        assert r["identity_error"] < 1e-9


def test_equals_a_dense_decomposition(spark):
    check(spark, made())


def test_fewer_dimensions_than_components(spark):
    check(spark, made(40, 2), k=2)


def test_rank_below_the_components_and_large_entries(spark):
    rows = [(i, [i * 1000.0, 0.0, -i * 1000.0, 7.0]) for i in range(50)]
    got = whitening.whole(table(spark, rows))
    model = whitening.train(got)
    assert len(model.values) == 1
    assert whitening.whitened(got, model).count() == 50


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, None)], [(1, [])]])
def test_tables_without_variance_give_no_rows(spark, rows):
    got = whitening.whole(table(spark, rows))
    assert whitening.whitened(got, whitening.train(got)).collect() == []


def test_rows_of_another_length_take_no_part(spark):
    rows = made(50, 6) + [(5000, [1.0, 2.0]), (5001, [])]
    got = whitening.whole(table(spark, rows))
    assert not got.where("vec_id >= 5000").count()
    assert whitening.whitened(got, whitening.train(got)).count() == 4 * got.count()


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [4.0e12 * (1 if i % 2 else -1), float(i)]) for i in range(6)]
    got = whitening.whole(table(spark, rows))
    got = whitening.whitened(got, whitening.train(got)).collect()
    assert got and all(r["deviation"] is None for r in got)


@pytest.mark.parametrize("d", [1, 2, 5, 40, 120])
def test_pairs_of_dense_operators(d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    for values in (np.ones(d), np.linspace(1, 2, d), 2.0 ** -np.arange(d), np.r_[np.full(min(5, d), 3.0), rng.random(d)][:d]):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        got = whitening.leading(lambda v: a @ v, d, space=24)
        want = np.sort(values)[::-1][:4]
        assert np.allclose(got.values, want, rtol=1e-12, atol=1e-13)
        assert np.allclose(got.vectors.T @ got.vectors, np.eye(len(want)), atol=1e-12)
        assert (np.linalg.norm(a @ got.vectors - got.vectors * got.values, axis=0) < 1e-12 * values.max()).all()


def test_minres_solves_projected_equations():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = rng.standard_normal((20, 3))
    theta = np.array([0.3, -0.2, 0.1])
    x = whitening.minres(lambda v: a @ v, b, theta, lambda t: t, 60, 1e-13)
    for j in range(3):
        assert np.allclose((a - theta[j] * np.eye(20)) @ x[:, j], b[:, j], atol=1e-8)
