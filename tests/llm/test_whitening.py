"""FEAST and whitening against numpy's dense eigensolver and exact fractions."""

from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("featurewright.llm")

from featurewright.llm import feast, whitening  # noqa: E402

SCHEMA = "vec_id bigint, embedding array<float>, component int, n string"


def _symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    m = q * np.array(values, float) @ q.T
    return (m + m.T) / 2


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 17):
        for _ in range(20):
            m = rng.standard_normal((n, n))
            m = m + m.T
            shift = float(rng.standard_normal())
            assert feast.inertia(m, shift) == (int((np.linalg.eigvalsh(m) > shift).sum()), 0)
    assert feast.inertia(np.diag([1.0, 1.0, 2.0]), 1.0) == (1, 2)
    assert feast.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 0)


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1, 0.5, 0.1, 0.01],
    [1e6, 1e3, 10, 1, 0.9, 0.89, 0.889, 0.8889, 0.88889, 1e-3],
    [5, 5, 5, 3, 3, 3, 3, 3, 3, 3, 1, 1],  # the 8th is one of a cluster
    [4, 1] + [0] * 10,
    [2] * 12,
    list(1 + 1e-7 * np.arange(12)),
])
def test_largest_eigenpairs(values):
    m = _symmetric(values)
    got, vectors = feast.largest(m, 8)
    want = np.sort(np.array(values, float))[::-1][:8]
    want = want[want > 0]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-12, atol=1e-13 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
    assert np.abs(m @ vectors - vectors * got).max() < 1e-13 * max(values)


def _rows():
    rng = np.random.default_rng(4)
    mix = rng.standard_normal((12, 12))
    x = (rng.standard_normal((400, 12)) @ mix * 0.05 + 0.3).astype(np.float32)
    rows = [(i, v.tolist(), 1, "clash") for i, v in enumerate(x)]
    rows += [rows[0], rows[1], (None, x[2].tolist(), 1, "c")]
    bad = [(900, None, 1, ""), (901, [None] + [0.0] * 11, 1, ""), (902, [float("nan")] + [0.0] * 11, 1, ""), (903, [float("inf")] + [0.0] * 11, 1, ""),
           (904, [1.0] * 5, 1, ""), (905, [], 1, "")]
    return rows, bad


def test_whitening_equals_a_dense_fit(spark):
    rows, bad = _rows()
    got = whitening.whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(5)).collect()
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 1024).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    v = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    z = (x - sums / n) @ vectors / np.sqrt(values)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() < 1e-9 and len({r["identity_error"] for r in got}) == 1
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, row in enumerate(rows):
        for c in range(8):
            for r in by[row[0], c + 1]:
                assert r["explained"] == pytest.approx(values[c] / np.trace(v), rel=1e-9)
                assert abs(r["whitened"]) == pytest.approx(abs(z[i, c]), abs=1e-8)
                assert r["deviation"] == sum((n * int(e) - int(s)) ** 2 for e, s in zip(x[i], sums))
    assert len(by[0, 1]) == 2 and len(by[None, 8]) == 1
    for c in range(1, 9):  # one sign for all rows
        assert len({np.sign(r["whitened"]) * np.sign(z[i, c - 1]) for i, row in enumerate(rows) for r in by[row[0], c]}) == 1


def test_covariance_is_exact(spark):
    rows, _ = _rows()
    frame, d = whitening._vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 1024)
    w = whitening.fit(frame, d)
    x = [[int(np.floor(np.float64(e) * 1024)) + 100_000 for e in np.array(r[1], np.float32)] for r in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    for i in range(d):
        for j in range(d):
            exact = sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in x) / n
            assert w.covariance[i, j] == float(exact)


def test_degenerate_inputs(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, "")], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 1, "")] * 3, SCHEMA)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [i * 0.5, 1.0, i * 0.25], 1, "") for i in range(4)], SCHEMA)).collect()
    assert len(line) == 4 and {r["component"] for r in line} == {1}
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([5**-0.5, 5**-0.5, 3 / 5**0.5, 3 / 5**0.5])


def test_large_entries(spark):
    rows = [(i, [1e5 * (i % 3), float(i), -1e5 * (i % 5)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 90 and got[0]["identity_error"] < 1e-4
    assert whitening.Whitener(3, [0, 0], np.array([[2, 0], [0, 1]], object), 2).deviation(np.array([[2**40, 1], [1, 1]])) == [None, 18]
