import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm.whitening import leading_components, leading_eigenvalues, op13_whitening, sturm_counts, tridiagonalise, whiten


def brute(rows, k=16):
    """{(row, component): ...} by whole arrays, exact sums and the library's eigensolver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in good]
    fit = sorted({tuple(v) for _, v in x})
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    y = np.array([[float(Fraction(n * v[j] - s[j], n)) for j in range(d)] for v in fit])
    cov = y.T @ y / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    keep = e > 1e-12 * e[0]
    e, vec = e[keep], vec[:, keep]
    out = []
    for i, v in x:
        dev = sum((n * a - b) ** 2 for a, b in zip(v, s))
        z = np.array([float(Fraction(n * a - b, n)) for a, b in zip(v, s)]) @ vec / np.sqrt(e)
        out.append((i, n, dev, z, e / np.trace(cov)))
    return out


def check(df, rows, k=16, tie=False):
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, []).append(r)
    want = brute(rows, k)
    assert set(got) == {i for i, *_ in want}
    sign = None
    for i, n, dev, z, explained in want:
        mine = sorted(got[i], key=lambda r: r.component)[: len(z)]
        assert [r.component for r in mine] == list(range(1, len(z) + 1)) and len(got[i]) % len(z) == 0
        assert {(r.n, r.deviation) for r in mine} == {(n, dev)}
        assert all(r.identity_error < 1e-9 for r in mine)
        np.testing.assert_allclose([r.explained for r in mine], explained, rtol=1e-9)
        w = np.array([r.whitened for r in mine])
        if tie:
            continue
        if sign is None and (np.abs(z) > 1e-3).all():
            sign = np.sign(w * z)
        if sign is not None:
            np.testing.assert_allclose(w, sign * z, atol=1e-7)
    assert tie or sign is not None


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("x", F.lit(1)).withColumn("id", F.lit(2))


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op13_whitening(spark, sf), rows)


def test_odd_vectors_and_a_hot_one(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * (8, 2, 1, 0.2)]) for i in range(60)]
    hot = [(100 + i, rows[0][1]) for i in range(400)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    df = frame(spark, rows + hot + odd)
    check(whiten(df), rows + hot, 16)
    check(whiten(df, components=2), rows + hot, 2)


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 2.0]), (7, [3.0, 1.0]), (7, [0.5, 5.0]), (8, [9.0, 9.0])]
    got = whiten(frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2)]


def test_no_variance_and_empty(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, None)])).collect() == []
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whiten(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1) for r in got)


def test_values_beyond_64_bits(spark):
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate([(1e30, 0.0), (-1e30, 1.0), (3e15, 2.0), (0.0, 3.0)])]
    got = whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3} and all(math.isfinite(r.whitened) for r in got)
    assert all(r.deviation is None for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_eigensolver(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 7, 40, 64, 90][seed]
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    e = np.sort(rng.choice([4.0, 4.0, 1.0, 1e-3, 0.0, 7.5], n) if seed % 2 else rng.exponential(size=n))[::-1]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    k = min(16, n)
    values, vectors = leading_components(a, k)
    np.testing.assert_allclose(values, e[:k], atol=1e-13 * max(n, 4))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    np.testing.assert_allclose(a @ vectors, vectors * values, atol=1e-12)
    d, off, _ = tridiagonalise(a)
    np.testing.assert_allclose(np.linalg.eigvalsh(np.diag(d) + np.diag(off, 1) + np.diag(off, -1)), e[::-1], atol=1e-12)
    at = np.array([-1.0, 0.5, 5.0, 99.0])
    assert (sturm_counts(d, off, at) == [(e < t).sum() for t in at]).all()
    assert (np.diff(leading_eigenvalues(d, off, k)) <= 1e-13).all()


def test_eigensolver_on_diagonal_and_equal_eigenvalues():
    for a in (np.eye(5), np.diag([3.0, 1.0, 3.0, 2.0, 3.0]), np.zeros((3, 3)), np.ones((6, 6))):
        values, vectors = leading_components(a, 4)
        np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:4], atol=1e-14 * 10)
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-12)
        np.testing.assert_allclose(a @ vectors, vectors * values, atol=1e-12)
