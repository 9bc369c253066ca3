"""Whitening against numpy's eigenvectors; counts of eigenvalues against numpy's."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from demandkit.llm import whitening
from demandkit.llm.queries import QUERIES


@pytest.mark.parametrize("kind", ["plain", "equal", "low rank", "close", "steep"])
def test_leading_eigenvectors(kind):
    rng = np.random.default_rng(len(kind))
    for d in (1, 2, 5, 40):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        e = np.sort(rng.uniform(0.1, 9, d))[::-1]
        if kind == "equal":
            e[:3] = 9.5
        elif kind == "low rank":
            e[2:] = 0
        elif kind == "close" and d > 2:
            e[1], e[2] = e[0] * (1 - 1e-13), e[0] * (1 - 1e-9)
        elif kind == "steep":
            e = 10.0 ** -np.arange(d)
        v = (q * e) @ q.T
        v = (v + v.T) / 2
        values, vectors = whitening.leading(v, 4)
        k = min(4, d, 2 if kind == "low rank" else 4)
        assert len(values) == k
        assert np.abs(values - e[:k]).max() < 1e-12
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11


def test_counts_of_eigenvalues():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 10, 30):
        for _ in range(10):
            a = rng.normal(size=(d, d))
            a = a + a.T
            if d == 10:
                np.fill_diagonal(a, 0)
            e = np.linalg.eigvalsh(a)
            assert whitening.inertia(a) == ((e > 0).sum(), 0, (e < 0).sum())
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1)


def brute(rows, components=4):
    """By id: n, deviation, and the whitened values up to the sign of the component."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    z = fit.astype(float) - np.array([float(v) / n for v in s])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    mean = np.array([float(v) / n for v in s])
    out = [(i, n, sum((n * a - b) ** 2 for a, b in zip(x, s)), (np.array(x, float) - mean) @ u / np.sqrt(e)) for i, x in kept]
    return out, e / np.trace(z.T @ z / n)


def compared(found, rows):
    wanted, explained = brute(rows)
    per = {}
    for r in found:
        per.setdefault(r.component, []).append(r)
    assert sorted(per) == [1, 2, 3, 4]
    for k, own in per.items():
        own = sorted(own, key=lambda r: (r.vec_id is None, r.vec_id, r.whitened))
        sign = None
        for sign in (1, -1):
            like = sorted(((i, n, dev, sign * w[k - 1]) for i, n, dev, w in wanted), key=lambda t: (t[0] is None, t[0], t[3]))
            if max(abs(a[3] - b.whitened) for a, b in zip(like, own)) < 1e-8:
                break
        else:
            raise AssertionError(f"component {k}")
        assert [(r.vec_id, r.n, r.deviation) for r in own] == [t[:3] for t in like]
        assert all(abs(r.explained - explained[k - 1]) <= 1e-10 * explained[k - 1] for r in own)
        assert all(r.identity_error < 1e-9 for r in own)


def test_query_on_the_whole_table(spark, sf):
    table = pq.read_table(f"{sf}/embeddings.parquet")
    rows = list(zip(table.column("vec_id").to_pylist(), table.column("embedding").to_pylist()))
    compared(QUERIES["op13_whitening"](spark, sf).collect(), rows)


def test_unusable_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 6)) * np.arange(1, 7))]
    rows += [(5, rows[5][1]), (7, rows[9][1]), (None, rows[0][1]), (90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(93, [float("nan")] * 6), (94, [float("inf")] + [0.0] * 5), (95, [0.0] * 6)]
    docs = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, n int, whitened double")
    compared(whitening.whiten(docs).collect(), rows)


def test_no_variance_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9)), round(r.explained, 9)) for r in two) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_errors(spark):
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "vec_id long, embedding array<float>"))
    far = whitening.whiten(spark.createDataFrame([(1, [1e12, 2.0]), (2, [1.0, 5.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="exceeds a long"):
        far.collect()
