"""Whitening against numpy's eigenvalues and exact integer sums."""

import math

import numpy as np
import pytest

from parcelle.llm import whitening


def spectrum(values, seed=0):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41), [5.0, 5.0, 5.0, 1.0, 1.0, 0.5], [1.0] * 7, [1e12, 1e3, 1.0, 1e-3], [3.0, 3.0 + 1e-12, 3.0 - 1e-12, 3.0, 0.1],
    [2.0], [2.0, 1.0], [0.0, 0.0, 4.0], [1.0, 0.0, 0.0, 0.0, 0.0]])
def test_leading_eigenpairs(values):
    a = spectrum(np.asarray(values))
    a = (a + a.T) / 2
    e, v = whitening.leading_eigenpairs(a, 4)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:4]
    scale = np.abs(want).max()
    assert np.allclose(e, want, atol=1e-13 * scale * len(a), rtol=1e-13)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-12)
    assert np.abs(a @ v - v * e).max() <= 1e-12 * scale * len(a)


def test_eigenpairs_of_diagonal_and_zero_matrices():
    e, v = whitening.leading_eigenpairs(np.diag([1.0, 9.0, 4.0, 4.0, 2.0]), 4)
    assert np.allclose(e, [9, 4, 4, 2]) and np.allclose(v.T @ v, np.eye(4), atol=1e-12)
    assert whitening.leading_eigenpairs(np.zeros((3, 3)), 4)[0].tolist() == [0, 0, 0]


def test_sturm_count():
    r = np.random.default_rng(1)
    d, o = r.standard_normal(30), r.standard_normal(29)
    e = np.linalg.eigvalsh(np.diag(d) + np.diag(o, 1) + np.diag(o, -1))
    for x in [-5, -1, 0, 0.3, 1, 5]:
        assert whitening.sturm_count(d, o, x) == (e < x).sum()


def brute(rows, k=4):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) and abs(c) < 2**55 for c in v)]
    if not good:
        return {}
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    pts = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in good if len(v) == d]
    fit = sorted({x for _, x in pts})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - t) / n for c, t in zip(x, s)] for x in fit])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return {"n": n, "dev": sorted((str(i), sum((n * c - t) ** 2 for c, t in zip(x, s))) for i, x in pts), "cov": cov, "e": e, "v": v, "trace": np.trace(cov), "pts": pts, "s": s}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "clash") for i, v in rows], "vec_id long, embedding array<float>, n int, x string").repartition(3)


def check(spark, rows, components):
    want = brute(rows)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == components * len(want["pts"])
    assert {g.n for g in got} == {want["n"]} and len({g.identity_error for g in got}) == 1 and got[0].identity_error <= 1e-4
    for c in range(1, components + 1):
        mine = [g for g in got if g.component == c]
        assert sorted((str(g.vec_id), g.deviation) for g in mine) == want["dev"]
        assert {round(g.explained / (want["e"][c - 1] / want["trace"]), 9) for g in mine} == {1.0}
        plain = sorted(((str(i), float(np.dot(np.array(x) - np.array(want["s"]) / want["n"], want["v"][:, c - 1]) / math.sqrt(want["e"][c - 1]))) for i, x in want["pts"]))
        seen = sorted((str(g.vec_id), g.whitened) for g in mine)
        by_id = dict(plain)
        sign = 1 if sum(w * by_id[i] for i, w in seen) > 0 else -1
        assert all(abs(sign * w - by_id[i]) < 1e-9 for i, w in seen)


def make_rows(n=200, d=9, seed=0):
    r = np.random.default_rng(seed)
    x = (r.standard_normal((n, d)) * np.arange(d, 0, -1) / 3).astype(np.float32).tolist()
    return list(enumerate(x))


def test_equals_numpy(spark):
    rows = make_rows()
    odd = [(900, None), (901, []), (902, [None] * 9), (903, [float("nan")] + [0.0] * 8), (904, [float("inf")] * 9), (905, [1e30] * 9), (906, [1.0, 2.0]),
           (907, [-0.0] * 9), (None, rows[3][1])]
    check(spark, rows + odd + rows[:50] + [rows[5]] * 300, 4)


def test_few_dimensions_few_rows(spark):
    check(spark, [(i, [float(i), 0.5 * i * i]) for i in range(6)], 2)
    check(spark, [(0, [0.0, 0.0, 1.0]), (1, [1.0, 0.0, 1.0])], 1)


def test_nothing_varies(spark):
    assert whitening.whiten(frame(spark, [(0, [1.0, 2.0])] * 3)).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(0, None)])).collect() == []


def test_wide_entries_are_exact(spark):
    """Deviations beyond 64 bits are null, sums stay exact."""
    rows = [(0, [float(2**54), 1.0]), (1, [-float(2**54), 2.0]), (2, [float(2**53), 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert got and all(g.deviation is None and math.isfinite(g.whitened) for g in got)


def test_query_on_given_tables(spark):
    from parcelle.llm.queries import op11_whitening
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    got = op11_whitening(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 4 * len(rows) and got[0].identity_error < 1e-10
    assert sorted((str(g.vec_id), g.deviation) for g in got if g.component == 2) == want["dev"]
    assert all(abs(g.explained - want["e"][g.component - 1] / want["trace"]) < 1e-12 for g in got)
