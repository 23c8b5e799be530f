"""Whitening against numpy's own eigenvectors and exact fractions."""
import math
from fractions import Fraction

import numpy as np
import pytest

from valuora.llm import whitening as W


def matrices():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 20, 64):
        a = rng.normal(size=(3 * n, n))
        yield "plain", a.T @ a / len(a)
        a = a[:max(1, n // 3)]
        yield "few vectors", a.T @ a / len(a)
        yield "all equal", np.eye(n) * 3
        q = np.linalg.qr(rng.normal(size=(n, n)))[0]
        e = np.ones(n)
        e[:4] = [1e6, 1e6 * (1 - 1e-11), 1e6 * (1 - 1e-8), 1e5][:n]
        yield "close values", (v := (q * e) @ q.T) / 2 + v.T / 2
        e = np.where(np.arange(n) < 3, 5.0, -2.0)
        yield "triple and negative", (v := (q * e) @ q.T) / 2 + v.T / 2


def test_slicing_finds_and_numbers_the_leading_pairs():
    for name, v in matrices():
        got = W.leading(v, 8)
        want = np.linalg.eigvalsh(v)[::-1][:8]
        size, k = np.abs(want).max(), len(want)
        assert np.abs(got.values - want).max() <= 1e-13 * size, name
        assert np.abs(v @ got.vectors - got.vectors * got.values).max() <= 1e-13 * size, name
        assert np.abs(got.vectors.T @ got.vectors - np.eye(k)).max() <= 1e-13, name
        assert all(over <= i < down for i, (over, down) in enumerate(got.certified)), name


def test_counts_are_inertia():
    rng = np.random.default_rng(4)
    for n in range(1, 12):
        a = rng.integers(-3, 4, size=(n, n)).astype(float)
        a = a + a.T
        a[np.diag_indices(n)] *= rng.integers(0, 2, n)  # zero pivots need blocks of two
        values = np.linalg.eigvalsh(a)
        f = W.Factors(a)
        assert f.negative == (values < -1e-9).sum() and f.zero <= (np.abs(values) <= 1e-9).sum()
        if np.abs(values).min() > 1e-9:
            b = rng.normal(size=n)
            assert np.allclose(a @ f.solve(b, 1e-300), b)


def brute(rows, k=8):
    """Expected (id, deviation) and per component (whitened up to sign, explained) of vectors of one length."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dim)]
    far = [[n * r[d] - s[d] for d in range(dim)] for r in x]
    v = np.array([[float(Fraction(sum(f[i] * f[j] for f in far), n ** 3)) for j in range(dim)] for i in range(dim)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    w = np.array(far, float) / n @ axes / np.sqrt(np.maximum(values, 1e-300))
    return n, [sum(c * c for c in f) for f in far], w, values / np.trace(v)


def check(spark, rows, kind="float", tol=1e-7):
    df = spark.createDataFrame([(i, v, 5, 7, "w", 3.0) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, n long, dim int, w string, component double").repartition(4)
    got = W.whiten(df).collect()
    if kind == "float":
        rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v) and v]
    want = []
    for dim in {len(v) for _, v in good}:
        part = [r for r in good if len(r[1]) == dim]
        n, deviation, w, explained = brute(part)
        shown = [r for r in got if r["n"] == n and r["component"] <= dim]
        assert {r["identity_error"] for r in shown if r["whitened"] is not None} and all(
            r["identity_error"] is None or r["identity_error"] <= 1e-9 for r in shown)
        for c in range(min(8, dim)):
            assert all(abs(r["explained"] - explained[c]) <= 1e-9 for r in shown if r["component"] == c + 1)
        want += [(part[k][0], c + 1, n, deviation[k], abs(w[k, c]) if explained[c] > 1e-12 else None)
                 for k in range(n) for c in range(w.shape[1])]
    have = [(r["id"], r["component"], r["n"], int(r["deviation"]), None if r["whitened"] is None else abs(r["whitened"])) for r in got]
    key = lambda r: (str(r[0]), r[1], r[2], r[3], r[4] or 0)
    have, want = sorted(have, key=key), sorted(want, key=key)
    assert [r[:4] for r in have] == [r[:4] for r in want]
    for a, b in zip(have, want, strict=True):
        assert (a[4] is None) == (b[4] is None) and (a[4] is None or abs(a[4] - b[4]) <= tol), (a, b)


def test_random_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 12)) * np.linspace(2, 0.3, 12)
    check(spark, list(enumerate(x.tolist())))
    check(spark, list(enumerate((300 * x).tolist())), kind="double")


def test_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(40, 3)) * [1, 2, 3]).tolist())]
    rows += [(3, [1.0, 2.0, 3.0])] * 7 + [(None, [0.0, 0.0, 0.0]), (50, None), (51, []), (52, [1.0, None, 1.0]),
                                          (53, [float("nan"), 1.0, 1.0]), (54, [float("inf"), 0.0, 0.0])]
    rows += [(60 + i, v) for i, v in enumerate((rng.normal(size=(9, 2)) * [1, 4]).tolist())]  # another length
    check(spark, rows)
    check(spark, list(enumerate([[1.0, 2.0, 0.0], [2.0, 4.0, 0.0], [5.0, 10.0, 0.0]])))  # all on a line


def test_without_variance(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[1:] for r in W.whiten(one).orderBy("id", "component").collect()] == [
        (c, 2, 0, None, None, None) for c in (1, 2, 1, 2)]
    assert W.whiten(one.limit(0)).collect() == []
    with pytest.raises(Exception, match="32768"):
        W.whiten(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>")).collect()


def test_sums_past_64_bits():
    """Products are exact as whole numbers, whatever their size, and do not depend on the split of the rows."""
    rng = np.random.default_rng(9)
    y = rng.integers(-(1 << 25), 1 << 25, size=(300, 3))
    high, low = W.products(y)
    want = [sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for i in range(3) for j in range(i, 3)]
    assert [(h << 30) + x for h, x in zip(high.tolist(), low.tolist(), strict=True)] == want
    parts = [W.products(p) for p in (y[:7], y[7:150], y[150:])]
    total = [(int(sum(p[0][k] for p in parts)) << 30) + int(sum(p[1][k] for p in parts)) for k in range(6)]
    assert total == want
