import math

import numpy as np
import pytest

from valuora.llm import embed_dedup as E


def brute(rows, threshold):
    """(id, links, component) of all rows by comparing all pairs; rows are nodes, ids name them."""
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    links, parent = {k: 0 for k in range(len(rows))}, {k: k for k in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for dim in {len(v) for (_, v), ok in zip(rows, fine, strict=True) if ok}:
        on = [k for k, ok in enumerate(fine) if ok and len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in on], np.float64)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        for a, b in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if a < b:
                links[on[a]] += 1
                links[on[b]] += 1
                parent[find(on[b])] = find(on[a])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, links[k], least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def check(spark, rows, threshold=0.9, kind="float"):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, cid int, m int").repartition(3)
    if kind == "float":
        rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted((tuple(r) for r in E.link(df, threshold=threshold).collect()), key=repr) == brute(rows, threshold)


def cloud(rng, n, dim, spread):
    base = rng.normal(size=(1, dim))
    return (base + spread * rng.normal(size=(n, dim))).tolist()


def test_clusters_copies_and_noise(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 8)
    monkeypatch.setattr(E, "INTERVAL", 40)
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(150, 8)).tolist() + cloud(rng, 60, 8, 0.25) + cloud(rng, 40, 8, 0.1) + cloud(rng, 1, 8, 0) * 30
    ids = rng.permutation(len(vecs)).tolist()
    check(spark, list(zip(ids, vecs, strict=True)))
    check(spark, list(zip(ids, vecs, strict=True)), threshold=0.99, kind="double")


def test_odd_rows(spark):
    v = [1.0, 2.0, -0.5]
    rows = [(1, v), (2, v), (2, v), (None, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]),
            (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0, -1.0]),
            (None, [-1.0, 5.0, 3.0]), (11, [0.0, 1.0, -0.0]), (12, [-0.0, 1.0, 0.0]), (3, [1e-30, 2e-30, -5e-31])]
    check(spark, rows, kind="double")


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert E.link(none).collect() == []
    bad = spark.createDataFrame([(4, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in E.link(bad).collect()] == [(4, 0, 4)]
    with pytest.raises(ValueError):
        E.link(none, threshold=-1)


def test_far_parts_are_skipped(monkeypatch):
    """The recursion drops provably distant halves and still finds every link."""
    monkeypatch.setattr(E, "BLOCK", 64)
    rng = np.random.default_rng(1)
    eps = math.sqrt(0.2)
    x = np.concatenate([cloud(rng, 300, 16, 0.02), cloud(rng, 300, 16, 0.02), cloud(rng, 300, 16, 0.02)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean = x.mean(axis=0)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :6]
    order = np.lexsort(np.floor((x - mean) @ axes / eps).T[::-1])
    j = E.Joiner(0.9, eps, mean, axes)
    part = j.load(np.arange(900).tobytes(), np.ones(900, np.int64).tobytes(), x[order].tobytes())
    asked = []
    far = j.far
    j.far = lambda a, b: asked.append(far(a, b)) or asked[-1]
    ids, links, root = j.join(part, part, True)
    hit = x[order] @ x[order].T >= 0.9
    np.fill_diagonal(hit, False)
    assert links.tolist() == hit.sum(axis=1)[ids].tolist() and len(set(root.tolist())) == 3
    assert any(asked)


def test_vectors_of_every_length_link(spark, monkeypatch):
    """Tables that mix lengths: each length is joined whole, the rarer ones too; columns may be named as the operator's."""
    monkeypatch.setattr(E, "INTERVAL", 20)
    monkeypatch.setattr(E, "SIDE", 2)
    rng = np.random.default_rng(3)
    rows = [(3, [1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, [2.0, 0.1, 0.0]), (6, [0.5]), (7, [2.0]), (8, [-1.0])]
    rows += list(zip(range(100, 250), cloud(rng, 150, 2, 0.4), strict=True)) + list(zip(range(300, 340), cloud(rng, 40, 5, 0.2), strict=True))
    check(spark, rows, kind="double")
    check(spark, rows, threshold=0.99)
