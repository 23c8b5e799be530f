"""Neighbour search against brute force: the search's parts exactly, the whole by recall."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuora.llm import stable_search as N


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute(rows, of, k):
    """(query id, [(vec id, score)]) of all query rows, every other row compared."""
    good = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for at, (i, v) in enumerate(good):
        if i % of == 0:
            found = [(-dot(v, w), j) for t, (j, w) in enumerate(good) if t != at and len(w) == len(v)]
            out.append((i, [(j, -s) for s, j in sorted(found)[:k]]))
    return sorted(out)


def found(spark, rows, of, k, kind="float", certainty=N.CERTAINTY):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, id int, gid int, region int").repartition(4)
    got = N.search(df, F.col("id") % of == 0, k=k, certainty=certainty)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return got.collect()


def single(rows):
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def grouped(got):
    """Results per query id; an id that asks more than once has each rank more than once."""
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"], r["vec_id"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def small(monkeypatch):
    for name, size in {"BLOCK": 60, "PACK": 7, "LEAF": 8, "SLOT": 3, "TURN": 2, "SAMPLE": 100}.items():
        monkeypatch.setattr(N, name, size)


def test_chi_square():
    # even degrees of freedom have a closed form
    for m in (2, 4, 8):
        for x in (0.1, 1.0, 5.0, 20.0):
            want = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
            assert abs(N.chi_square(x, m) - want) < 1e-12
        for p in (0.05, 0.5, 0.95):
            assert abs(N.chi_square(N.chi_square_quantile(p, m), m) - p) < 1e-12
    assert abs(N.chi_square_quantile(0.95, 1) - 3.841458820694124) < 1e-9
    rng = np.random.default_rng(3)  # the law itself: projected over true squared distances
    space, x = N.Space(20, 9.0), rng.normal(size=(4000, 20))
    x /= np.abs(x).sum(axis=1, keepdims=True)
    q = space.stretch(rng.normal(size=(1, 20)))
    lift = np.column_stack([x, np.sqrt(81 - (x * x).sum(axis=1))])
    true = ((lift - np.append(q, 0)) ** 2).sum(axis=1)
    assert np.allclose(2 * 81 - 2 * x @ q[0], true)
    assert np.allclose(space.queries(q), np.append(q, 0) @ space.axes) and np.allclose(space.points(x), lift @ space.axes)


def test_search_stops_where_the_test_says():
    """A block's candidates hold every vector whose projection is within reach of the k-th best score."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(300, 6)), 6 * np.eye(6)[rng.integers(0, 6, 200)] + rng.normal(size=(200, 6)) / 9])
    q = x[::25]
    space = N.Space(6, float(np.linalg.norm(x, axis=1).max()), 4)
    search = N.Search(space, 5, 0.9, 16)
    i, j, score, floor = search.run(q, np.full(len(q), -np.inf), x)
    gap = ((space.queries(q)[:, None] - space.points(x)[None]) ** 2).sum(axis=2)
    true = space.stretch(q) @ x.T
    for a in range(len(q)):
        mine = dict(zip(j[i == a].tolist(), score[i == a].tolist(), strict=True))
        assert len(mine) >= 5 and all(abs(s - dot(q[a], x[b])) == 0 for b, s in mine.items())
        must = np.flatnonzero((gap[a] <= search.radius(floor[a:a + 1])[0]) & (true[a] > floor[a]))
        assert set(must.tolist()) <= set(mine)
    looked = []
    run = np.partition
    try:
        np.partition = lambda a, *k, **kw: looked.append(a.shape[0] * (a.shape[1] - 5)) or run(a, *k, **kw)
        search.run(x[-8:], np.full(8, -np.inf), x)
    finally:
        np.partition = run
    assert sum(looked) < 0.7 * 8 * len(x)  # far leaves are not verified


def test_recall_and_scores(spark, monkeypatch):
    small(monkeypatch)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 24)) * rng.uniform(0.5, 2, size=(600, 1))
    x = np.concatenate([x, x[:60] + rng.normal(size=(60, 24)) / 10])
    rows = single(list(zip(rng.permutation(len(x)).tolist(), x.tolist(), strict=True)))
    want = dict(brute(rows, 4, 10))
    got = grouped(found(spark, rows, 4, 10))
    at = dict(rows)
    assert set(got) == set(want)
    for i, hits in got.items():
        assert [r for r, _, _ in hits] == list(range(1, 11))
        assert all(s == dot(at[i], at[j]) and j != i for _, j, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[2], h[1]))
    hit = sum(len({j for _, j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hit >= 0.9 * 10 * len(want)


def test_certain_search_is_exact(spark, monkeypatch):
    """Copies, ties, repeated ids and odd rows; a test that practically never stops early gives all neighbours."""
    small(monkeypatch)
    rng = np.random.default_rng(9)
    v = [1.0, 2.0, -0.5]
    rows = [(i, v) for i in range(70)] + [(100 + i, [0.0, 1.0, float(i % 3)]) for i in range(40)]
    rows += [(200 + i, x) for i, x in enumerate(rng.normal(size=(80, 3)).tolist())]
    rows += [(200, v), (204, [9.0, 9.0, 9.0]), (204, [9.0, 9.0, 9.0]), (None, v), (300, None), (304, []), (308, [0.0, 0.0, -0.0]),
             (312, [1.0, None, 2.0]), (316, [float("nan"), 1.0, 1.0]), (320, [float("inf"), 1.0, 1.0]),
             (324, [1.0, 2.0]), (325, [3.0, 2.0]), (328, [5.0]), (332, [-0.0, 1.0, 0.0])]
    for kind in ("float", "double"):
        data = single(rows) if kind == "float" else rows
        got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found(spark, data, 4, 9, kind, 1 - 1e-15))
        assert got == sorted((i, n, j, s) for i, hits in brute(data, 4, 9) for n, (j, s) in enumerate(hits, 1))


def test_no_vectors(spark):
    assert found(spark, [], 4, 3) == [] and found(spark, [(4, None)], 4, 3) == []
    assert found(spark, [(4, [1.0, 2.0])], 4, 3) == []  # no other row
    assert found(spark, [(5, [1.0, 2.0]), (7, [1.0, 2.0])], 4, 3) == []  # no query
    with pytest.raises(ValueError):
        N.search(None, None, k=0)
