import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from tests.llm.test_textops import ref_set
from valuora.llm import jaccard as J


def brute(rows, percent=75, width=5):
    """{id: component} and sizes by comparing all pairs; an id's texts are one node."""
    sets = [(i, ref_set(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def check(spark, df, rows, **kw):
    got = [(r.id, r.n_shingles, r.component_id) for r in J.jaccard_classes(df, **kw).collect()]
    comp = brute(rows, kw.get("percent", 75), kw.get("width", 5))
    want = [(i, len(ref_set(t, kw.get("width", 5))), comp.get(i)) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_rows(spark, odd_docs):
    check(spark, odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_families_near_the_threshold(spark, monkeypatch):
    """Families whose members link in chains, shared passages, and trees over several small blocks."""
    monkeypatch.setattr(J, "QUERY_BLOCK", 4)
    monkeypatch.setattr(J, "DATA_BLOCK", 8)
    rng = random.Random(3)
    passage = prose(rng, 60)
    rows, doc = [], 0
    for _ in range(6):
        base = prose(rng, rng.choice([8, 40, 150])).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(1 + len(w) // 15)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append((doc, " ".join(w)))
            doc += 1
    for _ in range(40):
        rows.append((doc, prose(rng, rng.randrange(1, 60)) + " " + passage + " " + prose(rng, rng.randrange(1, 60))))
        doc += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(spark, df, rows)


def test_large_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies that link with each other but not with the smallest ids: a few texts compared for each, not all pairs."""
    monkeypatch.setattr(J, "QUERY_BLOCK", 64)
    monkeypatch.setattr(J, "DATA_BLOCK", 128)
    rng = random.Random(5)
    base = prose(rng, 150).split()[:150]
    rows = []
    for doc in range(250):  # own words apart cost five shingles each: 126 of 166 are shared, or 121 of 171 with the first ten
        w = list(base)
        for at in rng.sample(range(5, 145, 5), 3 if doc < 10 else 2):
            w[at] = f"own{doc}x{at}"
        rows.append((doc, " ".join(w)))
    tested, confirmed = [], J._confirmed

    def counted(pairs, *rest):
        pairs = J.cut_lineage(pairs, "counted")
        tested.append(pairs.count())
        return confirmed(pairs, *rest)
    monkeypatch.setattr(J, "_confirmed", counted)
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    assert sum(tested) < 20 * len(rows), tested


def test_empty_table_and_bad_percent(spark, no_docs):
    assert J.jaccard_classes(no_docs).collect() == []
    with pytest.raises(ValueError):
        J.jaccard_classes(no_docs, percent=0)


def test_tree_finds_every_point_within_the_bound():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 200, 700)
    pts = np.stack([rng.multinomial(k, np.full(J.GROUPS, 1 / J.GROUPS)) for k in n]).astype(np.uint8)
    pts[:50] = pts[50:100]
    n[:50] = n[50:100]
    tree = J.RTree(pts, n)
    for q in range(0, 700, 7):
        want = np.flatnonzero(J.may_link(J.overlap_bound(pts[q], pts), n[q], n, 75))
        assert sorted(tree.query(pts[q], n[q], 75)) == want.tolist()


def test_full_coordinates_bound_nothing():
    full = np.full((1, J.GROUPS), J.FULL, np.uint8)
    assert J.may_link(J.overlap_bound(full[0], full), np.int64(10**6), np.array([10**6]), 75).all()


def test_points_bound_the_overlap_at_any_size():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, k, dtype=np.uint64)) for k in (3, 500, 2100, 9000, 9500)]
    sets += [np.unique(np.concatenate([s[: len(s) * 4 // 5], s[:1] + np.arange(len(s) // 9, dtype=np.uint64)])) for s in sets]
    heads = np.append(0, np.cumsum([len(s) for s in sets]))
    pts = J.points(np.concatenate(sets), heads)
    for p, s in zip(pts, sets, strict=True):
        assert p.sum() == len(s) and J.folded(p, J.GROUPS).sum() == len(s)
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    n = np.diff(heads)
    ok = J.pairs_may_link([pts[k] for k in i], [pts[k] for k in j], n[i], n[j], 75)
    for a, b, may in zip(i, j, ok, strict=True):
        inter = len(np.intersect1d(sets[a], sets[b]))
        assert may or 100 * inter < 75 * (len(sets[a]) + len(sets[b]) - inter)
    assert not ok.all()
