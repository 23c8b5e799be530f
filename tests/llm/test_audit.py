"""The filter audit against a plain count of every order."""
import itertools
import random
import re

import pytest

from valuora.llm import filter_audit as A


def failures(rows):
    """The letters that each row fails, from the rules as stated."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield {x for x, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and least[t] < i), strict=True) if bad}


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    told = list(zip(rows, failures(rows), strict=True))
    for part in {p or "" for _, _, p in rows}:
        docs = [(i, bad) for (i, _, p), bad in told if (p or "") == part]
        chains = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [(i, bad) for i, bad in left if x in bad]
                left = [(i, bad) for i, bad in left if x not in bad]
                chains.append(("".join(order), step, x, len(left), len(gone),
                               sum(x in bad for _, bad in docs) - len(gone), sum(bad == {x} for _, bad in docs),
                               sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        shapley = {x: sum(c[4] for c in chains if c[2] == x) for x in "ABCDE"}
        out += [(part, *c[:2], *c[3:], shapley[c[2]]) for c in chains]
    return sorted(out)


def check(spark, docs, labels):
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = A.audit(docs, lab)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)


def test_swaps_reach_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in A.swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


def test_swapped_diagrams_hold_the_same_counts():
    """After any swaps, each path of the diagram weighs what its mask weighs, and equal subgraphs are one node."""
    rng = random.Random(3)
    counts = {m: (rng.randrange(4), rng.randrange(2), 0) for m in range(32) if rng.random() < 0.7}
    d = A.Diagram("ABCDE", counts)
    for i in A.swaps(5):
        d.swap(i)
        for mask in range(32):
            at = d.root
            for x in d.order:
                at = d.failed[at] if mask >> "ABCDE".index(x) & 1 else d.passed[at]
            assert d.weight[at] == counts.get(mask, (0, 0, 0))
        for level in d.levels:
            assert len({(d.passed[u], d.failed[u]) for u in level.values()}) == len(level)


def test_words_are_split_in_pieces(monkeypatch):
    monkeypatch.setattr(A, "PIECE", 5)
    for t in ("", "   ", "a", "one two  one\nthree", "long" * 20 + " x", " \x0b\x1c end of x\x0cy "):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert A.words_of(t.encode()) == (len(w), len(set(w)))


def test_odd_rows(spark, odd_docs):
    rng = random.Random(8)
    docs = odd_docs.selectExpr("*", "case when doc_id % 3 = 0 then 'x' when doc_id % 3 = 1 then 'y' end as source",
                               "'c' as part", "1 as mask", "'d' as digest", "true as first", "1 as good", "0 as toxic")
    labels = [(rng.randrange(140), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)]
    check(spark, docs, [*labels, (None, 1, 1)])


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "Bc", "d#", "É", "XYZ", f"w{rng.randrange(99)}"]) for _ in range(rng.randrange(45, 60)))
             for _ in range(30)]
    rows = [(rng.randrange(80), rng.choice(texts), rng.choice(["p", "q", None])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    check(spark, docs, [(i, i % 2, i % 3 % 2) for i in range(80)])


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    check(spark, docs, [(1, 1, 1)])
