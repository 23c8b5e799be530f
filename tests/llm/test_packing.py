import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from valuora.llm import packing as P


def brute(lengths, capacities):
    """The rule of best_fit word for word, scanning all bins."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins, place = [], {}
    for k, i in enumerate(order):
        s = lengths[i]
        fits = [b for b in range(len(bins)) if bins[b][0] - bins[b][1] >= s]
        if fits:
            b = min(fits, key=lambda b: (bins[b][0] - bins[b][1], b))
        else:
            def price(c, s=s, k=k):
                to_come = sum(lengths[j] for j in order[k + 1:] if lengths[j] <= c - s)
                return P.cost(c) / c * (s + max(0, c - s - to_come))
            b = len(bins)
            bins.append([min((c for c in capacities if c >= s), key=lambda c: (price(c), c)), 0])
        place[i] = (b, bins[b][1])
        bins[b][1] += s
    return place, [min(c for c in capacities if c >= used) for _, used in bins], [used for _, used in bins]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_is_the_rule(lengths):
    capacities = (8, 16, 32, 64)
    bins, offsets, capacity, fill = P.best_fit(np.array(lengths, np.int64), capacities)
    place, caps, used = brute(lengths, capacities)
    assert [(int(b), int(o)) for b, o in zip(bins, offsets, strict=True)] == [place[i] for i in range(len(lengths))]
    assert capacity.tolist() == caps and fill.tolist() == used


def check(rows, docs, capacities):
    """Every word of every document once, bins without overlap and as short as permitted."""
    n_words = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for _, t in docs)
    bins = {}
    for r in rows:
        assert r.first_word == r.piece * capacities[-1]
        bins.setdefault(r.bin_id, []).append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        used = sum(r.length for r in rs)
        assert {(r.capacity, r.bin_used) for r in rs} == {(min(c for c in capacities if c >= used), used)}
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.piece == 0) == sorted((i is None, i) for i, _ in docs)
    assert sum(r.length for r in rows) == sum(n_words)


def test_table(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(P.pack(odd_docs, shard=7).collect(), docs, P.CAPACITIES)
    check(P.pack(odd_docs, capacities=(100, 50)).collect(), docs, (50, 100))
    assert P.pack(no_docs).collect() == []
    with pytest.raises(ValueError):
        P.pack(no_docs, capacities=())


def test_little_is_wasted(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, prose(rng, rng.randrange(1, 3000))) for i in range(300)], "doc_id long, text string")
    rows = P.pack(docs, shard=100).collect()
    caps = {r.bin_id: r.capacity for r in rows}
    assert sum(r.length for r in rows) > 0.95 * sum(caps.values())


def test_texts_are_counted_without_python(spark, monkeypatch):
    """The pass over the texts copies none of them to Python: only ids and lengths leave it."""
    plans = []
    monkeypatch.setattr(P, "cut_lineage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    spaces = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
    texts = [None, "", " ", "w", "$1 \\ w", "\x1f\x0e\x00 \x85 \u00a0 \u2003x", "\u00e4\u20ac\U0001f600 " * 3, "".join(spaces),
             *(f"{a}one{a}{b}two" for a in spaces for b in spaces), "x" * 100_000, "ab \n" * 30_000, " " * 200_000, "w" + "\n" * 200_000]
    docs = list(enumerate(texts))
    rows = P.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs, P.CAPACITIES)
    told = {i: sum(r.length for r in rows if r.doc_id == i) for i, _ in docs}
    assert told == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for i, t in docs}
    assert len(plans) == 1 and "Arrow" not in plans[0] and "Python" not in plans[0]
