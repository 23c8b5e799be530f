import random

import numpy as np

from tests.llm.conftest import prose
from valuora.llm import decontam as D


def edit(rng, text, k):
    t = list(text)
    for _ in range(k):
        at = rng.randrange(len(t))
        t[at] = rng.choice(["", "q", t[at] + "z"])
    return "".join(t)


def least_edits(item, doc):
    """Edit distance of the item to the nearest part of the document: the whole table, cell by cell along rows."""
    at = np.arange(len(doc) + 1)
    row = np.zeros(len(doc) + 1, np.int64)
    for i, ch in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (doc != ch), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def brute(doc, item, errors=D.ERRORS):
    """Least edits of the item anywhere in the document, both in normal form."""
    f = lambda t: np.frombuffer(" ".join(t.lower().split()).encode(), np.uint8)
    item, doc = f(item), f(doc)
    return least_edits(item, doc), min(int(errors * len(item)), (len(item) - D.Q) // D.Q)


def test_finds_what_the_budget_allows(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(12, 40))) for i in range(12)]
    docs = []
    for d in range(150):
        i, item = items[rng.randrange(12)]
        k = rng.randrange(0, 40)
        docs.append((d, f"{prose(rng, 50)} {edit(rng, item.upper() if d % 5 == 0 else item, k)}\n\n{prose(rng, 30)}"))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in D.find(df, bench).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            edits, budget = brute(text, item)
            if edits <= budget:
                want[d, i] = edits
    assert got == want
    assert 30 < len(want) < 150
    assert {r.doc_id for r in D.clean(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, None), (2, ""), (3, "ä€😀 ä€😀 ä€😀"), (None, "one two three four five"), (3, "two"), (4, "x" * 90)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in D.find(odd_docs, bench).collect()), key=repr)
    assert (8, None, 0) in got and (10, 3, 0) in got and (6, 3, 0) in got and (12, 4, 0) in got
    assert {g[0] for g in got} == {6, 7, 8, 10, 12}
    kept = D.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 5
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find(odd_docs, none).count() == 0 and D.find(no_docs, bench).count() == 0
    assert D.clean(odd_docs, none).count() == odd_docs.count()


def test_spans_are_code_points_of_the_text(spark):
    item = "Élan  vital, ça se répète à l'envi — nous le savons bien depuis longtemps"
    text = "😀 début. " + item.upper() + "\nfin"
    (r,) = D.find(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                  spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert text[r.start:r.end] == item.upper() and r.edits == 0


def test_benchmark_in_pieces(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, prose(rng, 30)) for i in range(20)]
    docs = spark.createDataFrame([(i, f"{prose(rng, 9)} {t}") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "INDEX_BYTES", 900)
    assert sorted((r.doc_id, r.item_id) for r in D.find(docs, bench).collect()) == [(i, i) for i in range(20)]
    assert D.clean(docs, bench).count() == 0


def test_band_holds_what_the_whole_table_holds():
    """Alignment in a band finds the same edits as the whole table wherever the occurrence lies in the band."""
    rng = random.Random(6)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(8, 60)))
        k = rng.randrange(0, 7)
        pre, post = rng.randrange(0, 30), rng.randrange(0, 30)
        text = "x" * pre + edit(rng, item, k) + "y" * post
        a, b = (np.frombuffer(t.encode(), np.uint8) for t in (item, text))
        want = least_edits(a, b)
        (whole, *_), _ = D._best_ends([a], [b], np.array([-len(a)]), len(a) + len(b) + 1, True)
        assert whole == want
        (start, stop, edits), (_, again, _), none = D.align([(a, b, len(a), pre - 2 * k, pre + 2 * k), (a, b, len(a), -len(a), len(b)),
                                                            (a, b[:0], 0, 0, 0)])
        assert edits == want and least_edits(a, b[start:stop]) == want and none is None and least_edits(a, b[:again]) == want


def test_long_items_are_found_whole_and_in_part(spark):
    import time
    rng = random.Random(12)
    item = prose(rng, 40_000)  # about 200 KB
    words = item.split()
    quoted = " ".join(words[9000:9800])  # a part of it, half edited
    docs = [(1, f"{prose(rng, 500)} {item} {prose(rng, 500)}"), (2, f"{prose(rng, 80)} {quoted} {prose(rng, 80)}"),
            (3, edit(rng, item, 2000)), (4, prose(rng, 3000)), (5, " ".join(words[:40]))]
    began = time.time()
    got = D.find(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                 spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert time.time() - began < 60
    whole = {r.doc_id: r for r in got}
    assert set(whole) == {1, 2, 3} and len(got) == 3
    text = docs[0][1]
    assert text[whole[1].start:whole[1].end] == item and whole[1].edits == 0
    assert whole[2].end - whole[2].start > 0.5 * len(quoted) and whole[3].edits > 0


def test_written_after_some_pieces(spark, monkeypatch):
    """More pieces than a plan holds: the same occurrences, and plans of a few indexes each."""
    rng = random.Random(10)
    items = [(i, prose(rng, 30)) for i in range(30)]
    docs = spark.createDataFrame([(i, f"{prose(rng, 9)} {t}") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "INDEX_BYTES", 900)
    monkeypatch.setattr(D, "GROUP", 3)
    found = D.find(docs, bench)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(30)]
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 3
    kept = D.clean(docs, bench)
    assert kept.count() == 0 and kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 3
