import numpy as np

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_decontam import least_edits
from tests.llm.test_jaccard import brute as components
from tests.llm.test_packing import check as check_packing
from valuora.llm import decontam, packing, secret_scan

SF = "/root/testdata/sf0.001"


def normal(t):
    return " ".join((t or "").lower().split())


def masked(text, spans):
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "<SECRET>"
        at = max(at, b)
    return out + text[at:]


def test_one_row_of_each_group_stays(spark):
    """Repeated ids, null ids and ids with two texts: rows are decided one by one."""
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(5, one, 1), (5, one, 2), (3, one + " tail", 3), (7, two, 4), (7, three, 5), (None, three, 6), (None, "own words", 7),
            (None, None, 8), (9, None, 9), (9, "", 10), (2, two, 11)]
    docs = spark.createDataFrame([(i, t, n, 0) for i, t, n in rows], "doc_id long, text string, row long, part int").repartition(4)
    out = P.one_of_each_group(spark, docs, SF)
    assert out.columns == docs.columns
    # ids 3, 5, 5 are one group, 2 and 7 another, 7's other text and a null id a third
    assert sorted(r.row for r in out.collect()) == [3, 5, 7, 8, 9, 10, 11]
    assert P.one_of_each_group(spark, docs.limit(0), SF).collect() == []


def test_every_stage_against_brute_force(spark):
    """Each stage on its own input: kept rows whole, decisions as a plain computation makes them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = [np.frombuffer(t.encode(), np.uint8) for t in items]
    parts = whole + [w for t in whole if len(t) > decontam.WINDOW for w in decontam.windows(t)]
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        found = {r.doc_id: [(x.s, x.e) for x in r.spans] for r in secret_scan.scan(docs).collect()} if name == "secret_scan" else {}
        docs = P.cut_lineage(stage(spark, docs, SF), name)
        rows = docs.collect()
        if k < len(P.STAGES) - 1:
            assert docs.columns == columns
            after = {r.doc_id: r for r in rows}
            assert len(after) == len(rows)
        if name == "quality_classifier":
            assert all(before[i] == r for i, r in after.items())
            told = [(i in after) == bool(labels[i]) for i in before if i in labels]
            assert sum(told) >= 0.95 * len(told)
        elif name == "ngram_jaccard_join":
            comp = components([(i, r.text) for i, r in before.items()])
            assert after == {i: r for i, r in before.items() if comp[i] == i}
        elif name == "benchmark_decontamination":
            assert all(before[i] == r for i, r in after.items())
            gone = {i for i in before if i not in after}
            assert gone >= {i for i, r in before.items() if any(t in normal(r.text) for t in items)}
            for i in gone:
                text = np.frombuffer(normal(before[i].text).encode(), np.uint8)
                assert any(least_edits(part, text) <= decontam.ERRORS * len(part) for part in parts)
        elif name == "secret_scan":
            assert set(after) == set(before)
            for i, r in after.items():
                assert r.n_chars == len(r.text)
                assert r.text == masked(before[i].text, found[i])
        else:
            check_packing(rows, [(i, r.text) for i, r in before.items()], packing.CAPACITIES)


def test_registered():
    names = queries()
    assert "pipeline" in names and [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in names)] == list(range(1, 11))
    assert set(oracle_sql()) <= set(names)
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
