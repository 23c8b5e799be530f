"""Scores on held-out rows, the pair identity, and odd rows."""
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from valuora.llm import quality, toxicity
from valuora.llm.shared import examples

SF = "/root/testdata/sf0.1"


def held(doc_id, of, rest):
    return zlib.crc32(str(doc_id).encode()) % of == rest


def test_quality_of_held_out_rows(spark):
    from valuora.llm.queries import op6_quality
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op6_quality(spark, SF).collect()
    assert len(rows) == 10000 and all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    own = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(own) > 500 and sum(p == y for p, y in own) >= 0.98 * len(own)


def test_toxicity_of_held_out_rows(spark):
    from valuora.llm.queries import op5_toxicity
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == 10000 and all(r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    own = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    # 300 toxic texts to learn from, in four languages
    assert sum(p for p, y in own if y) >= 0.75 * sum(y for _, y in own)
    assert sum(p for p, y in own if not y) <= 0.04 * sum(1 - y for _, y in own)


def test_pairs_by_the_sum_of_squares():
    rng = np.random.default_rng(3)
    words = 1 << quality.WORD_BITS
    m = quality.Machine(0.3, rng.normal(size=words + 4), rng.normal(size=(words + 4, 3)), np.zeros(4), np.ones(4))
    word, heads = np.array([5, 9, 700, 5]), np.array([0, 3, 3, 4])
    stats = rng.normal(size=(3, 4))
    got = m.score(word, heads, stats)
    for t in range(3):
        x = np.zeros(words + 4)
        own = word[heads[t]:heads[t + 1]]
        x[own] = 1 / np.sqrt(max(1, len(own)))
        x[words:] = np.clip(stats[t], -4, 4) / 2
        on = np.flatnonzero(x)
        z = 0.3 + m.weight @ x + sum(m.pairs[i] @ m.pairs[j] * x[i] * x[j] for i in on for j in on if i < j)
        assert abs(got[t] - 1 / (1 + np.exp(-z))) < 1e-9


def test_ngrams_are_the_brute_force_sets():
    rng = random.Random(1)
    texts = [None, "", "ab", "abc", "ABC abc", "é😀é😀é"] + [prose(rng, 30) for _ in range(5)]
    names = {}
    text, gram = toxicity._distinct(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        want = {low[a:a + n] for n in toxicity.ORDERS for a in range(len(low) - n + 1)}
        got = set(gram[text == i].tolist())
        assert len(want) - 4 <= len(got) <= len(want)  # hashes may collide
        names.setdefault(low, got)
        assert names[low] == got


def labelled(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        rows.append((i, (prose(rng, 40) + (" grubflop" if bad else "")) if i % 2 or not bad else prose(rng, 20) + " GRUBFLOP " + prose(rng, 9)))
        labels.append((i, int(not bad), int(bad)))
    labels += [(None, 1, 1), (3, None, None), (999, 1, 0), (5, 1, 0), (5, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_odd_rows(spark, odd_docs, no_docs):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    machine = quality.train(docs.withColumn("len", F.lit(None).cast("long")), labels, metadata=("len",))
    odd = odd_docs.withColumn("len", F.lit(float("nan")))
    for out in (toxicity.score(odd, model), quality.score(odd, machine, metadata=("len",))):
        got = out.collect()
        assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(r.doc_id) for r in odd_docs.collect())
        assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_docs, model).collect() == []
    kept = quality.keep_good(odd, machine, metadata=("len",), threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert quality.keep_good(odd, machine, metadata=("len",), threshold=1.1).count() == 0
    score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(score[i] for i in range(0, 120, 3)) > max(score[i] for i in range(120) if i % 3)


def test_fits_without_one_class(spark, no_docs):
    docs, labels = labelled(spark)
    none = labels.limit(0)
    for lab in (none, labels.where("toxic = 0")):
        out = toxicity.score(docs, toxicity.train(docs, lab)).collect()
        assert len({r.score for r in out}) == 1
        out = quality.score(docs, quality.train(docs, lab)).collect()
        assert len(out) == 120 and all(np.isfinite(r.score) for r in out)
    assert quality.train(no_docs, labels).bias == 0.0


def test_sample_is_bounded_and_fixed(spark):
    docs, labels = labelled(spark)
    rows = examples(docs, labels, "toxic", F.col("doc_id") % 5 != 0, 10).collect()
    again = examples(docs.repartition(7), labels.repartition(3), "toxic", F.col("doc_id") % 5 != 0, 10).collect()
    assert sorted((r.doc_id, r.y) for r in rows) == sorted((r.doc_id, r.y) for r in again)
    assert [sum(r.y == y for r in rows) for y in (0, 1)] == [10, 10] and all(r.doc_id % 5 for r in rows)


def test_every_telling_ngram_is_kept_with_its_ratio(spark):
    """Counts, gain and ratio of all n-grams against plain sets; no cap on their number."""
    import math
    rng = random.Random(6)
    texts = [(prose(rng, 25) + (" vile scum rotten filth" if i % 4 == 0 else " kind words to all"), int(i % 4 == 0)) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    sets = [set(toxicity._distinct(pa.array([t]))[1].tolist()) for t, _ in texts]
    t1 = sum(y for _, y in texts)
    t0 = len(texts) - t1

    def fit(n, t):
        return sum(c * math.log(c / t) for c in (n, t - n) if c)
    kept = 0
    for gram in set().union(*sets):
        n0, n1 = (sum(gram in s for s, (_, y) in zip(sets, texts, strict=True) if y == c) for c in (0, 1))
        gain = fit(n0, t0) + fit(n1, t1) - fit(n0 + n1, t0 + t1)
        if abs(gain - toxicity.GAIN) > 1e-3:
            assert (model.slot[gram] >= 0) == (gain > toxicity.GAIN)
        if model.slot[gram] >= 0:
            kept += 1
            assert abs(model.ratio[model.slot[gram]] - math.log((n1 + 1) / (t1 + 2) / ((n0 + 1) / (t0 + 2)))) < 1e-12
    assert kept == (model.slot >= 0).sum() == len(model.ratio) > 20
