"""Bootstrapped contexts of the personal-data scan against the rule as its docstring states it."""
import random
import re

from pyspark.sql import functions as F

from valuora.llm import pii, spans


def stated_bootstrap(edges):
    """All patterns in every round: the mean of the instances if SUPPORT of them are seeds or score 0.5."""
    members, behind = {}, {}
    for p, i, _ in edges:
        members.setdefault(p, set()).add(i)
        behind.setdefault(i, set()).add(p)
    seeds = {i for _, i, s in edges if s}
    score = {i: float(i in seeds) for i in behind}
    for _ in range(pii.ROUNDS):
        trust = {p: sum(score[i] for i in own) / len(own) if sum(score[i] >= .5 for i in own) >= pii.SUPPORT else 0.0
                 for p, own in members.items()}
        for i, own in behind.items():
            left = 1.0
            for p in own:
                left *= max(1 - trust[p], 1e-12)
            score[i] = 1.0 if i in seeds else 1 - left
    return {(p, i) for p, i, _ in edges
            if i not in seeds and score[i] >= pii.CONFIDENT and trust[p] >= pii.CONFIDENT}


def bootstrapped(spark, rows):
    return {tuple(r) for r in pii.bootstrap(spark.createDataFrame(
        rows, "pattern string, instance string, seed boolean")).collect()}


def test_patterns_join_through_found_instances(spark):
    """A pattern without seeds scores once its instances do, and reports those no other pattern has."""
    rows = [(p, f"{p[0]}{i}@mail.example", True) for p in ("reach me", "mail to") for i in range(40)]
    rows += [(p, f"id{i}", False) for p in ("reach me", "mail to", "badge no") for i in range(4)]
    rows += [("badge no", "new9", False), ("two only", "id0", False), ("two only", "id1", False)]
    got = bootstrapped(spark, rows)
    assert {("badge no", i) for i in ("new9", "id0", "id1", "id2", "id3")} <= got
    assert got == stated_bootstrap(rows)


def test_sparse_graph_matches_the_stated_rule(spark):
    """Few seeds, many patterns that hold none, one or two of them."""
    rng = random.Random(11)
    edges = {}
    for g in range(30):
        items = [f"g{g}i{i}" for i in range(rng.randrange(3, 9))]
        edges |= {(f"g{g}p0", f"g{g}s{k}"): True for k in range(30)}
        for p in range(4):
            edges |= {(f"g{g}p{p}", i): False for i in items if rng.random() < .9}
            edges |= {(f"g{g}p{p}", f"g{g}s{k}"): True for k in range(rng.randrange(3))}
            edges |= {(f"g{g}p{p}", f"odd{rng.randrange(50)}"): False for _ in range(rng.randrange(2))}
    rows = [(p, i, s) for (p, i), s in edges.items()]
    want = stated_bootstrap(rows)
    assert any(not p.endswith("p0") for p, _ in want)
    assert bootstrapped(spark, rows) == want


def words_before(text, start):
    """The two words before a position, plain quotes and brackets after them aside."""
    m = re.search(r"(?<!\S)(\S+\s+\S+)[\s\"'(]*\Z", text[:start], re.ASCII)
    return re.sub(r"\s+", " ", m[1].lower()) if m else ""


def test_words_before_come_from_the_whole_text(spark):
    """The context of a match holds earlier matches too, and words of any length."""
    rng = random.Random(12)
    parts = ["exp", "12/27", "cvv", "123", "ssn", "(", '"', "'x", "a1(", "b\"", "w" * 90, "9" * 100, "1a" * 30, "é2", "\n", "to:"]
    texts = ["exp 12/27 cvv 123 ssn 123-45-6789", "w" * 200 + " b \" ( 7", "x " + "y" * 300 + " 7 8", "1 2 3"]
    texts += ["".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "\n"]) for _ in range(rng.randrange(25))) for _ in range(150)]
    texts += [t.replace("cvv", "c@d.ef").replace("ssn", "c@d.ef,g@h.ij") for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        "doc_id", *[spans.matches(F.col("text"), p, context=True).alias(n) for n, p in (("word", pii.WORD), ("email", pii.EMAIL))])
    found = [(r.doc_id, x) for r in df.collect() for x in (*r.word, *r.email)]
    assert len(found) > 1000
    for i, x in found:
        assert x.v == texts[i][x.s:x.e]
        assert x.ctx == words_before(texts[i], x.s), (texts[i], x)


def test_neighbouring_identifiers_are_found(spark):
    """Ids in a record right after another word with a digit, behind words that introduce seeds."""
    rows = [(i, f"exp 12/27 cvv reach me u{i}@mail.example") for i in range(40)]
    rows += [(100, "exp 12/27 reach me id-77x"), (101, "no 5 reach me ID-77X reach me id-78x")]
    got = {r.doc_id: [rows[-2:][r.doc_id - 100][1][x.s:x.e] for x in r.spans] for r in pii.find(
        spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id >= 100").collect()}
    assert got == {100: ["id-77x"], 101: ["ID-77X", "id-78x"]}
