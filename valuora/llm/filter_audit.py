"""Filter interaction audit by count-weighted decision diagrams.

Which documents a chain of filters removes, and which filter gets the blame,
depends on the order of the chain. A pass over the texts turns every document
into a mask of the filters that it fails; documents are then only counted per
part and mask. Of a part's counts a decision diagram is built: a level for each
filter, an arc for passing and one for failing, equal subgraphs shared, empty
ones left out, and every node weighted by the documents below it. Exchanging
two adjacent levels changes the nodes of these two only, and a sequence of such
swaps runs through every order of the filters. In each order the path on which
all filters pass is the chain: what hangs on the failing arc of a step's node is
removed there, what hangs on the passing arc is kept.

Spark reads the texts once, in slices. Duplicates are found by the SHA-256 of the
texts: the first id of each text is a partial aggregate, and rows meet it on
(id, digest), so neither a text nor a part that holds a third of the table is a
hot key. A diagram has 2^filters paths at most, whatever the part's size.

Defined results: a null text is empty, a null part the empty string; an empty
text fails the length filter only (and the copy filter behind a smaller id). A
row without an id has no smaller id and no labels: it never fails as a copy. Rows
that repeat an id count one by one; a document is good or toxic if any of its
labels says so. Long texts are read in slices, so memory follows their distinct
words. A part is listed for every order and step, zeros included; an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .shared import cut_lineage

LETTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
SPACE = re.compile(rb"[\x20\x09-\x0D]")
PIECE = 1 << 20  # bytes of a text whose words are split at once

ZERO = 0  # the empty subgraph

Weight = tuple[int, ...]


def swaps(n: int) -> Iterator[int]:
    """Positions of the adjacent exchanges that lead through all orders of ``n`` things."""
    order, step = list(range(n)), [-1] * n
    while True:
        able = [x for x in order
                if 0 <= (to := order.index(x) + step[x]) < n and order[to] < x]
        if not able:
            return
        x = max(able)
        i = order.index(x)
        j = i + step[x]
        order[i], order[j] = order[j], order[i]
        for y in range(x + 1, n):
            step[y] = -step[y]
        yield min(i, j)


class Diagram:
    """Documents by the filters that they fail, one level for each filter."""

    def __init__(self, letters: str, counts: dict[int, Weight]):
        """``counts``: the weight of each mask; bit i of a mask is set if letter i fails."""
        self.order = list(letters)
        size = len(next(iter(counts.values()), (0,)))
        self.passed, self.failed = [ZERO], [ZERO]
        self.weight: list[Weight] = [(0,) * size]
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in letters]
        leaves: dict[Weight, int] = {}

        def build(level: int, mask: int) -> int:
            if level < len(letters):
                return self.node(self.levels[level], build(level + 1, mask), build(level + 1, mask | 1 << level))
            w = counts.get(mask)
            if w is None or not any(w):
                return ZERO
            if w not in leaves:
                leaves[w] = self.add(ZERO, ZERO, w)
            return leaves[w]

        self.root = build(0, 0)

    def add(self, passed: int, failed: int, weight: Weight) -> int:
        self.passed.append(passed)
        self.failed.append(failed)
        self.weight.append(weight)
        return len(self.weight) - 1

    def node(self, level: dict[tuple[int, int], int], passed: int, failed: int) -> int:
        """The level's node with these arcs; nothing hangs on an empty one."""
        if passed == ZERO and failed == ZERO:
            return ZERO
        at = level.get((passed, failed))
        if at is None:
            at = level[passed, failed] = self.add(
                passed, failed, tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed], strict=True)))
        return at

    def swap(self, i: int) -> None:
        """Exchange levels i and i + 1. A node above keeps its documents, so what points at it stays."""
        upper, lower = {}, {}
        for u in self.levels[i].values():
            p, f = self.passed[u], self.failed[u]
            self.passed[u] = self.node(lower, self.passed[p], self.passed[f])
            self.failed[u] = self.node(lower, self.failed[p], self.failed[f])
            upper[self.passed[u], self.failed[u]] = u
        self.levels[i], self.levels[i + 1] = upper, lower
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """(letter, weight kept, weight removed) along the path on which all pass."""
        at = self.root
        for letter in self.order:
            yield letter, self.weight[self.passed[at]], self.weight[self.failed[at]]
            at = self.passed[at]


def orders(letters: str, counts: dict[int, Weight]) -> dict[str, list[tuple[str, Weight, Weight]]]:
    """The steps of every order of the filters."""
    d = Diagram(letters, counts)
    out = {"".join(d.order): list(d.steps())}
    for i in swaps(len(letters)):
        d.swap(i)
        out["".join(d.order)] = list(d.steps())
    return out


def audited(letters: str, counts: dict[int, Weight]) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique fails, good lost, toxic lost, Shapley sum) of a part.

    Weights are (documents, good ones, toxic ones). What a filter removes as
    the first step are all its failures; as the last one, those that fail
    nothing else.
    """
    chains = orders(letters, counts)
    fails, alone, shapley = {}, {}, dict.fromkeys(letters, 0)
    for chain in chains.values():
        fails[chain[0][0]], alone[chain[-1][0]] = chain[0][2][0], chain[-1][2][0]
        for letter, _, removed in chain:
            shapley[letter] += removed[0]
    return [(order, step, kept[0], removed[0], fails[x] - removed[0], alone[x], removed[1], removed[2], shapley[x])
            for order, chain in sorted(chains.items()) for step, (x, kept, removed) in enumerate(chain, 1)]


AUDIT = {"filter_order": "string", "step": "int", "kept": "long", "removed": "long", "redundant": "long",
         "unique_fails": "long", "good_lost": "long", "toxic_lost": "long", "shapley": "long"}
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def interactions(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Steps of all orders for ``masks(part, mask, n, good, toxic)``, a row per part and mask."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                rows = audited(letters, {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in r["masks"]})
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), map(ARROW.get, AUDIT.values()), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r["part"]] * len(rows), pa.string()), *cols], names=["part", *AUDIT])

    # 2^filters structs of a part at most
    return (masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
            .mapInArrow(run, "part string, " + ", ".join(f"{c} {t}" for c, t in AUDIT.items())))


def words_of(data: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text, a piece at a time; a piece ends where a word does."""
    total, seen, at = 0, set(), 0
    while at < len(data):
        space = SPACE.search(data, at + PIECE)  # the word at the cut goes on until here
        to = space.start() if space else len(data)
        found = data[at:to].split()  # of bytes: at the six ASCII spaces
        total += len(found)
        seen.update(found)
        at = to
    return total, len(seen)


def text_mask(data: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = words_of(data)
    points = len(data) if data.isascii() else len(data.decode())
    upper = len(data) - len(data.translate(None, UPPER))
    return ((words < MIN_WORDS) | (100 * distinct < DISTINCT_PERCENT * words) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | (len(data.translate(None, SIGNS)) < len(data)) << 3)


def _measured(batches):
    for whole in batches:
        for b in T.slices(whole, "text"):
            texts = [t.encode() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array([text_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "mask", "digest"])


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """Rows ``(part, mask, n, good, toxic)``: how many documents of a part fail which filters."""
    seen = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                                   F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
                       .mapInArrow(_measured, "doc_id long, part string, mask int, digest binary")
                       .groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")), "masks")
    named, nameless = seen.where("doc_id is not null"), seen.where("doc_id is null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    told = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"),
                          (F.col("toxic") == 1).alias("toxic"))
            .where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    copy = F.when(F.col("first").isNull(), 1 << LETTERS.index("E")).otherwise(0)
    flag = lambda c: F.when(F.col(c), F.col("n")).otherwise(0)
    rows = (named.join(first, ["doc_id", "digest"], "left").join(told, "doc_id", "left")
            .select("part", (F.col("mask") + copy).alias("mask"), "n", flag("good").alias("good"), flag("toxic").alias("toxic"))
            .unionByName(nameless.select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))))
    return rows.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame, **cols: str) -> DataFrame:
    """Steps of all orders of the five filters, for every part of ``docs``."""
    return interactions(failure_masks(docs, labels, **cols))
