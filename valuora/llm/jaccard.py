"""N-gram Jaccard self-join over a forest of count-vector R-trees.

A document is the set of its distinct word shingles. Two documents link when
``100 * intersection >= percent * union``.

* *Points.* Shingle hashes fall into ``GROUPS`` groups; the number of a
  document's shingles in each group is a point. The overlap of two sets is at
  most the sum of the coordinates' minima, and of a point and a box the sum of
  the minima with the box's upper corner. A link needs an overlap of
  ``percent / (100 + percent)`` of both sizes together. Long documents have
  finer groups, a power of two of them, which fold into ``GROUPS`` for the tree.
* *Cells.* One R-tree over everything would compare each query with every
  document of its size, as hashed counts of unrelated texts look alike. So the
  documents are first cut into cells, losslessly: in any common order of the
  shingles, two linked sets share one of their first
  ``n - ceil(n * percent / 100) + 1`` shingles. The order puts shingles of
  rare hash groups (counted over all documents) first, so passages that many
  documents share come last. All documents that share such a shingle meet in
  the cell of the smallest id among them.
* *Join.* Each cell's members are tested against its first document; those
  that link need no further test with each other, as they are one component
  already. Members outside their cell's largest component query R-trees over
  the cell, cut into blocks of bounded size; node boxes and points prune by the
  bound. A query gets its best ``ASKED`` candidates, what they confirm is
  joined, and the cells that have more to tell are asked again: a group of near
  copies grows together after a few links a member, not one for every pair. A
  cell of many blocks is first dealt anew into small blocks, each asked by its
  own members only, as long as that halves the members outside.
* *Verification.* Surviving pairs are decided on the exact shingle sets of the
  whole texts.

Equal sets are one class before the join, so copies are never expanded.

Defined results: a null or empty text has size 0 and links with nothing; a
null id is returned with its size and a null component; rows that repeat an id
are one document for the links and each gives a row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .shared import components, cut_lineage, small_batches, spread_join, texts_of

GROUPS = 256         # coordinates of a point in a tree
SPREAD = 8           # shingles per coordinate, at most, of a long document's own point
ORDER_BITS = 18      # hash groups whose corpus counts order the shingles
LEAF = 16            # points in an R-tree leaf
FANOUT = 8           # children of an inner node
QUERY_BLOCK = 256    # queries, and
DATA_BLOCK = 1024    # members of a cell, that one task's tree joins
ASKED = 8            # candidates of a query in a block, in a cell's first round, and
ASKED_MORE = 16      # how many times as many in each later one
FULL = np.iinfo(np.uint8).max


# --- points and the R-tree --------------------------------------------------------

def points(sh: np.ndarray, heads: np.ndarray) -> list[np.ndarray]:
    """Shingles of each text per hash group; a coordinate stops at ``FULL``."""
    size = np.diff(heads)
    text = np.repeat(np.arange(len(size)), size)
    small = size <= GROUPS * SPREAD
    on = small[text]
    c = np.bincount(text[on] * GROUPS + (sh[on] & T.U64(GROUPS - 1)).astype(np.int64), minlength=len(size) * GROUPS)
    out = list(np.minimum(c, FULL).astype(np.uint8).reshape(len(size), GROUPS))
    for i in np.flatnonzero(~small).tolist():
        groups = 1 << int(size[i] // SPREAD).bit_length()
        own = (sh[heads[i]:heads[i + 1]] & T.U64(groups - 1)).astype(np.int64)
        out[i] = np.minimum(np.bincount(own, minlength=groups), FULL).astype(np.uint8)
    return out


def folded(p: np.ndarray, groups: int) -> np.ndarray:
    """A finer point in coarser groups."""
    if len(p) == groups:
        return p
    c = np.where((p == FULL).any(), FULL, p.reshape(-1, groups).sum(axis=0, dtype=np.int64))
    return np.minimum(c, FULL).astype(np.uint8)


def overlap_bound(q: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Sum of coordinate minima; unbounded where both coordinates are full."""
    low = np.minimum(q, upper)
    total = low.sum(axis=-1, dtype=np.int64)
    return np.where((low == FULL).any(axis=-1), np.iinfo(np.int64).max // 400, total)


def may_link(bound, n_a, n_b, percent: int) -> np.ndarray:
    """Whether sets of these sizes with at most this overlap can link."""
    bound = np.minimum(bound, np.minimum(n_a, n_b))
    return 100 * bound >= percent * (n_a + n_b - bound)


class RTree:
    """Packed R-tree over points; nodes keep an upper corner and the sizes' range.

    Points are packed along a sort by size and the coarsest halves of their
    coordinates, ``LEAF`` to a leaf and ``FANOUT`` nodes to a parent.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        halves = points.reshape(len(points), 4, -1).sum(axis=2, dtype=np.int64)
        self.order = np.lexsort((halves[:, 3], halves[:, 2], halves[:, 1], halves[:, 0], sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [self._pack(self.points, self.sizes, self.sizes, LEAF)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._pack(*self.levels[-1], FANOUT))

    @staticmethod
    def _pack(upper, low, high, width):
        at = np.arange(0, len(low), width)
        return np.maximum.reduceat(upper, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)

    def query(self, p: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Indexes of all points that may link with the point ``p`` of size ``n``."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = (x[nodes] for x in self.levels[depth])
            # sizes alone: the smaller set holds percent of the larger at least
            ok = (100 * high >= percent * n) & (100 * n >= percent * low)
            best = np.clip(n, low, high)  # the size in the node that suits the query best
            bound = overlap_bound(p, upper)
            ok &= may_link(bound, np.int64(n), np.minimum(best, np.maximum(low, bound)), percent)
            nodes = nodes[ok]
            width = FANOUT if depth else LEAF
            size = len(self.levels[depth - 1][0]) if depth else len(self.sizes)
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
            nodes = nodes[nodes < size]
        keep = may_link(overlap_bound(p, self.points[nodes]), np.int64(n), self.sizes[nodes], percent)
        return self.order[nodes[keep]]


# --- passes over the texts ----------------------------------------------------------

def _names(sh: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that name it; equal sets have equal names."""
    return T.sums(sh, heads), T.sums(T.mix(sh ^ T.U64(0xA5A5A5A55A5A5A5A)), heads)


def _sets(width: int):
    """Per document: size, the two sums that name its set, its point; and group counts."""
    def run(batches):
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for whole in batches:
            for b in T.slices(whole, "text"):
                sh, heads = T.text_shingles(b.column("text"), width)
                f1, f2 = _names(sh, heads)
                pts = points(sh, heads)
                counts += np.bincount((sh >> T.U64(64 - ORDER_BITS)).astype(np.int64), minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(np.diff(heads)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     pa.array([p.tobytes() for p in pts], pa.binary()), pa.nulls(len(pts), pa.int32())],
                    names=["id", "n", "f1", "f2", "point", "grp"])
        at = np.flatnonzero(counts)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, pa.array(counts[at]), none, none, pa.nulls(len(at), pa.binary()), pa.array(at, pa.int32())],
            names=["id", "n", "f1", "f2", "point", "grp"])
    return run


def _first_shingles(rank: np.ndarray, percent: int, width: int):
    """Rows (shingle, id): the first shingles of each set in the common order.

    Equal sets are one class: one document of a piece speaks for all of its class.
    """
    low = T.U64((1 << (64 - ORDER_BITS)) - 1)
    shift = T.U64(64 - ORDER_BITS)

    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                sh, heads = T.text_shingles(b.column("text"), width)
                name = np.stack([*_names(sh, heads), np.diff(heads).astype(T.U64)], axis=1)
                own = np.sort(np.unique(name, axis=0, return_index=True)[1])
                key = (rank[(sh >> shift).astype(np.int64)] << shift) | (sh & low)
                take = np.zeros(len(key), bool)
                for i in own.tolist():
                    a, z = heads[i], heads[i + 1]
                    key[a:z].sort()
                    n = z - a
                    take[a:a + (n - -(-n * percent // 100) + 1 if n else 0)] = True
                ids = np.repeat(b.column("id").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(heads))
                yield pa.RecordBatch.from_arrays([pa.array(key[take].view(np.int64)), pa.array(ids[take])],
                                                 names=["tok", "id"])
    return run


def _verify(percent: int, width: int):
    """Keeps the pairs whose exact sets link; the first side's set is kept while it repeats."""
    def run(batches):
        last, kept = None, None
        for whole in batches:
            for b in T.slices(whole, "text_b"):
                names = b.column("a").to_pylist()
                texts = b.column("text_a")
                hit = np.zeros(b.num_rows, bool)
                sh, heads = T.text_shingles(b.column("text_b"), width)
                for i, name in enumerate(names):
                    text = texts[i]
                    if kept is None or name != last or text != kept[0]:
                        last, kept = name, (text, T.text_shingles(texts.slice(i, 1), width)[0])
                    one, two = kept[1], sh[heads[i]:heads[i + 1]]
                    inter = len(np.intersect1d(one, two, assume_unique=True))
                    hit[i] = inter > 0 and 100 * inter >= percent * (len(one) + len(two) - inter)
                if hit.any():
                    yield b.select(["a", "b"]).filter(pa.array(hit))
    return run


def pairs_may_link(a: list[np.ndarray], b: list[np.ndarray], n_a, n_b, percent: int) -> np.ndarray:
    """:func:`may_link` of pairs of points, each pair in the finest groups that both have."""
    groups = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64)
    ok = np.zeros(len(groups), bool)
    for g in np.unique(groups).tolist():
        at = np.flatnonzero(groups == g)
        for part in np.array_split(at, -(-len(at) * g // (1 << 24))):
            left, right = (np.stack([folded(side[i], g) for i in part.tolist()]) for side in (a, b))
            ok[part] = may_link(overlap_bound(left, right), n_a[part], n_b[part], percent)
    return ok


def _read_points(col) -> list[np.ndarray]:
    return [np.frombuffer(p, np.uint8) for p in col.to_pylist()]


def _bound_filter(percent: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                n_a, n_b = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
                yield b.filter(pa.array(pairs_may_link(
                    _read_points(b.column("point_a")), _read_points(b.column("point_b")), n_a, n_b, percent)))
    return run


def _tree_join(percent: int):
    """One block of a cell: its queries against an R-tree over its data points.

    A query gives its best candidates, as many as the cell's ``asked`` allows;
    ``cut`` tells that it had more.
    """
    def run(key, table):
        own = _read_points(table.column("point"))
        pts = np.stack([folded(p, GROUPS) for p in own])
        ids, n, comp, asks, open_, asked = (
            table.column(c).to_numpy() for c in ("id", "n", "comp", "asks", "open", "asked"))
        data = np.flatnonzero(~asks)
        a, b, cut = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        if len(data) and asks.any():
            tree = RTree(pts[data], n[data])
            for q in np.flatnonzero(asks):
                hit = data[tree.query(pts[q], n[q], percent)]
                # a pair of two queries is asked once; one component needs no test
                hit = hit[(comp[hit] != comp[q]) & (~open_[hit] | (ids[hit] > ids[q]))]
                if len(own[q]) > GROUPS and len(hit):
                    hit = hit[pairs_may_link([own[q]] * len(hit), [own[i] for i in hit], np.full(len(hit), n[q]), n[hit], percent)]
                more = len(hit) > asked[q]
                if more:
                    inter = np.minimum(overlap_bound(pts[q], pts[hit]), np.minimum(n[q], n[hit]))
                    hit = hit[np.lexsort((ids[hit], -inter / (n[q] + n[hit] - inter)))[:asked[q]]]
                a.append(np.full(len(hit), ids[q]))
                b.append(ids[hit])
                cut.append(np.full(len(hit), more))
        a, b, cut = (np.concatenate(x) for x in (a, b, cut))
        return pa.table({"cell": np.full(len(a), key[0].as_py(), np.int64), "a": a, "b": b, "cut": cut})
    return run


# --- the operator ---------------------------------------------------------------------

def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75, width: int = 5) -> DataFrame:
    """Rows ``(id, n_shingles, component_id)``, one per row of ``docs``.

    ``component_id`` is the smallest id reachable over links.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return _classes(text, percent, width)


def _classes(text: DataFrame, percent: int, width: int) -> DataFrame:
    made = cut_lineage(text.mapInArrow(
        _sets(width), "id long, n long, f1 long, f2 long, point binary, grp int"), "sets")
    sets = made.where(F.col("grp").isNull())

    # the order of the shingles: groups by their count over all documents
    got = made.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.sum("n").alias("n")).toPandas()  # 2^18 rows at most
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    counts[got["grp"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    rank = np.empty(len(counts), T.U64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=T.U64)

    # classes of equal sets, named by their smallest id
    known = sets.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = cut_lineage(known.groupBy("n", "f1", "f2").agg(F.min("id").alias("rid"), F.first("point").alias("point")),
                          "classes")
    names = spread_join(known.select("id", "n", "f1", "f2"), classes.select("n", "f1", "f2", "rid"), ["n", "f1", "f2"], "id")
    to_rid = cut_lineage(names.select("id", "rid").distinct(), "names")

    # cells: the documents that share a first shingle meet at the smallest of them
    firsts = text.where(F.col("id").isNotNull()).mapInArrow(_first_shingles(rank, percent, width), "tok long, id long")
    heads = (firsts.groupBy("tok").agg(F.min("id").alias("head"), F.max("id").alias("tail"))
             .where("head < tail").select("tok", "head"))
    met = (firsts.join(heads, "tok").where("id <> head").select("head", "id").distinct())
    cells = cut_lineage(
        met.join(to_rid.select("id", F.col("rid").alias("b")), "id")
        .join(to_rid.select(F.col("id").alias("head"), F.col("rid").alias("a")), "head")
        .where("a <> b").select("a", "b").distinct(), "cells")

    # each member against the first document of its first cell, then what that leaves apart
    spots = classes.select(F.col("rid").alias("id"), "n", "point")
    near = cells.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = cut_lineage(_confirmed(_bounded(near, spots, percent), text, percent, width), "links")
    comp = components(links)
    apart = _apart(cells.join(near, ["a", "b"], "left_anti"), comp)
    links = cut_lineage(_confirmed(_bounded(apart, spots, percent), text, percent, width), "links")

    # the members among each other, round by round, until no cell has more to tell
    told = todo = None
    while todo is None or not todo.isEmpty():
        comp = _joined(comp, links)
        pairs, todo = _left_over(cells, comp, spots, percent, todo)
        fresh = pairs if told is None else pairs.join(told, ["a", "b"], "left_anti")
        told = pairs if told is None else told.unionByName(pairs)
        links = cut_lineage(_confirmed(fresh, text, percent, width), "links")
    comp = _joined(comp, links)

    # an id with several texts is one node: tie its classes together
    many = to_rid.groupBy("id").count().where("count > 1").select("id")
    tied = to_rid.join(many, "id").select(F.col("id").alias("a"), F.col("rid").alias("b"))
    comp = _joined(comp, cut_lineage(tied, "tied"))
    by_id = (to_rid.join(comp.withColumnRenamed("id", "rid"), "rid", "left")
             .groupBy("id").agg(F.min(F.coalesce("component", "rid")).alias("component")))
    return (sets.select("id", "n").join(by_id, "id", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links: each node holds on to its component's smallest id."""
    if links.isEmpty():
        return comp
    return components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links))


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs that are not in one component yet."""
    for side in ("a", "b"):
        pairs = (pairs.join(comp.select(F.col("id").alias(side), F.col("component").alias(f"c_{side}")), side, "left")
                 .withColumn(f"c_{side}", F.coalesce(f"c_{side}", side)))
    return pairs.where("c_a <> c_b").select("a", "b")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that the bound of their points lets through."""
    side = lambda s: points.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("point").alias(f"point_{s}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .select("a", "b", "n_a", "n_b", "point_a", "point_b")
            .mapInArrow(_bound_filter(percent), "a long, b long, n_a long, n_b long, point_a binary, point_b binary")
            .select("a", "b"))


def _confirmed(pairs: DataFrame, text: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose whole texts link."""
    pairs = cut_lineage(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    side = lambda s: texts_of(text, pairs.select(F.col(s).alias("id"))).toDF(s, f"text_{s}")
    return (pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_verify(percent, width), "a long, b long").distinct())


def _left_over(cells: DataFrame, comp: DataFrame, points: DataFrame, percent: int,
               todo: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A round of pairs of a cell that are still apart, and the cells that have more to tell.

    Members outside their cell's largest component query its R-trees, so any two
    of different components meet. Cells are cut into blocks of queries and of
    data, so a task holds a bounded part however large the cell. A cell of one
    data block is asked whole at once. A larger one is dealt anew each round into
    blocks of its members, which query their own block only, as long as that
    leaves half as many outside; then all its blocks meet. ``todo`` holds the
    cells of the round: how many were outside in the last one, whether all
    blocks have met in it, and the candidates a query gives now.
    """
    labels = comp.select("id", "component")
    state = (cells.select(F.col("a").alias("cell"), F.col("b").alias("id"))
             .join(labels, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component"))
    if todo is not None:
        state = state.join(todo.select("cell"), "cell", "left_semi")
    state = cut_lineage(state, "cells")
    sizes = (state.groupBy("cell", "comp").agg(F.count("*").alias("most"))
             .groupBy("cell").agg(F.sum("most").alias("m"), F.max(F.struct("most", "comp")).alias("main"))
             .where("main.most < m")
             .select("cell", F.col("main.comp").alias("main"), "m", (F.col("m") - F.col("main.most")).alias("u")))
    if todo is None:
        sizes = sizes.withColumn("whole", F.col("m") <= DATA_BLOCK).withColumn("asked", F.lit(ASKED).cast("long"))
    else:
        sizes = (sizes.join(todo, "cell")
                 .withColumn("whole", F.col("whole") | (F.col("m") <= DATA_BLOCK) | (2 * F.col("u") > F.col("last"))).drop("last"))
    sizes = cut_lineage(
        sizes.withColumn("nq", F.ceil(F.when(F.col("whole"), F.col("u")).otherwise(F.col("m")) / QUERY_BLOCK).cast("long"))
        .withColumn("nd", F.when(F.col("whole"), F.ceil(F.col("m") / DATA_BLOCK).cast("long")).otherwise(F.col("nq"))), "sizes")
    rows = state.join(sizes, "cell").join(points, "id").withColumn("open", F.col("comp") != F.col("main"))
    # the count outside falls from round to round, so it deals the small blocks anew in each
    h = F.xxhash64("id", F.when(F.col("whole"), F.lit(0)).otherwise(F.col("u")))
    every = lambda blocks, own: F.explode(F.when(
        F.col("whole"), F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)).otherwise(F.array(own)))
    asks = (rows.where("open").withColumn("qb", F.pmod(h, F.col("nq")))
            .withColumn("db", every("nd", "qb")).withColumn("asks", F.lit(True)))
    data = (rows.withColumn("db", F.pmod(h, F.col("nd")))
            .withColumn("qb", every("nq", "db")).withColumn("asks", F.lit(False)))
    cols = ["cell", "qb", "db", "asks", "open", "id", "n", "comp", "point", "asked"]
    found = cut_lineage(asks.select(*cols).unionByName(data.select(*cols)).groupBy("cell", "qb", "db")
                        .applyInArrow(_tree_join(percent), "cell long, a long, b long, cut boolean"), "found")
    more = found.where("cut").select("cell").distinct().withColumn("cut", F.lit(True))
    todo = (sizes.join(more, "cell", "left").where(~F.col("whole") | F.col("cut"))
            .select("cell", F.col("u").alias("last"), "whole",
                    F.when(F.col("whole"), F.col("asked") * ASKED_MORE).otherwise(F.col("asked")).alias("asked")))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), cut_lineage(todo, "todo")
