"""Approximate nearest neighbours by low-dimensional stable projections.

Largest inner product is made smallest distance: vectors get one more component
that brings all of them to the largest norm M, queries are stretched to M and get
0 there. A Gaussian matrix A (2-stable) takes these points to ``PROJECTED``
dimensions, where squared distances divided by the true ones follow a chi-square
law with as many degrees of freedom. A query therefore goes through the points in
the order of their projected distance, verifies true scores, and stops when a
point with a better score than the k-th best so far would, with probability
``CERTAINTY``, have come up already: when the next projected squared distance is
over ``chi2^-1(CERTAINTY)`` times the k-th best true one.

The index is a kd-tree over the projections. Its upper levels, cut on a bounded
sample, deal all vectors to at most ``REGIONS`` regions; a region is cut into
blocks of about ``BLOCK`` vectors, as many as its count needs, and a block holds
its own lower tree down to leaves of ``LEAF`` vectors, which are verified as one
product. Queries are searched in a block of their own region first; the k-th
score found there bounds which other regions each needs. Queries that live
together travel in packs, and a pack meets a block in one task, where every
query takes the leaves in the order of their distance until the test holds.

What is bounded: the sample, the regions (boxes and counts are the only tables
that every task gets), packs and blocks. Equal vectors are one point, which keeps
its k + 1 smallest ids, so a vector that fills a third of the table is no hot
group; equal queries are one query per slot of ids.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id, which could not be named;
vectors are compared with those of their own length. Rows that repeat an id are
rows of their own: each asks and each is found, only a query's own row is left
out of its neighbours. Scores are sums of products in double precision, left to
right. An empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut_lineage, small_batches

PROJECTED = 8       # dimensions of the projections
CERTAINTY = 0.95    # of the stopping test, per neighbour
SAMPLE = 32768      # projections the upper levels are cut on, at most
REGIONS = 4096      # regions at most
BLOCK = 8192        # vectors of a block, about
PACK = 512          # queries of a pack at most
LEAF = 256          # vectors of a leaf
SLOT = 2048         # ids of equal queries that one query stands for, about
TURN = 512          # packs that a block meets in one task, about
SLACK = 1e-9        # relative rounding of scores and distances


def chi_square(x: float, m: int) -> float:
    """Distribution function of the chi-square law with ``m`` degrees of freedom (series of the incomplete gamma)."""
    if x <= 0:
        return 0.0
    a, z = m / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-17:
        k += 1
        term *= z / k
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, float(m)
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


def matrix(col, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Space:
    """The lifted space of one vector length and its stable projection."""

    def __init__(self, dim: int, norm: float, projected: int = PROJECTED, seed: int = 12):
        self.dim, self.norm, self.projected = dim, norm, projected
        self.axes = np.random.default_rng([seed, dim]).normal(size=(dim + 1, projected))

    def points(self, x: np.ndarray) -> np.ndarray:
        """Projections of vectors, lifted to the largest norm."""
        lift = np.sqrt(np.maximum(0.0, self.norm ** 2 - (x * x).sum(axis=1)))
        return np.column_stack([x, lift]) @ self.axes

    def queries(self, x: np.ndarray) -> np.ndarray:
        """Projections of queries, stretched to the largest norm."""
        return self.stretch(x) @ self.axes[:-1]

    def stretch(self, x: np.ndarray) -> np.ndarray:
        return x * (self.norm / np.sqrt((x * x).sum(axis=1, keepdims=True)))


class Upper:
    """The upper levels of the kd-tree: a heap of (axis, cut), leaves are regions."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.levels = max(0, math.ceil(math.log2(max(1, regions))))
        self.known = np.arange(1 << self.levels)
        self.axis = np.zeros(1 << self.levels, np.int64)
        self.cut = np.zeros(1 << self.levels)
        parts = {1: sample}
        for node in range(1, 1 << self.levels):
            part = parts.pop(node)
            if len(part):
                self.axis[node] = (part.max(axis=0) - part.min(axis=0)).argmax()
                self.cut[node] = np.median(part[:, self.axis[node]])
            right = part[:, self.axis[node]] > self.cut[node]
            parts[2 * node], parts[2 * node + 1] = part[~right], part[right]

    def regions(self, p: np.ndarray) -> np.ndarray:
        at = np.ones(len(p), np.int64)
        for _ in range(self.levels):
            at = 2 * at + (p[np.arange(len(p)), self.axis[at]] > self.cut[at])
        return self.known[at - (1 << self.levels)]

    def keep(self, regions: list[int]) -> None:
        """From now on only these regions are given; others fall to the next one."""
        at = np.searchsorted(regions, np.arange(1 << self.levels))
        self.known = np.array(regions)[np.minimum(at, len(regions) - 1)]


def lower_tree(p: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Positions of the leaves of a kd-tree over the rows of ``p``."""
    out, todo = [], [np.arange(len(p))]
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        axis = (p[at].max(axis=0) - p[at].min(axis=0)).argmax()
        half = len(at) // 2
        order = np.argpartition(p[at, axis], half)
        todo += [at[order[:half]], at[order[half:]]]
    return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns)."""
    out = np.zeros((len(q), len(low)))
    for i in range(q.shape[1]):
        gap = np.maximum(0.0, np.maximum(low[:, i] - q[:, i:i + 1], q[:, i:i + 1] - high[:, i]))
        out += gap * gap
    return out


class Search:
    """Incremental search of queries in one block until the stopping test holds."""

    def __init__(self, space: Space, k: int, certainty: float, leaf: int):
        self.space, self.k, self.leaf = space, k, leaf
        self.reach = chi_square_quantile(certainty, space.projected)

    def radius(self, best: np.ndarray) -> np.ndarray:
        """Squared projected distance up to which points may beat the stretched score ``best``."""
        top = 2 * self.space.norm ** 2
        return self.reach * np.maximum(0.0, top - 2 * best) * (1 + SLACK) + SLACK * top

    def run(self, q: np.ndarray, best: np.ndarray, x: np.ndarray):
        """(query, vector, score) of the block's candidates and the k-th best stretched score of each query.

        ``best``: the k-th best known before, -inf for none. Candidates are all
        verified vectors that reach the k-th best score.
        """
        stretched, projected = self.space.stretch(q), self.space.queries(q)
        points = self.space.points(x)
        leaves = lower_tree(points, self.leaf)
        low = np.array([points[a].min(axis=0) for a in leaves])
        high = np.array([points[a].max(axis=0) for a in leaves])
        gap = box_distance(projected, low, high)
        order = np.argsort(gap, axis=1, kind="stable")
        score = np.full((len(q), len(x)), -np.inf)
        tops = np.full((len(q), self.k), -np.inf)
        tops[:, 0] = best  # stands in until the block itself has k
        floor = best.copy()
        active = np.arange(len(q))
        for step in range(len(leaves)):
            at = order[active, step]
            go = gap[active, at] <= self.radius(floor[active])
            active, at = active[go], at[go]  # leaves only get farther: a query that stops is done
            if not len(active):
                break
            for leaf in np.unique(at):
                who, cols = active[at == leaf], leaves[leaf]
                s = stretched[who] @ x[cols].T
                score[np.ix_(who, cols)] = s
                both = np.concatenate([tops[who], s], axis=1)
                tops[who] = -np.partition(-both, self.k - 1, axis=1)[:, :self.k]
            floor[active] = np.maximum(best[active], tops[active].min(axis=1))
        enough = floor - SLACK * self.space.norm ** 2
        i, j = np.nonzero((score >= enough[:, None]) & (score > -np.inf))
        exact = np.zeros(len(i))
        for d in range(q.shape[1]):  # products added left to right, whatever the shapes
            exact += q[i, d] * x[j, d]
        return i, j, exact, floor


# --- Spark ------------------------------------------------------------------

def _projected(space: Space):
    def run(batches):
        for b in batches:
            p = space.points(matrix(b.column("v"), space.dim))
            yield pa.RecordBatch.from_arrays([pa.array(list(p), pa.list_(pa.float64()))], names=["p"])
    return run


def _placed(space: Space, upper: Upper, query: bool):
    """Rows with their region."""
    def run(batches):
        for b in batches:
            x = matrix(b.column("v"), space.dim)
            region = upper.regions(space.queries(x) if query else space.points(x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region.astype(np.int32))], names=[*b.schema.names, "region"])
    return run


def packed(x: np.ndarray) -> bytes:
    """Vectors as single precision where that loses nothing."""
    short = x.astype(np.float32)
    return (short if (short == x).all() else x).tobytes()


def unpacked(data, n: int, dim: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * n * dim else np.float64
    return np.frombuffer(data, kind).reshape(n, dim).astype(np.float64)


BLOCK_ROW = "block long, region int, vs binary, low array<double>, high array<double>, least array<array<long>>"
PACK_ROW = "pack long, region int, home long, n int, gids binary, qs binary, best binary"
HIT = "gid long, ids array<long>, score double, own boolean"


def _build(space: Space):
    """A block's rows as one row."""
    def run(key, rows):
        rows = rows.combine_chunks()
        x = matrix(rows.column("v").combine_chunks(), space.dim)
        p = space.points(x)
        return pa.table({"block": [key[0].as_py()], "region": pa.array([rows.column("region")[0].as_py()], pa.int32()),
                         "vs": [packed(x)], "low": [p.min(axis=0).tolist()], "high": [p.max(axis=0).tolist()],
                         "least": [rows.column("ids").to_pylist()]})
    return run


def _packs(dim: int):
    """Queries of one home block, in packs."""
    def run(key, rows):
        rows = rows.sort_by("gid")
        out = {n: [] for n in ("pack", "region", "home", "n", "gids", "qs", "best")}
        for at in range(0, rows.num_rows, PACK):
            b = rows.slice(at, PACK).combine_chunks()
            gids = b.column("gid").to_numpy()
            out["pack"].append(int(gids[0]))
            out["region"].append(b.column("region")[0].as_py())
            out["home"].append(key[0].as_py())
            out["n"].append(len(gids))
            out["gids"].append(gids.tobytes())
            out["qs"].append(packed(matrix(b.column("v").combine_chunks(), dim)))
            out["best"].append(np.full(len(gids), -np.inf).tobytes())
        return pa.table({**out, "region": pa.array(out["region"], pa.int32()), "n": pa.array(out["n"], pa.int32())})
    return run


def _meet(search: Search, bounds: bool):
    """Searches a pack in a block: hits, or with ``bounds`` the k-th best scores too (as ids null)."""
    dim = search.space.dim

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                cell = lambda c, r=r, b=b: b.column(c)[r].as_buffer()
                gids, best = np.frombuffer(cell("gids"), np.int64), np.frombuffer(cell("best"), np.float64)
                q = unpacked(cell("qs"), len(gids), dim)
                least = b.column("least").slice(r, 1).flatten()
                x = unpacked(cell("vs"), len(least), dim)
                i, j, score, floor = search.run(q, best, x)
                own = (q[i] == x[j]).all(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(gids[i]), least.take(pa.array(j)), pa.array(score), pa.array(own)],
                                                 names=["gid", "ids", "score", "own"])
                if bounds:
                    none = pa.nulls(len(gids), pa.list_(pa.int64())), pa.nulls(len(gids), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(gids), none[0], pa.array(floor), none[1]],
                                                     names=["gid", "ids", "score", "own"])
    return run


def _needed(search: Search, boxes: list[tuple[int, np.ndarray, np.ndarray]]):
    """Regions that a pack's queries need beyond their home block."""
    region = np.array([r for r, _, _ in boxes], np.int32)
    low, high = np.array([a for _, a, _ in boxes]), np.array([b for _, _, b in boxes])
    dim = search.space.dim

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                best = np.frombuffer(b.column("best")[r].as_buffer(), np.float64)
                q = unpacked(b.column("qs")[r].as_buffer(), len(best), dim)
                near = box_distance(search.space.queries(q), low, high) <= search.radius(best)[:, None]
                to = region[near.any(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("pack").take(pa.array(np.full(len(to), r))), b.column("home").take(pa.array(np.full(len(to), r))),
                     pa.array(to)], names=["pack", "home", "region"])
    return run


def _listed(batches):
    """The queries of packs."""
    for b in batches:
        for pack, gids in zip(b.column("pack").to_pylist(), b.column("gids"), strict=True):
            g = np.frombuffer(gids.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), pack)), pa.array(g)], names=["pack", "gid"])


def _bounded(key, packs, bounds):
    """A pack with the bounds that the search at home has found."""
    at = dict(zip(bounds.column("gid").to_pylist(), bounds.column("score").to_pylist(), strict=True))
    best = np.array([at[g] for g in np.frombuffer(packs.column("gids")[0].as_py(), np.int64).tolist()])
    return packs.set_column(packs.schema.get_field_index("best"), "best", pa.array([best.tobytes()]))


def _searched(rows: DataFrame, dim: int, is_query: Column, k: int, certainty: float) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` among ``rows(id, v)``, all of length ``dim``."""
    spark = rows.sparkSession
    # points: distinct vectors, each with its k + 1 smallest ids (a bound that is applied before rows are shuffled)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    points = cut_lineage(rows.withColumn("place", place).where(F.col("place") <= k + 1)
                         .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    norm, n = points.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x))), F.count("*")).first()
    # queries: distinct vectors and the ids that ask with them, by slots, so that no list grows without bound
    asked = rows.where(is_query)
    slots = max(1, -(-asked.count() // SLOT))
    asked = cut_lineage(asked.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)))
                        .groupBy("v", "slot").agg(F.collect_list("id").alias("who"))
                        .withColumn("gid", F.monotonically_increasing_id()), "queries")

    space = Space(dim, norm * (1 + SLACK))
    search = Search(space, k + 1, certainty, LEAF)
    vectors = points.select("v")
    picked = vectors.mapInArrow(_projected(space), "p array<double>").orderBy(F.xxhash64("p"), "p").limit(SAMPLE)
    sample = np.array([r["p"] for r in picked.collect()])  # the bounded sample of the cuts
    upper = Upper(sample, min(REGIONS, -(-n // BLOCK)))
    kind = vectors.schema["v"].dataType.simpleString()
    counts = {r["region"]: r["n"] for r in vectors.mapInArrow(_placed(space, upper, False), f"v {kind}, region int")
              .groupBy("region").agg(F.count("*").alias("n")).collect()}
    first, total = {}, 0  # number of a region's first block
    for region in sorted(counts):
        first[region] = total
        total += -(-counts[region] // BLOCK)
    upper.keep(sorted(counts))
    parts = spark.createDataFrame([(r, first[r], -(-counts[r] // BLOCK)) for r in sorted(counts)], "region int, first long, parts int")

    def block_of(df: DataFrame, key: str) -> DataFrame:  # the table of regions has REGIONS rows at most
        return (df.join(F.broadcast(parts), "region")
                .withColumn("block", F.col("first") + F.pmod(F.xxhash64(key), F.col("parts"))).drop("first", "parts"))

    with small_batches(spark):
        placed = points.mapInArrow(_placed(space, upper, False), f"v {kind}, ids array<long>, region int")
        blocks = cut_lineage(block_of(placed, "v").groupBy("block").applyInArrow(_build(space), BLOCK_ROW), "blocks")
        home = asked.select("gid", "v").mapInArrow(_placed(space, upper, True), f"gid long, v {kind}, region int")
        packs = cut_lineage(block_of(home, "gid").groupBy("block").applyInArrow(_packs(dim), PACK_ROW), "packs")

        vectors_of = blocks.select("block", "vs", "least")
        at_home = cut_lineage(packs.join(vectors_of.withColumnRenamed("block", "home"), "home")
                              .mapInArrow(_meet(search, True), HIT), "home")

        bounds = (packs.select("pack", "gids").mapInArrow(_listed, "pack long, gid long")
                  .join(at_home.where("ids is null").select("gid", "score"), "gid"))
        packs = cut_lineage(packs.groupBy("pack").cogroup(bounds.groupBy("pack")).applyInArrow(_bounded, PACK_ROW), "bounded")

        sides = [F.array(*[f(F.col(c)[i]) for i in range(space.projected)]).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
        boxes = [(r["region"], np.array(r["low"]), np.array(r["high"]))  # a row per region
                 for r in blocks.groupBy("region").agg(*sides).collect()]
        # a block meets its packs in turns, so no task gets more than about TURN of them
        turns = max(1, -(-packs.count() // TURN))
        turn = F.pmod(F.xxhash64("pack"), F.lit(turns))
        pairs = (packs.mapInArrow(_needed(search, boxes), "pack long, home long, region int")
                 .join(F.broadcast(parts), "region")
                 .select("pack", "home", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("block"))
                 .where("block <> home").select("pack", "block", turn.alias("turn")))
        each = vectors_of.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))))
        away = cut_lineage(pairs.join(packs.select("pack", "gids", "qs", "best"), "pack").join(each, ["block", "turn"])
                           .mapInArrow(_meet(search, False), HIT), "away")

    hits = (at_home.where("ids is not null").unionByName(away)
            .select("gid", "score", "own", F.explode("ids").alias("vec_id")))
    order = Window.partitionBy("gid").orderBy(F.desc("score"), "vec_id")
    best = (hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
            .groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("found")))
    # a query leaves out its own row, one of those with its id and vector
    mine = F.array_min(F.transform(F.filter("found", lambda x: x["own"] & (x["vec_id"] == F.col("query_id"))), lambda x: x["place"]))
    rest = F.filter("found", lambda x: F.col("mine").isNull() | (x["place"] != F.col("mine")))
    return (asked.select("gid", "who").join(best, "gid").select(F.explode("who").alias("query_id"), "found")
            .withColumn("mine", mine).select("query_id", F.posexplode(F.slice(rest, 1, k)))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
                    F.col("col.score").alias("score")))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           certainty: float = CERTAINTY) -> DataFrame:
    """The ``k`` vectors of largest inner product found for each query: ``(query_id, rank, vec_id, score)``.

    ``is_query`` is a condition on the column ``id``.
    """
    if k < 1 or not 0 < certainty < 1:
        raise ValueError("k must be positive and certainty between 0 and 1")
    kind = vectors.select(vec_col).schema[0].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    zero = F.lit(0.0).cast(kind[6:-1])
    good = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"))
            .where(F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists("v", lambda x: x != 0))
            # -0.0 and 0.0 are one value
            .withColumn("v", F.transform("v", lambda x: x + zero)))
    out = None
    for r in good.select(F.size("v").alias("d")).distinct().orderBy("d").collect():  # vector lengths, few
        found = _searched(good.where(F.size("v") == r["d"]), r["d"], is_query, k, certainty)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out
