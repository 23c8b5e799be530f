"""Embedding near-duplicates by an epsilon grid order join.

Vectors link at a cosine of ``threshold`` or more, in double precision. For
unit vectors that is a distance of ``eps = sqrt(2 - 2 threshold)`` at most, in
the whole space and in every projection. So the vectors are projected on the
corpus's leading principal axes and sorted by their grid cells of side ``eps``
there (the epsilon grid order). The sorted sequence is cut into intervals; two
intervals meet only if their first cells are neighbours and their boxes on the
leading axes are no further apart than ``eps``. A meeting splits the longer
part in halves and drops halves whose boxes are too far apart, until small
blocks are left; these are decided by exact products. Meetings are dealt to tiles
of neighbouring intervals, so an interval travels once to each tile in which it
meets another, not once for each meeting.

Equal vectors are one class with a count before the join. A task returns, per
vector, how many vectors it links to and one link that joins it to its local
component, never the pairs; counts add up over tasks.

Defined results: vectors that are null, empty, zero or with null or non-finite
components link with nothing and are their own component; vectors of different
lengths are joined apart, each length by itself; a row with a null id gives a row whose component is the smallest id
it links to, or null; rows that repeat an id count as vectors of their own; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, cut_lineage, small_batches

AXES = 6         # leading principal axes of the grid
INTERVAL = 4096  # vectors of an interval, about
SIDE = 4         # intervals of a tile's side, about
BLOCK = 512      # vectors of a block that is decided by products
SLACK = 1e-9     # what rounding may add to a projected distance


def _matrix(col, dim: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(dim: int):
    """Per task: the sums of all products of the unit vectors' components and 1."""
    def run(batches):
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            x = _unit(_matrix(b.column(0), dim))
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])
    return run


def _add(batches):
    total = 0
    for b in batches:
        for s in b.column(0):
            total = total + np.frombuffer(s.as_buffer(), np.float64)
    if not isinstance(total, int):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])


def principal_axes(vectors: DataFrame, dim: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, leading axes as columns). A task sends on one matrix; they are added in two rounds, one reaches the driver."""
    with small_batches(vectors.sparkSession):
        sums = vectors.select("v").mapInArrow(_moments(dim), "s binary")
        for tasks in (16, 1):
            sums = sums.repartition(tasks).mapInArrow(_add, "s binary")
        m = np.frombuffer(sums.first()["s"]).reshape(dim + 1, dim + 1)
    n = max(1.0, m[-1, -1])
    mean = m[-1, :-1] / n
    _, vec = np.linalg.eigh(m[:-1, :-1] / n - np.outer(mean, mean))
    return mean, vec[:, ::-1][:, :axes].copy()


def _project(mean, axes, eps: float):
    dim, k = axes.shape

    def run(batches):
        for b in batches:
            y = (_unit(_matrix(b.column("v"), dim)) - mean) @ axes
            cells = np.floor(y / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), b.column("m"), b.column("v"), *[pa.array(cells[:, i]) for i in range(k)]],
                names=["cid", "m", "v", *[f"c{i}" for i in range(k)]])
    return run


INTERVAL_ROW = ("ids binary, ms binary, vs binary, n long, low array<double>, high array<double>, "
                "first int, last int, stretch long")


def _intervals(mean, axes, cells: list[str]):
    """Rows of intervals of one stretch of the order: vectors, their box on the axes, first cells."""
    dim = axes.shape[0]

    def run(key, stretch):
        stretch = stretch.sort_by([(c, "ascending") for c in [*cells, "cid"]])
        out = {n: [] for n in ("ids", "ms", "vs", "n", "low", "high", "first", "last")}
        for at in range(0, stretch.num_rows, INTERVAL):
            b = stretch.slice(at, INTERVAL).combine_chunks()
            x = _matrix(b.column("v").combine_chunks(), dim)
            y = (_unit(x) - mean) @ axes
            c = b.column("c0").to_numpy()
            out["ids"].append(b.column("cid").to_numpy().astype(np.int64).tobytes())
            out["ms"].append(b.column("m").to_numpy().astype(np.int64).tobytes())
            out["vs"].append(x.astype(np.float32).tobytes() if (x.astype(np.float32) == x).all() else x.tobytes())
            out["n"].append(len(x))
            out["low"].append(y.min(axis=0).tolist())
            out["high"].append(y.max(axis=0).tolist())
            out["first"].append(int(c.min()))
            out["last"].append(int(c.max()))
        return pa.table({**out, "first": pa.array(out["first"], pa.int32()), "last": pa.array(out["last"], pa.int32()),
                         "stretch": pa.array([key[0].as_py()] * len(out["n"]), pa.int64())})
    return run


class Joiner:
    """Recursive join of two sorted sequences."""

    def __init__(self, threshold: float, eps: float, mean, axes):
        self.threshold, self.eps, self.mean, self.axes = threshold, eps, mean, axes

    def load(self, ids: bytes, ms: bytes, vs: bytes):
        ids = np.frombuffer(ids, np.int64)
        wide = len(vs) == len(ids) * len(self.mean) * 8
        x = _unit(np.frombuffer(vs, np.float64 if wide else np.float32).astype(np.float64).reshape(len(ids), -1))
        return ids, np.frombuffer(ms, np.int64), x, (x - self.mean) @ self.axes

    def far(self, y1: np.ndarray, y2: np.ndarray) -> bool:
        gap = np.maximum(0, np.maximum(y1.min(axis=0) - y2.max(axis=0), y2.min(axis=0) - y1.max(axis=0)))
        return float(np.sqrt((gap ** 2).sum())) > self.eps + SLACK

    def join(self, one, two, same: bool):
        """(ids, links of each, a local component of each) of vectors that link."""
        n1 = len(one[0])
        ids = one[0] if same else np.concatenate([one[0], two[0]])
        ms = one[1] if same else np.concatenate([one[1], two[1]])
        shift = 0 if same else n1
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        todo = [(0, n1, 0, len(two[0]))]
        while todo:
            a, b, c, d = todo.pop()
            if same and (c < a):  # the mirror of a part that is joined anyway
                continue
            if self.far(one[3][a:b], two[3][c:d]):
                continue
            if max(b - a, d - c) > BLOCK:
                if same and (a, b) == (c, d):
                    mid = (a + b) // 2
                    todo += [(a, mid, a, mid), (a, mid, mid, b), (mid, b, mid, b)]
                elif b - a >= d - c:
                    mid = (a + b) // 2
                    todo += [(a, mid, c, d), (mid, b, c, d)]
                else:
                    mid = (c + d) // 2
                    todo += [(a, b, c, mid), (a, b, mid, d)]
                continue
            hit = one[2][a:b] @ two[2][c:d].T >= self.threshold
            own = same and (a, b) == (c, d)
            if own:
                np.fill_diagonal(hit, False)
            i, j = np.nonzero(hit)
            if not len(i):
                continue
            i, j = i + a, j + c + shift
            links += np.bincount(i, ms[j], len(ids)).astype(np.int64)
            if not own:
                links += np.bincount(j, ms[i], len(ids)).astype(np.int64)
            self.unite(label, i, j)
        on = np.flatnonzero(links)
        return ids[on], links[on], ids[label[on]]

    @staticmethod
    def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        """Ties the components of linked positions; a label is a component's smallest position."""
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j = i[open_], j[open_]
            np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
            while not np.array_equal(up := label[label], label):
                label[:] = up


def _tile(joiner: Joiner):
    """The meetings of one tile: its intervals come once, whatever number of meetings they have there."""
    def run(key, meetings, sides):
        at, column = {}, {c: sides.column(c).combine_chunks() for c in ("at", "ids", "ms", "vs")}
        for k, a in enumerate(column["at"].to_pylist()):
            at[a] = joiner.load(*(column[c][k].as_buffer() for c in ("ids", "ms", "vs")))
        out = [joiner.join(at[a], at[b], a == b) for a, b in
               sorted(zip(meetings.column("a").to_pylist(), meetings.column("b").to_pylist(), strict=True))]
        cat = lambda k: np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64)
        return pa.table({"cid": cat(0), "links": cat(1), "root": cat(2)})
    return run


def link(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """Rows ``(id, n_links, component_id)``, one per row of ``vectors``."""
    if not -1 < threshold <= 1:
        raise ValueError("threshold must be in (-1, 1]")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("v", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one value
    good = rows.where(fine).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("d", F.size("v"))
    out = rows.where(~fine).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for r in good.select("d").distinct().orderBy("d").collect():  # vector lengths, few
        out = out.unionByName(_linked(good.where(F.col("d") == r["d"]).drop("d"), r["d"], threshold))
    return out


def _linked(good: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Links and components of ``good(id, v)``, vectors of one length."""
    classes = cut_lineage(good.groupBy("v").agg(F.min("id").alias("rid"), F.count("*").alias("m"))
                          .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    mean, axes = principal_axes(classes, dim, min(AXES, dim))
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    cells = [f"c{i}" for i in range(axes.shape[1])]
    placed = classes.select("cid", "m", "v").mapInArrow(
        _project(mean, axes, eps), "cid long, m long, v array<double>, " + ", ".join(f"{c} int" for c in cells))
    # the sorted sequence as ranges, and neighbouring ranges as stretches of about INTERVAL vectors,
    # however many ranges Spark makes
    n = max(1, -(-classes.count() // INTERVAL))
    ranges = cut_lineage(placed.repartitionByRange(n, *cells, "cid").withColumn("part", F.spark_partition_id()), "ranges")
    made = ranges.agg(F.max("part")).first()[0] + 1
    stretch = F.floor(F.col("part") * F.lit(min(n, made)) / F.lit(made)).cast("long")
    intervals = cut_lineage(
        ranges.groupBy(stretch.alias("stretch")).applyInArrow(_intervals(mean, axes, cells), INTERVAL_ROW)
        .withColumn("at", F.monotonically_increasing_id()), "intervals")

    box = intervals.select("at", "low", "high", "first", "last", F.floor(F.col("stretch") / SIDE).cast("long").alias("g"))
    # an interval holds cells first..last of the leading axis; it meets those that hold one of them or of their next
    a = box.select(F.col("at").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.col("g").alias("ga"),
                   F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    b = box.select(F.col("at").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("g").alias("gb"),
                   F.explode(F.sequence("first", "last")).alias("cell"))
    gaps = F.transform(F.arrays_zip("low_a", "high_a", "low_b", "high_b"), lambda x: F.greatest(
        F.lit(0.0), x["low_a"] - x["high_b"], x["low_b"] - x["high_a"]))
    meetings = (a.join(b, "cell").where("a <= b")
                .where(F.aggregate(gaps, F.lit(0.0), lambda t, g: t + g * g) <= (eps + SLACK) ** 2)
                .select("a", "b", F.least("ga", "gb").alias("p"), F.greatest("ga", "gb").alias("q")).distinct())
    # meetings by tiles of SIDE x SIDE intervals: an interval is shipped once for each tile of its row and column
    # that has a meeting, and a task holds 2 SIDE intervals at most
    meetings = cut_lineage(meetings, "meetings")
    wanted = meetings.select(F.col("p").alias("tp"), F.col("q").alias("tq"), F.explode(F.array("a", "b")).alias("at")).distinct()
    with small_batches(good.sparkSession):
        met = cut_lineage(meetings.groupBy("p", "q").cogroup(
            wanted.join(intervals.select("at", "ids", "ms", "vs"), "at").groupBy("tp", "tq")).applyInArrow(
                _tile(Joiner(threshold, eps, mean, axes)), "cid long, links long, root long"), "met")

    counts = met.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(met.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    least = (classes.select("cid", "rid").join(comp.withColumnRenamed("id", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    least = least.join(least.groupBy("component").agg(F.min("rid").alias("component_id")), "component").select(
        "cid", "component_id")
    told = (classes.select("cid", "v", "m").join(counts, "cid", "left").join(least, "cid")
            .select("v", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    return good.join(told, "v").select("id", "n_links", "component_id")
