"""Embedding whitening by spectrum slicing.

Entries become whole numbers, so the covariance is exact: tasks centre them by
the rounded means, sum products as whole numbers, and what rounding left out of
the centre is taken off exactly before the one division. No order of rows or
tasks changes a digit of it.

The leading eigenvalues of that matrix V come from its inertia. By Sylvester's
law an LDLᵀ factorisation of V - sI has as many negative pivots as V has
eigenvalues under s, so counts at a few shifts slice the spectrum until each
leading eigenvalue has an interval of its own. Inverse iteration with the
interval's factors starts a Rayleigh quotient iteration, which converges
cubically; one that leaves its interval slices on. A count on either side of the
value certifies its number. Values that lie too close to be told apart by counts
share an interval: their vectors are iterated orthogonally to those already
found, and the interval's counts certify their numbers together.

Spark does three passes over the vectors (sums, products, projection) and one
over the projections. A task keeps one matrix; matrices are added in rounds of
fewer and fewer tasks, and one of dim (dim + 1) / 2 sums reaches the driver for
each vector length: the only things there are dim x dim.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, others stay, with null or repeated ids too; vectors of different
lengths are fitted apart, each length on all of its vectors; an empty vector has
no components and so no rows; fewer dimensions than components give as many rows
as there are dimensions. A component without variance (constant vectors, fewer
vectors than dimensions) has ``explained`` 0, or null where nothing varies at
all, and null ``whitened``; ``identity_error`` is over the others, null if there
are none. An empty table gives an empty result, extra columns are ignored.
Entries beyond +-32768 raise an error, as their products would not be exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut_lineage, small_batches

SCALE, SHIFT = 1024, 100_000
LIMIT = 32768.0          # largest entry: a product of two centred numbers stays under 2^53
ROUNDS = (64, 8, 1)      # tasks that add up matrices
LOW = (1 << 30) - 1
EPS = np.finfo(np.float64).eps


# --- slicing the spectrum ---------------------------------------------------

class Factors:
    """LDLᵀ factors of a symmetric matrix, pivots in blocks of one or two along the diagonal (Bunch and Kaufman)."""

    def __init__(self, a: np.ndarray):
        a = a.copy()
        n = len(a)
        self.order = np.arange(n)
        self.blocks: list[tuple[int, np.ndarray]] = []
        self.lower = np.eye(n)
        self.negative = self.zero = 0
        share = (1 + 17 ** 0.5) / 8
        nothing = float(np.abs(a).max(initial=0.0)) * EPS * EPS  # under this a column is what rounding left of zero
        k = 0
        while k < n:
            below = np.abs(a[k + 1:, k])
            r = k + 1 + int(below.argmax()) if len(below) else k
            most, here, size = float(below.max(initial=0.0)), abs(a[k, k]), 1
            if max(most, here) <= nothing:
                self.zero += 1
                self.blocks.append((k, np.zeros((1, 1))))
                k += 1
                continue
            if here < share * most:
                across = np.abs(a[r, k:])
                across[r - k] = 0
                widest = float(across.max())
                if here * widest < share * most * most:
                    if abs(a[r, r]) >= share * widest:
                        self._exchange(a, k, r)
                    else:
                        size = 2
                        self._exchange(a, k + 1, r)
            end = k + size
            pivot, col = a[k:end, k:end].copy(), a[end:, k:end]
            # updates are symmetric to the last digit
            if size == 1:
                self.negative += int(pivot[0, 0] < 0)
                a[end:, end:] -= np.outer(col, col) / pivot[0, 0]
                self.lower[end:, k] = col[:, 0] / pivot[0, 0]
            else:  # chosen so that its determinant is negative: one eigenvalue on either side
                self.negative += 1
                self.lower[end:, k:end] = np.linalg.solve(pivot, col.T).T
                change = self.lower[end:, k:end] @ col.T
                a[end:, end:] -= (change + change.T) / 2
            self.blocks.append((k, pivot))
            k = end

    def _exchange(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            self.lower[[i, j], :min(i, j)] = self.lower[[j, i], :min(i, j)]

    def solve(self, b: np.ndarray, floor: float) -> np.ndarray:
        """A solution for ``b``; pivots under ``floor`` in size count as ``floor``."""
        y = b[self.order].copy()
        n = len(y)
        for k in range(n):
            y[k + 1:] -= self.lower[k + 1:, k] * y[k]
        for k, pivot in self.blocks:
            if len(pivot) == 1:
                d = pivot[0, 0]
                y[k] /= d if abs(d) > floor else floor
            else:
                y[k:k + 2] = np.linalg.solve(pivot, y[k:k + 2])
        for k in range(n - 1, -1, -1):
            y[k] -= self.lower[k + 1:, k] @ y[k + 1:]
        out = np.empty(n)
        out[self.order] = y
        return out


@dataclass
class Spectrum:
    """Eigenvalues from the largest on and their unit vectors as columns.

    ``certified[i]``: how many eigenvalues counts have shown above and
    not below a value: (number above it, number down to it).
    """

    values: np.ndarray
    vectors: np.ndarray
    certified: list[tuple[int, int]]
    counts: int  # factorisations that were needed


def leading(v: np.ndarray, k: int) -> Spectrum:
    """The ``k`` leading eigenpairs of a symmetric matrix."""
    n = len(v)
    k = min(k, n)
    norm = float(np.abs(v).sum(axis=1).max()) if n else 0.0
    if k == 0 or norm == 0:
        return Spectrum(np.zeros(k), np.eye(n)[:, :k], [(0, n)] * k, 0)
    known: dict[float, int] = {}

    def above(s: float) -> int:
        """Eigenvalues over ``s``; counts at shifts once counted are kept."""
        if s not in known:
            known[s] = n - (f := Factors(v - s * np.eye(n))).negative - f.zero
        return known[s]

    tiny = 4 * n * EPS * norm
    top, bottom = norm * (1 + 8 * EPS) + tiny, -norm * (1 + 8 * EPS) - tiny
    known[top], known[bottom] = 0, n
    rng = np.random.default_rng(11)
    values, vectors, certified = np.zeros(k), np.zeros((n, k)), []

    def interval(i: int) -> tuple[float, float]:
        """The shifts counted so far next to eigenvalue ``i`` (from 0)."""
        return max(s for s, c in known.items() if c > i), min(s for s, c in known.items() if c <= i)

    def orthogonal(x: np.ndarray, i: int) -> np.ndarray:
        for _ in range(2):
            x = x - vectors[:, :i] @ (vectors[:, :i].T @ x)
        size = np.linalg.norm(x)
        return x / size if size > 0 else orthogonal(rng.normal(size=n), i)

    for i in range(k):
        while True:
            low, high = interval(i)
            alone = known[low] == i + 1 and known[high] == i
            if not alone and high - low > tiny:
                above((low + high) / 2)
                continue
            x = orthogonal(rng.normal(size=n), i)
            if alone or known[low] - i > 0:
                start = Factors(v - (low + high) / 2 * np.eye(n))
                for _ in range(2 if alone else 6):
                    x = orthogonal(start.solve(x, EPS * norm), i)
            value, gap = float(x @ v @ x), np.inf
            for _ in range(40):
                residual = float(np.linalg.norm(v @ x - value * x))
                if residual <= EPS * norm or residual >= gap / 2 and residual <= tiny:
                    break
                gap = residual
                x = orthogonal(Factors(v - value * np.eye(n)).solve(x, EPS * norm), i)
                value = float(x @ v @ x)
            if low - tiny <= value <= high + tiny and residual <= tiny or high - low <= tiny:
                break
            above((low + high) / 2)  # it went to another eigenvalue: slice on
        values[i], vectors[:, i] = value, x
        certified.append((above(value + tiny), above(value - tiny)))
    return Spectrum(values, vectors, certified, len(known) - 2)


# --- exact sums over the vectors --------------------------------------------

def numbers(flat: np.ndarray) -> np.ndarray:
    """Entries as whole numbers."""
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def by_length(column: pa.Array):
    """(positions, matrix of doubles) of the vectors of each length but 0."""
    size = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    heads = np.concatenate([[0], np.cumsum(size)])[:-1]
    for dim in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == dim)
        yield dim, at, flat[heads[at][:, None] + np.arange(dim)]


def _totals(batches):
    n, sums = {}, {}
    for b in batches:
        for dim, at, m in by_length(b.column("v")):
            n[dim] = n.get(dim, 0) + len(at)
            sums[dim] = sums.get(dim, 0) + numbers(m).sum(axis=0)
    for dim in n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim), pa.int32()), pa.array([n[dim]] * dim, pa.int64()),
             pa.array(sums[dim])], names=["dim", "at", "n", "s"])


def products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low parts (2^30) of the sums of products, upper triangle; exact for whole numbers under 2^26."""
    dim = y.shape[1]
    high, low = np.zeros((dim, dim), np.int64), np.zeros((dim, dim), np.int64)
    most = max(1, int(np.abs(y).max())) if len(y) else 1
    step = max(1, (1 << 53) // (most * most))  # rows whose products add up to whole doubles
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        total = (part.T @ part).astype(np.int64)
        high += total >> 30
        low += total & LOW
    up = np.triu_indices(dim)
    return high[up], low[up]


STATE = "dim int, state binary"


def _state_batches(sums: dict[int, np.ndarray]):
    for dim, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([s.tobytes()], pa.binary())], names=["dim", "state"])


def _add_products(centres: dict[int, np.ndarray]):
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, m in by_length(b.column("v")):
                sums[dim] = sums.get(dim, 0) + np.stack(products(numbers(m) - centres[dim]))
        yield from _state_batches(sums)
    return run


def _merge(batches):
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for dim, state in zip(b.column("dim").to_pylist(), b.column("state"), strict=True):
            sums[dim] = sums.get(dim, 0) + np.frombuffer(state.as_buffer(), np.int64).reshape(2, -1)
    yield from _state_batches(sums)


@dataclass
class Model:
    """What is known of the vectors of one length."""

    n: int
    sums: np.ndarray        # S, per dimension
    axes: np.ndarray        # components as columns
    values: np.ndarray      # their eigenvalues; 0 where there is no variance
    explained: list[float | None]


def covariance(n: int, sums: list[int], centre: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The exact covariance, each entry rounded once: products are of ``x - centre``."""
    dim = len(sums)
    left = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    v = np.zeros((dim, dim))
    for i, j, h, l in zip(*np.triu_indices(dim), high.tolist(), low.tolist(), strict=True):  # noqa: E741
        v[i, j] = v[j, i] = (n * ((h << 30) + l) - left[i] * left[j]) / (n * n)
    return v


def fit(vectors: DataFrame, components: int) -> dict[int, Model]:
    """A model for each length of ``vectors(v)``."""
    with small_batches(vectors.sparkSession):
        got = (vectors.mapInArrow(_totals, "dim int, at int, n long, s long")
               .groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
        counts = {r["dim"]: r["n"] for r in got}
        sums = {d: [s for _, s in sorted((r["at"], r["s"]) for r in got if r["dim"] == d)] for d in counts}
        centres = {d: np.array([(2 * s + counts[d]) // (2 * counts[d]) for s in sums[d]], np.int64) for d in counts}
        states = vectors.mapInArrow(_add_products(centres), STATE)
        for tasks in ROUNDS:
            states = states.repartition(tasks).mapInArrow(_merge, STATE)
        states = {r["dim"]: np.frombuffer(r["state"], np.int64).reshape(2, -1) for r in states.collect()}
    models = {}
    for d, n in counts.items():
        v = covariance(n, sums[d], centres[d], *states[d])
        trace = float(np.trace(v))
        found = leading(v, components)
        # under this a value is no more than what rounding left of zero
        values = np.where(found.values > 8 * d * EPS * trace, found.values, 0.0)
        models[d] = Model(n, np.array(sums[d], np.int64), found.vectors, values,
                          [e / trace if trace > 0 else None for e in values.tolist()])
    return models


def _whitened(models: dict[int, Model]):
    def run(batches):
        for b in batches:
            for dim, at, m in by_length(b.column("v")):
                model = models[dim]
                far = model.n * numbers(m) - model.sums
                if int(np.abs(far).max()) ** 2 * dim < 1 << 63:
                    deviation = (far * far).sum(axis=1).tolist()
                else:  # past 64 bits
                    deviation = (far.astype(object) ** 2).sum(axis=1).tolist()
                flat = model.values == 0
                w = far / model.n @ model.axes / np.sqrt(np.where(flat, 1.0, model.values))
                k = len(flat)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(at)), pa.array([dim] * len(at), pa.int32()),
                     pa.array(list(map(str, deviation)), pa.string()),
                     pa.ListArray.from_arrays(np.arange(0, len(at) * k + 1, k, dtype=np.int32),
                                              pa.array(w.ravel(), mask=np.tile(flat, len(at))))],
                    names=["id", "dim", "deviation", "w"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """Rows ``(id, component, n, deviation decimal(38,0), whitened, explained, identity_error)``."""
    if components < 1:
        raise ValueError("components must be positive")
    spark = vectors.sparkSession
    good = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))
    good = good.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) <= LIMIT, x).otherwise(
        F.raise_error(F.lit(f"entries beyond +-{LIMIT:g} are not supported")).cast("double"))))
    models = fit(good.select("v"), components)
    with small_batches(spark):
        told = cut_lineage(good.mapInArrow(_whitened(models), "id long, dim int, deviation string, w array<double>"), "whitened")
    k = max((len(m.values) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    at = lambda i: F.try_element_at("w", F.lit(i + 1))
    moments = told.groupBy("dim").agg(
        F.count("*").alias("n"), *[F.sum(at(i)).alias(f"s{i}") for i in range(k)],
        *[F.sum(at(i) * at(j)).alias(f"s{i}_{j}") for i, j in pairs]).collect()  # a row per length
    error = {}
    for r in moments:
        off = [abs(r[f"s{i}_{j}"] / r["n"] - r[f"s{i}"] / r["n"] * (r[f"s{j}"] / r["n"]) - (i == j))
               for i, j in pairs if r[f"s{i}_{j}"] is not None]
        error[r["dim"]] = max(off, default=None)
    facts = spark.createDataFrame(
        [(d, m.n, i + 1, e, error.get(d)) for d, m in models.items() for i, e in enumerate(m.explained)],
        "dim int, n long, component int, explained double, identity_error double")
    # a row per length and component: bounded by the lengths that occur
    return (told.join(F.broadcast(facts), "dim")
            .select("id", "component", "n", F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                    F.expr("try_element_at(w, component)").alias("whitened"), "explained", "identity_error"))
