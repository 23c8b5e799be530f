"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A text's features are its distinct character n-grams of 3 to 5 code points
(A-Z lower-cased), hashed. From the labelled texts of the fit come, per hashed
n-gram, the log ratio of its smoothed document shares in toxic and other texts;
these ratios scale the features, and a logistic regression learns one weight
per scaled feature. The model keeps every n-gram whose counts differ between the
classes by a log likelihood ratio of ``GAIN`` or more; the others weigh nothing.

The fit uses at most ``PER_CLASS`` labelled documents of each class (a bounded
sample, see ``shared.examples``): Spark counts their n-grams, then returns each
text's kept features, and the regression runs on the driver. Every document is
scored inside Spark tasks.

Defined results: a null or empty text is scored as a text without n-grams;
every row gives one row, repeated and null ids included; an empty table gives
an empty result; a class without labelled rows leaves the prior; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .shared import cut_lineage, examples

ORDERS = (3, 4, 5)
BITS = 18            # hashed n-grams: 2^18
GAIN = 11.0          # least log likelihood ratio of a kept n-gram
PER_CLASS = 4000     # labelled documents of each class the fit may use
STEPS, SHRINK = 300, 1e-3


def ngrams(col):
    """For each order n: (n, hashed n-gram at every position, offsets of the texts)."""
    cp, offsets = T.codepoints(col)
    low = np.where((cp >= 65) & (cp <= 90), cp + 32, cp).astype(T.U64)
    roll = low
    for n in range(2, max(ORDERS) + 1):
        if len(roll) < 2:
            return
        roll = roll[:-1] * T.U64(0x100000001B3)
        roll += low[n - 1:]
        if n in ORDERS:
            h = roll ^ T.U64(n)
            h *= T.U64(0x9E3779B97F4A7C15)
            h >>= T.U64(64 - BITS)
            yield n, h.view(np.int64), offsets


def _distinct(col, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs, sorted; with ``slot`` only kept n-grams, as their slots."""
    keys = []
    kept = None if slot is None else slot >= 0
    for n, gram, offsets in ngrams(col):
        at = np.arange(len(gram)) if kept is None else np.flatnonzero(kept[gram])
        text = np.searchsorted(offsets, at, "right") - 1
        whole = at + n <= offsets[text + 1]  # n-grams across two texts are none
        gram, text = gram[at[whole]], text[whole]
        keys.append(text << BITS | (gram if slot is None else slot[gram]))
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    slot: np.ndarray    # hashed n-gram -> kept feature, or -1
    ratio: np.ndarray   # log-count ratio of each kept feature
    weight: np.ndarray  # learned weight of each scaled feature
    bias: float

    def score(self, col) -> np.ndarray:
        text, f = _distinct(col, self.slot)
        z = self.bias + np.bincount(text, (self.ratio * self.weight)[f], len(col))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _counts(batches):
    total = np.zeros((2, 1 << BITS), np.int64)
    texts = np.zeros(2, np.int64)
    for whole in batches:
        for b in T.slices(whole, "text"):
            y = b.column("y").to_numpy(zero_copy_only=False)
            text, gram = _distinct(b.column("text"))
            for c in (0, 1):
                total[c] += np.bincount(gram[y[text] == c], minlength=1 << BITS)
                texts[c] += (y == c).sum()
    at = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[0, at], texts[0])),
                                      pa.array(np.append(total[1, at], texts[1]))], names=["gram", "n0", "n1"])


def _kept(slot: np.ndarray):
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                text, f = _distinct(b.column("text"), slot)
                heads = np.searchsorted(text, np.arange(b.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("y"), pa.array([f[i:j].astype(np.int32).tobytes() for i, j in zip(heads[:-1], heads[1:], strict=True)],
                                             pa.binary())], names=["y", "f"])
    return run


def _gain(n0, n1, t0, t1):
    """Log likelihood ratio of an n-gram's document counts in the two classes."""
    def part(n, t):
        p = np.clip(n / max(1, t), 1e-9, 1 - 1e-9)
        return n * np.log(p), (t - n) * np.log(1 - p)
    a, b, c, d = *part(n0, t0), *part(n1, t1)
    e, f = part(n0 + n1, t0 + t1)
    return a + b + c + d - e - f


def log_ratio(n0, n1, t0, t1):
    """Log ratio of an n-gram's smoothed document shares in toxic and other texts."""
    return np.log((n1 + 1) / (t1 + 2)) - np.log((n0 + 1) / (t0 + 2))


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", train_on: Column | None = None,
          text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """Fits the model on labelled documents for which ``train_on`` (of ``doc_id``) holds."""
    rows = cut_lineage(examples(docs.select("doc_id", F.col(text_col).cast("string").alias("text")), labels, target,
                                F.lit(True) if train_on is None else train_on, per_class).select("y", "text"), "examples")
    got = (rows.mapInArrow(_counts, "gram long, n0 long, n1 long").groupBy("gram")
           .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("gram < 0 or n0 + n1 > 1"))
    table = np.array([tuple(r) for r in got.collect()], np.int64).reshape(-1, 3)  # 2^BITS + 1 rows at most
    t0, t1 = table[table[:, 0] < 0, 1:].sum(axis=0).tolist()
    table = table[table[:, 0] >= 0]
    prior = (t1 + 1) / (t0 + t1 + 2)
    empty = Model(np.full(1 << BITS, -1), np.zeros(1), np.zeros(1), float(np.log(prior / (1 - prior))))
    if not t0 or not t1:
        return empty
    best = table[_gain(table[:, 1], table[:, 2], t0, t1) >= GAIN]
    best = best[np.argsort(best[:, 0])]
    if not len(best):
        return empty
    slot = np.full(1 << BITS, -1)
    slot[best[:, 0]] = np.arange(len(best))
    ratio = log_ratio(best[:, 1], best[:, 2], t0, t1)
    data = sorted((r["y"], bytes(r["f"])) for r in rows.mapInArrow(_kept(slot), "y int, f binary").collect())
    return fit(slot, ratio, [np.frombuffer(f, np.int32) for _, f in data],
               np.array([y for y, _ in data], np.float64))


def fit(slot: np.ndarray, ratio: np.ndarray, features: list[np.ndarray], y: np.ndarray) -> Model:
    """Logistic regression on the scaled features, by full-batch steps of adaptive size."""
    f = np.concatenate(features)
    row = np.repeat(np.arange(len(y), dtype=np.int32), [len(x) for x in features])
    x = ratio[f]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))  # classes weigh alike
    w, bias = np.zeros(len(ratio)), 0.0
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for t in range(1, STEPS + 1):
        z = bias + np.bincount(row, w[f] * x, len(y))
        err = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.append(np.bincount(f, err[row] * x, len(ratio)) + SHRINK * w, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g ** 2
        step = 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return Model(slot, ratio, w, float(bias))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, score)``: the probability of label 1 for every whole text."""
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(b.column("text")))],
                                                 names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))
