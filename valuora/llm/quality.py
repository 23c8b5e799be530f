"""Quality classifier: a factorisation machine over whole texts.

Inputs of a score are the text's hashed words (each distinct word once, the
vector scaled to length 1), structure statistics of the text and the numeric
metadata columns named by the caller. The machine adds a weight per input and,
for every pair of inputs, the product of their values and of the dot product
of their low-rank vectors; the pairs cost linear time by the sum-of-squares
identity ``sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2``.

The model is fitted with mini-batches on the driver, on at most ``PER_CLASS``
labelled documents of each class (a bounded sample, see ``shared.examples``);
every document is scored inside Spark tasks.

Defined results: a null or empty text is scored as a text without words; null
or non-finite metadata count as the training mean; every row gives one row,
repeated ids and null ids included; an empty table gives an empty result; a
class without labelled rows leaves the prior; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .shared import examples

WORD_BITS = 14       # hashed words: 2^14 inputs
RANK = 8             # length of the pair vectors
PER_CLASS = 4000     # labelled documents of each class the fit may use
EPOCHS, BATCH, RATE, SHRINK = 12, 128, 0.05, 1e-4

_CLASSES = {
    "upper": bytes(range(65, 91)), "letter": bytes(range(97, 123)), "digit": b"0123456789",
    "stop": b".,;:?", "bang": b"!", "bar": b"|", "sign": b"#$%&*@^~<>{}[]\\=+_`", "quote": b"\"'()-/",
    "line": b"\n", "wide": bytes(range(128, 256)),
}
_TABLES = np.zeros((len(_CLASSES), 256), bool)
for _i, _chars in enumerate(_CLASSES.values()):
    _TABLES[_i, list(_chars)] = True
STATS = len(_CLASSES) + 7


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def inputs(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word inputs of all texts, first of each text, statistics of each text)."""
    raw, offsets = T.text_bytes(col)
    data = T.lower(raw)
    starts, ends, first = T.words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashed = T.word_hashes(data, starts, ends)
    # one sort by (text, hash): its runs are the distinct words, and those of the top bits the inputs
    key = np.sort((doc.astype(T.U64) << T.U64(44)) | (hashed >> T.U64(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    run = np.flatnonzero(new)
    run_doc = (key[run] >> T.U64(44)).astype(np.int64)
    size = np.diff(np.append(run, len(key)))
    n_texts = len(offsets) - 1
    n_words = np.diff(first)
    n_distinct = np.bincount(run_doc, minlength=n_texts)
    most = np.zeros(n_texts, np.int64)
    np.maximum.at(most, run_doc, size)
    slot = key[run] >> T.U64(44 - WORD_BITS)
    slot = slot[np.append(True, slot[1:] != slot[:-1])] if len(slot) else slot
    word = (slot & T.U64((1 << WORD_BITS) - 1)).astype(np.int64)
    heads = np.searchsorted((slot >> T.U64(WORD_BITS)).astype(np.int64), np.arange(n_texts + 1))

    n_bytes = np.maximum(1, np.diff(offsets))
    some = np.maximum(1, n_words)
    lens = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=lens[1:])
    # words that repeat the word four places back or the pair before: loops
    far = np.zeros(len(hashed), bool)
    far[1:] = hashed[1:] == hashed[:-1]
    pair = hashed[1:] * T.U64(3) + hashed[:-1] if len(hashed) > 1 else hashed[:0]
    pair_key = np.sort((doc[1:].astype(T.U64) << T.U64(44)) | (T.mix(pair) >> T.U64(20))) if len(pair) else pair
    fresh = np.ones(len(pair_key), bool)
    fresh[1:] = pair_key[1:] != pair_key[:-1]
    n_pairs = np.bincount((pair_key[fresh] >> T.U64(44)).astype(np.int64), minlength=n_texts)
    stats = [_per_text(t[raw], offsets) / n_bytes for t in _TABLES]
    stats += [np.log1p(np.diff(offsets)), np.log1p(n_words), (lens[first[1:]] - lens[first[:-1]]) / some,
              n_distinct / some, most / some, n_pairs / some, _per_text(far, first) / some]
    return word, heads, np.stack(stats, axis=1).astype(np.float64)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray   # of words, then statistics, then metadata
    pairs: np.ndarray    # (inputs, RANK)
    mean: np.ndarray     # of statistics and metadata
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        x = np.where(np.isfinite(stats), (stats - self.mean) / self.scale, 0.0)
        return np.clip(x, -4, 4) / np.sqrt(len(self.mean))

    def sums(self, word: np.ndarray, heads: np.ndarray, dense: np.ndarray):
        """Per text: linear part, sum of v x, sum of squares of v x."""
        n = np.diff(heads)
        x = np.repeat(1 / np.sqrt(np.maximum(1, n)), n)
        words = 1 << WORD_BITS
        vx = self.pairs[word] * x[:, None]
        doc = np.repeat(np.arange(len(n)), n)
        lin = self.bias + np.bincount(doc, self.weight[word] * x, len(n)) + dense @ self.weight[words:]
        tail = self.pairs[words:]
        s, q = dense @ tail, (dense ** 2) @ (tail ** 2)
        full = np.flatnonzero(n)
        if len(full):
            s[full] += np.add.reduceat(vx, heads[full], axis=0)
            q[full] += np.add.reduceat(vx ** 2, heads[full], axis=0)
        return lin, s, q, x, vx, doc

    def score(self, word, heads, stats) -> np.ndarray:
        lin, s, q, *_ = self.sums(word, heads, self.dense(stats))
        z = lin + 0.5 * (s ** 2 - q).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(word: list[np.ndarray], stats: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine:
    """Mini-batch fit of the logistic loss with per-input step sizes."""
    rng = np.random.default_rng(seed)
    d = (1 << WORD_BITS) + stats.shape[1]
    scale = stats.std(axis=0) if len(stats) else np.ones(stats.shape[1])
    prior = (y.sum() + 1) / (len(y) + 2)
    m = Machine(float(np.log(prior / (1 - prior))), np.zeros(d), rng.normal(0, 0.05, (d, RANK)),
                np.nan_to_num(stats.mean(axis=0)) if len(stats) else np.zeros(stats.shape[1]),
                np.where(scale > 1e-9, scale, 1.0))
    if not len(y) or y.min() == y.max():
        m.pairs[:] = 0
        return m
    dense = m.dense(stats)
    gw, gv, gb, words = np.full(d, 1e-6), np.full((d, RANK), 1e-6), 1e-6, 1 << WORD_BITS
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            w = np.concatenate([word[r] for r in rows])
            heads = np.append(0, np.cumsum([len(word[r]) for r in rows]))
            x_dense = dense[rows]
            lin, s, q, x, vx, doc = m.sums(w, heads, x_dense)
            z = lin + 0.5 * (s ** 2 - q).sum(axis=1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            part = err[doc] * x
            g = np.zeros(d)
            g[:words] = np.bincount(w, part, words)
            g[words:] = err @ x_dense
            g += SHRINK * m.weight
            h = SHRINK * m.pairs
            pull = part[:, None] * (s[doc] - vx)
            for f in range(RANK):
                h[:words, f] += np.bincount(w, pull[:, f], words)
            h[words:] += x_dense.T @ (err[:, None] * s) - ((x_dense ** 2).T @ err)[:, None] * m.pairs[words:]
            gw += g ** 2
            gv += h ** 2
            gb += err.sum() ** 2
            m.weight -= RATE * g / np.sqrt(gw)
            m.pairs -= RATE * h / np.sqrt(gv)
            m.bias -= RATE * err.sum() / np.sqrt(gb)
    return m


def _meta(b: pa.RecordBatch, names: list[str]) -> np.ndarray:
    cols = [np.log1p(np.abs(b.column(n).to_numpy(zero_copy_only=False).astype(np.float64))) for n in names]
    return np.stack(cols, axis=1) if cols else np.zeros((b.num_rows, 0))


def _features(names: list[str]):
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                word, heads, stats = inputs(b.column("text"))
                stats = np.concatenate([stats, _meta(b, names)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("y"),
                     pa.array([word[i:j].astype(np.uint16).tobytes() for i, j in zip(heads[:-1], heads[1:], strict=True)], pa.binary()),
                     pa.array([r.tobytes() for r in stats], pa.binary())], names=["y", "word", "stats"])
    return run


def _score(machine: Machine, names: list[str]):
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                word, heads, stats = inputs(b.column("text"))
                out = machine.score(word, heads, np.concatenate([stats, _meta(b, names)], axis=1))
                yield b.drop_columns(["text", *names]).append_column("score", pa.array(out))
    return run


def _as_inputs(docs: DataFrame, text_col: str, metadata: list[str]) -> tuple[list[Column], list[str]]:
    names = [f"meta_{i}" for i in range(len(metadata))]
    return ([F.col(text_col).cast("string").alias("text")]
            + [F.col(c).cast("double").alias(n) for c, n in zip(metadata, names, strict=True)], names)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", train_on: Column | None = None,
          text_col: str = "text", metadata: tuple[str, ...] = (), per_class: int = PER_CLASS) -> Machine:
    """Fits the machine on labelled documents for which ``train_on`` (of ``doc_id``) holds."""
    cols, names = _as_inputs(docs, text_col, list(metadata))
    rows = (examples(docs.select("doc_id", *cols), labels, target, F.lit(True) if train_on is None else train_on, per_class)
            .select("y", "text", *names).mapInArrow(_features(names), "y int, word binary, stats binary").collect())
    word = [np.frombuffer(r["word"], np.uint16).astype(np.int64) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["y"], bytes(rows[i]["word"]), bytes(rows[i]["stats"])))
    stats = (np.stack([np.frombuffer(r["stats"], np.float64) for r in rows]) if rows
             else np.zeros((0, STATS + len(names))))
    return fit([word[i] for i in order], stats[order], np.array([rows[i]["y"] for i in order], np.float64))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
          metadata: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(doc_id, score)``: the probability of label 1 for every whole text."""
    cols, names = _as_inputs(docs, text_col, list(metadata))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), *cols)
            .mapInArrow(_score(machine, names), "doc_id long, score double"))


def keep_good(docs: DataFrame, machine: Machine, text_col: str = "text", metadata: tuple[str, ...] = (),
              threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns kept."""
    meta = list(metadata)

    def run(batches):
        for whole in batches:
            for b in T.slices(whole, text_col):
                word, heads, stats = inputs(b.column(text_col))
                s = machine.score(word, heads, np.concatenate([stats, _meta(b, meta)], axis=1))
                yield b.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)
