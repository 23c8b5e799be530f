"""Arrow/numpy helpers the text operators run inside Spark tasks.

A batch of texts is handled as one byte (or code point) array plus offsets, so
the work per byte is vectorised and no Python string is made per word.
Null texts count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# bytes handled at once by the hashing passes; bounds their scratch arrays
SLICE = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (a bijection)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_BASE = U64(0xD6E8FEB86659FD93)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(1, n), base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of each text); null is empty."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def codepoints(col) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, offsets of each text); null is empty."""
    data, offsets = text_bytes(col)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return cp, heads[offsets]


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z of a byte array lower-cased; other letters stay."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: (starts, ends, first word of each text)."""
    if len(data) == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, a slice of words at a time."""
    out = np.empty(len(starts), dtype=U64)
    lens = ends - starts
    total = np.concatenate([[0], np.cumsum(lens)])
    pw = powers(int(lens.max()) if len(lens) else 1)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE, "right")) - 1)
        ln, at = lens[i:j], total[i:j] - total[i]
        pos = np.arange(total[j] - total[i]) - np.repeat(at, ln)
        val = _BYTE_VALUE[data[np.repeat(starts[i:j], ln) + pos]] * pw[pos]
        out[i:j] = np.add.reduceat(val, at)
        i = j
    return mix(out ^ (lens.astype(U64) * U64(0x9E3779B97F4A7C15)))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's ``width``-word shingles, and where each text's begin.

    A text of fewer words gives the whole sequence as one shingle, a text
    without words none.
    """
    mult = mix(np.arange(1, width + 1, dtype=U64)) | U64(1)
    n_words = np.diff(first)
    n = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    heads = np.concatenate([[0], np.cumsum(n)])
    rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=U64)
    for k in range(width):
        rolled += hashes[k:k + len(rolled)] * mult[k]
    long = n_words >= width
    at = np.repeat(first[:-1] - heads[:-1], np.where(long, n, 0)) + np.flatnonzero(np.repeat(long, n))
    out = np.empty(heads[-1], dtype=U64)
    out[np.repeat(long, n)] = rolled[at]
    for i in np.flatnonzero((n_words > 0) & ~long):
        part = hashes[first[i]:first[i + 1]] * mult[:n_words[i]]
        out[heads[i]] = part.sum(dtype=U64) ^ U64(n_words[i])
    out = mix(out)
    for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[heads[:-1][n > 0]] = True
    count = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=count[1:])
    return out[new], count[heads]


def text_shingles(col, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingles` of a column of texts, A-Z lower-cased."""
    data, offsets = text_bytes(col)
    data = lower(data)
    starts, ends, first = words(data, offsets)
    return shingles(word_hashes(data, starts, ends), first, width)


def sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sum of each run ``heads[i]:heads[i + 1]``, modulo 2^64; an empty run sums to 0."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[heads[1:]] - total[heads[:-1]]


def slices(batch: pa.RecordBatch, col: str, limit: int = 1 << 20, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """A batch cut so that the texts of a piece hold about ``limit`` bytes at most (one text at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(size, done + limit, "right"))))
        yield batch.slice(at, to - at)
        at = to


class BitFilter:
    """A fixed-size bit table over 64-bit ids: no false negatives.

    The size never grows with the data, so shipping it to every task is
    bounded; on more ids it only lets more rows through, which a join removes.
    """

    BITS = 1 << 23

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def slots(cls, ids: np.ndarray) -> np.ndarray:
        return (mix(ids.astype(np.int64).view(U64)) % U64(cls.BITS)).astype(np.int64)

    @classmethod
    def of(cls, df, col: str) -> BitFilter:
        """Built by Spark: each task ORs its ids, the driver gets 2^17 words at most."""
        from pyspark.sql import functions as F

        def bits(batches):
            table = np.zeros(cls.BITS // 64, dtype=np.uint64)
            for b in batches:
                s = cls.slots(b.column(0).drop_null().to_numpy(zero_copy_only=False))
                np.bitwise_or.at(table, s >> 6, U64(1) << (s & 63).astype(U64))
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(table[at].view(np.int64))], names=["at", "bits"])

        got = (df.select(F.col(col).cast("long").alias("id")).mapInArrow(bits, "at long, bits long")
               .groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas())
        table = np.zeros(cls.BITS // 64, dtype=np.uint64)
        table[got["at"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
        return cls(table)

    def has(self, ids: np.ndarray) -> np.ndarray:
        s = self.slots(ids)
        return ((self.table[s >> 6] >> (s & 63).astype(U64)) & U64(1)).astype(bool)
