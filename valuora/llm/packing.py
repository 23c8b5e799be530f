"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Documents, longest first, go to the
open bin with the least room that still holds them. If none does, a bin is
opened: every permitted length that holds the document is priced by its cost
per token times the tokens it would use, which are the document's, plus the
room that the documents still to come cannot fill; the least price wins, the
shorter length on a tie. At the end each bin is downsized to the shortest
permitted length that holds its contents.

A document's tokens are its words ``[^\\x20\\x09-\\x0D]+`` and one end mark. A
document longer than the longest sequence is cut into full sequences, which are
bins of their own, and a rest that is packed.

Spark deals the documents into shards of about ``SHARD`` rows by a hash of
their place in the table of lengths (so no key is hot) and packs the shards in
parallel; only ids and lengths are shuffled.

Defined results: null and empty texts are packed as their end mark alone; null
and repeated ids are packed row by row; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut_lineage

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD = 4096
WORD = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
PACKED = ("doc_id long, piece long, first_word long, length long, bin_id long, bin_offset long, "
          "capacity long, bin_used long")


def cost(capacity: int) -> float:
    """Price of a sequence: its tokens, and attention that grows with their square."""
    return capacity * (1 + capacity / 32768)


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES):
    """(bin of each item, offset of each item, capacity of each bin, contents of each bin).

    Items must be at least 1 and at most the largest capacity long.
    """
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order].tolist()
    left = np.append(np.cumsum(lengths[order][::-1])[::-1], 0).tolist()  # tokens from an item on
    falling = [-s for s in size]
    bins, offsets = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, sorted
    for i, s in enumerate(size):
        at = bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            best = None
            for c in capacities:
                if c >= s:
                    to_come = left[max(i + 1, bisect_left(falling, s - c))]  # items no longer than the room
                    price = cost(c) / c * (s + max(0, c - s - to_come))
                    if best is None or price < best[0]:
                        best = (price, c)
            free, b = best[1], len(used)
            used.append(0)
        bins[order[i]], offsets[order[i]] = b, used[b]
        used[b] += s
        if free > s:
            insort(room, (free - s, b))
    fill = np.array(used, np.int64)
    return bins, offsets, np.array(capacities, np.int64)[np.searchsorted(capacities, fill)], fill


def tokens(text: Column) -> Column:
    """Words of a text and its end mark, which is added as a word: each becomes one letter, with what lies before it."""
    return F.length(F.regexp_replace(F.concat(F.coalesce(text, F.lit("")), F.lit(" .")), F.lit(WORD), F.lit("w"))).cast("long")


def _pack_shard(capacities: tuple[int, ...]):
    top = capacities[-1]

    def run(key, table):
        table = table.sort_by("row")
        n = table.column("length").to_numpy()
        full, rest = n // top, n % top
        some = np.flatnonzero(rest)
        bins, offsets, capacity, fill = best_fit(rest[some], capacities)
        own = np.repeat(np.arange(len(n)), full)  # full sequences, then the rests
        piece = np.arange(len(own)) - np.repeat(np.cumsum(full) - full, full)
        doc = np.concatenate([own, some])
        local = np.concatenate([np.arange(len(own)) + len(fill), bins])
        one = lambda v: np.full(len(own), v)
        piece = np.concatenate([piece, full[some]])
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(doc)),
            "piece": piece, "first_word": piece * top,
            "length": np.concatenate([one(top), rest[some]]),
            "bin_id": (key[0].as_py() << 32) + local,
            "bin_offset": np.concatenate([one(0), offsets]),
            "capacity": np.concatenate([one(top), capacity[bins]]),
            "bin_used": np.concatenate([one(top), fill[bins]])})
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         capacities: tuple[int, ...] = CAPACITIES, shard: int = SHARD) -> DataFrame:
    """One row per document piece: where it starts, and its place in which bin of which length."""
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    # counted in Spark's own functions: no text is copied to Python or to buffers outside the heap
    lengths = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                      tokens(F.col(text_col).cast("string")).alias("length"),
                                      F.monotonically_increasing_id().alias("row")), "lengths")
    shards = max(1, -(-lengths.count() // shard))
    return (lengths.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("long"))
            .groupBy("shard").applyInArrow(_pack_shard(capacities), PACKED))
