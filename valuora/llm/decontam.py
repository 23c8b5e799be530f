"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of ``m`` characters that occurs in a document with at most
``k`` edits shares at least ``m - q + 1 - q * k`` q-grams with it, and their
diagonals (document position less item position) span at most ``k``. Per
document the shared q-grams are counted in overlapping diagonal bands of width
``2 (k + 1)``, one band starting every ``k + 1`` diagonals, so one band holds
all of an occurrence. Bands that reach the lemma's count are regions, and a
banded alignment of the item decides each.

Texts are compared with A-Z and the capitals U+00C0 to U+00DE lower-cased and
whitespace runs as one blank;
q-grams and edits count UTF-8 bytes of that form. ``k`` is ``errors`` of the
item's length, less for items so short that the lemma's count would fall under
one. Items shorter than ``q`` must occur exactly. An item longer than ``WINDOW``
is looked for by windows of that length, half of which overlap, each with a
budget of its own: a document that quotes a part of it is found, and one that
holds all of it within the budget holds some window within its own. Windows that
meet in a text are one occurrence, whose ``edits`` are the most of one window.

The items' q-gram index goes to every task. It is built from pieces of about
``INDEX_BYTES`` of item text (one item at least): a larger benchmark takes one
pass over the documents per piece, and what is found, or left, is written after
every ``GROUP`` of them, so that neither a plan nor the driver holds more.

Defined results: null or empty documents and items match nothing; an id that is
null or repeated is carried as it is, each row by itself; empty tables give
empty results; extra columns are ignored (``clean`` keeps those of ``docs``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .shared import cut_lineage

Q = 8                    # bytes of a q-gram; one 64-bit word
ERRORS = 0.1             # edits allowed per byte of an item
WINDOW = 512             # bytes of an item, beyond which its windows are looked for
CELLS = 1 << 18          # cells of a row that alignments share
INDEX_BYTES = 4 << 20    # item text in one index
GROUP = 4                # indexes that one plan holds
MATCHES = "doc_id long, item_id long, start long, end long, edits long"


def normal(data: np.ndarray, offsets: np.ndarray):
    """(normal form, its offsets, the byte position each of its bytes comes from)."""
    low = T.lower(data)
    if len(low):  # capitals of U+00C0..U+00DE are two bytes, the second 32 below its small letter's
        wide = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][wide] += 32
    gap = T._SPACE[low] if len(low) else np.zeros(0, bool)
    low = np.where(gap, np.uint8(32), low)
    drop = np.zeros(len(low), bool)
    drop[1:] = gap[1:] & gap[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    drop[heads] = gap[heads]  # a text begins with a word
    at = np.flatnonzero(~drop)
    return low[at], np.searchsorted(at, offsets), at


def qgrams(norm: np.ndarray) -> np.ndarray:
    """The 64-bit word of the ``Q`` bytes at each position (the last ``Q - 1`` are padded)."""
    n = len(norm)
    padded = np.zeros(n + 2 * Q, np.uint8)
    padded[:n] = norm
    out = np.empty(n, np.uint64)
    for o in range(min(Q, n)):
        part = out[o::Q]
        part[:] = padded[o:o + Q * len(part)].view("<u8")
    return out


def windows(norm: np.ndarray) -> list[np.ndarray]:
    """An item, or the overlapping windows of a long one; the last one ends with it."""
    if len(norm) <= WINDOW:
        return [norm]
    heads = [*range(0, len(norm) - WINDOW, WINDOW // 2), len(norm) - WINDOW]
    return [norm[a:a + WINDOW] for a in heads]


class Index:
    """Postings of the items' q-grams, behind a small table of their hashes."""

    def __init__(self, items: list[tuple[int | None, str]], errors: float):
        self.ids, self.texts, self.budget, self.need = [], [], [], []
        grams, item, pos = [], [], []
        self.short, self.long = [], set()
        for item_id, text in items:
            data, offsets = T.text_bytes(pa.array([text], pa.string()))
            norm = normal(data, offsets)[0]
            if len(norm) and norm[-1] == 32:
                norm = norm[:-1]
            m = len(norm)
            if not m:
                continue
            if m < Q:
                self.short.append((item_id, norm.tobytes()))
                continue
            if m > WINDOW:
                self.long.add(item_id)
            for norm in windows(norm):
                m = len(norm)
                k = min(int(errors * m), (m - Q) // Q)
                g = qgrams(norm)[:m - Q + 1]
                grams.append(g)
                item.append(np.full(len(g), len(self.ids)))
                pos.append(np.arange(len(g)))
                self.ids.append(item_id)
                self.texts.append(norm)
                self.budget.append(k)
                self.need.append(m - Q + 1 - Q * k)
        self.budget, self.need = np.array(self.budget, np.int64), np.array(self.need, np.int64)
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        grams, item, pos = cat(grams, np.uint64), cat(item, np.int64), cat(pos, np.int64)
        order = np.argsort(grams, kind="stable")
        self.keys, self.first = np.unique(grams[order], return_index=True)
        self.first = np.append(self.first, len(grams))
        self.item, self.pos = item[order], pos[order]
        self.bits = min(24, max(16, int(32 * len(self.keys)).bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.slot(self.keys)] = True

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * T.U64(0x9E3779B97F4A7C15)) >> T.U64(64 - self.bits)).astype(np.int64)

    def regions(self, norm: np.ndarray, offsets: np.ndarray):
        """Rows (text, item, first diagonal, last diagonal) of bands that reach the lemma's count.

        Bands of one text and item that touch are one row.
        """
        none = np.zeros((0, 4), np.int64)
        if not len(norm) or not len(self.keys):
            return none
        grams = qgrams(norm)
        at = np.flatnonzero(self.seen[self.slot(grams)])
        k = np.searchsorted(self.keys, grams[at])
        ok = (k < len(self.keys)) & (self.keys[np.minimum(k, len(self.keys) - 1)] == grams[at])
        at, k = at[ok], k[ok]
        doc = np.searchsorted(offsets, at, "right") - 1
        ok = at + Q <= offsets[doc + 1]
        at, k, doc = at[ok], k[ok], doc[ok]
        if not len(at):
            return none
        n = self.first[k + 1] - self.first[k]
        post = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
        doc, at, item = np.repeat(doc, n), np.repeat(at, n), self.item[post]
        # texts that share too few q-grams with an item in all need no bands
        name = doc * len(self.ids) + item
        if (len(offsets) - 1) * len(self.ids) <= 8 * len(name) + 1_000_000:
            ok = np.bincount(name)[name] >= self.need[item]
        else:
            _, inv, count = np.unique(name, return_inverse=True, return_counts=True)
            ok = count[inv] >= self.need[item]
        doc, at, item, post = doc[ok], at[ok], item[ok], post[ok]
        if not len(at):
            return none
        diag = at - self.pos[post] - offsets[doc]
        step = self.budget[item] + 1
        band = diag // step
        low = band.min() - 1
        width = band.max() - low + 1
        key = (doc * len(self.ids) + item) * width + band - low
        key, count = np.unique(key, return_counts=True)  # q-grams per half band
        # a band is a half and the next one
        head = np.unique(np.concatenate([key, key - 1]))
        both = np.append(count, 0)
        for half in (head, head + 1):
            at = np.searchsorted(key, half)
            same = key[np.minimum(at, len(key) - 1)] == half
            total = np.where(same, both[np.minimum(at, len(key))], 0) + (0 if half is head else total)
        item = head // width % len(self.ids)
        head = head[total >= self.need[item]]
        rows = np.stack([head // width // len(self.ids), head // width % len(self.ids), head % width + low], axis=1)
        if not len(rows):
            return none
        new = np.ones(len(rows), bool)
        new[1:] = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0) | (np.diff(rows[:, 2]) > 2)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(rows)) - 1
        step = self.budget[rows[head, 1]] + 1
        return np.stack([rows[head, 0], rows[head, 1], rows[head, 2] * step, (rows[last, 2] + 2) * step - 1], axis=1)

    def matches(self, norm: np.ndarray, offsets: np.ndarray):
        """Rows (text, item id, start, end, edits) in positions of the normal form; a long item's windows joined."""
        open_: dict[tuple, list] = {}
        for row in sorted(self.found(norm, offsets), key=lambda r: (r[0], r[2])):
            if row[1] not in self.long:
                yield row
                continue
            d, item_id, start, end, edits = row
            last = open_.get((d, item_id))
            if last is not None and start <= last[3]:
                last[3], last[4] = max(last[3], end), max(last[4], edits)
            else:
                if last is not None:
                    yield tuple(last)
                open_[d, item_id] = list(row)
        yield from map(tuple, open_.values())

    def found(self, norm: np.ndarray, offsets: np.ndarray):
        """Rows of items and of windows."""
        open_: dict[int, list] = {}  # by item length: regions to align
        for d, i, low, high in self.regions(norm, offsets).tolist():
            item, k = self.texts[i], int(self.budget[i])
            skip = max(0, low - k)
            a = skip + offsets[d]
            b = min(offsets[d + 1], offsets[d] + high + len(item) + k)
            part = norm[a:b]
            exact = part.tobytes().find(item.tobytes())
            if exact >= 0:
                yield d, self.ids[i], a + exact, a + exact + len(item), 0
            elif k:
                open_.setdefault(len(item), []).append((d, self.ids[i], a, (item, part, k, low - k - skip, high + k - skip)))
        for regions in open_.values():
            for (d, item_id, a, _), hit in zip(regions, align([r[3] for r in regions]), strict=True):
                if hit is not None:
                    yield d, item_id, a + hit[0], a + hit[1], hit[2]
        for item_id, word in self.short:
            for d in range(len(offsets) - 1):
                at = norm[offsets[d]:offsets[d + 1]].tobytes().find(word)
                if at >= 0:
                    yield d, item_id, offsets[d] + at, offsets[d] + at + len(word), 0


def _best_ends(items: list[np.ndarray], parts: list[np.ndarray], first: np.ndarray, width: int,
               free_start: bool) -> tuple[np.ndarray, np.ndarray]:
    """(least edits, end in its part) of each item along ``width`` diagonals of its part from ``first`` on.

    A diagonal is a position in the part less one in the item. Only the band's
    cells are filled, a row for each byte, those of all items (of one length) at
    once. An item starts on any of the diagonals, or (not ``free_start``) at 0.
    """
    m = len(items[0])
    item, n = np.stack(items), np.array([len(p) for p in parts])[:, None]
    text = np.full((len(parts), m + width), -1, np.int16)  # column c: the byte at first + c
    for r, (part, f) in enumerate(zip(parts, first.tolist(), strict=True)):
        a, b = max(0, f), min(len(part), f + m + width)
        if a < b:
            text[r, a - f:b - f] = part[a:b]
    far, band, first = 2 * (m + width) + 1, np.arange(width, dtype=np.int32), first[:, None]
    at = first + band  # positions in the part
    row = np.where((at >= 0) & (at <= n), 0 if free_start else np.abs(at), far).astype(np.int32)
    for i in range(m):
        at += 1
        new = row + (text[:, i:i + width] != item[:, i:i + 1])        # same diagonal
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])      # a byte of the item left out
        new[at == 0] = i + 1                                          # nothing of the part used
        outside = (at < 0) | (at > n)
        new[outside] = far
        row = np.minimum.accumulate(new - band, axis=1) + band        # bytes of the part left out
        row[outside] = far
    best = row.argmin(axis=1)
    return row[np.arange(len(row)), best], m + first[:, 0] + best


def align(regions: list[tuple]) -> list[tuple[int, int, int] | None]:
    """(start, end, edits) of the best occurrence in each region ``(item, part, k, first, last)``, or None.

    Items are of one length. An occurrence takes ``k`` edits at most on the
    region's diagonals ``first`` to ``last``. Regions share rows of ``CELLS`` cells.
    """
    out: list = [None] * len(regions)
    size = [r[4] - r[3] + 1 for r in regions]
    todo = sorted(range(len(regions)), key=size.__getitem__)
    while todo:
        n = 1
        while n < len(todo) and (n + 1) * (len(regions[0][0]) + size[todo[n]]) <= CELLS:
            n += 1
        some, todo = todo[:n], todo[n:]
        first = np.array([regions[r][3] for r in some])
        edits, end = _best_ends([regions[r][0] for r in some], [regions[r][1] for r in some], first, max(size[r] for r in some), True)
        hit = [x for x in range(n) if edits[x] <= regions[some[x]][2]]
        if not hit:
            continue
        # backwards from the end: the start lies within k of where it would without edits
        k = max(regions[some[x]][2] for x in hit)
        items = [regions[some[x]][0][::-1] for x in hit]
        backs = [regions[some[x]][1][max(0, end[x] - len(items[0]) - k):end[x]][::-1] for x in hit]
        _, length = _best_ends(items, backs, np.full(len(hit), -k), 2 * k + 1, False)
        for x, used in zip(hit, length.tolist(), strict=True):
            out[some[x]] = int(end[x]) - used, int(end[x]), int(edits[x])
    return out


def _find(index: Index):
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, "text"):
                data, offsets = T.text_bytes(b.column("text"))
                norm, ends, origin = normal(data, offsets)
                rows = sorted(index.matches(norm, ends), key=lambda r: (r[0], r[2], r[3]))
                if not rows:
                    continue
                heads = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
                d = np.array([r[0] for r in rows])
                start = heads[origin[[r[2] for r in rows]]] - heads[offsets[d]]
                stop = heads[origin[[r[3] - 1 for r in rows]]] + 1 - heads[offsets[d]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(d)), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array(start), pa.array(stop), pa.array([r[4] for r in rows], pa.int64())],
                    names=["doc_id", "item_id", "start", "end", "edits"])
    return run


def _without(index: Index, text_col: str):
    def run(batches):
        for whole in batches:
            for b in T.slices(whole, text_col):
                norm, ends, _ = normal(*T.text_bytes(b.column(text_col)))
                hit = np.zeros(b.num_rows, bool)
                hit[[r[0] for r in index.matches(norm, ends)]] = True
                yield b.filter(pa.array(~hit))
    return run


def _indexes(benchmark: DataFrame, id_col: str, text_col: str, errors: float):
    """One index per piece of the benchmark, each of bounded size.

    Items go to pieces by hash; their number follows from the benchmark's bytes.
    """
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.where("length(text) > 0").distinct()
    size = F.octet_length("text") * F.when(F.octet_length("text") > WINDOW, 2).otherwise(1)  # windows overlap
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    pieces = max(1, -(-2 * total // INDEX_BYTES))
    items = items.withColumn("piece", F.pmod(F.xxhash64("id", "text"), F.lit(pieces)))
    for p in range(pieces):
        rows = items.where(F.col("piece") == p).select("id", "text").orderBy("id", "text").collect()  # INDEX_BYTES, about
        index = Index([(r["id"], r["text"]) for r in rows], errors)
        if index.ids or index.short:
            yield index


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
         item_id: str = "item_id", item_text: str = "text", errors: float = ERRORS) -> DataFrame:
    """Occurrences ``(doc_id, item_id, start, end, edits)``; code points, end exclusive."""
    text = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).cast("string").alias("text"))
    out, done = None, None
    for n, index in enumerate(_indexes(benchmark, item_id, item_text, errors), 1):
        part = text.mapInArrow(_find(index), MATCHES)
        out = part if out is None else out.unionByName(part)
        if n % GROUP == 0:
            out = cut_lineage(out, "occurrences")
            done, out = (out if done is None else done.unionByName(out)), None
    parts = [p for p in (done, out) if p is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], MATCHES)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def clean(docs: DataFrame, benchmark: DataFrame, doc_text: str = "text", item_id: str = "item_id",
          item_text: str = "text", errors: float = ERRORS) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, all columns kept."""
    for n, index in enumerate(_indexes(benchmark, item_id, item_text, errors), 1):
        docs = docs.mapInArrow(_without(index, doc_text), docs.schema)
        if n % GROUP == 0:
            docs = cut_lineage(docs, "uncontaminated")
    return docs
