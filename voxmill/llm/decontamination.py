"""Benchmark decontamination by q-gram lemma filtering.

Texts are lower-cased and runs of white space become one space.  An occurrence of an item of m characters with at most
e edits shares at least m - q + 1 - q * e of its q-grams with the item, all on diagonals within e of each other.  So
q-gram hits are counted by item in overlapping diagonal bands of 2 * (e + 1), regions with enough hits are kept, and
each is verified by alignment in the band.  The scan only maps over documents; the item index goes to every task.  A
benchmark of over BLOCK characters takes a scan for each block of items; one block at a time is on the driver and in the
tasks, and what a scan has found is written before the next.

e is `RATE` of the item's length, lowered for short items until the bound asks for two shared q-grams.  Edge cases:
null text is the empty text; items under q characters match nothing; repeated items and documents are reported each;
empty tables give empty results; extra columns are ignored by the search and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, map_arrow, table, whole_text

Q, RATE = 8, 0.1
BLOCK = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288], np.uint32)
BITS = 22
SCHEMA = "doc_id long, item_id long, edits int, start long, end long"


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code points with folded case and white space, their places in the text)."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (codes == 32) | ((codes < 14) & (codes > 8)) | ((codes < 32) & (codes > 27))
    rare = np.flatnonzero((codes == 133) | (codes == 160) | (codes >= 5760))
    if len(rare):
        space[rare] = np.isin(codes[rare], _SPACES)
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return np.where(space, np.uint32(32), codes)[keep], np.flatnonzero(keep)


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each q-gram (q = 8), by doubling."""
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        for k in (1, 2, 4):
            x = x[:-k] * _BASE ** np.uint64(k) + x[k:]
        return x ^ (x >> np.uint64(29))


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


class Index:
    """q-grams of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.codes, self.budget, self.least = [], [], [], []
        hashes, owner, place = [], [], []
        for item_id, text in items:
            codes = normal(text.strip())[0]
            m = len(codes)
            if m < Q:
                continue
            e = max(0, min(int(RATE * m), (m - Q - 1) // Q))
            h = grams(codes)
            hashes.append(h)
            owner.append(np.full(len(h), len(self.ids), np.int32))
            place.append(np.arange(len(h), dtype=np.int32))
            self.ids.append(item_id)
            self.codes.append(codes)
            self.budget.append(e)
            self.least.append(m - Q + 1 - Q * e)
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int32))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int32))[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[slot(self.hash)] = True
        #: What diagonals are raised by, so that none is negative.
        self.shift = max((len(c) for c in self.codes), default=0) + Q
        self.width = np.array([e + 1 for e in self.budget], np.int64)
        self.need = np.array(self.least, np.int64)


def align(item: np.ndarray, window: np.ndarray, budget: int) -> tuple[int, int, int]:
    """(edits, start, end) of the cheapest occurrence of the item on the diagonals of a band; rows cut by budget.

    window: as many code points as the item has and one less than the band has diagonals; the item may start on any.
    """
    whole = window.tobytes().find(item.tobytes())
    if whole >= 0 and whole % 4 == 0:  # a whole diagonal agrees
        return 0, whole // 4, whole // 4 + len(item)
    width = len(window) - len(item) + 1
    cost = np.zeros(width, np.int32)
    start = np.arange(width)
    steps = np.arange(width, dtype=np.int32)
    for k, c in enumerate(item):
        best, from_ = cost + (window[k : k + width] != c), start.copy()
        # a code point of the item that the text lacks comes from the next diagonal
        up = cost[1:] + 1
        take = up < best[:-1]
        best[:-1][take], from_[:-1][take] = up[take], start[1:][take]
        # and one of the text that the item lacks from the one before: best[j] = min over i <= j of best[i] + (j - i)
        lifted = best - steps
        low = np.minimum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == low, steps, 0))
        cost, start = (low + steps).astype(np.int32), from_[source]
        if cost.min() > budget:
            return budget + 1, 0, 0
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end + len(item)


def occurrences(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of the best occurrence of each item in each text; start and end in code points."""
    if not index.ids or not texts:
        return []
    both = [normal(t) for t in texts]
    sizes = np.array([len(c) + Q for c, _ in both])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.full(int(starts[-1]), 0xFFFFFFFF, np.uint32)
    for a, (codes, _) in zip(starts, both, strict=False):
        joined[a : a + len(codes)] = codes
    h = grams(joined)
    at = np.flatnonzero(index.seen[slot(h)])
    lo = np.searchsorted(index.hash, h[at], "left")
    hi = np.searchsorted(index.hash, h[at], "right")
    times = hi - lo
    keep = times > 0
    at, lo, times = at[keep], lo[keep], times[keep]
    if not len(at):
        return []
    which = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
    at = np.repeat(at, times)
    item, place = index.owner[which].astype(np.int64), index.place[which].astype(np.int64)
    diagonal = at - place + index.shift
    band = diagonal // index.width[item]
    # a diagonal lies in the band that begins at its step and in the one before
    key = np.concatenate([item << 44 | band, item << 44 | (band - 1)])
    key, count = np.unique(key, return_counts=True)
    good = count >= index.need[key >> 44]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    # bands of the most hits come first: an exact occurrence ends the search for its item
    for k in key[good][np.argsort(-count[good], kind="stable")].tolist():
        i, b = k >> 44, k & ((1 << 44) - 1)
        first = b * int(index.width[i]) - index.shift
        e, m = index.budget[i], len(index.codes[i])
        doc = int(np.searchsorted(starts, min(max(first + e + m // 2, 0), starts[-1] - 1), "right")) - 1
        if (doc, i) in best and not best[doc, i][0]:
            continue
        # diagonals e before the band to e behind it; what lies outside of the text agrees with nothing
        from_, to = first - e, first + 2 * (e + 1) + e + m
        lo, hi = max(from_, int(starts[doc])), min(to, int(starts[doc + 1]) - Q)
        if hi - lo < m - e:  # an occurrence has that many code points
            continue
        window = np.full(to - from_, 0xFFFFFFFE, np.uint32)
        window[lo - from_ : hi - from_] = joined[lo:hi]
        edits, a, z = align(index.codes[i], window, e)
        if edits <= e:
            length = int(starts[doc + 1] - starts[doc]) - Q
            place = from_ - int(starts[doc])
            found = (edits, min(max(place + a, 0), length - 1), min(max(place + z, 0), length))
            if (doc, i) not in best or found < best[doc, i]:
                best[doc, i] = found
    out = []
    for (doc, i), (edits, a, z) in sorted(best.items()):
        place = both[doc][1]
        out.append((doc, index.ids[i], edits, int(place[a]), int(place[z - 1]) + 1 if z else 0))
    return out


def indexes(benchmark: DataFrame) -> tuple[int, Iterator[Index]]:
    """(number of blocks of items, their indexes one after the other)."""
    items = benchmark.select(F.col("item_id").cast("long"), whole_text().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // BLOCK))
    blocks = (items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == k) if parts > 1 else items for k in range(parts))
    return parts, (Index(sorted((tuple(r) for r in b.collect()), key=lambda r: (r[0] is None, r[0], r[1]))) for b in blocks)


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    parts, blocks = indexes(benchmark)
    out = None
    for index in blocks:

        def find(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            ids = batch.column(0).to_pylist()
            rows = [(ids[d], *rest) for d, *rest in occurrences(batch.column(1).to_pylist(), index)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "item_id", "edits", "start", "end"])

        part = map_arrow(slim, find, SCHEMA)
        part = durable(part, "contaminated") if parts > 1 else part
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, in which no item occurs."""
    at = docs.columns.index("text")
    parts, blocks = indexes(benchmark)
    for index in blocks:

        def keep(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            bad = np.zeros(batch.num_rows, bool)
            for d, *_ in occurrences([t or "" for t in batch.column(at).to_pylist()], index):
                bad[d] = True
            return batch.filter(pa.array(~bad))

        docs = map_arrow(docs, keep, docs.schema)
        docs = durable(docs, "decontaminated") if parts > 1 else docs
    return docs


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
