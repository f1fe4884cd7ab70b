"""Document fingerprints: an invertible Bloom lookup sketch of paragraph digests.

A text's lines are its paragraphs; a paragraph is cut further behind words whose hash is divisible by `CUT` (and
behind one character in `LONG`, which cuts text without white space), so that an edit inside a long paragraph changes
few elements.  An element is the 64-bit digest of a piece together with how often it has stood before, so equal pieces
stay apart.  The sketch has `CELLS` cells of (count, xor of digests, xor of check
sums) and each element lies in three of them.  Two sketches subtract cell by cell; peeling the difference returns the
digests that only one side has.  Where peeling fails, both sides are sketched again with sixteen times the cells, until it
succeeds, so the likeness 1 - |difference| / |union| is that of the full sets.  A fingerprint is a sketch's cells in
base 64: counts and the low halves of check sums of 32 bits, digests of 64.  A reader can subtract two and peel a difference of
some thirty elements; a greater one takes the larger sketches that are made here.

Edge cases: null text is the empty text; two empty texts are alike (1.0); null doc_id sorts first and repeated rows
follow each other; the last document's next is the first one, a lone document's is itself; empty tables give empty
results; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_width, slices, table, whole_text

CELLS = 48
LONG = 128
CUT = 4
#: Documents in a run that one task reads in order, and the most runs (larger tables have longer ones).
RUN, MOST_RUNS = 512, 16_000
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_elements long"
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray, k: int = 0) -> np.ndarray:
    """A 64-bit finaliser; k chooses one of a family."""
    with np.errstate(over="ignore"):
        x = x + _M[0] * np.uint64(2 * k + 1)
        x = (x ^ (x >> np.uint64(30))) * _M[1]
        x = (x ^ (x >> np.uint64(27))) * _M[2]
        return x ^ (x >> np.uint64(31))


def byte_powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _M[0] | np.uint64(1)), dtype=np.uint64)


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(digest of each piece, document of each piece), texts in order."""
    joined = "".join(texts)
    if not joined:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(data)
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], ends[:-1]])
    newline = data == 10
    gap = newline | (data == 32)
    # a word ends where white space follows it; its hash is of the last four characters before the gap
    with np.errstate(over="ignore"):
        x = mix(data.astype(np.uint64))
        tail = x.copy()
        for k in (1, 2, 3):
            before = x[:-k] * (_M[0] ** np.uint64(k + 1))
            for j in range(k):  # characters of the text before don't count
                at = starts[starts + j < n] + j - k
                before[at[at >= 0]] = 0
            tail[k:] += before
    word_end = np.zeros(n, bool)
    word_end[:-1] = gap[1:] & ~gap[:-1]
    word_end[ends[ends > 0] - 1] = False
    chance = mix(tail, 1)
    stop = word_end & (chance & np.uint64(CUT - 1) == 0)
    stop |= (chance >> np.uint64(8)) & np.uint64(LONG - 1) == 1
    stop |= newline
    stop[ends[ends > 0] - 1] = True
    last = np.flatnonzero(stop)
    first = np.concatenate([[0], last[:-1] + 1])
    # polynomial over the piece: prefix sums of x * B^i, shifted back by B^-first
    power = byte_powers(n)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(x * power, dtype=np.uint64)])
        inverse = np.uint64(pow(int(_M[0] | np.uint64(1)), -1, 1 << 64))
        back = np.cumprod(np.full(n, inverse), dtype=np.uint64)
        value = (total[last + 1] - total[first]) * back[first] + (last - first).astype(np.uint64)
    # newlines alone are no element
    keep = (np.cumsum(~gap)[last] - np.concatenate([[0], np.cumsum(~gap)])[first]) > 0
    return mix(value[keep], 2), np.searchsorted(ends, last[keep], "right")


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(element, document), a set for each document: the k-th equal piece of a document is an element of its own."""
    digest, doc = pieces(texts)
    order = np.lexsort((digest, doc))
    digest, doc = digest[order], doc[order]
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(digest))
    nth = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
    with np.errstate(over="ignore"):
        return mix(digest + nth.astype(np.uint64) * _M[1], 3), doc


class Sketch:
    """Cells of many documents side by side, `cells` (a multiple of 3) for each."""

    def __init__(self, docs: int, cells: int):
        self.cells, self.docs = cells, docs
        self.count = np.zeros(docs * cells, np.int64)
        self.key = np.zeros(docs * cells, np.uint64)
        self.check = np.zeros(docs * cells, np.uint64)

    def places(self, element: np.ndarray, doc: np.ndarray):
        third = self.cells // 3
        for k in range(3):
            yield doc * self.cells + k * third + (mix(element, 4 + k) % np.uint64(third)).astype(np.int64)

    def add(self, element: np.ndarray, doc: np.ndarray, sign) -> Sketch:
        check = mix(element, 8)
        for at in self.places(element, doc):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, element)
            np.bitwise_xor.at(self.check, at, check)
        return self

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(self.docs, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(elements, their documents, side +1 or -1, documents that peeled out wholly)."""
        found: list[tuple] = []
        live = np.flatnonzero(self.count != 0)
        while len(live):
            pure = live[(np.abs(self.count[live]) == 1)]
            pure = pure[self.check[pure] == mix(self.key[pure], 8)]
            if not len(pure):
                break
            doc = pure // self.cells
            element, sign = self.key[pure], self.count[pure]
            order = np.lexsort((element, doc))
            first = np.ones(len(order), bool)
            first[1:] = (element[order][1:] != element[order][:-1]) | (doc[order][1:] != doc[order][:-1])
            one = order[first]
            doc, element, sign = doc[one], element[one], sign[one]
            found.append((element, doc, sign))
            self.add(element, doc, -sign)
            live = np.unique(np.concatenate(list(self.places(element, doc))))
            live = live[self.count[live] != 0]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        done = np.flatnonzero(~left.reshape(self.docs, self.cells).any(axis=1))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), done
        return *(np.concatenate(x) for x in zip(*found, strict=True)), done

    def texts(self) -> list[str]:
        rows = np.empty((self.docs, self.cells), dtype=[("n", "<i4"), ("k", "<u8"), ("c", "<u4")])
        rows["n"], rows["k"], rows["c"] = (x.reshape(self.docs, self.cells) for x in (self.count, self.key, self.check & np.uint64(0xFFFFFFFF)))
        return [base64.b64encode(r.tobytes()).decode() for r in rows]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], docs: int, sketches: tuple[Sketch, Sketch] | None = None) -> np.ndarray:
    """Jaccard likeness of each pair of element sets, through peeled differences."""
    sizes = np.bincount(a[1], minlength=docs) + np.bincount(b[1], minlength=docs)
    differ = np.zeros(docs, np.int64)
    left, cells = np.arange(docs), CELLS
    while len(left):
        new = np.full(docs, -1)
        new[left] = np.arange(len(left))
        if sketches is None:
            pair = []
            for element, doc in (a, b):
                own = new[doc] >= 0
                pair.append(Sketch(len(left), cells).add(element[own], new[doc[own]], 1))
            sketches = (pair[0], pair[1])
        _, doc, _, done = sketches[0].minus(sketches[1]).peel()
        n = np.bincount(doc, minlength=len(left))
        differ[left[done]] = n[done]
        left = np.delete(left, done)
        cells, sketches = cells * 16, None
    union = (sizes + differ) / 2
    return np.where(union > 0, 1 - differ / np.maximum(union, 1), 1.0)


def compare(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """The result rows of some documents, given each one's next text."""
    n = len(texts)
    edited = []
    for text, other in zip(texts, following, strict=True):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + other[:half])
    # a following text that is the next one of `texts` is not cut again
    again = [k + 1 < n and following[k] is texts[k + 1] for k in range(n)]
    extra = [k for k in range(n) if not again[k]]
    element, doc = elements([*texts, *(following[k] for k in extra)])
    target = np.full(n + len(extra), -1)
    target[[k + 1 for k in range(n) if again[k]]] = [k for k in range(n) if again[k]]
    target[n:] = extra
    mine, theirs = doc < n, target[doc] >= 0
    sets = [(element[mine], doc[mine]), elements(edited), (element[theirs], target[doc[theirs]])]
    own, changed, nxt = (Sketch(n, CELLS).add(e, d, 1) for e, d in sets)
    near = (likeness(sets[0], sets[1], n, (own, changed)), likeness(sets[0], sets[2], n, (own, nxt)))
    sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited]
    columns = [ids, [len(t) for t in texts], sha, own.texts(), changed.texts(), near[0], near[1], np.bincount(sets[0][1], minlength=n)]
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in runs: each run holds consecutive documents in order and, not owned, the first document of the next run.

    Borders are approximate quantiles of doc_id (at most 256), each stretch cut evenly, MOST_RUNS runs at most.  Only
    the first id of each run comes to the driver, never texts.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    n, lo, hi = slim.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    lo = (lo if lo is not None else 0) - 1
    hi = hi if hi is not None else lo
    runs = max(1, min(MOST_RUNS, -(-n // RUN)))
    stretches = min(256, runs)
    points = slim.stat.approxQuantile("doc_id", [k / stretches for k in range(1, stretches)], 0.001) if stretches > 1 else []
    borders = [lo, *sorted({int(p) for p in points if lo < p < hi})]
    parts = -(-runs // len(borders))
    widths = [max(1, -(-(b - a) // parts)) for a, b in zip(borders, [*borders[1:], hi + 1], strict=True)]
    key = F.coalesce(F.col("doc_id"), F.lit(lo))
    keyed = slim.withColumn("_key", key)
    at = F.size(F.filter(F.lit(borders), lambda b: b <= F.col("_key")))
    keyed = keyed.withColumn("_at", at)
    inside = F.floor((F.col("_key") - F.element_at(F.lit(borders), F.col("_at"))) / F.element_at(F.lit(widths), F.col("_at")))
    keyed = keyed.select((F.col("_at") * (parts + 1) + inside).cast("long").alias("run"), "_key", "doc_id", "text")
    firsts = sorted(tuple(r) for r in keyed.groupBy("run").agg(F.min("_key")).collect())
    following = [(run, firsts[(k + 1) % len(firsts)][1]) for k, (run, _) in enumerate(firsts)]
    want = F.broadcast(spark.createDataFrame(following, "_for long, _key long"))
    lent = keyed.join(want, "_key").select(F.col("_for").alias("run"), F.lit(False).alias("own"), "doc_id", "text")
    return keyed.select("run", F.lit(True).alias("own"), "doc_id", "text").unionByName(lent)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = with_next(docs).repartition(max(1, shuffle_width(spark)), "run").sortWithinPartitions("run", F.desc("own"), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches):
        ready: list[tuple] = []
        size = 0

        def flush():
            nonlocal ready, size
            out = compare([r[0] for r in ready], [r[1] for r in ready], [r[2] for r in ready]) if ready else None
            ready, size = [], 0
            return out

        before = None
        for batch in batches:
            for part in slices(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if before is not None and before[0] == row[0] and before[1]:
                        ready.append((before[2], before[3], row[3]))
                        size += len(before[3]) + len(row[3])
                    before = row
                    if size > 4 << 20:
                        yield flush()
        if (out := flush()) is not None:
            yield out

    return rows.mapInArrow(run, SCHEMA)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
