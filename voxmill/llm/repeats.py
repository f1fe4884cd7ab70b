"""Suffix-array deduplication: bytes covered by a string of `LENGTH` bytes that also starts elsewhere.

1. Every window of LENGTH bytes has an anchor that depends on its content alone: the place of the least 8-byte hash
   among its first `REACH` starts.  Equal windows have equal anchors, and the `CORE` bytes behind the anchor lie in all
   of its windows.  Only anchors whose core stands at two places of different texts, or twice in one, go on.
2. Such an anchor becomes a unit: the bytes before and behind the core that its windows reach.  Equal units are one
   class; one of two or more units repeats wholly.
3. The classes of a core are compared by a suffix array of their strings, built by linear grouping (see suffixes.py),
   the core standing as one symbol: a window repeats where it agrees with a neighbour in the array in full length.
4. A core with over `GROUP` classes (a passage in very many texts) isn't compared in one task: its windows are cut into
   ranges of neighbouring starts, whose common bytes are a longer core, and these go through 2 to 4 again; a range of
   one window is settled by counting alone.
   Before 3, each string is cut to what it shares with any other of its core on either side (neighbours in sorted
   order tell), which changes no match.
5. The windows found cover bytes; runs of them are cut out.  Copies of a whole text are found first, by its digest.
6. Passages shorter than LENGTH bytes but of `PASSAGE` words or more: the same anchors over words, and every window of
   PASSAGE words around a core that stands in different texts is counted by its hash.  `n_passage_words` counts the
   words in windows that another document holds too (repeats inside one document don't count); it removes nothing.

Edge cases: null text is the empty text; texts under LENGTH bytes lose nothing; repeated rows are copies, whether or not
they share a doc_id; one doc_id may stand on different texts; null doc_id is allowed; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, durable, halves, shuffle_width, slices, table, whole_text
from .fingerprints import mix
from .words import word_hashes
from .suffixes import suffix_array

LENGTH, REACH = 400, 200
CORE = LENGTH - REACH + 1
GROUP = 400
#: Widths of the ranges of starts at which a crowded core is cut.
STEPS = (25, 5, 1)
SLICE = 1 << 20
#: Words of a passage, and the starts among which its anchor is chosen.
PASSAGE, PASSAGE_REACH = 51, 26
PASSAGE_CORE = PASSAGE - PASSAGE_REACH + 1
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64(28)
UNIT = "u1 long, u2 long, k1 long, k2 long, c long, left binary, tail binary, lo int, hi int"


@functools.lru_cache(maxsize=4)
def _kept_powers(base: int) -> np.ndarray:
    return np.cumprod(np.full(SLICE + 1, np.uint64(base)), dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base, base ** 2, ... of n places; those of a usual slice are made once a worker."""
    with np.errstate(over="ignore"):
        return _kept_powers(base)[:n] if n <= SLICE + 1 else np.cumprod(np.full(n, np.uint64(base)), dtype=np.uint64)


def prefix_hash(values: np.ndarray, base: np.uint64):
    """A function (starts, length) -> hashes of that many values from each start."""
    n = len(values)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(values * powers(int(base), n), dtype=np.uint64)])
    back = powers(pow(int(base), -1, 1 << 64), n + 1)

    def at(starts: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (total[starts + length] - total[starts]) * back[starts]

    return at


_VALUES = mix(np.arange(256, dtype=np.uint64), 21)


def window_anchors(h: np.ndarray, sizes: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, lo, hi) over texts of `sizes` symbols end to end; h: an order of the symbols, by what begins there.

    anchor counts from the beginning of all texts; lo and hi are the least and the greatest distance of a window's start.
    """
    n = int(sizes.sum())
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    empty = (np.zeros(0, np.int64),) * 4
    if n < length or not (sizes >= length).any():
        return empty
    # the greatest place wins ties: it is stored inverted below the hash
    m = len(h)
    low = np.uint64((1 << int(_PLACE)) - 1)
    packed = (h & ~low) | (low - np.arange(m, dtype=np.uint64))
    width = -(-m // reach) * reach
    padded = np.full(width + reach, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = packed
    grid = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(behind[:count], ahead[reach - 1 : reach - 1 + count])
    anchor = (low - (least & low)).astype(np.int64)
    place = np.arange(count)
    owner = np.repeat(np.arange(len(sizes)), sizes)[:count]
    ok = place + length <= (starts + sizes)[owner]
    place, anchor, owner = place[ok], anchor[ok], owner[ok]
    if not len(place):
        return empty
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(place)]]) - 1
    a = anchor[first]
    return owner[first], a, a - place[last], a - place[first]


def anchors(raw: list[bytes], both: bool = True):
    """(text, anchor, lo, hi, k1, k2) arrays over the texts; k1 and k2, hashes of the core (k2 only where `both`)."""
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    none = np.zeros(0, np.uint64)
    if len(data) < LENGTH or not (sizes >= LENGTH).any():
        return (np.zeros(0, np.int64),) * 4 + (none, none)
    with np.errstate(over="ignore"):
        x = _VALUES[data]
        h = x
        for k in (1, 2, 4):
            h = h[:-k] * _B1 ** np.uint64(k) + h[k:]
        h = mix(h, 22)
    owner, a, lo, hi = window_anchors(h, sizes, LENGTH, REACH)
    starts = np.cumsum(sizes) - sizes
    k1 = mix(prefix_hash(x, _B1)(a, CORE), 23)
    k2 = mix(prefix_hash(x, _B2)(a, CORE), 24) if both else none
    return owner, a - starts[owner], lo, hi, k1, k2


def passage_anchors(texts: list[str]):
    """(text, anchor, lo, hi, key of the core, hash of PASSAGE words at each place, first place of each text) over words."""
    word, doc = word_hashes(texts)
    sizes = np.bincount(doc, minlength=len(texts))
    if not len(word) or sizes.max() < PASSAGE:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, None, empty
    with np.errstate(over="ignore"):
        h = mix(word[:-1] * _B1 + word[1:], 25)
    owner, a, lo, hi = window_anchors(h, sizes, PASSAGE, PASSAGE_REACH)
    starts = np.cumsum(sizes) - sizes
    at = prefix_hash(word, _B1)
    return owner, a - starts[owner], lo, hi, mix(at(a, PASSAGE_CORE), 26).view(np.int64), at, starts


def digest(text: bytes) -> tuple[int, int]:
    """Two halves of the text's SHA-256, as `find` takes them from sha2()."""
    d = hashlib.sha256(text).hexdigest()
    return int(d[:15], 16), int(d[15:30], 16)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """fn over slices of `text`, small enough for the arrays that are made of them."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                out = fn(part)
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def batch_of(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    parts = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, parts, strict=True)], names=[p[0] for p in parts])


def hash_units(k1: int, left: bytes, tail: bytes, cut: int) -> int:
    return int.from_bytes(hashlib.blake2b(left + b"|" + tail, digest_size=8, key=k1.to_bytes(8, "little", signed=True), salt=cut.to_bytes(2, "little")).digest(), "little", signed=True)


def agreement(a: bytes, b: bytes) -> int:
    """Bytes that a and b share from their start."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def pruned(group: list[tuple[int, bytes, bytes, int, int]], extra: int) -> list[tuple[int, bytes, bytes, int, int]]:
    """The classes of one core that may share a window with another, cut to what they share with any other on each side."""
    reach = []
    for side in ([left[::-1] for _, left, *_ in group], [tail for _, _, tail, *_ in group]):
        order = sorted(range(len(group)), key=side.__getitem__)
        most = [0] * len(group)
        for i, j in zip(order, order[1:]):  # noqa: B905
            n = agreement(side[i], side[j])
            most[i], most[j] = max(most[i], n), max(most[j], n)
        reach.append(most)
    out = []
    for (row, left, tail, lo, hi), before, behind in zip(group, *reach, strict=True):
        a, b = max(lo, extra - behind), min(hi, before)
        if a <= b:
            out.append((row, left[len(left) - b :], tail[: extra - a], a, b))
    return out


def compare_core_groups(groups: list[list[tuple[int, bytes, bytes, int, int]]], extra: int) -> list[tuple[int, int, int, list[int]]]:
    """groups of classes (row, left, tail, lo, hi) -> (row, first, last) ranges of repeating distances, one suffix array for all.

    A window from distance o takes o bytes of `left`, the core and extra - o of `tail`: extra + 1 symbols.
    """
    symbols: list[np.ndarray] = []
    spot, row_of, dist = [], [], []
    at = 0
    for g, group in enumerate(groups):
        for row, left, tail, lo, hi in group:
            s = np.empty(len(left) + len(tail) + 2, np.int32)
            s[: len(left)] = np.frombuffer(left, np.uint8)
            s[len(left)] = 300 + g
            s[len(left) + 1 : -1] = np.frombuffer(tail, np.uint8)
            s[-1] = -1
            symbols.append(s)
            # the window of distance o starts len(left) - o symbols in
            o = np.arange(lo, hi + 1)
            spot.append(at + len(left) - o)
            row_of.append(np.full(len(o), row))
            dist.append(o)
            at += len(s)
    text = np.concatenate(symbols)
    order = np.array(suffix_array(text))
    spot, row_of, dist = np.concatenate(spot), np.concatenate(row_of), np.concatenate(dist)
    window = np.full(len(text), -1)
    window[spot] = np.arange(len(spot))
    lined = order[window[order] >= 0]  # window starts in suffix order
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.full(extra + 1, -1, np.int32)]), extra + 1)
    same = np.zeros(max(0, len(lined) - 1), bool)
    for k in range(0, len(same), 8192):
        same[k : k + 8192] = (view[lined[k : k + 8193][:-1]] == view[lined[k + 1 : k + 8193]]).all(axis=1)
    hit = np.zeros(len(lined), bool)
    hit[:-1] |= same
    hit[1:] |= same
    found = window[lined[hit]]
    rows = np.stack([row_of[found], dist[found]], axis=1)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    if not len(rows):
        return []
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    return [(int(rows[a, 0]), int(rows[a, 1]), int(rows[b, 1])) for a, b in zip(first, last, strict=True)]


def sorted_groups(classes: DataFrame, extra: int) -> DataFrame:
    """classes of cores with few classes -> (k1, c, first, last)."""
    spark = classes.sparkSession
    dealt = classes.select("k1", "k2", "c", "left", "tail", "lo", "hi").repartition(shuffle_width(spark), "k1", "k2").sortWithinPartitions("k1", "k2")

    def run(batches):
        groups: list[list] = []
        keys: list[tuple[int, int]] = []  # (k1, c) of each row
        size, before = 0, None

        def flush():
            nonlocal size
            several = [g for g in (pruned(g, extra) for g in groups if len(g) > 1) if len(g) > 1]
            found = compare_core_groups(several, extra) if several else []
            out = batch_of([[keys[r][0] for r, _, _ in found], [keys[r][1] for r, _, _ in found], [a for _, a, _ in found], [b for _, _, b in found]], "k1 long, c long, first int, last int")
            groups.clear()
            keys.clear()
            size = 0
            return out

        for batch in batches:
            for k1, k2, c, left, tail, lo, hi in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (k1, k2) != before:
                    if size > 60_000:
                        yield flush()
                    groups.append([])
                    before = (k1, k2)
                groups[-1].append((len(keys), left, tail, lo, hi))
                keys.append((k1, c))
                size += len(left) + len(tail) + 2
        if groups:
            yield flush()

    return dealt.mapInArrow(run, "k1 long, c long, first int, last int")


def cut_ranges(classes: DataFrame, extra: int, step: int) -> DataFrame:
    """Units of the ranges of `step` neighbouring distances of each class; u1 is its c, u2 the range's first distance."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for k1, k2, c, left, tail, lo, hi in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for s in range(lo // step * step, hi + 1, step):
                    e = s + step - 1
                    # the common core of distances s to e: s bytes before the old core, extra - e behind it
                    inner = (left[len(left) - s :] if s else b"", tail[: max(0, extra - e)])
                    if len(inner[0]) < s:
                        continue
                    sub1, sub2 = (hash_units(k, *inner, s) for k in (k1, k2))
                    before = left[max(0, len(left) - e) : len(left) - s]
                    behind = tail[max(0, extra - e) : max(0, extra - s)]
                    row = (c, s, sub1, sub2, hash_units(sub1, before, behind, step), before, behind, max(lo, s) - s, min(hi, e) - s)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield batch_of(out, UNIT)

    return classes.select("k1", "k2", "c", "left", "tail", "lo", "hi").mapInArrow(run, UNIT)


def resolve(units: DataFrame, extra: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """units -> (u1, u2, first, last): ranges of repeating distances."""
    # units whose bytes and distances agree are one class; c, a digest of them, stands with k1 for the class
    classes = units.groupBy("k1", "k2", "c", "lo", "hi").agg(F.count("*").alias("n"), F.first("left").alias("left"), F.first("tail").alias("tail"))
    classes = durable(classes, "repeat-classes")
    groups = durable(classes.groupBy("k1", "k2").agg(F.count("*").alias("m")), "repeat-groups")
    several = classes.where("n > 1").select("k1", "c", F.col("lo").alias("first"), F.col("hi").alias("last"))
    rest = durable(classes.join(groups, ["k1", "k2"]).where("m > 1"), "repeat-several")
    found = several.unionByName(sorted_groups(rest.where(F.col("m") <= GROUP), extra))
    crowded = rest.where(F.col("m") > GROUP)
    if steps and crowded.limit(1).count():
        step = steps[0]
        again = resolve(durable(cut_ranges(crowded, extra, step), "repeat-ranges"), step - 1, steps[1:])
        found = found.unionByName(again.join(crowded.select("k1", F.col("c").alias("u1")).distinct(), "u1").select("k1", F.col("u1").alias("c"), (F.col("first") + F.col("u2")).cast("int").alias("first"), (F.col("last") + F.col("u2")).cast("int").alias("last")))
    found = durable(found.distinct(), "repeat-found")
    discard(classes, groups, rest)
    return units.select("u1", "u2", "k1", "c").join(found, ["k1", "c"]).select("u1", "u2", "first", "last")


def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The anchors of both kinds of windows, of bytes and (w) of words."""
    texts = batch.column(0).to_pylist()
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    owner, a, _, _, k1, _ = anchors(raw, both=False)
    word_owner, word_a, _, _, word_key, _, _ = passage_anchors(texts)
    t = np.array([digest(r) for r in raw], np.int64).reshape(-1, 2)[np.concatenate([owner, word_owner])]
    columns = [np.concatenate([k1.view(np.int64), word_key]), t[:, 0], t[:, 1], np.concatenate([a, word_a]).astype(np.int32), np.arange(len(t)) >= len(a)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "t1", "t2", "a", "w"])


def unit(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Holders of texts -> units of their wanted anchors."""
    raw = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
    want = [set(x) for x in batch.column(2).to_pylist()]
    ids = batch.column(0).to_pylist()
    out: list[list] = [[] for _ in range(9)]
    for d, a, lo, hi, k1, k2 in zip(*(x.tolist() for x in anchors(raw)), strict=True):
        if a in want[d]:
            left, tail = raw[d][a - hi : a], raw[d][a + CORE : a + LENGTH - lo]
            k1, k2 = (k - (1 << 64) if k >> 63 else k for k in (k1, k2))
            for column, value in zip(out, (ids[d], a, k1, k2, hash_units(k1, left, tail, 0), left, tail, lo, hi), strict=True):
                column.append(value)
    return batch_of(out, UNIT)


def passage_windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Holders of texts -> (u1, p, h): the hash of PASSAGE words from word p on, for the windows of wanted anchors."""
    owner, a, lo, hi, _, at, starts = passage_anchors(batch.column(1).to_pylist())
    want = [set(x) for x in batch.column(2).to_pylist()]
    keep = np.fromiter((x in want[d] for d, x in zip(owner.tolist(), a.tolist(), strict=True)), bool, len(owner))
    owner, a, lo, hi = owner[keep], a[keep], lo[keep], hi[keep]
    if not len(owner):
        return batch_of([[], [], []], "u1 long, p int, h long")
    times = hi - lo + 1
    row = np.repeat(np.arange(len(times)), times)
    p = (a - hi)[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    ids = np.array(batch.column(0).to_pylist(), np.int64)[owner][row]
    h = mix(at(starts[owner][row] + p, PASSAGE), 27).view(np.int64)
    return batch_of([ids, p, h], "u1 long, p int, h long")


def passages(holders: DataFrame) -> DataFrame:
    """(u1, n_passage_words): words in windows of PASSAGE words that stand in another text too."""
    seen = durable(mapped(holders.where(F.size("words") > 0).select("u1", "text", "words"), passage_windows, "u1 long, p int, h long"), "passage-windows")
    shared = durable(seen.groupBy("h").agg(F.min("u1").alias("x"), F.max("u1").alias("y")).where("x <> y").select("h"), "passage-shared")
    starts = seen.join(shared, "h").groupBy("u1").agg(F.sort_array(F.collect_set("p")).alias("_p"))
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-PASSAGE).alias("at"))
    n = F.aggregate("_p", begin, lambda acc, p: F.struct((acc["n"] + F.least(F.lit(PASSAGE), p - acc["at"])).alias("n"), p.alias("at")), lambda acc: acc["n"])
    out = durable(starts.select("u1", n.alias("n_passage_words")), "passages")
    discard(seen, shared)
    return out


def find(docs: DataFrame) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    spaced = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    sha = slim.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.size(spaced).alias("n_words"), F.sha2("text", 256).alias("sha"))
    base = durable(sha.select("doc_id", *halves(F.col("sha")), "n_bytes", "n_words", "sha"), "repeat-base")
    texts = durable(base.groupBy("t1", "t2", "n_bytes", "n_words").agg(F.count("*").alias("copies"), F.min("doc_id").alias("led")), "repeat-texts")
    spots = durable(mapped(slim.select("text"), mark, "k1 long, t1 long, t2 long, a int, w boolean"), "repeat-anchors")
    # a core twice: at two places of one text (bytes), or in two different texts (copies of a text count once)
    where = F.when(F.col("w"), F.xxhash64("t1", "t2")).otherwise(F.xxhash64("t1", "t2", "a"))
    twice = durable(spots.groupBy("w", "k1").agg(F.min(where).alias("x"), F.max(where).alias("y")).where("x <> y").select("w", "k1"), "repeat-cores")
    hit = spots.join(twice, ["w", "k1"]).groupBy("t1", "t2").agg(F.collect_set(F.when(~F.col("w"), F.col("a"))).alias("places"), F.collect_set(F.when(F.col("w"), F.col("a"))).alias("words"))
    # one row stands for all copies of its text: of its least doc_id, which other texts may bear too
    chosen = hit.join(texts.select("t1", "t2", "led"), ["t1", "t2"]).withColumnsRenamed({"t1": "u1", "t2": "u2"})
    keyed = slim.select("doc_id", "text", *halves(F.sha2("text", 256)))
    same = (keyed["t1"] == chosen["u1"]) & (keyed["t2"] == chosen["u2"]) & keyed["doc_id"].eqNullSafe(chosen["led"])
    holders = durable(keyed.join(chosen, same).select("u1", "t2", "text", "places", "words"), "repeat-holders")
    if holders.groupBy("u1", "t2").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():  # whole rows that repeat
        holders = durable(holders.dropDuplicates(["u1", "t2"]), "repeat-holders-once")
    units = durable(mapped(holders.where(F.size("places") > 0).select("u1", "text", "places"), unit, UNIT), "repeat-units")
    ranges = resolve(units, LENGTH - CORE)
    covered = ranges.groupBy("u1").agg(F.collect_list(F.struct((F.col("u2") - F.col("last")).cast("int").alias("a"), (F.col("u2") - F.col("first") + LENGTH).cast("int").alias("z"))).alias("spans"))
    covered = durable(covered, "repeat-spans")
    discard(units, spots, twice)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(5)]
        for u1, t2, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw, kept, at, runs, removed = text.encode("utf-8", "surrogatepass"), [], 0, 0, 0
            for s in sorted((x["a"], x["z"]) for x in spans):
                if s[0] > at or not runs:
                    kept.append(raw[at : s[0]])
                    runs += 1
                    removed -= s[0]
                    at = s[0]
                    removed += at
                removed += max(0, s[1] - at)
                at = max(at, s[1])
            kept.append(raw[at:])
            for column, value in zip(out, (u1, t2, removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                column.append(value)
        return batch_of(out, "t1 long, t2 long, n_removed long, n_spans long, kept string")

    some = mapped(holders.drop("places", "words").join(covered, "u1").select("u1", "t2", "text", "spans"), cut, "t1 long, t2 long, n_removed long, n_spans long, kept string")
    found = holders.select(F.col("u1").alias("t1"), "t2").join(passages(holders).withColumnRenamed("u1", "t1"), "t1")
    state = durable(texts.join(some, ["t1", "t2"], "left").join(found, ["t1", "t2"], "left"), "repeat-state")
    discard(texts, holders, covered)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    copied = (F.col("copies") > 1) & (F.col("n_words") >= PASSAGE)
    nothing = hashlib.sha256(b"").hexdigest()
    return base.join(state.drop("n_bytes", "n_words", "led"), ["t1", "t2"]).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_passage_words", F.lit(0))).cast("long").alias("n_passage_words"),
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
