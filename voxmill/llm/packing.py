"""Best-fit packing of tokenised documents into fixed-length sequences by bin completion.

A document becomes its token ids and an end id; only a document longer than the capacity is cut, into pieces of
exactly the capacity and a shorter last one.  Pieces are packed by length class: the driver sees only the histogram
of lengths (at most `capacity` classes, whatever the corpus size) and plans fillings with multiplicities; each row
then finds its place from its rank in its class.  Ranks are counted by (length, salt), so a class that holds a third
of all rows is dealt over every task.

Edge cases: null text is the empty text, one end id; empty tables give empty results; repeated rows are packed each;
further columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import functools
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, map_arrow, shuffle_width, table, whole_text

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Nodes for the fillings of one bin; beyond it those found, or else the best-fit one, stand.
BRANCHES = 4000
#: Nodes of a whole search, and rests that it remembers (16 kB each at the usual capacity).
NODES, SEEN = 400_000, 2000
#: Nodes that a step of the search counts as, by its time.
STEP = 20
#: Words whose ids a worker remembers between slices and tasks, about 30 MB; further words are encoded in each slice.
KNOWN_WORDS, ENCODED_AT_ONCE, SLICE_BYTES = 150_000, 4096, 2 << 20
#: A Latin letter that stays one letter when composed and lowered (U+0130 doesn't), and an ASCII mark but the apostrophe.
_MARK = r"([A-Za-zÀ-ÖØ-öø-įı-ſ])([!-&(-/:-@\[-`{-~])"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _known(path: str) -> dict[str, bytes]:
    return {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coded_words(vocab: list[str], path: str) -> list[bytes]:
    """The ids of each word, 4 bytes an id; words met before by this worker come from its bounded memory."""
    seen = _known(path)
    found = [seen.get(w) for w in vocab]
    missing = [k for k, ids in enumerate(found) if ids is None]
    # an encoding holds far more than its ids, so few of them live at once
    for at in range(0, len(missing), ENCODED_AT_ONCE):
        part = missing[at : at + ENCODED_AT_ONCE]
        for k, e in zip(part, tokenizer(path).encode_batch_fast([vocab[k] for k in part], add_special_tokens=False), strict=True):
            found[k] = array("I", e.ids).tobytes()
    for k in missing[: max(0, KNOWN_WORDS - len(seen))]:
        seen[vocab[k]] = found[k]
    return found


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts end to end, number of ids of each text).

    The tokenizer drops white space, never joins across it, and always cuts between a Latin letter and an ASCII mark other
    than the apostrophe, so each distinct word of the slice is encoded once.  It lowers case, so words in ASCII share an entry
    with their lower form (others don't: their composed forms may differ).
    """
    spaced = pc.replace_substring(pc.replace_substring_regex(texts, _MARK, r"\1 \2"), "\n", " ")
    words = pc.split_pattern(spaced, " ")
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(words.flatten())
    lower = pc.dictionary_encode(pc.if_else(pc.string_is_ascii(coded.dictionary), pc.ascii_lower(coded.dictionary), coded.dictionary))
    index = lower.indices.to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
    found = coded_words(lower.dictionary.to_pylist(), path)
    lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), np.uint32)
    first = np.concatenate([[0], np.cumsum(lens)])[:-1]
    per_word = lens[index]
    ends = np.cumsum(per_word)
    source = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[index] - (ends - per_word), per_word)
    per_doc = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return flat[source], np.diff(per_doc)


def cut(batch: pa.RecordBatch, path: str, capacity: int, end_id: int) -> pa.RecordBatch:
    """One row for each piece of each document of a slice."""
    ids, counts = token_ids(batch.column(1), path)
    out: list[list] = [[], [], [], [], []]
    at = 0
    end = np.array([end_id], "<u4")
    for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
        own = np.concatenate([ids[at : at + n].astype("<u4"), end])
        at += n
        for k, start in enumerate(range(0, n + 1, capacity)):
            part = own[start : start + capacity]
            for column, value in zip(out, (doc_id, k, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
        names=["doc_id", "piece", "start", "length", "ids_crc32"],
    )


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(slim, lambda b: cut(b, path, capacity, end_id), PIECES, limit=SLICE_BYTES)


def best_fit(room: int, left: np.ndarray) -> list[tuple[int, int]]:
    """Always the largest item that still fits."""
    out = []
    while room > 0:
        fits = np.flatnonzero(left[: room + 1])
        if not len(fits) or fits[-1] == 0:
            break
        size = int(fits[-1])
        times = min(int(left[size]), room // size)
        out.append((size, times))
        room -= size * times
        left = left.copy()
        left[size] = 0
    return out


def fillings(room: int, left: np.ndarray, slack: int, branches: int, enough: bool = False) -> tuple[list[tuple[int, list[tuple[int, int]]]], int]:
    """([(waste, [(length, times)])], nodes): undominated fillings of at most `slack` waste, least waste first.

    Depth-first over (class, times), the largest first.  A filling is dominated when another item still fits, when one of
    its items could be exchanged for a larger available one within its waste, or when an item of just the room left could
    stand for what follows.  A branch is cut where all items that it may still take leave more than the least waste
    allowed.  `enough`: one filling without waste ends it.
    """
    classes = np.flatnonzero(left[: room + 1])[::-1]
    # what all items from a class on come to
    after = np.concatenate([np.cumsum((classes * left[classes])[::-1])[::-1], [0]]).tolist()
    negated, classes = (-classes).tolist(), classes.tolist()
    out, nodes = [], 0
    stack: list[tuple[int, int, tuple]] = [(0, room, ())]
    while stack and nodes <= branches:
        k, rest, held = stack.pop()
        nodes += 1
        k = bisect.bisect_left(negated, -rest, k)
        if rest - after[k] > slack:
            continue
        if k < len(classes) and classes[k] == rest:
            out.append((0, [*held, (rest, 1)]))
        elif k == len(classes):
            used = dict(held)
            free = [c for c in classes if left[c] > used.get(c, 0)]
            if not any(c <= rest for c in free) and not any(size < c <= size + rest for size in used for c in free):
                out.append((rest, list(held)))
        else:
            size = classes[k]
            stack.append((k + 1, rest, held))
            # the most of a class comes off the stack first
            for times in range(1, min(int(left[size]), rest // size) + 1):
                stack.append((k + 1, rest - size * times, (*held, (size, times))))
        if enough and out and not out[-1][0]:
            break
    return sorted(out, key=lambda x: x[0]), nodes


def counts_of(histogram: dict[int, int], capacity: int) -> np.ndarray:
    left = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        left[size] += n
    return left


def lower_bound(left: np.ndarray) -> int:
    """Bins that any packing of the counts by size needs: the greatest of three bounds.

    Volume; for each k, the items of over capacity - k, which stand alone, those of over half, and what of the others of k
    and more doesn't fit beside these; for each size, the items of that size and more, of which a bin holds few.
    """
    capacity = len(left) - 1
    sizes = np.arange(capacity + 1)
    number, volume = np.cumsum(left), np.cumsum(left * sizes)
    half = capacity // 2
    k = sizes[1 : half + 1]
    alone, large = number[-1] - number[capacity - k], number[capacity - k] - number[half]
    over = volume[half] - volume[k - 1] - (large * capacity - (volume[capacity - k] - volume[half]))
    beside = alone + large + np.maximum(0, -(-over // capacity))
    few = -(-(number[-1] - number[sizes[1:] - 1]) // (capacity // sizes[1:]))
    return int(max(-(-volume[-1] // capacity), beside.max(initial=0), few.max(initial=0)))


def search(histogram: dict[int, int], capacity: int, count: int, bound: int, branches: int, nodes: int) -> list[tuple[int, list[tuple[int, int]]]] | None:
    """A plan of fewer than `count` bins, the best that bin completion finds within `nodes` nodes, or None.

    Each node takes the largest class left and branches over the undominated fillings of its bin, repeated as often as
    the counts allow, half as often, and so on down to once.  A branch is cut when its waste leaves no room for fewer bins
    than the incumbent's, when the lower bound of its rest does, or when that rest was reached before with as few bins.
    """
    total = sum(k * v for k, v in histogram.items())
    left = counts_of(histogram, capacity)
    best, tried, path, seen = None, 0, [], {}

    def options(waste: int):
        nonlocal tried
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        found, n = fillings(capacity - top, left, capacity * (count - 1) - total - waste, branches)
        left[top] += 1
        tried += n
        for lost, more in found:
            used = {top: 1}
            for size, times in more:
                used[size] = used.get(size, 0) + times
            bins = min(int(left[size]) // times for size, times in used.items())
            while bins:
                yield bins, lost * bins, sorted(used.items(), reverse=True)
                bins //= 2

    # (options, waste so far, bins so far)
    stack = [(options(0), 0, 0)]
    while stack:
        choices, waste, bins = stack[-1]
        step = next(choices, None) if tried <= nodes and count > bound else None
        if step is None:
            stack.pop()
            if path:
                n, items = path.pop()
                for size, times in items:
                    left[size] += n * times
            continue
        n, lost, items = step
        tried += STEP
        if waste + lost > capacity * (count - 1) - total or bins + n >= count:
            continue
        for size, times in items:
            left[size] -= n * times
        path.append((n, items))
        key = left.tobytes() if len(seen) < SEEN else None
        if not left.any():
            best, count = list(path), bins + n
        elif bins + n + lower_bound(left) < count and (key is None or seen.get(key, count) > bins + n):
            if key is not None:
                seen[key] = bins + n
            stack.append((options(waste + lost), waste + lost, bins + n))
            continue
        path.pop()
        for size, times in items:
            left[size] += n * times
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY, branches: int = BRANCHES) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(number of bins, [(length, times in each)])]; every item of the histogram is used exactly once.

    Each step takes the largest class left, completes its bin and repeats that bin as often as the counts allow, which
    exhausts a class; so there are at most as many steps as classes.  The best-fit plan is the first incumbent, the one
    that completes each bin with the least waste the second; where both miss the lower bound, `search` branches over the
    undominated fillings.  No plan has more bins than best fit's; one that meets the bound is optimal, and where the
    search ends by its number of nodes, the gap is at most the plan's bins less lower_bound().
    """
    bound = lower_bound(counts_of(histogram, capacity))

    def build(choose) -> list[tuple[int, list[tuple[int, int]]]]:
        left = counts_of(histogram, capacity)
        out, top = [], capacity
        while True:
            while top and not left[top]:
                top -= 1
            if not top:
                return out
            left[top] -= 1
            more = choose(capacity - top, left)
            left[top] += 1
            used: dict[int, int] = {top: 1}
            for size, times in more:
                used[size] = used.get(size, 0) + times
            bins = min(int(left[size]) // times for size, times in used.items())
            for size, times in used.items():
                left[size] -= bins * times
            out.append((bins, sorted(used.items(), reverse=True)))

    def least_waste(room: int, left: np.ndarray) -> list[tuple[int, int]]:
        found, _ = fillings(room, left, room, branches, enough=True)
        return found[0][1] if found else best_fit(room, left)

    best = build(best_fit)
    count = sum(b for b, _ in best)
    if count > bound:
        other = build(least_waste)
        if (n := sum(b for b, _ in other)) < count:
            best, count = other, n
    if count > bound:
        best = search(histogram, capacity, count, bound, branches, NODES) or best
    return best


def places(planned: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each class its runs of ranks in order: first rank, items in each bin, first bin, offset of the first item."""
    rank: dict[int, int] = {}
    runs: dict[int, list] = {}
    base = 0
    for bins, used in planned:
        offset = 0
        for size, times in used:
            at = rank.get(size, 0)
            runs.setdefault(size, []).append((at, times, base, offset))
            rank[size] = at + bins * times
            offset += size * times
        base += bins
    return runs


def pack(pieces_df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with (doc_id, piece, start, length, ids_crc32)."""
    spark = pieces_df.sparkSession
    salts = shuffle_width(spark)
    rows = pieces_df.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = rows.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    # at most `capacity` rows
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    # at most `capacity` rows again, one for each class; the runs of all are a few for each step of the plan
    where = spark.createDataFrame(list(places(plan(histogram, capacity)).items()), "length long, _runs array<struct<rank: long, times: long, base: long, offset: long>>")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rows.join(counts, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1)
    run = F.element_at(F.filter("_runs", lambda r: r["rank"] <= F.col("_rank")), -1)
    placed = ranked.join(F.broadcast(where), "length").withColumn("_run", run).withColumn("_r", F.col("_rank") - F.col("_run.rank"))
    sequence = F.col("_run.base") + F.expr("_r div _run.times")
    offset = F.col("_run.offset") + F.expr("_r % _run.times") * F.col("length")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    return pack(durable(pieces(docs, path or vocabulary_path(), capacity), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
