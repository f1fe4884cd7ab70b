"""Folds of one long key over many tasks.

A fold that moves along an axis (time, or a running sum) and looks at most `reach` ahead forgets what lies behind: from any row on, it
goes where it would have gone from there anyway, and runs that meet stay together.  So a key is cut into stretches of the axis:

1. Each stretch is folded from every row at which the stretch before it may have left off: its first row, or one after a row
   within `reach` of its begin.  Runs are followed only until they meet.  What is left is where each run leaves the
   stretch, and how many outputs it made.
2. These summaries are composed, `COMPOSED` stretches a task, then the blocks of them in order, then the stretches of each block: the border
   where every stretch really begins, and the number of its first output.
3. Each stretch is folded once more, from there, and yields its outputs.

A stretch holds its own rows and those of the next one within reach; no task holds a key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import Fold, bucket_of, streamed
from .relational import running

#: Summaries that one task composes.
COMPOSED = 128


@dataclass(frozen=True)
class Jumps:
    """over(rows) gives step(i) -> (row after what begins at row i, outputs of it: 0 or 1); emit(rows, i, j, number) the
    outputs' rows.  A row is (at, *values); what begins at a row depends on rows within `reach` of it."""

    reach: float
    over: Callable[[list[tuple]], Callable[[int], tuple[int, int]]]
    emit: Callable[[list[tuple], int, int, int], list[tuple]]
    returns: str


def word_segments(fewest: float, most: float, pause: float = 0.05) -> Jumps:
    """Rows (start, end, word) to segments of fewest..most, cut at the last pause over `pause` that leaves the least length;
    without one a segment is as long as it may be.  A word that starts beyond `most` doesn't fit, whatever its end."""

    def over(rows):
        def step(i):
            begin, fit = rows[i][0], i
            while fit < len(rows) and rows[fit][1] - begin <= most and rows[fit][0] - begin <= most:
                fit += 1
            if fit == i:
                return i + 1, 0
            at = fit - 1
            if fit < len(rows):
                k = at
                while k >= i and rows[k][1] - begin >= fewest:
                    if rows[k + 1][0] - rows[k][1] > pause:
                        at = k
                        break
                    k -= 1
            good = rows[at][1] - begin >= fewest and any((r[2] or "").strip() for r in rows[i : at + 1])
            return (at + 1, 1) if good else (i + 1, 0)

        return step

    def emit(rows, i, j, number):
        return [(number, rows[i][0], rows[j - 1][1], " ".join(r[2] or "" for r in rows[i:j]))]

    # a next word out of sight lies behind a pause
    return Jumps(most + 2 * pause, over, emit, "number long, start double, end double, text string")


def filled_batches(size: int) -> Jumps:
    """Rows (sum before, id, length) to batches that are full once their lengths reach `size`; the rest makes a last one."""

    def over(rows):
        ends = [r[0] + r[2] for r in rows]
        return lambda i: (min(bisect_left(ends, rows[i][0] + size, i) + 1, len(rows)), 1)

    def emit(rows, i, j, number):
        return [(r[1], r[2], number) for r in rows[i:j]]

    return Jumps(size, over, emit, "id long, length long, batch long")


class _Held(Fold):
    """Collects the rows of one stretch; `own` of them begin in it, `head` within reach of its begin."""

    def __init__(self, jumps: Jumps):
        self.jumps, self.rows, self.own, self.head = jumps, [], 0, 0

    def take(self, own: bool, head: bool, row: tuple):
        self.rows.append(row)
        self.own += own
        self.head += own and head


class Summary(_Held):
    """(own, head, *row) to (exits, counts): for a begin at row 0 to `head`, the row of the next stretch where the run goes on, and its outputs here."""

    def feed(self, row):
        self.take(row[0], row[1], row[2:])
        return ()

    def close(self):
        if not self.own:
            return ()
        step, found = self.jumps.over(self.rows), {}
        for entry in range(self.head + 1):
            path, i = [], entry
            while i < self.own and i not in found:
                j, n = step(i)
                path.append((i, n))
                i = j
            out, count = found[i] if i < self.own else (i - self.own, 0)
            for i, n in reversed(path):
                count += n
                found[i] = (out, count)
            if entry == self.own:
                found[entry] = (0, 0)
        runs = [found[e] for e in range(self.head + 1)]
        return [([e for e, _ in runs], [n for _, n in runs])]


class Composed(Fold):
    """Summaries of stretches in order to that of them all."""

    def __init__(self):
        self.exits = self.counts = None

    def feed(self, row):
        exits, counts = row
        if self.exits is None:
            self.exits, self.counts = exits, counts
        else:
            self.counts = [n + counts[e] for e, n in zip(self.exits, self.counts, strict=True)]
            self.exits = [exits[e] for e in self.exits]
        return ()

    def close(self):
        return [(self.exits, self.counts)]


class Walk(Fold):
    """(place, exits, counts, entry, number) in order to (place, entry, number): where each one begins, and the number of its first output."""

    def __init__(self):
        self.at = None

    def feed(self, row):
        place, exits, counts, entry, number = row
        entry, number = self.at or (entry, number)
        self.at = exits[entry], number + counts[entry]
        return [(place, entry, number)]


class Outputs(_Held):
    """(own, head, entry, number, *row) to the outputs of what begins in the stretch."""

    def feed(self, row):
        if not self.rows:
            self.at, self.number = row[2:4]
        self.take(row[0], row[1], row[4:])
        return ()

    def close(self):
        step, out, i, number = self.jumps.over(self.rows), [], self.at, self.number
        while i < self.own:
            j, n = step(i)
            if n:
                out += self.jumps.emit(self.rows, i, j, number)
            number += n
            i = j
        return out


def _beside(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join in which null keys are equal."""
    other = right.select(*[F.col(c).alias(f"_r{i}") if c in on else F.col(c) for i, c in enumerate(right.columns)])
    named = {c: f"_r{i}" for i, c in enumerate(right.columns) if c in on}
    same = [F.col(c).eqNullSafe(F.col(named[c])) for c in on]
    return left.join(other, reduce(and_, same)).drop(*named.values())


def borders(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _g, exits, counts) to (keys, _g, _entry, _number)."""
    blocks = summaries.withColumn("_b", F.floor(F.col("_g") / COMPOSED))
    lists = "exits array<int>, counts array<long>"
    whole = streamed(blocks, [*keys, "_b"], ["_g"], ["exits", "counts"], Composed, lists)
    begun = whole.withColumns({"_entry": F.lit(0), "_number": F.lit(0).cast("long")})
    at_blocks = streamed(begun, keys, ["_b"], ["_b", "exits", "counts", "_entry", "_number"], Walk, "_b long, _entry int, _number long")
    inside = _beside(blocks, at_blocks, [*keys, "_b"])
    return streamed(inside, [*keys, "_b"], ["_g"], ["_g", "exits", "counts", "_entry", "_number"], Walk, "_g long, _entry int, _number long").drop("_b")


def stretched(rows: DataFrame, keys: list[str], at: str, order: list[str], values: list[str], length: float, jumps: Jumps) -> DataFrame:
    """The keys and outputs of a fold by jumps over the rows of each key, in order of the axis `at` and then of `order`.

    `length` is that of a stretch on the axis, no less than the fold's reach; rows whose place is null are left out.
    """
    if length < jumps.reach:
        raise ValueError("a stretch must be at least as long as the fold's reach")
    placed = rows.where(F.col(at).isNotNull()).withColumn("_home", F.floor(F.col(at) / length).cast("long"))
    head = F.col(at) <= F.col("_home") * length + jumps.reach
    copies = F.when(head, F.array(F.struct(F.col("_home").alias("_g"), F.lit(True).alias("_own")), F.struct((F.col("_home") - 1).alias("_g"), F.lit(False).alias("_own")))).otherwise(F.array(F.struct(F.col("_home").alias("_g"), F.lit(True).alias("_own"))))
    dealt = placed.withColumn("_head", head).withColumn("_copy", F.explode(copies)).select("*", "_copy._g", "_copy._own").drop("_copy", "_home")
    place = [*keys, "_g"]
    held = ["_own", "_head", at, *values]
    summaries = streamed(dealt, place, [at, *order], held, lambda: Summary(jumps), "exits array<int>, counts array<long>")
    known = _beside(dealt, borders(summaries, keys), place)
    return streamed(known, place, [at, *order], ["_own", "_head", "_entry", "_number", at, *values], lambda: Outputs(jumps), jumps.returns).drop("_g")


def segmented(words: DataFrame, file: str, fewest: float, most: float, pause: float = 0.05, length: float | None = None) -> DataFrame:
    """words(file, start, end, word) -> (file, number, start, end, text) of the segments, in stretches of time."""
    jumps = word_segments(fewest, most, pause)
    whole = words.where("start is not null and end is not null")
    return stretched(whole, [file], "start", ["end", "word"], ["end", "word"], length or 64 * jumps.reach, jumps)


def bucket_batches(df: DataFrame, id_: str, length: str, size: int, buckets: int = 200, stretch: int | None = None) -> DataFrame:
    """Rows of like length share a bucket, and each bucket is cut, in order of ids, into batches of at least `size` (but the
    last): (bucket, id, length, batch), in stretches of the running sum.  A null length counts 0."""
    ends = df.agg(F.min(length).alias("_lo"), F.max(length).alias("_hi"))
    rows = df.crossJoin(F.broadcast(ends)).select(bucket_of(F.col(length), F.col("_lo"), F.col("_hi"), buckets).alias("bucket"), F.col(id_).cast("long").alias("id"), F.coalesce(F.col(length).cast("long"), F.lit(0)).alias("length"))
    placed = running(rows, "id", ["bucket"], F.col("length"), "before")
    return stretched(placed, ["bucket"], "before", ["id"], ["id", "length"], stretch or 64 * size, filled_batches(size))
