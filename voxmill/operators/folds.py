"""Sequential folds: segments, batches, balanced bins.

`streamed` deals rows by key, sorts them inside their partitions and feeds them to a fold whose state is bounded, so a
large key is never held in memory.  `stretches` spreads one key over many tasks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .relational import numbered


class Fold:
    """Takes the rows of one key in order; both methods return output tuples."""

    def feed(self, row: tuple) -> Iterable[tuple]:
        raise NotImplementedError

    def close(self) -> Iterable[tuple]:
        return ()


def streamed(df: DataFrame, keys: list[str], order: list[str], values: list[str], start: Callable[[], Fold], returns: str) -> DataFrame:
    """The keys and what a fold returns for the rows of each; `returns` is the DDL of the fold's columns."""
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType([*key_fields, *T.StructType.fromDDL(returns).fields])
    arrow = to_arrow_schema(schema)
    width = len(keys)

    def run(batches):
        fold, current = None, None
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if fold is None or row[:width] != current:
                    if fold is not None:
                        out += [current + tuple(x) for x in fold.close()]
                    fold, current = start(), row[:width]
                out += [current + tuple(x) for x in fold.feed(row[width:])]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], schema=arrow)
        if fold is not None and (out := [current + tuple(x) for x in fold.close()]):
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], schema=arrow)

    rows = df.select(*keys, *values, *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)])
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *[f"_by{i}" for i in range(len(order))])
    return dealt.select(*keys, *values).mapInArrow(run, schema)


class Segments(Fold):
    """Words (start, end, word) to segments of fewest..most seconds, cut at the last pause over `pause` that leaves the
    least length; without one the segment is as long as it may be.  Holds the words of one window only."""

    def __init__(self, fewest: float, most: float, pause: float = 0.05):
        self.fewest, self.most, self.pause, self.held = fewest, most, pause, deque()

    def feed(self, row):
        if row[0] is None or row[1] is None:
            return []
        self.held.append(row)
        return self._cut(False)

    def close(self):
        return self._cut(True)

    def _cut(self, last: bool):
        out, w = [], self.held
        while w:
            begin = w[0][0]
            fit = sum(1 for _ in takewhile(lambda x: x[1] - begin <= self.most, w))
            if fit == len(w) and not last:
                break
            at = fit - 1
            if fit and fit < len(w):
                long = takewhile(lambda k: w[k][1] - begin >= self.fewest, range(fit - 1, -1, -1))
                at = next((k for k in long if w[k + 1][0] - w[k][1] > self.pause), at)
            said = " ".join(w[k][2] or "" for k in range(at + 1))
            good = fit and w[at][1] - begin >= self.fewest and said.strip()
            if good:
                out.append((begin, w[at][1], said))
            for _ in range(at + 1 if good else 1):
                w.popleft()
        return out


class FrameBatches(Fold):
    """(id, frames) to (id, frames, batch): a batch holds at most `budget` frames and `most` rows (0: any number).  A row
    over the budget is left out and closes the open batch."""

    def __init__(self, budget: float, most: int = 0):
        self.budget, self.most, self.batch, self.total, self.rows = budget, most, 0, 0.0, 0

    def feed(self, row):
        size = row[1]
        if size is None:
            return []
        if self.total + size > self.budget or (self.most and self.rows >= self.most):
            self.batch += self.rows > 0
            self.total, self.rows = 0.0, 0
            if size > self.budget:
                return []
        self.total, self.rows = self.total + size, self.rows + 1
        return [(row[0], size, self.batch)]


def class_runs(counts: list[tuple[int, int]], budget: int, most: int) -> list[tuple[int, int, int, int, int]]:
    """For each class of equal frames, in order: (frames, rows that the open batch takes, its number, the number of the
    batch after it, rows of a batch of this class alone)."""
    out, batch, total, rows = [], 0, 0, 0
    for size, n in counts:
        if size > budget:
            break
        each = max(1, min(budget // size if size else n, most or n))
        first = min(n, (budget - total) // size if size else n, most - rows if most else n)
        after = batch + (rows + first > 0)
        out.append((size, first, batch, after, each))
        left = n - first
        if left:
            batch, rows = after + (left - 1) // each, (left - 1) % each + 1
            total = rows * size
        else:
            total, rows = total + first * size, rows + first
    return out


def frame_batches(df: DataFrame, id_: str, frames: str, budget: int, most: int = 0) -> DataFrame:
    """(id, frames, batch): rows in order of their whole-numbered frames, then ids, into batches of at most `budget` frames
    and `most` rows (0: any number); rows over the budget are left out.

    Rows of equal frames are alike, so the batches follow from the counts by frames (at most budget + 1 of them) and a
    row's batch from its rank among its like: nothing is folded row by row.
    """
    rows = df.select(F.col(id_).cast("long").alias("id"), F.col(frames).cast("long").alias("frames")).where("frames is not null")
    counts = rows.groupBy(F.least("frames", F.lit(budget + 1)).alias("frames")).agg(F.count("*").alias("n"))
    runs = class_runs(sorted((int(r[0]), int(r[1])) for r in counts.collect()), budget, most)
    found = df.sparkSession.createDataFrame(runs, "frames long, _first long, _batch long, _next long, _each long")
    ranked = numbered(rows.where(F.col("frames") <= budget), "id", ["frames"])
    joined = ranked.join(F.broadcast(found), "frames")
    return joined.select("id", F.col("frames").cast("double").alias("frames"), F.when(F.col("_k") < F.col("_first"), F.col("_batch")).otherwise(F.col("_next") + F.floor((F.col("_k") - F.col("_first")) / F.col("_each"))).cast("long").alias("batch"))


def bucket_of(length: Column, low: Column | float, high: Column | float, buckets: int = 200) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.floor((length - low) / (high - low + 1) * buckets).cast("int")


def balanced(groups: DataFrame, name: str, size: str, bins: int = 5) -> DataFrame:
    """Largest first into the lightest bin, the first of equal ones: (name, size, bin).  The rows are group totals (as many
    as there are speakers or folders); they are folded in one native aggregate."""
    item = F.struct((-F.col(size).cast("double")).alias("neg"), F.col(name).cast("string").alias("name"))
    sums = F.expr(f"transform(sequence(1, {bins}), x -> 0D)")
    start = F.struct(sums.alias("sums"), F.expr("cast(array() as array<int>)").alias("at"))

    def place(acc: Column, x: Column) -> Column:
        k = F.array_position(acc["sums"], F.array_min(acc["sums"])).cast("int")
        return F.struct(F.transform(acc["sums"], lambda v, i: F.when(i == k - 1, v - x["neg"]).otherwise(v)).alias("sums"), F.concat(acc["at"], F.array(k - 1)).alias("at"))

    all_ = groups.where(F.col(size).isNotNull()).agg(F.array_sort(F.collect_list(item)).alias("items"))
    placed = all_.select("items", F.aggregate("items", start, place)["at"].alias("at"))
    one = placed.select(F.explode(F.arrays_zip("items", "at")).alias("z"))
    return one.select(F.col("z.items.name").alias("name"), (-F.col("z.items.neg")).alias("size"), F.col("z.at").alias("bin"))
