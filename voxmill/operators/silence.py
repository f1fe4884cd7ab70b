"""Silences of recordings of any length: blocks, quiet runs, split points, what shortening leaves out.  No recording is one task's work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import numbered, running
from .stretches import Jumps, stretched


def blocks(pieces: DataFrame, file: str, order: str, samples: str, size: int) -> DataFrame:
    """pieces(file, order integer, samples) -> (file, k, level): the levels in dB, to a millionth, of blocks of `size` samples,
    numbered in a file.  A piece holds whole blocks, but for its last one."""
    n = F.ceil(F.size(samples) / size).cast("long")
    counted = running(pieces.where(F.size(samples) > 0).select(file, order, samples, n.alias("_blocks")), order, [file], F.col("_blocks"), "_first")
    block = lambda b: F.slice(samples, (b * size + 1).cast("int"), F.lit(size))
    power = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")) / F.size(x)
    level = lambda b: F.round(20 * F.log10(F.greatest(F.sqrt(power(block(b))), F.lit(1e-10))), 6)
    each = F.posexplode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), level)).alias("_b", "level")
    return counted.select(file, "_first", each).select(file, (F.col("_first") + F.col("_b")).alias("k"), "level")


def quiet_runs(levels: DataFrame, file: str, quiet: float, least: int) -> DataFrame:
    """(file, first, last) of the runs of at least `least` blocks under `quiet`; `last` is the block behind."""
    # a block's number less its place among the quiet ones is the same along a run
    placed = numbered(levels.where(F.col("level") < quiet).select(file, "k"), "k", [file], "_place")
    runs = placed.groupBy(file, (F.col("k") - F.col("_place")).alias("_run")).agg(F.min("k").alias("first"), (F.max("k") + 1).alias("last"))
    return runs.where(F.col("last") - F.col("first") >= least).select(file, "first", "last")


def forced_cuts(longest: int) -> Jumps:
    """From a cut on, while more than `longest` blocks follow: to the quietest block of the last fifth of that stretch."""
    begin = int(longest * 0.8)

    def over(rows):
        def step(i):
            if len(rows) - i <= longest or begin >= longest:
                return len(rows), 0
            window = range(i + begin, i + longest)
            return min(window, key=lambda j: rows[j][1]), 1

        return step

    return Jumps(longest, over, lambda rows, i, j, number: [(int(rows[j][0]),)], "cut long")


def split_points(levels: DataFrame, file: str, quiet: float, least: int, longest: int, length: int | None = None) -> DataFrame:
    """(file, cut): the block at the middle of each silence of `least` blocks, rounded down, the quietest ones where two cuts lie more than
    `longest` blocks apart, 0, and the block behind the last."""
    middles = quiet_runs(levels, file, quiet, least).select(F.col(file).alias("_file"), F.floor((F.col("first") + F.col("last")) / 2).alias("cut"))
    marked = levels.join(middles, F.col(file).eqNullSafe(F.col("_file")) & (F.col("k") == F.col("cut")), "left").select(file, "k", "level", F.col("cut").isNotNull().cast("long").alias("_cut"))
    # from one cut to the next
    between = running(marked, "k", [file], F.col("_cut"), "_before").withColumn("_part", F.col("_before") + F.col("_cut"))
    forced = stretched(between, [file, "_part"], "k", [], ["level"], length or 16 * longest, forced_cuts(longest)).select(file, "cut")
    ends = levels.groupBy(file).agg(F.max("k").alias("k")).select(file, F.explode(F.array(F.lit(0).cast("long"), F.col("k") + 1)).alias("cut"))
    return forced.unionByName(middles.select(F.col("_file").alias(file), "cut")).unionByName(ends).distinct()


def left_out(levels: DataFrame, file: str, quiet: float, least: int, keep: int) -> DataFrame:
    """(file, from, to): blocks that shortening leaves out, of silences of `least` blocks all but `keep` at the side of what is heard; a
    silence at an end has one such side, and a file that is all silence none."""
    ends = levels.groupBy(F.col(file).alias("_file")).agg((F.max("k") + 1).alias("_n"))
    runs = quiet_runs(levels, file, quiet, least).join(ends, F.col(file).eqNullSafe(F.col("_file")))

    def side(at: Column, end: Column | int, by: int) -> Column:
        return F.when(at == end, at).otherwise(at + by)

    spans = runs.select(file, side(F.col("first"), F.lit(0), keep).alias("from"), side(F.col("last"), F.col("_n"), -keep).alias("to"))
    return spans.where(F.col("from") < F.col("to"))
