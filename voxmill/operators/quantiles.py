"""Exact quantiles of groups of any size, by counting refinement, and equal-width histograms.

A quantile lies between two ranks.  For each rank asked for, the range that holds it is cut into cells, the values in
them are counted, and the cell with the rank, shrunk to the values that it has, is the next range: only counts are gathered, never values.
A range ends when its least and greatest value are one.
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a range, and the most rounds of refinement.
CELLS, ROUNDS = 4096, 60
MOST, SMALLEST = sys.float_info.max, 1e-300


def _same(by: list[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]


def _renamed(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_by_{c}" for c in by})


def numbers(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, _v) without null and NaN; infinite values count as the greatest double."""
    v = F.col(value).cast("double")
    return rows.where(v.isNotNull() & ~F.isnan(v)).select(*by, F.greatest(F.lit(-MOST), F.least(F.lit(MOST), v)).alias("_v"))


def cell_of(value: Column, low: Column, high: Column, cells: int) -> Column:
    """A cell from 0 of a value in low..high; the last one holds `high`.  Cells are equally wide, or, where a range spans
    orders of magnitude, equal factors."""

    def place(x: Column) -> Column:
        return F.signum(x) * (F.log(F.greatest(F.abs(x), F.lit(SMALLEST))) - F.log(F.lit(SMALLEST)))

    least, most = F.least(F.abs(low), F.abs(high)), F.greatest(F.abs(low), F.abs(high))
    spans = (low <= 0) & (high >= 0) | (most > cells * least)
    # halves, as the difference of two doubles may be none
    part = F.when(spans, (place(value) - place(low)) / (place(high) - place(low))).otherwise((value / 2 - low / 2) / (high / 2 - low / 2))
    return F.when(high > low, F.least(F.lit(cells - 1), F.floor(part * cells).cast("int"))).otherwise(F.lit(0))


def ranked_values(rows: DataFrame, by: list[str], value: str, ranks: DataFrame, place) -> DataFrame:
    """(by, rank, value): the value at each rank from 0 of its group; ranks(by, rank, low, high) has a group's ends.

    `place(df)` writes a small table and reads it back.
    """
    state = place(ranks.withColumn("before", F.lit(0).cast("long")))
    for _ in range(ROUNDS):
        if not state.where("low < high").limit(1).count():
            break
        open_ = _renamed(state.where("low < high"), by)
        inside = F.col(value).between(F.col("low"), F.col("high"))
        met = rows.select(*by, value).join(open_, reduce(and_, [*_same(by), inside]))
        key = [*[f"_by_{c}" for c in by], "rank", "before"]
        counted = met.groupBy(*key, cell_of(F.col(value), F.col("low"), F.col("high"), CELLS).alias("cell")).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
        # at most CELLS rows for a rank of a group
        upto = F.sum("n").over(Window.partitionBy(*key).orderBy("cell"))
        found = counted.withColumn("upto", F.col("before") + upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        narrowed = found.select(*[F.col(f"_by_{c}").alias(c) for c in by], "rank", F.col("least").alias("low"), F.col("most").alias("high"), (F.col("upto") - F.col("n")).alias("before"))
        state = place(state.where("low >= high").unionByName(narrowed))
    else:
        raise RuntimeError(f"quantiles haven't settled in {ROUNDS} rounds")
    return state.select(*by, "rank", F.col("low").alias("value"))


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float], place) -> DataFrame:
    """(by, n, least, most, *names) with each share's quantile between its two ranks; null and NaN values are left out."""
    known = numbers(rows, by, value)
    ends = place(known.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most")))
    at = {name: (F.col("n") - 1) * F.lit(float(share)) for name, share in shares.items()}
    asked = F.array_distinct(F.concat(*[F.array(F.floor(a), F.ceil(a)) for a in at.values()]))
    ranks = ends.select(*by, F.explode(asked).alias("rank"), F.col("least").alias("low"), F.col("most").alias("high"))
    values = ranked_values(known, by, "_v", ranks, place).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    both = ends.join(_renamed(values, by), reduce(and_, _same(by), F.lit(True)))
    low, high = (lambda a: F.element_at("_at", F.floor(a))), (lambda a: F.element_at("_at", F.ceil(a)))
    made = {name: low(a) + (high(a) - low(a)) * (a - F.floor(a)) for name, a in at.items()}
    return both.select(*by, "n", "least", "most", *[c.alias(name) for name, c in made.items()])


def bins_for(n: Column, fewest: int = 5, most: int = 20) -> Column:
    """As many bins as half the values, within limits."""
    return F.greatest(F.lit(fewest), F.least(F.lit(most), F.floor(n / 2))).cast("int")


def histogram(rows: DataFrame, by: list[str], value: str, bins=bins_for) -> DataFrame:
    """(by, bin from 0, low, high, n) of equal-width bins between a group's ends, empty ones too; where all values are one,
    the bins lie half a unit to both sides of it."""
    known = numbers(rows, by, value)
    ends = known.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    wide = ends.select(*by, bins(F.col("_n")).alias("_bins"), F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"), F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    met = known.join(_renamed(wide, by), reduce(and_, _same(by), F.lit(True)))
    counts = met.groupBy(*by, F.least(F.col("_bins") - 1, F.floor((F.col("_v") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / F.col("_bins")))).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    every = wide.select("*", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("bin"))
    found = _renamed(counts, by).withColumnRenamed("bin", "_bin")
    joined = every.join(found, reduce(and_, [*_same(by), F.col("bin") == F.col("_bin")]), "left")
    return joined.select(*by, "bin", (F.col("_lo") + step * F.col("bin")).alias("low"), (F.col("_lo") + step * (F.col("bin") + 1)).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))
