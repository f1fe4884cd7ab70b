"""Joins, first and last rows of keys, caps and prefixes, as DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(rows: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    return rows.join(done, on, "left_anti")


#: Rows of a stretch of a table that is numbered or summed in order, once it has more than a task for each core.
STRETCH_ROWS = 1 << 20


def stretch_of(rows: DataFrame, key: str, stretch: int = STRETCH_ROWS) -> Column:
    """The number of a row's stretch, in order of an integer key; as many stretches as the rows ask for.

    Keys that fill their range (a quarter of it at least) are cut evenly, which takes their ends and count only; others at
    approximate quantiles.
    """
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // stretch))
    at = F.col(key).cast("long")
    if not n or high - low < 4 * max(n, parts):
        return F.floor((at - F.lit(low or 0)) / F.lit(float((high or 0) - (low or 0) + 1)) * parts).cast("int")
    lows = rows.stat.approxQuantile(key, [k / parts for k in range(1, parts)], 1 / (4 * parts))
    borders = sorted({int(x) for x in lows})
    # as long as there are stretches
    return F.size(F.filter(F.lit(borders), lambda b: b <= at)) if borders else F.lit(0)


#: Rows of a task whose work doesn't show in their bytes, and the most tasks for that.
SPREAD_ROWS, SPREAD_TASKS = 1_000, 10_000


def spread(rows: DataFrame, key: str | Column, like: DataFrame | None = None, each: int = SPREAD_ROWS) -> DataFrame:
    """rows dealt out by their number, as many as `like` has: by bytes few tasks would take all of what is short, but long at work."""
    n = (rows if like is None else like).count()
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, min(SPREAD_TASKS, -(-n // each))), key)


def running(rows: DataFrame, key: str, by: list[str], value: Column, name: str) -> DataFrame:
    """rows with the sum of `value` over the rows before them, in order of an integer key within `by`.

    The key's range is cut into stretches; sums run within a stretch, and the stretches before it are summed up: no
    group, and not the whole table, is one task's work.
    """
    keyed = rows.withColumns({"_running_at": stretch_of(rows, key), "_running_value": value})
    sums = keyed.groupBy(*by, "_running_at").agg(F.sum("_running_value").alias("_running_n"))
    # one row for each group and stretch
    before = Window.partitionBy(*by).orderBy("_running_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_running_by_{c}") for c in by], F.col("_running_at").alias("_running_stretch"), F.coalesce(F.sum("_running_n").over(before), F.lit(0)).alias("_running_before"))
    same = F.col("_running_at").eqNullSafe(F.col("_running_stretch"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_running_by_{c}"))
    inside = F.coalesce(F.sum("_running_value").over(Window.partitionBy(*by, "_running_at").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = keyed.withColumn("_running_inside", inside).join(sums, same).withColumn(name, F.col("_running_before") + F.col("_running_inside"))
    return out.drop("_running_at", "_running_value", "_running_stretch", "_running_before", "_running_inside", *[f"_running_by_{c}" for c in by])


def numbered(rows: DataFrame, key: str, by: list[str] | None = None, name: str = "_k") -> DataFrame:
    """rows with their number, from 0, in order of an integer key within `by`."""
    return running(rows, key, by or [], F.lit(1).cast("long"), name)


def capped(rows: DataFrame, group: str, order: list, each: int, overall: int) -> DataFrame:
    """At most `each` rows of a group, and `overall` in all, groups in their order.

    Ranks stay within groups.  Every group has a row at least, so only the first `overall` groups count; the rows before
    each of these are summed over them alone.
    """
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_k") <= each)
    first = ranked.groupBy(group).agg(F.count("*").alias("_n")).orderBy(group).limit(overall)
    before = first.select(group, F.coalesce(F.sum("_n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranked.join(F.broadcast(before), group).where(F.col("_before") + F.col("_k") <= overall).drop("_k", "_before")


def wide(rows: DataFrame, key: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    return rows.groupBy(*key).pivot(name, names).agg(F.first(value, ignorenulls=True))


def islands(rows: DataFrame, key: list[str], order: list, flag: str) -> DataFrame:
    """Runs of equal flags: (key, run, flag, n)."""
    w = Window.partitionBy(*key).orderBy(*order)
    new = F.when(F.lag(flag).over(w).isNull() | (F.lag(flag).over(w) != F.col(flag)), 1).otherwise(0)
    marked = rows.withColumn("_new", new).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(*key, "run", flag).agg(F.count("*").alias("n"))
