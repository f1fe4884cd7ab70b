"""Nodes of JSON documents whose layout isn't known: a walk over VARIANT values, a level a round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE = ("path", "item", "name", "node")


def _level(nodes: DataFrame, key: str) -> DataFrame:
    """The children of every node.  An element of an array keeps the array's name and begins an item of its own."""
    listed = "schema_of_variant(n.node) LIKE 'ARRAY%'"
    child = "concat(n.path, array(e.pos))"
    return nodes.sparkSession.sql(f"SELECT n.{key}, {child} AS path, CASE WHEN {listed} THEN {child} ELSE n.item END AS item, CASE WHEN {listed} THEN n.name ELSE e.key END AS name, e.value AS node FROM {{nodes}} n, LATERAL variant_explode(n.node) e", nodes=nodes)


def rooted(rows: DataFrame, key: str, json: Column) -> DataFrame:
    """Each document as a node without a name; broken ones are left out."""
    none = F.expr("cast(array() as array<int>)")
    return rows.select(key, none.alias("path"), none.alias("item"), F.lit("").alias("name"), F.try_parse_json(json).alias("node")).where("node is not null")


def found(nodes: DataFrame, key: str, names: tuple[str, ...], put, rounds: int = 200) -> DataFrame:
    """(key, path, item, name, node) of all nodes below with one of the names, at any depth, but not of what lies below them.

    `path` holds the places from the root, in whose order nodes stand in the document (fields of an object by their
    names); `item` is the path of the nearest element of an array around a node.  `put(df)` writes a level and reads it back.
    """
    level, out = put(nodes), None
    for _ in range(rounds):
        here = level.where(F.col("name").isin(*names) & (F.size("path") > 0))
        out = here if out is None else out.unionByName(here)
        below = level.where(~F.col("name").isin(*names) | (F.size("path") == 0))
        level = put(_level(below, key))
        if not level.limit(1).count():
            return out
    raise RuntimeError(f"documents are deeper than {rounds} levels")


def first_found(nodes: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Of each key's nodes the first by path, of the earliest of the names that any has; its path begins anew."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("name"))
    best = nodes.groupBy(key).agg(F.min(F.struct(rank.alias("rank"), "path")).alias("_best"))
    none = F.expr("cast(array() as array<int>)")
    met = nodes.withColumnRenamed(key, "_key").join(best, F.col("_key") == F.col(key)).where(F.col("_best.path") == F.col("path"))
    return met.select(key, none.alias("path"), none.alias("item"), "name", "node")
