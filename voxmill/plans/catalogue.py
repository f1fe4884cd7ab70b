"""All registered queries of the reference operators and their DuckDB SQL, from the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregates, files, filters, joins, ordering, scores, segments, speech, streams, texts

MODULES = (filters, joins, aggregates, ordering, texts, scores, segments, speech, streams, files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in MODULES for k, (_, sql) in m.QUERIES.items() if sql}
