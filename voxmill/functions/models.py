"""Where neural models plug in: loaded once a worker, applied to Arrow batches; a failed row gives nulls."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_loaded: dict[str, object] = {}


def once(name: str, load: Callable[[], object]) -> object:
    """The worker's only model; another name takes its place."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = load()
    return _loaded[name]


def applied(df: DataFrame, name: str, load: Callable[[], Callable[[dict], dict]], returns: str) -> DataFrame:
    """All columns of df and those that the model gives for each row (a dict in, a dict out)."""
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(returns).fields])
    added = [f.name for f in T.StructType.fromDDL(returns).fields]

    def run(frames):
        model = once(name, load)
        for frame in frames:
            made = []
            for row in frame.to_dict("records"):
                try:
                    out = model(row) or {}
                except Exception:  # noqa: BLE001  any fault of a plugged-in model is that row's alone
                    out = {}
                made.append([out.get(c) for c in added])
            yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(made, columns=added, dtype=object)], axis=1)

    return df.mapInPandas(run, schema)


def first_good(candidates: list[Column], good: Callable[[Column], Column]) -> Column:
    """The first candidate that passes, else null: a chain of fallbacks.  Rows without any are rejects, never deleted."""
    return F.coalesce(*[F.when(good(c), c) for c in candidates])


def clipped(score: Column, low: float, high: float) -> Column:
    return F.when(score.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), score)))
