"""Table functions for SQL: one row or one partition in, many rows out.

`register(spark)` makes them known: segments(TABLE(words) PARTITION BY file ORDER BY start, fewest, most) and
sentences(text, fewest), the latter for LATERAL joins.
"""

from __future__ import annotations

import re

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators.folds import Segments

_BEHIND = re.compile(r"(?<=[.!?;])\s+")


class SegmentsTable:
    """The words (file, start, end, word) of one file, in their order, to its segments; the fold holds one window of words."""

    def __init__(self):
        self.fold = self.file = None
        self.number = 0

    @staticmethod
    def analyze(words: AnalyzeArgument, fewest: AnalyzeArgument, most: AnalyzeArgument) -> AnalyzeResult:
        if not words.isTable or not {"start", "end", "word"} < set(words.dataType.names):
            raise ValueError("segments takes a table of a file's column, start, end and word")
        rest = [f for f in words.dataType.fields if f.name not in ("start", "end", "word")]
        made = T.StructType([rest[0]]).add("number", T.LongType()).add("start", T.DoubleType()).add("end", T.DoubleType()).add("text", T.StringType())
        return AnalyzeResult(made)

    def rows(self, made):
        for begin, end, text in made:
            yield self.file, self.number, begin, end, text
            self.number += 1

    def eval(self, words: Row, fewest: float, most: float):
        if self.fold is None:
            self.fold = Segments(float(fewest), float(most))
            self.file = next(v for k, v in words.asDict().items() if k not in ("start", "end", "word"))
        yield from self.rows(self.fold.feed((words["start"], words["end"], words["word"])))

    def terminate(self):
        if self.fold is not None:
            yield from self.rows(self.fold.close())


class SentencesTable:
    """The sentences of a text, short ones joined with the next, a short rest with the last."""

    def eval(self, text: str, fewest: int):
        done, held = [], ""
        for piece in filter(None, _BEHIND.split((text or "").strip())):
            held = f"{held} {piece}" if held else piece
            if len(held.split()) >= fewest:
                done.append(held)
                held = ""
        if held and done:
            done[-1] += f" {held}"
        elif held:
            done.append(held)
        yield from enumerate(done)


def register(spark: SparkSession) -> None:
    spark.udtf.register("segments", F.udtf(SegmentsTable))
    spark.udtf.register("sentences", F.udtf(SentencesTable, returnType="pos int, sentence string"))
