"""Structured Streaming jobs: folders followed until they are read up, micro-batches saved once, progress as rows.

Every job names its checkpoint, so that a restart goes on where it stopped, and no source file is ever deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener


def followed(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", glob: str | None = None, files: int | None = None, archive: str | None = None, deep: bool = False) -> DataFrame:
    """A folder as a stream, with `deep` all that lies below it.  With `archive` read files are moved there."""
    reader = spark.readStream.schema(schema).format(kind)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if deep:
        reader = reader.option("recursiveFileLookup", "true")
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def triggered(writer, every: str | None = None):
    """Once through what is there, or at an interval for ever."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def saved(stream: DataFrame, out: str, checkpoint: str, every: str | None = None):
    """Rows appended to a Parquet folder, exactly once; returns the running query."""
    return triggered(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint), every).start()


def saved_batches(stream: DataFrame, out: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda b: b, every: str | None = None):
    """Each micro-batch in a folder of its number: a batch that is run again overwrites itself."""

    def save(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return triggered(stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint), every).start()


def charted(totals: DataFrame, out: str, checkpoint: str, every: str | None = None):
    """The whole aggregate after each micro-batch, in place of the one before."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    return triggered(totals.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", checkpoint), every).start()


def new_only(batch: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done, each key once."""
    return batch.join(done.select(key).distinct(), key, "left_anti").dropDuplicates([key])


class Progress(StreamingQueryListener):
    """What the micro-batches of one query read and wrote, as rows; `told(rows so far, share of total)` is called after each."""

    def __init__(self, total: int | None = None, told: Callable[[int, float | None], None] = lambda rows, share: None):
        self.total, self.told, self.batches, self.run, self.ended = total, told, {}, None, Event()

    def onQueryStarted(self, event) -> None:
        self.run = self.run or event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.runId != self.run:
            return
        # a batch without rows may be told twice; the last word counts
        self.batches[p.batchId] = (p.batchId, p.numInputRows, p.batchDuration)
        seen = sum(rows for _, rows, _ in self.batches.values())
        self.told(seen, seen / self.total if self.total else None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()

    def rows(self, spark: SparkSession, wait: float = 60.0) -> DataFrame:
        """(batch, rows, milliseconds), once the query has ended and all its batches are told."""
        if not self.ended.wait(wait):
            raise TimeoutError("the query's end wasn't told")
        return spark.createDataFrame(sorted(self.batches.values()), "batch long, rows long, milliseconds long")


@contextmanager
def watched(spark: SparkSession, progress: Progress):
    """The next query that is started inside tells its progress."""
    spark.streams.addListener(progress)
    try:
        yield progress
    finally:
        spark.streams.removeListener(progress)
