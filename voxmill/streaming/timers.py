"""Jobs that end: a state machine with event-time timers, on the state API of Structured Streaming.

A job is open from its first event; a terminal status closes it for good, and so does silence: `patience_ms` after the
last event a timer ends it as `timeout`.  States live in the RocksDB store, so a restart on the same checkpoint goes on with them.

A call of Python and its questions to the store cost far more than a job's few events, so jobs of neighbouring numbers share them: 32
jobs are one key of the stream, with one value and one timer.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATUS = "job_id long, status string, n long"
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OPEN, SILENT = "processing", "timeout"
#: How late an event may come.
LATE = "1 second"
#: Last bits of a job's number that its key of the stream leaves out.  A checkpoint goes on only under the same.
SHARED = 5


@contextmanager
def rocks(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE[0])
        else:
            spark.conf.set(STORE[0], before)


def after(jobs: pd.DataFrame, events: pd.DataFrame, terminal: dict[str, str], patience: int) -> pd.DataFrame:
    """Open jobs (status, n, at by job_id) after their events(job_id, us, id, status), those that have any: each stops at its first end or silence."""
    events = events.sort_values(["job_id", "us", "id"])
    job, at = events["job_id"].to_numpy(), events["us"].to_numpy() // 1000
    status = np.array([terminal.get(x, OPEN) for x in events["status"]], object)
    first = np.flatnonzero(np.r_[True, job[1:] != job[:-1]])
    last = np.r_[first[1:], len(job)] - 1
    n = jobs["n"].reindex(job[first], fill_value=0)
    before = np.roll(at, 1)
    before[first] = jobs["at"].reindex(job[first], fill_value=0)
    silent = at - before >= patience
    silent[first] &= n.to_numpy() > 0
    over = np.where(silent | (status != OPEN), np.arange(len(job)), len(job))
    stop = np.minimum(np.minimum.reduceat(over, first), last)
    hush = silent[stop]
    return pd.DataFrame({"status": np.where(hush, SILENT, status[stop]), "n": n + stop - first + ~hush, "at": np.where(hush, before[stop], at[stop])}, index=n.index)


class Jobs(StatefulProcessor):
    """One value for the jobs of a key: their (status, events so far, milliseconds of the last one), side by side.  One timer, where the
    patience of the first of them ends."""

    def __init__(self, terminal: dict[str, str], patience_ms: int):
        self.terminal, self.patience = terminal, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.jobs = handle.getValueState("jobs", "job_id array<long>, status array<string>, n array<long>, at array<long>")

    def held(self) -> pd.DataFrame:
        job, status, n, at = self.jobs.get() or ([], [], [], [])
        return pd.DataFrame({"status": np.array(status, object), "n": np.array(n, "int64"), "at": np.array(at, "int64")}, index=pd.Index(np.array(job, "int64"), name="job_id"))

    def due(self, jobs: pd.DataFrame) -> int | None:
        waiting = jobs["at"][jobs["status"] == OPEN]
        return int(waiting.min()) + self.patience if len(waiting) else None

    def keep(self, jobs: pd.DataFrame, timer: int | None) -> None:
        """These jobs from now on, in place of those that `timer` was set for."""
        self.jobs.update((jobs.index.tolist(), *(jobs[c].tolist() for c in ("status", "n", "at"))))
        due = self.due(jobs)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        jobs = self.held()
        closed = jobs.index[jobs["status"] != OPEN]
        events = pd.concat([r.loc[~r["job_id"].isin(closed), ["job_id", "us", "id", "status"]] for r in rows])
        if events.empty:
            return
        changed = after(jobs, events, self.terminal, self.patience)
        self.keep(pd.concat([jobs[~jobs.index.isin(changed.index)], changed]), self.due(jobs))
        yield changed.rename_axis("job_id").reset_index()[["job_id", "status", "n"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        jobs, timer = self.held(), expiredTimerInfo.getExpiryTimeInMs()
        silent = (jobs["status"] == OPEN) & (jobs["at"] + self.patience <= max(timer, timerValues.getCurrentWatermarkInMs()))
        if silent.any():
            jobs.loc[silent, "status"] = SILENT
            self.keep(jobs, timer)
            yield jobs[silent].reset_index()[["job_id", "status", "n"]]

    def close(self) -> None:
        pass


def job_states(events: DataFrame, terminal: dict[str, str], patience_ms: int) -> DataFrame:
    """events(job_id, ts, id, status) as a stream -> (job_id, status, n) whenever a job changes; n counts its events up to its end.

    A job's events of one micro-batch are put in order by time and id; those of later batches must be later, but for LATE.
    """
    rows = events.where("job_id is not null and ts is not null").withWatermark("ts", LATE)
    job, last = F.col("job_id").cast("long"), F.lit(2**63 - 1)
    timed = rows.select(F.shiftright(job, SHARED).alias("key"), job.alias("job_id"), "ts", F.unix_micros("ts").alias("us"), F.coalesce(F.col("id").cast("long"), last).alias("id"), "status")
    return timed.groupBy("key").transformWithStateInPandas(Jobs(terminal, patience_ms), STATUS, "Update", "EventTime")
