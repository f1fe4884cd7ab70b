"""Folds by stretches against whole-key versions; numbers and sums in order; table functions; jobs with timers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voxmill.functions import tables
from voxmill.operators import folds, stretches
from voxmill.operators import relational as R
from voxmill.streaming import jobs, timers


def plain_batches(rows, size):
    out, batch, total = [], 0, 0
    for i, n in rows:
        out.append((i, n, batch))
        total += n
        if total >= size:
            batch, total = batch + 1, 0
    return out


def plain_segments(words, fewest, most):
    fold, out = folds.Segments(fewest, most), []
    for w in words:
        out += fold.feed(w)
    return [(k, *x) for k, x in enumerate([*out, *fold.close()])]


def made_words(pick, n):
    at, out = 0.0, []
    for _ in range(n):
        at += pick.choice([0.0, 0.3, 0.34, 0.4, 2.0, 50.0 if pick.random() < 0.02 else 0.3])
        out.append((round(at, 3), round(at + pick.choice([0.0, 0.3, 0.3, 6.0 if pick.random() < 0.05 else 0.25]), 3), pick.choice(["a", "b", " ", "c", None])))
    return sorted(out, key=lambda w: (w[0], w[1], w[2] is not None, w[2] or ""))


@pytest.fixture(scope="module")
def words():
    pick = random.Random(5)
    return {**{k: made_words(pick, pick.randint(1, 400)) for k in range(60)}, None: made_words(pick, 200)}


@pytest.mark.parametrize("length", [5.1, 12.0, 1e6])
def test_segments_by_stretches_are_those_of_the_whole_key(spark, words, length):
    rows = [(k, *w) for k, ws in words.items() for w in ws]
    df = spark.createDataFrame(rows, "file long, start double, end double, word string").repartition(7)
    got = {}
    for r in stretches.segmented(df, "file", 2.0, 5.0, length=length).collect():
        got.setdefault(r.file, []).append((r.number, r.start, r.end, r.text))
    for k, ws in words.items():
        assert sorted(got.get(k, [])) == plain_segments(ws, 2.0, 5.0), k


def test_batches_by_stretches_are_those_of_the_whole_bucket(spark):
    pick = random.Random(6)
    rows = [(i, pick.choice([0, 1, 3, 10, 200])) for i in pick.sample(range(10**6), 3000)]
    df = spark.createDataFrame([*rows, (10**7, None)], "id long, n long")
    got = stretches.bucket_batches(df, "id", "n", 40, buckets=3, stretch=50).collect()
    by = {}
    for r in got:
        by.setdefault(r.bucket, []).append((r.id, r.length, r.batch))
    for bucket, found in by.items():
        mine = sorted((i, n) for i, n in rows if int(n / 201 * 3) == bucket)
        if bucket is not None:
            assert sorted(found) == plain_batches(mine, 40)
    assert by[None] == [(10**7, 0, 0)]


def test_no_stretch_is_shorter_than_the_reach(spark):
    df = spark.createDataFrame([], "file long, start double, end double, word string")
    with pytest.raises(ValueError):
        stretches.segmented(df, "file", 2.0, 5.0, length=4.0)
    assert stretches.segmented(df, "file", 2.0, 5.0).count() == 0


def test_composed_summaries_are_those_of_one_stretch():
    """Exits and counts of two stretches, one after the other."""
    fold = stretches.Composed()
    fold.feed(([1, 0, 0], [2, 1, 1]))
    fold.feed(([0, 2], [5, 7]))
    assert fold.close() == [([2, 0, 0], [9, 6, 6])]


@pytest.mark.parametrize("spread", [1, 10**6])
def test_running_sums(spark, spread):
    pick = random.Random(7)
    rows = [(k * pick.randint(1, spread), pick.choice(["a", "b", None]), pick.randint(0, 9)) for k in range(1, 500)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "k long, g string, n long")
    got = {r.k: r.before for r in R.running(df, "k", ["g"], F.col("n"), "before").collect()}
    for k, g, _ in rows:
        assert got[k] == sum(n for k2, g2, n in rows if g2 == g and k2 < k)


def test_table_functions(spark, words):
    tables.register(spark)
    df = spark.createDataFrame([(k, *w) for k, ws in words.items() if k is not None for w in ws], "file long, start double, end double, word string")
    got = {}
    for r in spark.sql("SELECT * FROM segments(TABLE({w}) PARTITION BY file ORDER BY (start, end, word), 2, 5)", w=df).collect():
        got.setdefault(r.file, []).append((r.number, r.start, r.end, r.text))
    assert all(sorted(got.get(k, [])) == plain_segments(ws, 2, 5) for k, ws in words.items() if k is not None)
    said = spark.sql("SELECT * FROM sentences('One two. Three four five six! Seven', 3)").collect()
    assert [tuple(r) for r in said] == [(0, "One two. Three four five six! Seven")]


def test_silent_jobs_time_out_and_ends_are_final(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    hours = lambda *x: [day + dt.timedelta(hours=h) for h in x]
    lots = [
        [(1, t, i, "view") for i, t in enumerate(hours(0, 1))] + [(2, hours(0)[0], 5, "view"), (2, hours(2)[0], 6, "done"), (3, hours(1)[0], 7, "view")],
        [(2, hours(5)[0], 8, "view"), (3, hours(6)[0], 9, "view"), (4, hours(11)[0], 10, "view")],
        [(1, hours(12)[0], 11, "done"), (3, hours(15)[0], 12, "view"), (5, hours(40)[0], 13, "view")],
    ]
    shape = "job_id long, ts timestamp, id long, status string"
    with timers.rocks(spark):
        for lot in lots:
            spark.createDataFrame(lot, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            states = timers.job_states(jobs.followed(spark, str(tmp_path / "in"), spark.createDataFrame([], shape).schema), {"done": "completed"}, 10 * 3_600_000)
            jobs.saved_batches(states, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    last = {}
    for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: r.batch):
        last[r.job_id] = (r.status, r.n)
    # 1 fell silent for 11 hours, 2 ended before its late event, 3 stopped, 4 too, 5 is still open
    assert last == {1: ("timeout", 2), 2: ("completed", 2), 3: ("timeout", 3), 4: ("timeout", 1), 5: ("processing", 1)}
