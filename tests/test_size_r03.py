"""Work and memory of the queries that the findings of round 3 name."""

import numpy as np
from pyspark.sql import functions as F

from voxmill.functions import signals as S
from voxmill.operators import relational as R

SMALL = "/root/testdata/sf0.001"


def test_long_arrays_leave_a_worker_in_parts(spark, monkeypatch):
    # the rows of a batch before the function is called again tell how many arrays were held
    monkeypatch.setattr(S, "HELD", 100)
    series = [np.arange(3.0)] * 50
    import pandas as pd

    parts = list(S.column(lambda x: np.repeat(x, 20)).__closure__[0].cell_contents[1].func(iter([pd.Series(series)])))
    assert max(len(p) for p in parts) == 2 and sum(len(p) for p in parts) == 50
    monkeypatch.undo()
    rows = spark.range(40).select("id", F.when(F.col("id") % 7 > 0, F.array(F.col("id").cast("float"), F.lit(1.0).cast("float"))).alias("x")).coalesce(1)
    got = {r.id: r.y for r in rows.select("id", S.column(lambda x: np.repeat(x, 100_000))("x").alias("y")).select("id", F.size("y").alias("y")).collect()}
    assert got == {k: 200_000 if k % 7 else None for k in range(40)}


def test_pairs_are_summed_where_they_are_made_and_dealt_out_by_number(spark):
    from voxmill.plans.segments import QUERIES, with_next

    out = with_next("total", lambda a, b: np.concatenate([a, -b]))(spark, SMALL)
    e = {r.vec_id: np.asarray(r.embedding, float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    got = {r.vec_id: (r.n, r.total) for r in out.collect()}
    assert got.keys() == {k for k in e if k + 1 in e}
    assert all(n == 128 and abs(total - np.abs(e[k]).sum() - np.abs(e[k + 1]).sum()) < 1e-4 for k, (n, total) in got.items())
    for name in ("m06_time_aligned", "m07_prepared_pair"):
        plan = QUERIES[name][0](spark, SMALL)._jdf.queryExecution().toString()
        assert "REPARTITION_BY_NUM" in plan and "aggregate(m" not in plan
    assert R.spread(spark.range(5_000), "id").rdd.getNumPartitions() == 8
    assert R.spread(spark.range(9_500), "id").rdd.getNumPartitions() == 10


def test_silences_of_a_wave_list_last(tmp_path):
    import io

    from voxmill.sources.formats import riff_head

    number = lambda n: n.to_bytes(4, "little")
    fmt = b"fmt " + number(16) + b"\1\0\1\0" + number(8000) + number(16000) + b"\2\0\20\0"
    parts = b"data" + number(3) + b"abc\0" + b"slnt" + number(4) + number(7999) + b"junk" + number(1) + b"x\0" + b"data" + number(2) + b"ab"
    held = lambda kind: b"RIFF" + number(0) + b"WAVE" + fmt + b"LIST" + number(4 + len(parts)) + kind + parts + b"data" + number(8000)
    assert riff_head(io.BytesIO(held(b"wavl"))) == ((3 + 2 * 7999 + 2) / 16000, 8000, 1, 16)
    # another list holds no samples, whatever it looks like
    assert riff_head(io.BytesIO(held(b"INFO"))) == (0.5, 8000, 1, 16)


def test_the_speech_folder_grows_with_its_files(spark, tmp_path):
    from pathlib import Path

    from voxmill.plans.files import QUERIES, speech_folder

    keys = [0, 1, 9, 10, 11, 99, 1000, 360_000]
    d = tmp_path / "in"
    spark.createDataFrame([(k, k % 3, f"Supplier#{k:09d}", float(k % 2) - 0.5) for k in keys], "s_suppkey long, s_nationkey int, s_name string, s_acctbal double").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(k,) for k in range(3)], "r_regionkey int").write.parquet(f"{d}/region.parquet")
    found = [p for p in Path(speech_folder(spark, str(d)).removeprefix("file:")).rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert len(found) == len(keys) + sum(k % 2 for k in keys) and max(p.stat().st_size for p in found) < 2000
    whole = {int(p.stem[-9:]): p.read_bytes() for p in found if p.suffix == ".wav"}
    assert all(int.from_bytes(x[4:8], "little") == len(x) - 8 for x in whole.values())
    for name in ("s06_wav_seconds", "s33_probed"):
        got = {int(r.path[-13:-4]): r.seconds for r in QUERIES[name][0](spark, str(d)).where("path like 'wavs/%'").collect()}
        assert got == {k: k / 100 for k in keys if k or name.startswith("s06")}


def test_next_valid_rows_are_found_in_one_walk(spark, tmp_path):
    from voxmill.plans.segments import g11

    rows = [(k * 3 % 1009, 60000.0 if k % 5 == 1 and 100 < k * 3 % 1009 < 900 else 1.0) for k in range(1009)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    out = g11(spark, str(tmp_path))
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "currentrow$(), unboundedfollowing" not in plan and "1, unboundedfollowing" not in plan and "unboundedpreceding$(), currentrow" in plan
    good = sorted(k for k, p in rows if p > 1)
    assert {tuple(r) for r in out.collect()} == {(k, next((g for g in good if g >= k), good[0])) for k, _ in rows}


def test_pitch_is_found_once_for_each_voice(spark):
    from voxmill.plans.segments import QUERIES

    for name, n in (("m08_contours", 1), ("m14_pairs", 1), ("m09_cepstral_distortion", 1)):
        plan = QUERIES[name][0](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == n and "RepartitionByExpression" in plan
    # the bands of a frame are made once
    assert S.mel_filters(16000, 2048, 128, True) is S.mel_filters(16000, 2048, 128, True)


def test_troughs_share_the_thresholds_as_one_after_the_other():
    from voxmill.functions import voice as V

    d = np.random.default_rng(5).uniform(0, 1.2, (6, 40))
    d[3] = 1.5 - np.arange(40) / 400  # no trough
    frame, _, chance = V.candidates(d, 3)
    edges = np.linspace(0, 1, V.THRESHOLDS + 1)
    a, b = V.PRIOR
    prior = np.diff(1 - (1 - edges) ** (a + b - 1) - (a + b - 1) * edges * (1 - edges) ** (a + b - 2))
    want = []
    for row in d:
        at = [k for k in range(3, 39) if row[k] < row[k - 1] and row[k] <= row[k + 1]]
        mass = dict.fromkeys(at, 0.0)
        for t, p in zip(edges[1:], prior, strict=True):
            under = [k for k in at if row[k] < t]
            if under:
                mass[under[0]] += p
            elif at:
                mass[min(at, key=lambda k: row[k])] += p * V.NO_TROUGH
        want += [mass[k] for k in at]
    assert chance.tolist() == want and 3 not in frame


def test_files_are_read_where_their_names_are(spark, tmp_path):
    from voxmill.plans.files import QUERIES
    from voxmill.sources import store

    rows = spark.createDataFrame([(k, f"{k % 3}/{k}.bin", bytes([k]) * k) for k in range(50)], "id long, name string, content binary")
    store.write_files(rows, str(tmp_path))
    got = store.read_files(rows.select("id", "name"), str(tmp_path))
    assert got.columns == ["id", "name", "content"] and {(r.id, bytes(r.content)) for r in got.collect()} == {(k, bytes([k]) * k) for k in range(50)}
    assert "binaryFile" not in QUERIES["s24_raw_bytes"][0](spark, SMALL)._jdf.queryExecution().toString()


def test_spoken_numbers_are_dealt_out(spark):
    from voxmill.plans.speech import t17_spoken

    assert t17_spoken(spark, SMALL).rdd.getNumPartitions() >= 8


def test_cells_carry_no_rows_along(spark, tmp_path):
    from voxmill.plans.texts import t21

    spark.createDataFrame([("de", "ab😀")], "lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(1, 0, "ba?"), (1, 1, None), (1, 2, ""), (2, 0, ""), (3, 0, "😀"), (4, 0, None)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = t21(spark, str(tmp_path))
    assert "Generate posexplode" in out._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in sorted(out.collect()):
        got.setdefault((r.conv_id, r.turn), []).append(r.id)
    assert got == {(1, 0): [1, 0, 0], (1, 1): [-1] * 3, (1, 2): [-1] * 3, (3, 0): [2]}


def test_jobs_of_neighbouring_numbers_share_a_state(spark, tmp_path):
    # many jobs of few events: the store holds a value for each 32 numbers, and every job has its own end
    import datetime as dt
    import random

    from voxmill.streaming import jobs, timers

    dice, patience, hour = random.Random(15), 10 * 3_600_000, 3_600_000_000
    events, start = [], 1_704_067_200_000_000
    for job in [*range(-40, 160), 2**53 + 1, 2**62 + 1]:
        for i in range(dice.randint(1, 9)):
            events.append((job, start + dice.randrange(40 * hour), dice.choice([None, 2**53 + i, 2**53 + i]), dice.choice(["view", "view", "view", None, "done"])))
    # 500: two events within a millisecond, the later one of the smaller number; 501: patience ends with the last event but LATE
    events += [(500, start + 900, 1, "view"), (500, start + 500, 2, "done"), (501, start + 40 * hour + 1_000_000 - patience * 1000 - 1_000_000, 3, "view"), (502, start + 40 * hour + 1_000_000, 4, "view")]
    # a job's ties in time are put apart by their numbers alone
    assert len({e[:2] for e in events}) == len(events)
    want, now = {}, max(e[1] for e in events) // 1000 - 1000
    for job in {e[0] for e in events}:
        status, n, before = "processing", 0, None
        for us, status in sorted((e[1], {"done": "completed"}.get(e[3], "processing")) for e in events if e[0] == job):
            if before is not None and us // 1000 - before >= patience:
                status = "timeout"
                break
            before, n = us // 1000, n + 1
            if status != "processing":
                break
        want[job] = ("timeout" if status == "processing" and now - before >= patience else status, n)
    assert {s for s, _ in want.values()} == {"processing", "completed", "timeout"} and want[500] == ("completed", 1) and want[501] == ("timeout", 1)
    shape = "job_id long, ts timestamp, id long, status string"
    with timers.rocks(spark):
        for lot in range(3):
            part = [(j, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us), i, s) for j, us, i, s in events if min((us - start) // (14 * hour), 2) == lot]
            spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            states = timers.job_states(jobs.followed(spark, f"{tmp_path}/in", spark.createDataFrame([], shape).schema), {"done": "completed"}, patience)
            query = jobs.saved_batches(states, f"{tmp_path}/out", f"{tmp_path}/state")
            query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").groupBy("job_id").agg(F.max_by("status", "batch").alias("status"), F.max_by("n", "batch").alias("n"))
    assert {r.job_id: (r.status, r.n) for r in out.collect()} == want
    assert query.lastProgress.stateOperators[0].numRowsTotal == len({j >> 5 for j in want}) < len(want) / 10
