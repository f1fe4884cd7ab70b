"""Channel names, spoken times, reports, saved results, lists and joints."""

import pytest
from pyspark.sql import functions as F

from voxmill.functions import arrays as A
from voxmill.functions import durations as D
from voxmill.functions import signals as S
from voxmill.functions import text as X
from voxmill.sources import sinks, store, tables


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(("url", "channel", "user"), [("https://y/channel/UCab_-9/videos", "UCab_-9", ""), ("https://y/channel/XX1", "", ""), ("y/@né.me-1/x", "", "né.me-1"), ("y/c/old/@new", "", "new"), ("y/c/a.b", "", "a.b"), ("", "", ""), (None, "", "")])
def test_channels(spark, url, channel, user):
    assert one(spark, X.channel_id(F.col("x")), url) == channel and one(spark, X.channel_user(F.col("x")), url) == user


@pytest.mark.parametrize(("seconds", "said"), [(0.0, "0.00s"), (59.994, "59.99s"), (60.0, "1m 0.00s"), (3600.0, "1h 0m 0.00s"), (7384.5, "2h 3m 4.50s"), (None, None)])
def test_spoken_times(spark, seconds, said):
    assert one(spark, X.spoken_time(F.col("x")), seconds, "double") == said


def test_framed_levels_and_joints(spark):
    import numpy as np

    x = [float(v) for v in np.random.default_rng(1).normal(size=50)]
    assert one(spark, A.framed_rms(F.col("x"), 16, 8), x, "array<double>") == pytest.approx(S.framed_rms(np.array(x), 16, 8).tolist())
    assert one(spark, D.joined([F.slice("x", 1, 1), F.slice("x", 2, 1)], F.array(F.lit(0.0))), x, "array<double>") == [x[0], 0.0, x[1]]
    rtf = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 1.0)], "a double, b double").select(D.real_time_factor(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in rtf] == [0.25, None, None]


def test_reports_come_back(spark, tmp_path):
    rows = [("1", ' a "quoted",\n\ntext ', 0.5, None), ("2", "", None, 2.0), ("3", None, 1.0, 1.0)]
    at = str(tmp_path / "report")
    sinks.metric_report(spark.createDataFrame(rows, "sample_id string, text string, wer double, other double"), at)
    read = sinks.read_report(spark, at)
    assert read.columns == ["sample_id", "text", "mcd", "pesq", "stoi", "utmos", "f0_correlation", "wer", "cer"]
    assert sorted((r.sample_id, r.text, r.wer, r.cer) for r in read.collect()) == [("1", rows[0][1], 0.5, None), ("2", None, None, None), ("3", None, 1.0, None)]


def test_broken_results_are_moved_aside_once(spark, tmp_path):
    at = str(tmp_path / "results")
    contents = {"a/1": '{"samples":[1]}', "b": "{broken", "c": "[1]", "d": "{}"}
    df = spark.createDataFrame(list(contents.items()), "model string, content string")
    store.write_files(df.select(sinks.result_name_of(F.col("model"), "wer").alias("name"), "content"), at)
    store.write_bytes(spark, f"{at}/b_wer.json.backup", b"old")
    asked = spark.createDataFrame([("a/1",), ("b",), ("c",), ("d",), ("e",)], "model string")
    for _ in range(2):
        assert {r.model: r.result for r in sinks.existing_results(spark, at, asked, "wer").collect()} == {"a/1": '{"samples":[1]}', "b": None, "c": None, "d": None, "e": None}
    left = sorted(r.path for r in tables.files(spark, at, "*").select("path").collect())
    assert left == ["a_1_wer.json", "b_wer.json.backup", "b_wer.json.backup.1", "c_wer.json.backup", "d_wer.json.backup"]


def test_lists_keep_first_places(spark, tmp_path):
    rows = [("x.json", '["b", " a ", "", 7, "b", null]'), ("y.json", "[]"), ("z.json", "{broken")]
    store.write_files(spark.createDataFrame(rows, "name string, content string"), str(tmp_path / "l"))
    assert sorted(tuple(r) for r in tables.url_lists(spark, str(tmp_path / "l")).collect()) == [("x", "7", 3), ("x", "a", 1), ("x", "b", 0)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 40])
def test_fades_and_edges_are_those_of_whole_signals(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    rows = [(rng.normal(size=a).tolist(), (rng.normal(size=b) * rng.choice([1.0, 1e-3], b)).tolist()) for a, b in ((0, 3), (4, 0), (7, 9), (30, 50), (1, 1))]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    for r, x in zip(df.select("a", "b", A.crossfaded(F.col("a"), F.col("b"), n).alias("x")).collect(), rows, strict=True):
        want = S.crossfaded([np.array(x[0]), np.array(x[1])], n, 1.0)
        assert r.x == pytest.approx(want.tolist())
    for step in (1, 4):
        for r in df.select("b", A.edges_trimmed(F.col("b"), step, -30.0).alias("x")).collect():
            assert r.x == S.edges_trimmed(np.array(r.b), step * 1000, -30.0).tolist()
