"""Streams that stop and go on, sinks that are read back, model seams."""

import json

from pyspark.sql import functions as F

from voxmill.functions import models
from voxmill.sources import sinks, tables
from voxmill.streaming import jobs


def test_a_restart_reads_only_new_files(spark, tmp_path):
    rows = spark.range(10).select("id")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    follow = lambda: jobs.followed(spark, f"{tmp_path}/in", rows.schema)
    jobs.saved(follow(), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    jobs.saved(follow(), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.saved(follow(), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(15))


def test_new_only(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert [r[0] for r in jobs.new_only(batch, spark.createDataFrame([("a",)], "k string"), "k").collect()] == ["b"]


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\nnot json\n\n{"a": 2}\n')
    good, bad = sinks.split_broken(spark, f"{tmp_path}/x.json", "a int")
    assert sorted(r["a"] for r in good.collect()) == [1, 2]
    assert [r["value"] for r in bad.collect()] == ["not json"]
    assert sinks.quarantined(spark, f"{tmp_path}/x.json").endswith("x.json.backup")
    (tmp_path / "x.json").write_text("again")
    assert sinks.quarantined(spark, f"{tmp_path}/x.json").endswith("x.json.backup.1")
    assert sinks.quarantined(spark, f"{tmp_path}/x.json") is None


def test_documents_and_history(spark, tmp_path):
    path = f"{tmp_path}/deep/r.json"
    assert sinks.read_document(spark, path, []) == []
    sinks.document(spark, path, [{"t": "tiếng"}])
    assert sinks.read_document(spark, path, []) == [{"t": "tiếng"}] and sinks.read_document(spark, path, {}) == {}
    assert sinks.history(spark, f"{tmp_path}/none", "a int, b string").count() == 0
    sinks.appended(spark.createDataFrame([(1,)], "a int"), f"{tmp_path}/h")
    sinks.appended(spark.createDataFrame([(2, "x")], "a int, b string"), f"{tmp_path}/h")
    assert sorted(tuple(r) for r in sinks.history(spark, f"{tmp_path}/h", "a int, b string").collect()) == [(1, None), (2, "x")]


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("m1", "wer", "s1", 0.5), ("m1", "mcd", "s2", None)], "model string, metric string, sample string, value double")
    sinks.csv_report(rows, f"{tmp_path}/csv")
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert "m1,mcd,s2,\n" in text and "m1,wer,s1,0.5" in text
    sinks.named_results(rows, f"{tmp_path}/named")
    assert (tmp_path / "named" / "model=m1" / "metric=wer").is_dir()
    sinks.per_folder(rows, f"{tmp_path}/per", "sample")
    assert spark.read.parquet(f"{tmp_path}/per").count() == 2
    sinks.json_results(rows, rows.agg(F.avg("value").alias("WER")), f"{tmp_path}/js")
    assert json.loads(next((tmp_path / "js" / "summary").glob("part-*")).read_text()) == {"WER": 0.5}
    sinks.prepared(spark.createDataFrame([("ba", 1.0), ("ạb", 2.0)], "text string, duration double"), f"{tmp_path}/p")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/p/vocab").collect()] == ["a", "b", "ạ"]


def test_manifests(spark, tmp_path):
    (tmp_path / "m.txt").write_text("wavs/a.wav|chào \"em\"|1.0\n\nonly\nb.wav|\n")
    assert [tuple(r) for r in tables.manifest(spark, f"{tmp_path}/m.txt").collect()] == [("a", "wavs/a.wav", 'chào "em"')]
    (tmp_path / "h.csv").write_text("﻿wav|text\nx.wav|hi\n")
    assert [r.asDict() for r in tables.headed_manifest(spark, f"{tmp_path}/h.csv").collect()] == [{"wav": "x.wav", "text": "hi"}]
    (tmp_path / "u.lst").write_text("u1|pt|pw|gt\nu2|pt|pw|gt|own.wav\nbad|row\n")
    assert [r["gt_wav"] for r in tables.listed_utterances(spark, f"{tmp_path}/u.lst").collect()] == ["wavs/u1.wav", "own.wav"]


def test_wav_headers(spark, tmp_path):
    import wave

    with wave.open(f"{tmp_path}/a.wav", "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000), w.writeframes(b"\0\0" * 12000)
    (tmp_path / "b.wav").write_bytes(b"junk")
    got = {r["path"].rpartition("/")[2]: r["seconds"] for r in tables.wav_durations(spark, str(tmp_path)).collect()}
    assert got == {"a.wav": 1.5, "b.wav": None}


def test_a_failing_model_spares_the_other_rows(spark):
    def load():
        return lambda row: {"said": row["text"].upper()}

    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    assert sorted(tuple(r) for r in models.applied(rows, "upper", load, "said string").collect()) == [(1, "a", "A"), (2, None, None)]
