"""Folds against hand-made and brute-force results, signals on simple waves."""

import random

import numpy as np
import pytest

from voxmill.functions import signals as S
from voxmill.functions import text as X
from voxmill.operators import folds, stretches

DATA = "/root/testdata/sf0.001"


def fed(fold, rows):
    out = []
    for r in rows:
        out += fold.feed(r)
    return out + list(fold.close())


def test_segments_cut_at_pauses():
    words = [(0, 2, "a"), (2, 4, "b"), (4.5, 6, "c"), (6, 8, "d")]
    assert fed(folds.Segments(3, 7), words) == [(0, 4, "a b"), (4.5, 8, "c d")]


def test_segments_edges():
    assert fed(folds.Segments(3, 7), []) == []
    assert fed(folds.Segments(3, 7), [(0, 9, "long"), (9, 13, "x")]) == [(9, 13, "x")]
    assert fed(folds.Segments(3, 7), [(0, 4, " ")]) == []
    assert fed(folds.Segments(3, 7), [(None, 4, "x"), (0, 4, "y")]) == [(0, 4, "y")]


def test_segments_match_a_whole_array_version():
    rng = np.random.default_rng(3)
    for _ in range(200):
        gaps, lengths = rng.choice([0, 0.04, 0.3], 40), rng.uniform(0.1, 2.5, 40)
        start = np.cumsum(gaps + np.concatenate([[0], lengths[:-1]]))
        words = [(float(a), float(a + n), "w") for a, n in zip(start, lengths, strict=True)]
        want, i = [], 0
        while i < len(words):
            ends = [k for k in range(i, len(words)) if words[k][1] - words[i][0] <= 5]
            if not ends:
                i += 1
                continue
            cut = ends[-1]
            if cut + 1 < len(words):
                pauses = [k for k in ends if words[k][1] - words[i][0] >= 2 and words[k + 1][0] - words[k][1] > 0.05]
                cut = pauses[-1] if pauses else cut
            if words[cut][1] - words[i][0] >= 2:
                want.append((words[i][0], words[cut][1], " ".join("w" * (cut - i + 1))))
                i = cut + 1
            else:
                i += 1
        assert fed(folds.Segments(2, 5), words) == want


def test_frame_batches():
    assert fed(folds.FrameBatches(10), [("a", 4), ("b", 5), ("c", 6), ("d", 11)]) == [("a", 4, 0), ("b", 5, 0), ("c", 6, 1)]
    assert [r[2] for r in fed(folds.FrameBatches(10, 2), [(k, 1) for k in range(5)])] == [0, 0, 1, 1, 2]


def test_batches_by_classes_are_those_of_the_fold():
    rng = random.Random(3)
    for _ in range(300):
        budget, most = rng.randint(1, 40), rng.choice([0, 0, 1, 3, 7])
        frames = sorted(rng.randint(0, rng.randint(1, 45)) for _ in range(rng.randint(0, 60)))
        want = [(f, b) for _, f, b in fed(folds.FrameBatches(budget, most), list(enumerate(frames)))]
        got = []
        counts = sorted((f, frames.count(f)) for f in set(frames))
        for size, first, batch, after, each in folds.class_runs(counts, budget, most):
            got += [(size, batch if k < first else after + (k - first) // each) for k in range(frames.count(size))]
        assert got == want


def test_batches_keep_the_budget(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = folds.frame_batches(docs, "doc_id", "n_chars", 20000, 8).toPandas()
    assert len(out) == docs.where("n_chars <= 20000").count()
    by = out.groupby("batch")["frames"]
    assert by.sum().max() <= 20000 and by.count().max() <= 8
    full = stretches.bucket_batches(docs, "doc_id", "n_chars", 5000).toPandas()
    assert sorted(full["id"]) == sorted(r[0] for r in docs.select("doc_id").collect())
    sums = full.groupby(["bucket", "batch"])["length"].sum().reset_index()
    last = sums.groupby("bucket")["batch"].transform("max")
    assert (sums[sums["batch"] < last]["length"] >= 5000).all()


def test_balanced(spark):
    rows = spark.createDataFrame([("a", 9.0), ("b", 7.0), ("c", 5.0), ("d", 3.0), ("e", None)], "name string, size double")
    got = {r["name"]: r["bin"] for r in folds.balanced(rows, "name", "size", 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0}
    assert folds.balanced(rows.where("false"), "name", "size", 2).collect() == []


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "text string").select(column.alias("x")).first()["x"]


def test_text_folds(spark):
    from pyspark.sql import functions as F

    c = F.col("text")
    assert one(spark, X.chunks(c, 10), "aa, bb. cccccccccccc! d") == ["aa, bb.", "cccccccccccc!", "d"]
    assert one(spark, X.chunks(c, 10), "") == []
    assert one(spark, X.first_package_chunks(c, 4, 12), "aa, bb. cccc dd. e") == ["aa,", "bb.", "cccc dd. e"]
    assert [tuple(r) for r in one(spark, X.styled(c), "hi {Sad} low {x}")] == [("Regular", "hi"), ("Sad", "low")]
    assert [tuple(r) for r in one(spark, X.voiced(c, ["town"]), "a [town] b [no] c")] == [("main", "a"), ("town", "b"), ("main", "c")]
    assert one(spark, X.unpunctuated(c, "zh"), "你好，吗") == "你 好 吗"
    assert one(spark, X.joined(F.split(c, ",")), " a, ,b ") == "a b"


def test_silence():
    wave = np.sin(np.arange(8000) / 3)
    x = np.concatenate([wave, np.zeros(24000), wave])
    assert S.split_points(x, 8000).tolist() == [0, pytest.approx(2.5, abs=0.1), 5]
    assert len(S.silence_shortened(x, 8000)) == 8000 * 3
    assert len(S.edges_trimmed(np.concatenate([np.zeros(800), wave, np.zeros(800)]), 8000)) == pytest.approx(8000, abs=16)
    assert S.split_points(wave.repeat(20), 8, longest=900.0).tolist()[-1] == 20000
    assert np.diff(S.split_points(wave.repeat(20), 8, longest=900.0)).max() <= 900
    assert len(S.edges_trimmed(np.zeros(50), 1000)) == 0 and S.split_points(np.empty(0), 8).tolist() == [0]


def test_scores_of_equal_signals():
    x = np.sin(np.arange(16000) / 5)
    assert S.cepstral_distortion(x, x) == pytest.approx(0)
    assert S.cepstral_distortion(x, np.empty(0)) is None
    hz = 200 + 20 * np.sin(np.arange(60) / 4)
    assert S.contour_similarity(hz, hz) == pytest.approx(1)
    assert S.contour_similarity(hz[:3], hz) is None
    assert S.contour_similarity(np.full(9, 200.0), np.full(9, 200.0)) == pytest.approx(1)
    assert len(S.crossfaded([np.ones(100), np.ones(100)], 100)) == 185
    assert S.crossfaded([np.ones(100), np.ones(100)], 100) == pytest.approx(np.ones(185))
