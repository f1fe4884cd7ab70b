"""Chunks, sentences with numbers, and signals, against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.functions import arrays as A
from voxmill.functions import numbers as N
from voxmill.functions import sentences as Y
from voxmill.functions import signals as S
from voxmill.functions import text as X
from voxmill.operators import relational as R


def plain_chunks(text):
    parts = [p.strip() for p in text.split(". ") if p.strip()]
    merged = []
    for p in parts:
        if merged and (len(p.split()) < 4 or len(merged) == 1 and len(merged[0].split()) < 4):
            merged[-1] += ", " + p
        else:
            merged.append(p)
    out = []
    for m in merged:
        held = []
        for p in m.split(", "):
            held.append(p.strip())
            if sum(len(x.split()) for x in held) > 20:
                out.append(", ".join(held))
                held = []
        if held:
            out.append(", ".join(held))
    if len(out) > 1 and len(out[-1].split()) < 4:
        out[-2:] = [out[-2] + ", " + out[-1]]
    return out


def test_reading_chunks(spark):
    rng = random.Random(1)
    texts = ["", "one", "one two. three", ". ".join("w " * 3 for _ in range(5))]
    texts += [". ".join(", ".join(" ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", X.reading_chunks(F.col("text")).alias("c")).collect()
    for r in rows:
        assert r.c == plain_chunks(texts[r.id])


def test_sentences_say_what_they_show(spark):
    rows = spark.range(3000).select("id", Y.sentence(F.col("id")).alias("x")).select("id", "x.*").collect()
    share = {k: sum(r.category == k for r in rows) / len(rows) for k, _ in Y.SHARES}
    assert all(abs(share[k] - w) < 0.04 for k, w in Y.SHARES)
    whole = {r.written: r.said for r in rows if r.category == "plain_digits"}
    said = spark.createDataFrame([(int(k),) for k in whole], "n long").select("n", N.spoken(F.col("n")).alias("s")).collect()
    assert all(whole[str(r.n)] == r.s for r in said)
    for r in rows:
        assert r.said and r.written and "{" not in r.said + r.written
        assert not re.search("[0-9]", r.said.replace("3D", ""))
        if r.category == "plain_single":
            assert len(r.written.split()) == len(r.said.split()) in range(2, 7)
        if r.category == "phone":
            assert re.search(r"0\d{9}|0\d\d \d{3} \d{4}|0\d{3} \d{3} \d{3}", r.written)
        if r.category == "price":
            assert "VNĐ" not in r.said and "đồng" in r.said


def test_numbered_is_the_place_in_order(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.pmod("id", F.lit(3)).alias("g"))
    whole = R.numbered(rows, "k").collect()
    assert all(r.k == r._k for r in whole) and len(whole) == 1000
    for g in range(3):
        mine = sorted((r.k, r._k) for r in R.numbered(rows, "k", ["g"]).collect() if r.g == g)
        assert [n for _, n in mine] == list(range(len(mine)))
    assert R.numbered(spark.range(0).toDF("k"), "k").count() == 0


def test_resampling_keeps_low_tones_and_drops_what_does_not_fit():
    t = np.arange(4800) / 48000
    low, high = np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 15_000 * t)
    out = S.resampled(low, 48000, 16000)
    assert len(out) == 1600
    assert np.abs(out - np.sin(2 * np.pi * 440 * np.arange(1600) / 16000))[50:-50].max() < 0.01
    assert np.abs(S.resampled(high, 48000, 16000))[50:-50].max() < 0.05
    up = S.resampled(low, 48000, 72000)
    assert len(up) == 7200 and np.abs(up - np.sin(2 * np.pi * 440 * np.arange(7200) / 72000))[100:-100].max() < 0.01


def test_pieces_between_pauses():
    rate = 1000
    tone = lambda s: np.sin(np.arange(int(s * rate)))
    quiet = lambda s: np.zeros(int(s * rate))
    x = np.concatenate([tone(3), quiet(0.5), tone(3), quiet(6), tone(2.5)])
    cuts = S.slices_of_speech(x, rate)
    assert len(cuts) == 3 and cuts[0][0] == 0 and 3000 <= cuts[0][1] <= 3500 == 3500
    # a long pause keeps two seconds at most at either side
    assert 6500 <= cuts[1][1] <= 8520 and 10480 <= cuts[2][0] <= 12520
    assert S.slices_of_speech(tone(0.05), rate).tolist() == [[0, 50]]
    assert len(S.slices_of_speech(tone(5), rate)) == 1


def test_pairs_and_gates():
    rng = np.random.default_rng(2)
    a = rng.normal(size=4000)
    x, y = S.prepared_pair(a, a[:3500] * 9)
    assert len(x) == len(y) and np.abs(x).max() == pytest.approx(0.95) and np.abs(y).max() == pytest.approx(0.95)
    short, long = S.time_aligned(a, a[:1000])
    assert len(short) == len(long) == 1000
    assert S.listening_score(a[:500], a[:500], 16000, lambda *_: 4.0) is None
    seen = []
    assert S.listening_score(a, a, 48000, lambda rate, p, q, band: seen.append((rate, band, len(p))) or 3.5) == 3.5
    assert seen[0][:2] == (16000, "wb")
    assert S.listening_score(a, a, 8000, lambda *_: 1 / 0) is None
    assert S.intelligibility(a[:100], a, 8000, lambda *_: 1.0) == 0.0 and S.intelligibility(a, a, 8000, lambda *_: 7.0) == 1.0


def test_references_are_short():
    rate = 100
    part = np.tile([0.5, -0.5], 200)
    x = np.concatenate([np.concatenate([part, np.zeros(150)]) for _ in range(6)])
    out = S.clipped_reference(x, rate)
    assert 6 * rate < len(out) <= 12 * rate + 5 and not out[-5:].any()
    assert len(S.clipped_reference(np.tile([0.5, -0.5], 1500), rate)) == 12 * rate + 5


def test_contours_by_antidiagonals():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.normal(size=rng.integers(1, 12)), rng.normal(size=rng.integers(1, 12))
        path = S.warp(a, b)
        cost = np.full((len(a) + 1, len(b) + 1), np.inf)
        cost[0, 0] = 0
        for i in range(len(a)):
            for j in range(len(b)):
                cost[i + 1, j + 1] = abs(a[i] - b[j]) + min(cost[i, j], cost[i, j + 1], cost[i + 1, j])
        assert np.abs(a[path[:, 0]] - b[path[:, 1]]).sum() == pytest.approx(cost[-1, -1])


def test_channels_and_blend(spark):
    rows = spark.createDataFrame([([[1.0, 3.0], [2.0, 4.0]],)], "f array<array<double>>")
    assert rows.select(A.remixed(F.col("f"), 1).alias("x")).first().x == [[2.0], [3.0]]
    assert spark.createDataFrame([([2.0, -1.0],)], "x array<double>").select(A.peak_blended(F.col("x")).alias("y")).first().y == [int((0.5 * 0.45 + 0.5) * 32767), int(-(0.25 * 0.45 + 0.25) * 32767)]
