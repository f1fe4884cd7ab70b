"""Silences of recordings by stretches against loops over whole recordings."""

import random

import numpy as np
import pytest

from voxmill.functions import signals as S
from voxmill.operators import silence as Z


def plain_runs(levels, quiet, least):
    return [(int(a), int(b)) for a, b in S.runs(np.array(levels) < quiet) if b - a >= least]


def plain_cuts(levels, quiet, least, longest):
    cuts = [0]
    for target in [*[(a + b) // 2 for a, b in plain_runs(levels, quiet, least)], len(levels)]:
        while target - cuts[-1] > longest:
            low = cuts[-1] + int(longest * 0.8)
            cuts.append(low + int(np.argmin(levels[low : cuts[-1] + longest])))
        cuts.append(target)
    return sorted(set(cuts))


@pytest.fixture(scope="module")
def recordings():
    pick = random.Random(9)
    out = {}
    for k in [*range(25), None]:
        levels = []
        while len(levels) < pick.choice([1, 30, 200, 700]):
            levels += [float(-60 + pick.randint(0, 5))] * pick.randint(0, 12) + [float(pick.randint(-40, -1)) for _ in range(pick.randint(1, 90))]
        out[k] = levels
    out["quiet"] = [-80.0] * 50
    return {str(k) if k is not None else None: v for k, v in out.items()}


@pytest.fixture(scope="module")
def levels(spark, recordings):
    rows = [(f, k, x) for f, xs in recordings.items() for k, x in enumerate(xs)]
    return spark.createDataFrame(rows, "file string, k long, level double").repartition(6)


def test_runs(levels, recordings):
    got = {}
    for r in Z.quiet_runs(levels, "file", -50.0, 4).collect():
        got.setdefault(r.file, []).append((r.first, r.last))
    assert {f: sorted(x) for f, x in got.items()} == {f: x for f, xs in recordings.items() if (x := plain_runs(xs, -50, 4))}


@pytest.mark.parametrize("length", [40, 10_000])
def test_split_points(levels, recordings, length):
    got = {}
    for r in Z.split_points(levels, "file", -50.0, 4, 40, length).collect():
        got.setdefault(r.file, []).append(r.cut)
    forced = 0
    for f, xs in recordings.items():
        want = plain_cuts(xs, -50, 4, 40)
        assert sorted(got[f]) == want, f
        forced += len(want) - 2 - len(plain_runs(xs, -50, 4))
    assert forced > 20


def test_what_shortening_leaves_out(levels, recordings):
    got = {}
    for r in Z.left_out(levels, "file", -50.0, 4, 2).collect():
        got.setdefault(r.file, set()).update(range(r["from"], r.to))
    for f, xs in recordings.items():
        want = set()
        for a, b in plain_runs(xs, -50, 4):
            want |= set(range(a + 2 * (a > 0), b - 2 * (b < len(xs))))
        assert got.get(f, set()) == want


def test_blocks_are_numbered_through_pieces(spark):
    rows = [("a", 7, [1.0] * 4 + [0.5] * 4), ("a", 3, [0.1] * 4), ("a", 9, [0.01] * 3), ("b", 1, []), ("b", 2, None), ("b", 5, [0.0] * 2)]
    got = Z.blocks(spark.createDataFrame(rows, "f string, p long, x array<double>"), "f", "p", "x", 4).collect()
    assert sorted((r.f, r.k, r.level) for r in got) == [("a", 0, -20.0), ("a", 1, 0.0), ("a", 2, -6.0206), ("a", 3, -40.0), ("b", 0, -200.0)]


def test_whole_signals_follow_the_same_rules():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=50), np.zeros(30), rng.normal(size=400), np.zeros(25), rng.normal(size=10)])
    levels = S.decibels(x, 5)
    want = [*(np.array(plain_cuts(levels, -45, 4, 40)[:-1]) * 5 / 10), len(x) / 10]
    assert S.split_points(x, 10, -45.0, 2.0, 20.0, 0.5).tolist() == pytest.approx(want)
    assert len(S.silence_shortened(np.concatenate([np.zeros(400), np.ones(100), np.zeros(300)]), 100, keep=0.5)) == 200
