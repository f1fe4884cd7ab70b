"""Time stretching, pitch and intelligibility of tones and noises."""

import numpy as np
import pytest

from voxmill.functions import signals as S
from voxmill.functions import voice as V

RATE = 16000


def tone(hz, seconds=1.0, rate=RATE, harmonics=5):
    phase = 2 * np.pi * np.cumsum(np.broadcast_to(hz, int(seconds * rate))) / rate
    return sum(np.sin(k * phase) / k for k in range(1, harmonics + 1)) * 0.2


@pytest.mark.parametrize("ratio", [1 / 1.35, 0.9, 1.2, 1.35])
@pytest.mark.parametrize("hz", [220.0, 731.0])
def test_stretching_keeps_pitch(ratio, hz):
    x = tone(hz, 1.5, harmonics=1)
    y = V.vocoded(x, int(len(x) * ratio))
    assert len(y) == int(len(x) * ratio)
    spectrum = lambda v: np.abs(np.fft.rfft(v[4000:-4000] * np.hanning(len(v) - 8000), 1 << 16)).argmax() * RATE / (1 << 16)
    assert abs(spectrum(x) - spectrum(y)) < RATE / 2048
    assert np.sqrt((y[4000:-4000] ** 2).mean()) == pytest.approx(np.sqrt((x[4000:-4000] ** 2).mean()), rel=0.1)


def test_stretching_of_little():
    assert len(V.vocoded(np.empty(0), 5)) == 5 and len(V.vocoded(np.ones(3), 4)) == 4 and len(V.vocoded(np.ones(100), 0)) == 0
    x = tone(300, 0.1)
    assert (V.vocoded(x, len(x)) == x).all()


def test_pitch_of_glides():
    t = np.arange(2 * RATE) / RATE
    hz = 160 * 2 ** (0.8 * np.sin(2 * np.pi * 0.4 * t))
    got = V.pitch(tone(hz, 2.0), RATE)
    at = np.arange(len(got)) * V.HOP
    inner = (at > 2048) & (at < len(t) - 2048)
    cents = 1200 * np.log2(got[inner] / hz[at[inner]])
    assert np.isfinite(got[inner]).all() and np.abs(cents).max() < 20


def test_silence_and_noise_are_unvoiced():
    rng = np.random.default_rng(1)
    assert np.isnan(V.pitch(np.zeros(RATE), RATE)).all()
    assert np.isnan(V.pitch(rng.normal(size=RATE) * 0.1, RATE)).mean() > 0.9
    both = V.pitch(np.concatenate([tone(200.0), np.zeros(RATE), tone(400.0)]), RATE)
    third = len(both) // 3
    assert np.nanmedian(both[:third]) == pytest.approx(200, rel=0.01) and np.nanmedian(both[-third:]) == pytest.approx(400, rel=0.01)
    assert np.isnan(both[third + 4 : 2 * third - 4]).all()
    assert len(V.pitch(np.empty(0), RATE)) == 0


def test_paths_are_the_likeliest():
    """The banded search against all paths of a small lattice."""
    import itertools

    rng = np.random.default_rng(2)
    n, reach = 4, 1
    seen = rng.uniform(0.01, 1, (5, 2 * n))
    weight = np.array([1.0, 2.0, 1.0])
    total = np.convolve(np.ones(n), weight, "same")

    def move(a, b):
        d = b % n - a % n
        return (weight[d + reach] / total[a % n] * (1 - V.SWITCH if a // n == b // n else V.SWITCH)) if abs(d) <= reach else 0.0

    def value(p):
        out = seen[0, p[0]]
        for k in range(1, len(p)):
            out *= move(p[k - 1], p[k]) * seen[k, p[k]]
        return out

    best = max(itertools.product(range(2 * n), repeat=5), key=value)
    assert tuple(V.best_path(seen, reach)) == best


def test_intelligibility_falls_with_noise():
    rng = np.random.default_rng(3)
    t = np.arange(3 * RATE) / RATE
    # syllables: noise in bands, with an envelope of four a second
    x = np.convolve(rng.normal(size=len(t)), [0.5, 0.3, 0.2], "same") * np.abs(np.sin(2 * np.pi * 2 * t)) ** 2
    scores = [V.stoi(x, x + k * rng.normal(size=len(x)), RATE) for k in (0, 0.1, 0.3, 1.0, 3.0)]
    assert scores[0] == pytest.approx(1.0, abs=1e-6) and all(a > b for a, b in zip(scores, scores[1:], strict=False)) and scores[-1] < 0.5
    assert V.stoi(x[:100], x[:100], RATE) == 1e-5 and V.stoi(np.zeros(RATE), np.zeros(RATE), RATE) < 0.01
    assert S.intelligibility(x, x, RATE) == pytest.approx(1.0, abs=1e-3) and S.intelligibility(x[:1000], x, RATE) == 0.0


def test_third_octaves_hold_their_middles():
    bands, hz = V.third_octaves(), np.linspace(0, 5000, 257)
    assert [int(b @ (np.abs(hz - 150 * 2 ** (k / 3)) < 10)) > 0 for k, b in enumerate(bands)] == [True] * 15
    assert bands.sum(axis=0).max() == 1


def test_metrics_of_pairs_fail_alone(spark):
    from voxmill.plans.segments import m14_pairs

    rows = {r.vec_id: r for r in m14_pairs(spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) > 100
    for k, r in rows.items():
        if k % 7 == 0:
            assert (r.mcd, r.stoi, r.f0_correlation, r.pesq) == (None,) * 4
        elif k % 5 == 0:
            # silence: no pitch and nothing understood, but a distance
            assert r.mcd > 0 and r.stoi < 0.1 and r.f0_correlation is None
        elif k % 4 == 0:
            assert r.mcd > 0 and r.stoi == 0.0 and r.f0_correlation is None and r.pesq is None
        else:
            assert r.mcd > 0 and 0 <= r.stoi <= 1 and r.pesq is not None
    assert sum(r.f0_correlation is not None for r in rows.values()) > 20
