"""Signal operators that need numpy: silence cuts, trimming, resampling, cepstra, contours.

Each has a plain numpy function and, as `column(function)`, an Arrow-batched column over array<float>.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .voice import resampled, stoi, vocoded

FLOOR = 1e-10


#: Values that a column's rows may hold before they leave a worker.
HELD = 1 << 20


def column(fn, returns: str = "array<double>"):
    """fn(array, ...) -> value or None, over whole columns; a null input, or one that fn fails on, gives null.

    Arrays that are made leave the worker by HELD values, not by Spark's rows of a batch, of which long signals fill any memory.
    """

    def rows(batches):
        for sides in batches:
            out, held = [], 0
            for values in zip(*sides, strict=True):
                try:
                    made = None if any(v is None for v in values) else fn(*[np.asarray(v, float) for v in values])
                except (ValueError, FloatingPointError, ZeroDivisionError, np.linalg.LinAlgError):
                    made = None
                out.append(made)
                held += np.size(made)
                if held >= HELD:
                    yield pd.Series(out, dtype=object)
                    out, held = [], 0
            yield pd.Series(out, dtype=object)

    def one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return rows((a,) for a in batches)

    def two(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        return rows(batches)

    made = {1: F.pandas_udf(one, returns), 2: F.pandas_udf(two, returns)}
    return lambda *columns: made[len(columns)](*columns)


def decibels(x: np.ndarray, block: int) -> np.ndarray:
    """Level of each whole or partial block."""
    starts = np.arange(0, len(x), block)
    if not len(starts):
        return np.empty(0)
    power = np.add.reduceat(x * x, starts) / np.diff(np.append(starts, len(x)))
    return 20 * np.log10(np.maximum(np.sqrt(power), FLOOR))


def runs(flags: np.ndarray) -> np.ndarray:
    """[n, 2] begin and end (exclusive) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def split_points(x: np.ndarray, rate: int, quiet: float = -45.0, least: float = 2.0, longest: float = 900.0, block: float = 0.1) -> np.ndarray:
    """Seconds to cut at: the middles of silences, rounded down to blocks, and where two cuts lie further apart than `longest`, the quietest block
    in the last fifth of the allowed stretch.  0 and the end are cuts, too."""
    size = max(1, int(rate * block))
    block = size / rate
    level = decibels(x, size)
    end = len(x) / rate
    few, many = int(least / block), int(longest / block)
    cuts = [0]
    for target in [*[(a + b) // 2 for a, b in runs(level < quiet) if b - a >= few], len(level)]:
        while target - cuts[-1] > many and int(many * 0.8) < many:
            lo = cuts[-1] + int(many * 0.8)
            cuts.append(lo + int(np.argmin(level[lo : cuts[-1] + many])))
        cuts.append(target)
    return np.unique(np.round([*(k * block for k in cuts[:-1]), end], 6))


def trimmed(x: np.ndarray, below: float = 45.0, frame: int = 2048, hop: int = 512, least: int = 256, share: float = 0.15) -> np.ndarray:
    """Without edges that lie `below` dB under the loudest frame; x itself if too little would stay."""
    level = framed_rms(x, frame, hop)
    loud = np.flatnonzero(20 * np.log10(np.maximum(level, FLOOR)) > 20 * np.log10(max(level.max(initial=0.0), FLOOR)) - below)
    if not len(loud):
        return x
    cut = x[loud[0] * hop : min(len(x), (loud[-1] + 1) * hop)]
    return cut if len(cut) >= max(least, share * len(x)) else x


def edges_trimmed(x: np.ndarray, rate: int, quiet: float = -42.0) -> np.ndarray:
    """Without the milliseconds at both ends that lie under `quiet`."""
    step = max(1, rate // 1000)
    loud = np.flatnonzero(decibels(x, step) >= quiet)
    return x[loud[0] * step : (loud[-1] + 1) * step] if len(loud) else x[:0]


def silence_shortened(x: np.ndarray, rate: int, quiet: float = -50.0, least: float = 1.0, keep: float = 0.5, block: float = 0.01) -> np.ndarray:
    """Silences of `least` seconds or more keep `keep` seconds at the side of what is heard."""
    size = max(1, int(rate * block))
    block = size / rate
    stay = np.ones(len(x), bool)
    for a, b in runs(decibels(x, size) < quiet):
        if (b - a) * block >= least:
            end = b * size >= len(x)
            lo, hi = a * size + int(keep * rate) * (a > 0), len(x) if end else b * size - int(keep * rate)
            stay[lo : max(lo, hi)] = False
    return x[stay]


def framed_rms(x: np.ndarray, frame: int = 2048, hop: int = 512) -> np.ndarray:
    """Centred frames over zero padding."""
    padded = np.pad(x, frame // 2)
    if len(padded) < frame:
        return np.empty(0)
    total = np.concatenate([[0.0], np.cumsum(padded * padded)])
    start = np.arange(0, len(padded) - frame + 1, hop)
    return np.sqrt(np.maximum(total[start + frame] - total[start], 0) / frame)


def time_aligned(a: np.ndarray, b: np.ndarray, most: float = 1.35, stretch=None) -> tuple[np.ndarray, np.ndarray]:
    """Both at the shorter length; before that b is stretched to a's, where their ratio lies within `most`."""
    a, b = (centred(v) for v in (a, b))
    if not len(a) or not len(b):
        return a, b
    if 1 / most <= len(b) / len(a) <= most:
        b = (stretch or vocoded)(b, len(a))
    n = min(len(a), len(b))
    return a[:n], b[:n]


def centred(x: np.ndarray) -> np.ndarray:
    """Finite values without their mean."""
    x = np.nan_to_num(np.asarray(x, float), nan=0.0, posinf=0.0, neginf=0.0)
    return x - x.mean() if len(x) else x


def level(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(x * x))) if len(x) else 0.0


def prepared_pair(a: np.ndarray, b: np.ndarray, align: bool = True, peak: bool = True, trim=None) -> tuple[np.ndarray, np.ndarray]:
    """A reference and its likeness without silent edges, aligned in time, at one loudness (a gain of 0.25 to 4) and at
    a peak of 0.95 (a gain of 20 at most)."""
    trim = trim or trimmed
    a, b = (trim(centred(v)) for v in (a, b))
    if align:
        a, b = time_aligned(a, b)
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if level(a) > FLOOR and level(b) > FLOOR:
        b = b * np.clip(level(a) / level(b), 0.25, 4.0)
    if peak:
        a, b = (v * min(0.95 / top, 20.0) if (top := np.abs(v).max(initial=0.0)) > FLOOR else v for v in (a, b))
    return a, b


def listening_score(a: np.ndarray, b: np.ndarray, rate: int, score, least: int = 1024, prepare=prepared_pair) -> float | None:
    """score(rate, a, b, band) of a prepared pair at 8 or 16 kHz; None for short ones and where it fails."""
    a, b = prepare(a, b)
    if rate not in (8000, 16000):
        a, b, rate = resampled(a, rate, 16000), resampled(b, rate, 16000), 16000
    n = min(len(a), len(b))
    if n < least:
        return None
    try:
        return float(score(rate, a[:n], b[:n], "wb" if rate == 16000 else "nb"))
    except Exception:  # a model's failure is a missing value
        return None


def intelligibility(a: np.ndarray, b: np.ndarray, rate: int, score=None, prepare=prepared_pair) -> float:
    """score(a, b, rate) of a prepared pair, short-time objective intelligibility, within 0 and 1; 0 under a quarter of a second."""
    a, b = prepare(a, b)
    return 0.0 if min(len(a), len(b)) < 0.25 * rate else float(np.clip((score or stoi)(a, b, rate), 0.0, 1.0))


def isolated(metrics: dict, prepare=None):
    """Metrics (name -> function of the array and a second value) as one column, a struct of doubles: what fails is null, alone.

    With `prepare` they are functions of what it makes of both, once for all of them.
    """

    def run(x: pd.Series, key: pd.Series) -> pd.DataFrame:
        out = {name: [] for name in metrics}
        for v, k in zip(x, key, strict=True):
            try:
                ready = prepare(np.asarray(v, float), k) if prepare else None
            except Exception:  # then each metric fails
                ready = None
            for name, metric in metrics.items():
                try:
                    made = metric(ready) if prepare else metric(np.asarray(v, float), k)
                except Exception:  # the others go on
                    made = None
                out[name].append(made)
        return pd.DataFrame({name: pd.Series(values, dtype="float64") for name, values in out.items()})

    return F.pandas_udf(run, ", ".join(f"{name} double" for name in metrics))


def slices_of_speech(x: np.ndarray, rate: int, threshold: float = -40.0, shortest: float = 2.0, pause: float = 0.3, hop: float = 0.02, kept: float = 2.0) -> np.ndarray:
    """[n, 2] samples from and to of the pieces between pauses.

    A pause of `pause` seconds or more ends a piece of `shortest` or more (or, at the start, one longer than `kept`): a
    pause up to `kept` is cut at its quietest frame, up to twice that between the quietest frames near its ends, widened by
    the one where these overlap, and a longer one loses its middle.  Short signals and such without a cut are one piece.
    """
    step = round(rate * hop)
    frame = min(round(rate * pause), 4 * step)
    least, gap, keep = round(rate * shortest / step), round(rate * pause / step), round(rate * kept / step)
    if len(x) <= least:
        return np.array([[0, len(x)]])
    level_ = framed_rms(x, frame, step)
    n = len(level_)
    low = lambda a, b: a + int(np.argmin(level_[a:b]))
    cuts, piece = [], 0
    silent = runs(level_ < 10 ** (threshold / 20))
    for a, b in silent:
        if b == n:
            if n - a >= gap:
                cuts.append((low(a, min(n, a + keep) + 1), n + 1))
            break
        if not (a == 0 and b > keep) and not (b - a >= gap and b - piece >= least):
            continue
        if b - a <= keep:
            left = right = low(a, b + 1)
        else:
            left, right = low(a, a + keep + 1), low(b - keep, b + 1)
            if b - a <= 2 * keep:
                middle = low(b - keep, a + keep + 1)
                left, right = min(left, middle), max(right, middle) if a else right
        cuts.append((0 if a == 0 else left, right))
        piece = right
    if not cuts:
        return np.array([[0, n * step]])
    edges = [(0, cuts[0][0])] if cuts[0][0] > 0 else []
    edges += [(p[1], q[0]) for p, q in zip(cuts, cuts[1:])]  # noqa: B905
    edges += [(cuts[-1][1], n)] if cuts[-1][1] < n else []
    return np.array(edges).reshape(-1, 2) * step


def clipped_reference(x: np.ndarray, rate: int, enough: float = 6.0, most: float = 12.0, tail: float = 0.05) -> np.ndarray:
    """A reference of `most` seconds at most: its parts between silences (first of 1 s under -50 dB, then of 0.1 s under
    -40 dB) as long as the next one fits or there isn't `enough`, else its beginning; silent edges go, and silence of
    `tail` seconds follows."""

    def parts(least: float, quiet: float, keep: float = 1.0, block: float = 0.01) -> list[np.ndarray]:
        size = max(1, int(rate * block))
        loud = np.concatenate([[0], *[(a * size, b * size) for a, b in runs(decibels(x, size) < quiet) if (b - a) * block >= least], [len(x)]]).reshape(-1, 2).astype(int)
        pad = int(keep * rate)
        spans = [[max(0, a - pad), min(len(x), b + pad)] for a, b in loud if b > a]
        for p, q in zip(spans, spans[1:]):  # noqa: B905
            if q[0] < p[1]:  # what both would keep of a silence is shared at its middle
                p[1] = q[0] = (p[1] + q[0]) // 2
        return [x[a:b] for a, b in spans]

    out = x
    for least, quiet in ((1.0, -50.0), (0.1, -40.0)):
        out = x[:0]
        for part in parts(least, quiet):
            if len(out) > enough * rate and len(out) + len(part) > most * rate:
                break
            out = np.concatenate([out, part])
        if len(out) <= most * rate:
            break
    return np.concatenate([edges_trimmed(out[: int(most * rate)], rate), np.zeros(int(tail * rate))])


def crossfaded(parts: list[np.ndarray], rate: int, seconds: float = 0.15) -> np.ndarray:
    """One after the other, their ends mixed linearly over at most `seconds`."""
    out = np.asarray(parts[0], float) if parts else np.empty(0)
    for p in parts[1:]:
        n = min(int(seconds * rate), len(out), len(p))
        fade = np.linspace(1, 0, n)
        out = np.concatenate([out[: len(out) - n], out[len(out) - n :] * fade + np.asarray(p[:n]) * (1 - fade), p[n:]])
    return out


@lru_cache(maxsize=16)
def mel_filters(rate: int, fft: int, bands: int, slaney: bool = False) -> np.ndarray:
    """[bands, fft // 2 + 1] triangles between points that are evenly spaced in mels; by the other scale, of equal area."""
    if slaney:
        hz = _from_slaney(np.linspace(0, _slaney(np.array(rate / 2)), bands + 2))
        return _triangles(hz, rate, fft) * (2 / (hz[2:] - hz[:-2]))[:, None]
    mel = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), bands + 2)
    return _triangles(700 * (10 ** (mel / 2595) - 1), rate, fft)


def _triangles(hz: np.ndarray, rate: int, fft: int) -> np.ndarray:
    f = np.linspace(0, rate / 2, fft // 2 + 1)
    up = (f - hz[:-2, None]) / np.diff(hz)[:-1, None]
    down = (hz[2:, None] - f) / np.diff(hz)[1:, None]
    return np.maximum(0, np.minimum(up, down))


def log_mel(x: np.ndarray, rate: int = 24000, fft: int = 1024, hop: int = 256, bands: int = 100, centred_frames: bool = True) -> np.ndarray:
    """[frames, bands] natural logarithms, not under 1e-5.

    Two variants: frames centred on their time and bands by the one mel scale, or frames that begin (fft - hop) / 2 before
    it, bands by the other scale, and a magnitude kept from zero.
    """
    edge = fft // 2 if centred_frames else (fft - hop) // 2
    padded = np.pad(x, edge, mode="reflect" if len(x) > edge else "constant")
    if len(padded) < fft:
        return np.empty((0, bands))
    frames = np.lib.stride_tricks.sliding_window_view(padded, fft)[::hop]
    power = np.abs(np.fft.rfft(frames * np.hanning(fft + 1)[:-1], axis=1))
    if not centred_frames:
        power = np.sqrt(power * power + 1e-9)
    return np.log(np.maximum(power @ mel_filters(rate, fft, bands, not centred_frames).T, 1e-5))


def _slaney(hz: np.ndarray) -> np.ndarray:
    return np.where(hz < 1000, hz * 3 / 200, 15 + np.log(np.maximum(hz, 1000) / 1000) * 27 / np.log(6.4))


def _from_slaney(mel: np.ndarray) -> np.ndarray:
    return np.where(mel < 15, mel * 200 / 3, 1000 * np.exp((mel - 15) * np.log(6.4) / 27))


def cepstra(x: np.ndarray, rate: int, n: int = 14, bands: int = 128, fft: int = 2048, hop: int = 512) -> np.ndarray:
    """[frames, n]: cosine transform of mel powers in dB, at most 80 under the loudest; bands of equal area."""
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(x, fft // 2), fft)[::hop]
    power = np.abs(np.fft.rfft(frames * np.hanning(fft + 1)[:-1], axis=1)) ** 2
    level = 10 * np.log10(np.maximum(power @ mel_filters(rate, fft, bands, True).T, 1e-10))
    level = np.maximum(level, level.max(initial=-np.inf) - 80)
    basis = np.cos(np.pi / bands * (np.arange(bands)[None, :] + 0.5) * np.arange(n)[:, None]) * np.sqrt(2 / bands)
    basis[0] /= np.sqrt(2)
    return level @ basis.T


def cepstral_distortion(a: np.ndarray, b: np.ndarray, rate: int = 16000) -> float | None:
    """Mean frame distance of 13 coefficients (without the zeroth), in dB; the shorter signal is padded."""
    if not len(a) or not len(b):
        return None
    n = max(len(a), len(b))
    d = cepstra(np.pad(a, (0, n - len(a))), rate) - cepstra(np.pad(b, (0, n - len(b))), rate)
    return float(10 * np.sqrt(2) / np.log(10) * np.sqrt((d[:, 1:] ** 2).sum(axis=1)).mean())


def warp(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[steps, 2] cheapest monotone alignment of two contours by absolute difference."""
    cost = np.abs(a[:, None] - b[None, :])
    total = np.full((len(a) + 1, len(b) + 1), np.inf)
    total[0, 0] = 0
    # along the antidiagonals, whose cells need only those of the two before
    for k in range(len(a) + len(b) - 1):
        i = np.arange(max(0, k - len(b) + 1), min(k + 1, len(a)))
        j = k - i
        total[i + 1, j + 1] = cost[i, j] + np.minimum(np.minimum(total[i, j], total[i, j + 1]), total[i + 1, j])
    i, j, path = len(a), len(b), []
    while i and j:
        path.append((i - 1, j - 1))
        i, j = min(((i - 1, j - 1), (i - 1, j), (i, j - 1)), key=lambda p: total[p])
    return np.array(path[::-1])


def contour_similarity(a: np.ndarray, b: np.ndarray) -> float | None:
    """Correlation of two pitch contours in Hz (0 or NaN: unvoiced) after alignment; None under five voiced frames; flat
    contours are compared by their distance in cents."""

    def voiced(x):
        x = np.log2(x[np.isfinite(x) & (x > 0)])
        mad = np.median(np.abs(x - np.median(x))) if len(x) else 0
        return x[np.abs(x - np.median(x)) <= 6 * mad] if mad > 0 else x

    a, b = voiced(a), voiced(b)
    if min(len(a), len(b)) < 5:
        return None
    p = warp(a, b)
    x, y = a[p[:, 0]], b[p[:, 1]]
    if x.std() < 1e-5 or y.std() < 1e-5:
        return float(np.clip(1 - 1200 * np.sqrt(((x - y) ** 2).mean()) / 300, -1, 1))
    return float(np.clip(np.corrcoef(x, y)[0, 1], -1, 1))
