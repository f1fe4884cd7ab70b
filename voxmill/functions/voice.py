"""Voices from samples: resampling, time stretching, pitch, intelligibility.  Plain numpy on one signal; `signals.column` runs them over columns."""

from __future__ import annotations

import math

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

#: Fixed values of the pitch search: lowest and highest pitch in Hz, samples of a frame and a hop.
LOWEST, HIGHEST, FRAME, HOP = 50.0, 650.0, 2048, 256
#: Thresholds of the difference function and the parameters of their prior (a beta distribution), the share that a frame without a trough
#: under any keeps, bins of a semitone, octaves a second that pitch may move, and the chance that voice begins or ends.
THRESHOLDS, PRIOR, NO_TROUGH, BINS, OCTAVES, SWITCH = 100, (2, 18), 0.01, 10, 35.92, 0.01
#: Fixed values of the intelligibility index: rate, samples of a frame, points of its transform, third octaves from the lowest, frames of
#: a segment, dB under the loudest frame that count as silence, and dB of the clipping.
STOI_RATE, STOI_FRAME, STOI_FFT, BANDS, BAND_FROM, SEGMENT, SILENT, CLIPPED = 10_000, 256, 512, 15, 150.0, 30, 40.0, -15.0


def resampled(x: np.ndarray, rate: int, to: int, zeros: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """On another grid by a Hann-windowed sinc, whose band is the narrower of the two; as many values as fit, the last one up."""
    x = np.asarray(x, float)
    if rate == to or not len(x):
        return x
    common = math.gcd(rate, to)
    rate, to = rate // common, to // common
    cut = min(rate, to) * rolloff
    reach = math.ceil(zeros * rate / cut)
    taps = np.arange(-reach, reach + rate)
    # one row of weights for each of the `to` phases of a block of `rate` samples
    at = (np.arange(0, -to, -1)[:, None] / to + taps[None, :] / rate) * cut
    at = np.clip(at, -zeros, zeros)
    kernel = np.sinc(at) * np.cos(at * np.pi / zeros / 2) ** 2 * (cut / rate)
    n = math.ceil(len(x) * to / rate)
    padded = np.pad(x, (reach, reach + rate + rate * 2))
    blocks = np.lib.stride_tricks.sliding_window_view(padded, len(taps))[: len(x) + 1 : rate]
    return (blocks @ kernel.T).ravel()[:n]


def hann(n: int) -> np.ndarray:
    return np.hanning(n + 1)[:-1]


def spectra(x: np.ndarray, fft: int, hop: int) -> np.ndarray:
    """[frames, bins] of frames that are centred on their time."""
    padded = np.pad(x, fft // 2)
    padded = np.pad(padded, (0, max(0, fft - len(padded))))
    return np.fft.rfft(sliding_window_view(padded, fft)[::hop] * hann(fft), axis=1)


def overlapped(frames: np.ndarray, hop: int) -> np.ndarray:
    """Frames added at their places."""
    n, fft = frames.shape
    out = np.zeros((n - 1) * hop + fft)
    for k in range(n):
        out[k * hop : k * hop + fft] += frames[k]
    return out


def vocoded(x: np.ndarray, n: int, fft: int = 2048) -> np.ndarray:
    """x at n samples, its pitch kept: a phase vocoder.  Magnitudes lie between those of the two frames around a time;
    phases go on from frame to frame by what they advance there."""
    x = np.asarray(x, float)
    if len(x) < 16 or not n or n == len(x):
        return np.resize(x, n) if len(x) == n else np.interp(np.linspace(0, max(0, len(x) - 1), n), np.arange(len(x)), x) if len(x) and n else np.zeros(n)
    fft = min(fft, 1 << (len(x).bit_length() - 1))
    hop = fft // 4
    s = spectra(x, fft, hop)
    s = np.vstack([s, np.zeros((2, s.shape[1]))])
    at = np.arange(0, len(s) - 2, len(x) / n)
    k, part = at.astype(int), at % 1
    size = (1 - part)[:, None] * np.abs(s[k]) + part[:, None] * np.abs(s[k + 1])
    expected = 2 * np.pi * hop * np.arange(s.shape[1]) / fft
    moved = np.angle(s[k + 1]) - np.angle(s[k]) - expected
    advance = expected + moved - 2 * np.pi * np.round(moved / (2 * np.pi))
    phase = np.angle(s[0]) + np.vstack([np.zeros(s.shape[1]), np.cumsum(advance[:-1], axis=0)])
    out = overlapped(np.fft.irfft(size * np.exp(1j * phase), fft, axis=1) * hann(fft), hop)
    weight = overlapped(np.tile(hann(fft) ** 2, (len(at), 1)), hop)
    out = np.where(weight > 1e-8, out / np.maximum(weight, 1e-8), 0)[fft // 2 :]
    return np.pad(out, (0, max(0, n - len(out))))[:n]


def differences(frames: np.ndarray, most: int) -> np.ndarray:
    """[frames, most + 1] of the cumulative mean normalised difference of each frame and itself, moved by 0 to `most`."""
    n, size = frames.shape
    width = size - most
    fft = 1 << (size + width).bit_length()
    head = frames[:, :width]
    cross = np.fft.irfft(np.fft.rfft(frames, fft, axis=1) * np.conj(np.fft.rfft(head, fft, axis=1)), fft, axis=1)[:, : most + 1]
    power = np.concatenate([np.zeros((n, 1)), np.cumsum(frames**2, axis=1)], axis=1)
    moved = power[:, width : width + most + 1] - power[:, : most + 1]
    d = np.maximum(moved[:, :1] + moved - 2 * cross, 0)
    d[:, 0] = 0
    mean = np.cumsum(d, axis=1)[:, 1:] / np.arange(1, most + 1)
    return np.concatenate([np.ones((n, 1)), d[:, 1:] / np.maximum(mean, 1e-12)], axis=1)


def candidates(d: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(frame, period, probability) of the troughs: each threshold gives its prior to the first trough under it, and where there is none
    a little of it to the deepest one."""
    edges = np.linspace(0, 1, THRESHOLDS + 1)
    a, b = PRIOR
    # the distribution function of beta(2, b)
    below = 1 - (1 - edges) ** (a + b - 1) - (a + b - 1) * edges * (1 - edges) ** (a + b - 2)
    prior = np.diff(below)
    inner = d[:, least:-1]
    trough = (inner < d[:, least - 1 : -2]) & (inner <= d[:, least + 1 :])
    frame, lag = np.nonzero(trough)
    depth = inner[frame, lag]
    # the least depth before each trough of its frame: thresholds over it have their first trough there
    least_yet = np.minimum.accumulate(np.where(trough, inner, np.inf), axis=1)
    before = np.concatenate([np.full((len(d), 1), np.inf), least_yet[:, :-1]], axis=1)[frame, lag]
    order = np.lexsort((depth, frame))
    deepest = np.zeros(len(frame), bool)
    deepest[order[np.unique(frame[order], return_index=True)[1]]] = True
    chance = np.zeros(len(frame))
    for t, p in zip(edges[1:], prior, strict=True):
        chance[(depth < t) & (before >= t)] += p
        chance[deepest & (depth >= t)] += p * NO_TROUGH
    at = lag + least
    left, mid, right = d[frame, at - 1], d[frame, at], d[frame, at + 1]
    bend = left - 2 * mid + right
    shift = np.where(np.abs(bend) > 1e-12, (left - right) / (2 * np.where(bend == 0, 1, bend)), 0)
    return frame, at + np.clip(shift, -1, 1), chance


def best_path(seen: np.ndarray, reach: int) -> np.ndarray:
    """Of [frames, 2 n] chances of n voiced and n unvoiced states the likeliest path: a state moves by `reach` bins at most, nearer ones
    likelier, and seldom between voiced and unvoiced."""
    n = seen.shape[1] // 2
    step = np.log(np.maximum(reach + 1 - np.abs(np.arange(-reach, reach + 1)), 1e-9))
    # chances of what may follow each bin sum to one, also at the ends
    into = np.log(np.convolve(np.ones(n), np.exp(step), "same"))
    stay, switch = np.log(1 - SWITCH), np.log(SWITCH)
    logs = np.log(np.maximum(seen, 1e-300)).reshape(len(seen), 2, n)
    score, back = logs[0] - np.log(2 * n), np.zeros((len(seen), 2, n), int)
    # one place for the sums of all steps, which are large
    wide, window = np.full((2, n + 2 * reach), -np.inf), np.empty((2, n, 2 * reach + 1))
    moved, side, place = sliding_window_view(wide, 2 * reach + 1, axis=1), np.arange(2)[:, None], np.arange(n)
    for k in range(1, len(seen)):
        np.subtract(score, into, out=wide[:, reach : reach + n])
        best = np.add(moved, step, out=window).argmax(axis=2)
        came = best + place - reach
        reached = wide[side, best + place] + step[best]
        turned = reached[::-1] + switch > reached + stay
        score = np.where(turned, reached[::-1] + switch, reached + stay) + logs[k]
        back[k] = np.where(turned, 1 - side, side) * n + np.where(turned, came[::-1], came)
    state = int(score.reshape(-1).argmax())
    path = np.empty(len(seen), int)
    for k in range(len(seen) - 1, -1, -1):
        path[k] = state
        state = int(back[k].reshape(-1)[state])
    return path


def pitch(x: np.ndarray, rate: int, lowest: float = LOWEST, highest: float = HIGHEST, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Hz of each frame, NaN where it is unvoiced."""
    x = np.asarray(x, float)
    most = min(int(np.ceil(rate / lowest)), frame // 2)
    least = max(2, int(rate / highest))
    # a frame and itself, moved by a period, have their middle before the frame's
    padded = np.pad(x, (frame // 2 - most // 4, frame // 2 + most // 4))
    if not len(x) or len(padded) < frame or most <= least + 1:
        return np.empty(0)
    frames = sliding_window_view(padded, frame)[::hop]
    which, period, chance = candidates(differences(frames, most), least)
    bins = int(np.ceil(12 * BINS * np.log2(highest / lowest))) + 1
    bin_ = np.clip(np.round(12 * BINS * np.log2(rate / period / lowest)), 0, bins - 1).astype(int)
    seen = np.zeros((len(frames), 2 * bins))
    np.add.at(seen, (which, bin_), chance)
    voiced = np.minimum(seen[:, :bins].sum(axis=1), 1)
    seen[:, bins:] = ((1 - voiced) / bins)[:, None]
    reach = max(1, round(OCTAVES * 12 * BINS * hop / rate))
    path = best_path(seen, min(reach, bins - 1))
    # the candidate of the path's bin that is the likeliest, else the bin's own pitch
    out = np.where(path < bins, lowest * 2 ** (path % bins / (12 * BINS)), np.nan)
    for k in np.argsort(chance, kind="stable"):
        if path[which[k]] == bin_[k]:
            out[which[k]] = rate / period[k]
    return out


def third_octaves() -> np.ndarray:
    """[bands, bins] of the frequencies that each band takes."""
    hz = np.linspace(0, STOI_RATE / 2, STOI_FFT // 2 + 1)
    middle = BAND_FROM * 2 ** (np.arange(BANDS) / 3)
    low, high = (np.array([np.argmin((hz - m * 2**e) ** 2) for m in middle]) for e in (-1 / 6, 1 / 6))
    k = np.arange(len(hz))
    return ((k >= low[:, None]) & (k < high[:, None])).astype(float)


def heard(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the frames in which x is silent, put together again."""
    hop = STOI_FRAME // 2
    w = np.hanning(STOI_FRAME + 2)[1:-1]
    a, b = (sliding_window_view(v, STOI_FRAME)[::hop] * w for v in (x, y))
    level = 20 * np.log10(np.linalg.norm(a, axis=1) + 1e-12)
    loud = level > level.max(initial=-np.inf) - SILENT
    return tuple(overlapped(v[loud], hop) if loud.any() else v[:0].ravel() for v in (a, b))


def stoi(x: np.ndarray, y: np.ndarray, rate: int) -> float:
    """Short-time objective intelligibility of y against the clean x: the mean correlation of third-octave envelopes over
    segments, y's clipped where it stands too far over x's; 1e-5 where fewer frames than a segment are heard."""
    x, y = (resampled(v, rate, STOI_RATE) for v in (x, y))
    n = min(len(x), len(y))
    if n < STOI_FRAME:
        return 1e-5
    x, y = heard(x[:n], y[:n])
    w, hop = np.hanning(STOI_FRAME + 2)[1:-1], STOI_FRAME // 2
    if len(x) < STOI_FRAME + SEGMENT * hop:
        return 1e-5
    bands = third_octaves()
    a, b = (np.sqrt(bands @ (np.abs(np.fft.rfft(sliding_window_view(v, STOI_FRAME)[:-1:hop] * w, STOI_FFT, axis=1)) ** 2).T) for v in (x, y))
    if a.shape[1] < SEGMENT:
        return 1e-5
    # [bands, segments, frames]
    a, b = (sliding_window_view(v, SEGMENT, axis=1) for v in (a, b))
    tiny = np.finfo(float).eps
    b = b * np.linalg.norm(a, axis=2, keepdims=True) / (np.linalg.norm(b, axis=2, keepdims=True) + tiny)
    b = np.minimum(b, a * (1 + 10 ** (-CLIPPED / 20)))
    a, b = (v - v.mean(axis=2, keepdims=True) for v in (a, b))
    a, b = (v / (np.linalg.norm(v, axis=2, keepdims=True) + tiny) for v in (a, b))
    return float((a * b).sum(axis=2).mean())
