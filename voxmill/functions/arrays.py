"""Signal and vector numerics on array<float> columns, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(x: Column) -> Column:
    return F.transform(x, lambda v: F.coalesce(F.when(F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v.cast("double")), F.lit(0.0)))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def mean(x: Column) -> Column:
    return total(x) / F.size(x)


def mono(x: Column) -> Column:
    """Finite doubles without their mean."""
    clean = _doubles(x)
    m = mean(clean)
    return F.transform(clean, lambda v: v - m)


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v).cast("double")))


def peak_normalized(x: Column, target: float = 0.95, most: float = 20.0) -> Column:
    p = peak(x)
    gain = F.least(F.lit(target) / p, F.lit(most))
    return F.when(p > 0, F.transform(x, lambda v: v * gain)).otherwise(F.transform(x, lambda v: v.cast("double")))


def rms(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v) / F.size(x))


def rms_matched(x: Column, reference: Column, low: float = 0.25, high: float = 4.0) -> Column:
    gain = F.greatest(F.lit(low), F.least(F.lit(high), rms(reference) / rms(x)))
    return F.when((rms(x) > 0) & (rms(reference) > 0), F.transform(x, lambda v: v.cast("double") * gain)).otherwise(F.transform(x, lambda v: v.cast("double")))


def fitted(x: Column, n: int | Column) -> Column:
    """Cut, or padded with zeros, to n values."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.slice(F.concat(F.transform(x, lambda v: v.cast("double")), F.array_repeat(F.lit(0.0), n)), F.lit(1), n)


def remixed(frames: Column, channels: int) -> Column:
    """frames (one array of channels each) with another number of channels: their mean, one repeated, or the first ones."""

    def frame(f: Column) -> Column:
        if channels == 1:
            return F.array(F.aggregate(f, F.lit(0.0), lambda a, v: a + v) / F.size(f))
        return F.when(F.size(f) == 1, F.array_repeat(F.get(f, F.lit(0)), channels)).otherwise(F.slice(f, 1, channels))

    return F.transform(frames, frame)


def peak_blended(x: Column, most: float = 0.9, alpha: float = 0.5) -> Column:
    """16-bit values of a blend of the signal with itself at the peak `most`; a peak over 1 is brought to 1 first."""
    p = peak(x)

    def value(v: Column) -> Column:
        calm = F.when(p > 1, v.cast("double") / p).otherwise(v.cast("double"))
        return ((calm / p * (most * alpha) + (1 - alpha) * calm) * 32767).cast("int")

    return F.transform(x, value)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def l1(a: Column, b: Column) -> Column:
    return mean(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def mse(a: Column, b: Column) -> Column:
    return mean(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))))


def pcm16(x: Column) -> Column:
    return F.transform(x, lambda v: F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v.cast("double"))) * 32767).cast("int"))


def placed_total(x: Column) -> Column:
    """The sum of the values, each times its place from 1."""
    return F.aggregate(F.transform(x, lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, v: a + v)


def framed_rms(x: Column, frame: int, hop: int) -> Column:
    """Levels of frames that are centred on every `hop`-th sample, over zero padding."""
    half = F.array_repeat(F.lit(0.0), frame // 2)
    padded = F.concat(half, F.transform(x, lambda v: v.cast("double")), half)
    squares = lambda k: F.aggregate(F.slice(padded, (k * hop + 1).cast("int"), frame), F.lit(0.0), lambda a, v: a + v * v)
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(x) / hop).cast("int")), lambda k: F.sqrt(squares(k) / frame))


def crossfaded(a: Column, b: Column, n: int) -> Column:
    """One after the other, their last and first `n` values, as far as both have them, mixed linearly."""
    k = F.least(F.lit(n), F.size(a), F.size(b))
    fade = lambda i: F.when(k > 1, 1 - i / (k - 1)).otherwise(1.0)
    mixed = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(k, F.lit(1)) - 1), lambda i: i < k), lambda i: F.get(a, F.size(a) - k + i) * fade(i) + F.get(b, i) * (1 - fade(i)))
    return F.concat(F.slice(a, F.lit(1), F.size(a) - k), mixed, F.slice(b, k + 1, F.size(b) - k))


def edges_trimmed(x: Column, step: int, quiet: float) -> Column:
    """Without the steps at both ends whose level in dB lies under `quiet`; empty where all do."""
    power = lambda b: F.aggregate(F.slice(x, b * step + 1, F.lit(step)), F.lit(0.0), lambda a, v: a + v * v) / F.least(F.lit(step), F.size(x) - b * step)
    steps = F.filter(F.sequence(F.lit(0), F.ceil(F.greatest(F.size(x), F.lit(1)) / step).cast("int") - 1), lambda b: b * step < F.size(x))
    loud = F.filter(steps, lambda b: 20 * F.log10(F.greatest(F.sqrt(power(b)), F.lit(1e-10))) >= quiet)
    first = F.array_min(loud) * step
    return F.when(F.size(loud) > 0, F.slice(x, first + 1, (F.array_max(loud) + 1) * step - first)).otherwise(F.slice(x, 1, 0))
