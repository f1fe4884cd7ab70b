"""Lengths of what will be spoken, and lengths in frames, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import word_count


def frames_by_bytes(reference_frames: Column, reference: Column, text: Column, speed: float = 1.0) -> Column:
    """Reference frames and, in proportion to the UTF-8 bytes, those of the text."""
    n = F.octet_length(reference)
    return F.when(n > 0, reference_frames + F.floor(reference_frames / n * F.octet_length(text) / speed)).cast("long")


def seconds_by_words(reference_seconds: Column, reference: Column, text: Column, speed: float = 1.0, usual: float = 2.5) -> Column:
    """By words a second of the reference, towards four a second; texts under three words are spoken slowly."""
    spoken, wanted = word_count(reference), word_count(text)
    rate = F.when((spoken > 0) & (reference_seconds > 0), spoken / reference_seconds).otherwise(usual)
    return reference_seconds + wanted / rate / F.when(wanted < 3, 0.3).otherwise(speed) * (rate / 4.0)


def most_chars(reference: Column, seconds: Column, window: float = 22.0) -> Column:
    return F.floor(F.octet_length(reference) / seconds * (window - seconds)).cast("long")


def frames(seconds: Column, rate: int = 24000, hop: int = 256) -> Column:
    return seconds * rate / hop


def length_mask(n: Column, width: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: i < n)


def span_mask(width: Column, begin: Column, end: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: (i >= begin) & (i < end))


def masked_mean(x: Column, mask: Column) -> Column:
    kept = F.filter(F.zip_with(x, mask, lambda v, m: F.when(m, v.cast("double"))), lambda v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, v: a + v) / F.size(kept))


def padded(x: Column, width: Column, value: float = 0.0) -> Column:
    """Filled up at the right; -11.512925 is the silence of log mels."""
    return F.concat(F.transform(x, lambda v: v.cast("double")), F.array_repeat(F.lit(value), F.greatest(width - F.size(x), F.lit(0))))


def edited(x: Column, spans: list[tuple[int, int]]) -> Column:
    """(value, keep): keep is false inside the spans [begin, end)."""

    def outside(i: Column) -> Column:
        keep = F.lit(True)
        for a, b in spans:
            keep = keep & ~((i >= a) & (i < b))
        return keep

    return F.transform(x, lambda v, i: F.struct(v.cast("double").alias("value"), outside(i).alias("keep")))


def joined(parts: list[Column], gap: Column) -> Column:
    """Arrays one after the other, `gap` between them."""
    out = [parts[0]]
    for p in parts[1:]:
        out += [gap, p]
    return F.concat(*out)


def real_time_factor(spent: Column, duration: Column) -> Column:
    """Seconds of synthesis for a second of sound; null without any."""
    return F.when(duration > 0, spent / duration)
