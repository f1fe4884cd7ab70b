"""Hashes of the words of texts, all texts of a slice at once."""

from __future__ import annotations

import numpy as np

from .fingerprints import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word in order; words are parted by ASCII white space, and A-Z count as a-z."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raw])
    gap = _GAP[data]
    first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    last = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]]))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(data), _ODD), dtype=np.uint64)
        back = np.cumprod(np.full(len(data), np.uint64(pow(int(_ODD), -1, 1 << 64))), dtype=np.uint64)
        values = mix(np.arange(256, dtype=np.uint64), 13)
        total = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * power, dtype=np.uint64)])
        word = mix((total[last + 1] - total[first]) * back[first], 14)
    return word, np.searchsorted(ends, first, "right")
