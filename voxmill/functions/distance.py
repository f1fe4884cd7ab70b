"""Edit distances and error rates.

Word distance stays native: the distinct words of a pair become single code points and `levenshtein` compares the two
strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, normalized, words


def word_distance(reference: Column, hypothesis: Column) -> Column:
    def coded(side: Column, vocabulary: Column) -> Column:
        def letter(w: Column) -> Column:
            at = F.array_position(vocabulary, w) + 256
            # the code points of surrogates are left out
            point = F.when(at < 0xD800, at).otherwise(at + 2048)
            return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")

        return F.array_join(F.transform(side, letter), "")

    def distance(p: Column) -> Column:
        vocabulary = F.array_distinct(F.concat(p["r"], p["h"]))
        return bound(vocabulary, lambda v: F.levenshtein(coded(p["r"], v), coded(p["h"], v)))

    return bound(F.struct(words(reference).alias("r"), words(hypothesis).alias("h")), distance)


#: What an empty side gives: (both empty, reference empty, hypothesis empty) for words and characters.
POLICIES = {"filter": ((0.0, 1.0, 1.0), (0.0, 1.0, 1.0)), "phase": ((0.0, 1.0, 1.0), (0.0, 1.0, 1.0)), "calculator": ((0.0, 1.0, 1.0), (0.0, 0.0, 1.0)), "pipeline": ((0.0, 0.0, 1.0), (0.0, 0.0, 1.0))}


def _rate(distance: Column, length: Column, r: Column, h: Column, given: tuple[float, float, float]) -> Column:
    both, no_reference, no_hypothesis = given
    return F.when((r == "") & (h == ""), both).when(r == "", no_reference).when(h == "", no_hypothesis).otherwise(distance / length)


def wer(reference: Column, hypothesis: Column, policy: str = "pipeline") -> Column:
    def rate(p: Column) -> Column:
        return _rate(word_distance(p["r"], p["h"]), F.size(words(p["r"])), p["r"], p["h"], POLICIES[policy][0])

    return bound(F.struct(normalized(reference).alias("r"), normalized(hypothesis).alias("h")), rate)


def cer(reference: Column, hypothesis: Column, policy: str = "pipeline") -> Column:
    def rate(p: Column) -> Column:
        return _rate(F.levenshtein(p["r"], p["h"]), F.char_length(p["r"]), p["r"], p["h"], POLICIES[policy][1])

    return bound(F.struct(normalized(reference).alias("r"), normalized(hypothesis).alias("h")), rate)
