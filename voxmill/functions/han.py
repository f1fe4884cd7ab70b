"""Chinese words and their readings in mixed text: a trie over a given dictionary, and the most probable segmentation."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most words that a dictionary may have: every worker holds it.
MOST_WORDS = 500_000
#: A run of Chinese characters, one of ASCII letters and digits, or any other character.
_PIECE = re.compile(r"([\u3100-\u9fff]+)|([A-Za-z0-9]+)|(.)", re.DOTALL)
_QUOTES = str.maketrans({";": ",", "“": '"', "”": '"', "‘": "'", "’": "'"})


class Trie:
    """Words by their characters; the end of one holds its log probability and its readings, a character each."""

    def __init__(self, words: list[tuple[str, float, list[str]]]):
        self.root: dict = {}
        total = sum(n for _, n, _ in words) or 1.0
        #: A character that is no word: as likely as a word seen once.
        self.unknown = -math.log(total + 1)
        self.single: dict[str, str] = {}
        for word, n, readings in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = (math.log(n) - math.log(total + 1) if n > 0 else self.unknown, readings)
            if len(word) == 1:
                self.single[word] = readings[0]

    def matches(self, text: str, at: int):
        """(end, log probability, readings) of every word that begins there."""
        node = self.root
        for end in range(at, len(text)):
            node = node.get(text[end])
            if node is None:
                return
            if "" in node:
                yield end + 1, *node[""]

    def words(self, text: str) -> list[tuple[str, list[str]]]:
        """The most probable words of a run and their readings, from its end to its begin; of equally probable ones that with the longer
        first word.  A character without a word stands for itself."""
        best: list = [(0.0, 0, ())] * (len(text) + 1)
        for at in range(len(text) - 1, -1, -1):
            ways = list(self.matches(text, at))
            if not ways or ways[0][0] > at + 1:
                ways.append((at + 1, self.unknown, [text[at]]))
            best[at] = max(((p + best[end][0], end, readings) for end, p, readings in ways), key=lambda w: w[:2])
        out, at = [], 0
        while at < len(text):
            _, end, readings = best[at]
            out.append((text[at:end], list(readings)))
            at = end
        return out

    def symbols(self, text: str) -> list[str]:
        """Characters, with a space before and the reading in place of each Chinese one, and a space before a run of two or more
        letters and digits that follows anything but a space, a colon or a quote."""
        out: list[str] = []
        for han, plain, other in _PIECE.findall(text.translate(_QUOTES)):
            if han:
                for _, readings in self.words(han):
                    for reading in readings:
                        out += [" ", reading]
            elif plain:
                if out and len(plain) > 1 and out[-1] not in " :'\"":
                    out.append(" ")
                out += plain
            else:
                out.append(other)
        return out


def dictionary(words: DataFrame) -> list[tuple[str, float, list[str]]]:
    """words(word, n, readings), of which the first readings of a word count, as far as there is one for each character."""
    good = words.where((F.char_length("word") > 0) & (F.size("readings") == F.char_length("word"))).groupBy("word").agg(F.max("n").cast("double").alias("n"), F.min("readings").alias("readings"))
    rows = good.limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"a dictionary holds at most {MOST_WORDS} words")
    return sorted((r.word, r.n or 0.0, list(r.readings)) for r in rows)


def symbols_column(words: DataFrame):
    """A column function: text to its symbols, by a dictionary; null stays null."""
    trie = Trie(dictionary(words))

    def symbols(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else trie.symbols(x))

    return F.pandas_udf(symbols, "array<string>")
