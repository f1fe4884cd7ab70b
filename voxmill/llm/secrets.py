"""Secret scans: base patterns, and random strings found by their token efficiency.

A string that a byte-pair vocabulary has not seen breaks into many short tokens.  Candidates are runs of 16 or more
characters of a key alphabet, with or without digits; one whose characters per token fall to `RATIO` or lower is
random, unless it is a known digest length in hex, a UUID, a number, or words and numbers whose letter runs the
vocabulary itself encodes in few tokens.  Words that no vocabulary has are inefficient, too: a candidate of letters in the case of words is
random only if its pairs of letters are no likelier in this document than by chance.  Base spans (assignments, access keys, long hex) are kept whatever the test says; a random
string inside a base span adds nothing.

Edge cases: null text is the empty text; ties and repeated rows are rows of their own; texts of any length are scanned whole, and judged by all their letters; empty tables give empty
results; further columns are ignored by the scan and kept by the redaction.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table, whole_text

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters per token at or below which a candidate is random.
RATIO = 2.2
#: Letters per token from which the letter runs of a candidate are words.
WORDS = 3
SHORTEST = 16
#: Hex digits of known digests (crc and md5 to sha512).
DIGESTS = (32, 40, 56, 64, 96, 128)
#: Pairs of letters that the vocabulary stands for beside a document's own.
PRIOR_PAIRS = 300.0
KINDS = ("assign", "access", "hex", "random")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long, n_found long"

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}(?![0-9A-Za-z])")
_LETTERS = re.compile(r"[A-Za-z]+")
_AFFIX = re.compile(r"[A-Za-z]+[^A-Za-z]+|[^A-Za-z]+[A-Za-z]+")


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def known(s: str, path: str) -> bool:
    """Digests and identifiers that are no secrets by themselves."""
    if len(s) in DIGESTS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return True
    # what whole UUIDs leave: words and numbers (names, paths, dates, versions), or a number with one token beside it
    rest = _UUID.sub("", s)
    runs = _LETTERS.findall(rest)
    tokens = sum(len(encoding(path).encode_ordinary(" " + r.lower())) for r in runs)
    return sum(map(len, runs)) >= WORDS * tokens or tokens == 1 and bool(_AFFIX.fullmatch(rest))


def random_string(s: str, path: str, ratio: float = RATIO) -> bool:
    # the test first: few candidates fail it
    return len(s) / max(1, len(encoding(path).encode_ordinary(s))) <= ratio and not known(s, path)


def letter_pairs(text: str) -> np.ndarray:
    """[26, 26] how often each ASCII letter, in either case, follows each."""
    b = np.frombuffer(text.encode("ascii", "replace").lower(), np.uint8).astype(np.int64) - 97
    both = (b[:-1] >= 0) & (b[:-1] < 26) & (b[1:] >= 0) & (b[1:] < 26)
    return np.bincount(b[:-1][both] * 26 + b[1:][both], minlength=676).reshape(26, 26).astype(float)


@functools.lru_cache(maxsize=2)
def usual_pairs(path: str) -> np.ndarray:
    """Shares of pairs of letters in the vocabulary's tokens."""
    n = letter_pairs(" ".join(t.decode("utf-8", "ignore") for t in encoding(path).token_byte_values())) + 1
    return n / n.sum()


def worded(s: str, text: str, path: str) -> bool:
    """Whether letters in the case of words (small, all great, or the first one great) follow each other as in the document and the
    vocabulary, rather than each as likely as any other."""
    runs = _LETTERS.findall(s)
    if any(not r[1:].islower() and not r.isupper() for r in runs if len(r) > 1) or any(c.isdigit() for c in s):
        return False
    # without the candidate itself, however often it stands there
    n = letter_pairs(text.replace(s, " ")) + PRIOR_PAIRS * usual_pairs(path)
    gain = np.log(26 * n / n.sum(axis=1, keepdims=True))
    return float((letter_pairs(s) * gain).sum()) > 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the base patterns; failing matches are dropped, without another try."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int]], path: str) -> list[tuple[int, int, int]]:
    out = []
    for m in _CANDIDATE.finditer(text):
        if random_string(m[0], path) and not any(a <= m.start() and m.end() <= b for a, _, b in base) and not worded(m[0], text, path):
            out.append((m.start(), 3, m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
    rows = []
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        base = base_spans(text)
        extra = added_spans(text, base, path)
        n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        rows.append((doc_id, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + extra)), len(extra), len(base) + len(extra)))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def scan_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    path = path or vocabulary_path()
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), lambda b: scan(b, path), SCHEMA)


def mask(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, path: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with every found span of `text` replaced by `mark`; n_chars, where there, is counted anew."""
    path = path or vocabulary_path()
    at = docs.columns.index("text")
    schema = docs.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text in batch.column(at).to_pylist():
            base = base_spans(text or "")
            texts.append(text if text is None else mask(text, sorted(base + added_spans(text, base, path)), mark))
        return batch.set_column(at, "text", pa.array(texts, batch.column(at).type))

    out = map_arrow(docs, run, schema)
    return out.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))
