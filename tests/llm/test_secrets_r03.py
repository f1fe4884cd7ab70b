"""Words aren't secrets, random strings are: both on given documents, and the whole test against a plain version."""

import random
import re
import string

import duckdb
import pytest
from pyspark.sql import functions as F

from voxmill.llm import secrets

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def texts():
    return [t for (t,) in duckdb.sql(f"select text from '{DOCS}' where text <> ''").fetchall()]


@pytest.mark.parametrize(("alphabet", "least"), [(string.ascii_letters + string.digits, 0.99), (string.ascii_letters, 0.99), (string.ascii_lowercase + string.digits, 0.98), (string.ascii_lowercase, 0.95), (string.ascii_uppercase, 0.95)])
@pytest.mark.parametrize("size", [16, 20, 24, 31])
def test_random_strings_are_found_in_documents(texts, alphabet, least, size):
    pick, path, found = random.Random(size), secrets.vocabulary_path(), 0
    for _ in range(300):
        s, text = "".join(pick.choice(alphabet) for _ in range(size)), pick.choice(texts)
        at = pick.randint(0, len(text))
        found += any(b - a >= size for a, _, b in secrets.added_spans(f"{text[:at]} {s} {text[at:]}", [], path))
    assert found >= least * 300


def test_no_word_of_the_documents_is_a_secret(spark):
    rows = secrets.op10_secret_scans(spark, "/root/testdata/sf0.01")
    assert rows.agg(F.sum("n_random")).first()[0] == 0


def plain_added(text, base, path):
    """The ratio test and the pairs of letters, a character at a time."""
    enc = secrets.encoding(path)
    vocabulary = " ".join(t.decode("utf-8", "ignore") for t in enc.token_byte_values())

    def pairs(x):
        out = {}
        for a, b in zip(x.lower(), x.lower()[1:], strict=False):
            if a in string.ascii_lowercase and b in string.ascii_lowercase:
                out[a + b] = out.get(a + b, 0) + 1
        return out

    usual = pairs(vocabulary)
    total = sum(usual.values()) + 676
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
        s = m[0]
        if len(s) / len(enc.encode_ordinary(s)) > secrets.RATIO or secrets.known(s, path) or any(a <= m.start() and m.end() <= b for a, _, b in base):
            continue
        words = re.findall("[A-Za-z]+", s)
        if not any(c.isdigit() for c in s) and all(len(w) == 1 or w[1:].islower() or w.isupper() for w in words):
            own, gain = pairs(text.replace(s, " ")), 0.0
            n = {a + b: own.get(a + b, 0) + secrets.PRIOR_PAIRS * (usual.get(a + b, 0) + 1) / total for a in string.ascii_lowercase for b in string.ascii_lowercase}
            import math

            for p, k in pairs(s).items():
                gain += k * math.log(26 * n[p] / sum(n[p[0] + b] for b in string.ascii_lowercase))
            if gain > 0:
                continue
        out.append((m.start(), 3, m.end()))
    return out


def test_added_spans_are_those_of_a_plain_version(texts):
    pick, path = random.Random(5), secrets.vocabulary_path()
    made = ["dieeinkeitgekeit", "eaumenteuxaiauxch", "xqzkwvjtrplmnbdf", "Kvbqzrtlmxwpjhdnsg", "ERSCHSCHBERBERTZ", "XQZKWVJTRPLMNBDF", "kVbQzRtLmXwPjHdNsGfC", "a9f3k2l1m8n7b6v5c4", "Donaudampfschiffahrtsgesellschaft", "well-known-something-else", "qwx-zkv-jtr-plm-nbd-fgh"]
    for _ in range(25):
        text = pick.choice(texts)[:3000]
        for s in pick.sample(made, 4):
            at = pick.randint(0, len(text))
            text = f"{text[:at]} {s} {text[at:]}"
        base = secrets.base_spans(text)
        assert secrets.added_spans(text, base, path) == plain_added(text, base, path)


def test_words_beside_a_repeated_secret(texts):
    path, s = secrets.vocabulary_path(), "xqzkwvjtrplmnbdf"
    assert len(secrets.added_spans(f"{s} " * 50, [], path)) == 50
    assert secrets.added_spans("", [], path) == []


def test_redaction_leaves_prose(spark):
    docs = spark.read.parquet(DOCS)
    scanned = secrets.scan_documents(docs)
    clean = docs.join(scanned.where("n_found = 0").select("doc_id"), "doc_id")
    changed = secrets.redact(clean).select("doc_id", F.col("text").alias("after")).join(clean, "doc_id").where("not (after <=> text)")
    assert clean.count() > 300 and changed.count() == 0
