"""Toxicity by a weighted finite-state pattern grammar over clauses.

The first transducer reads words and writes their classes (insult, threat, target, negation, report, other), an insult
with a weight, the log odds of its stem among the labels.  Five small machines read the classes: the insult and threat
machines remember what was said, the target machine whether someone is addressed, the negation and report machines
whether it is denied or quoted.  Their product is composed once; a final state names the pattern that the clause matched
(say, a targeted insult, or a reported one) and weighs the path that led there.  A document's evidence is the number of
clauses of each pattern and the sum of their weights; a logistic model fitted on both turns it into a score.

Insult stems are learned: word and stem document frequencies among toxic and clean labelled rows, kept where a
likelihood-ratio test is beyond chance.  At most `FIT_ROWS` labelled rows (the lowest hashes of doc_id, held-out fold
excluded) are used for the fit; every document is scored whole.

Edge cases: null or empty text has no clause and gets the model's intercept; null doc_id counts as not held out;
without labels, or with one class only, stems are empty and the score is the smoothed base rate; repeated label rows
count once, the highest label wins; further columns are ignored by scoring and kept by filtering.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, map_arrow, table, whole_text

FIT_ROWS = 12_000
THRESHOLD = 0.3
#: Stem lengths besides whole words; the likelihood ratio a stem must reach.
STEMS, EVIDENCE = (4, 5, 6), 25.0
#: Different words that must precede a stem, as a share of its toxic rows (counted up to 24): in copies of one text it is one.
SPREAD = 0.4
SCHEMA = "doc_id long, score double, predicted int, clauses int"

#: Closed word classes of the grammar (English, German, French, Spanish).
THREAT = frozenset("kill hurt destroy burn shoot stab murder beat töten umbringen vernichten tuer frapper détruire matar golpear destruir".split())
TARGET = frozenset("you your yours u he she they him her them these those du dich dir ihr euch sie tu te toi vous ils elles tú usted ustedes vosotros ellos".split())
NEGATION = frozenset("not no never nobody none cannot don't isn't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split())
REPORT = frozenset("said says quoted quote reported claimed wrote called sagte schrieb zitierte dit écrit déclaré dijo escribió citado".split())
CLASSES = ("other", "insult", "threat", "target", "negation", "report")

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:,\n]+")


def latch(on: str) -> dict[tuple[int, str], int]:
    """A machine of two states that stays in 1 once it has read `on`."""
    return {(s, c): 1 if c == on else s for s in (0, 1) for c in CLASSES}


def near(on: str, reach: int) -> dict[tuple[int, str], int]:
    """State k: `on` was read at most `reach` words ago; the last state is reached by an insult or threat within reach."""
    hit = reach + 1
    out = {}
    for s, c in itertools.product(range(reach + 2), CLASSES):
        if s == hit:
            out[s, c] = hit
        elif c == on:
            out[s, c] = reach
        elif s and c in ("insult", "threat"):
            out[s, c] = hit
        else:
            out[s, c] = max(0, s - 1)
    return out


def compose(*machines: dict[tuple[int, str], int]) -> tuple[dict[tuple[int, str], int], list[tuple[int, ...]]]:
    """The product of machines: transitions between numbered states, and what each state is made of."""
    states = [(0,) * len(machines)]
    number = {states[0]: 0}
    moves = {}
    for state in states:  # grows while it is read
        for c in CLASSES:
            to = tuple(m[s, c] for m, s in zip(machines, state, strict=True))
            if to not in number:
                number[to] = len(states)
                states.append(to)
            moves[number[state], c] = number[to]
    return moves, states


_REACH = 2
GRAMMAR, STATES = compose(latch("insult"), latch("threat"), latch("target"), near("negation", _REACH), latch("report"))
PATTERNS = ("insult", "targeted insult", "threat", "negated", "reported", "weight")


def pattern(state: int) -> str | None:
    insult, threat, target, negation, report = STATES[state]
    if not insult and not (threat and target):
        return None
    if report:
        return "reported"
    if negation == _REACH + 1:
        return "negated"
    if insult:
        return "targeted insult" if target else "insult"
    return "threat"


#: What a clause that ends in a state counts as, and the weight of its path there: what is denied or quoted weighs half.
FINAL = [(name, 0.5 if name in ("negated", "reported") else 1.0) if (name := pattern(k)) else None for k in range(len(STATES))]


def stems(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in STEMS if len(word) >= n)]


def insult_weight(word: str, lexicon: dict[str, float]) -> float:
    return max((lexicon[s] for s in stems(word) if s in lexicon), default=0.0)


def evidence(text: str, lexicon: dict[str, float]) -> list[float]:
    """Clauses of each pattern, and the summed weights of their insults."""
    low = text.lower()
    words = set(_WORD.findall(low))
    weights = {w: v for w in words if (v := insult_weight(w, lexicon))}
    out = dict.fromkeys(PATTERNS, 0.0)
    if not weights and words.isdisjoint(THREAT):
        return list(out.values())
    kind = dict.fromkeys(words & REPORT, "report") | dict.fromkeys(words & NEGATION, "negation") | dict.fromkeys(words & TARGET, "target")
    kind |= dict.fromkeys(words & THREAT, "threat") | dict.fromkeys(weights, "insult")
    for clause in _CLAUSE.split(low):
        state, heavy = 0, 0.0
        for w in _WORD.findall(clause):
            state = GRAMMAR[state, kind.get(w, "other")]
            heavy += weights.get(w, 0.0)
        if FINAL[state]:
            found, weight = FINAL[state]
            out[found] += 1
            out["weight"] += heavy * weight
    return list(out.values())


def squashed(x: np.ndarray) -> np.ndarray:
    return np.log1p(x)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all but the intercept, which comes first."""
    x = np.hstack([np.ones((len(x), 1)), squashed(x)])
    w = np.zeros(x.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """(weights of insult stems, weights of the patterns with the intercept first)."""
    key = F.col("doc_id").cast("long")
    known = labels.select(key.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select(key.alias("doc_id"), whole_text().alias("text")).join(F.broadcast(known), "doc_id").select("toxic", "text")
    sample = durable(sample, "toxic-fit").repartition(16)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sides, before = (Counter(), Counter()), Counter()
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _WORD.findall(text.lower())
            sides[toxic > 0].update({s for w in set(words) if len(w) > 2 for s in stems(w)})
            if toxic > 0:
                for left, w in set(zip(["", *words], words)):  # noqa: B905
                    if len(w) > 2:
                        bit = 1 << zlib.crc32(left.encode()) % 62
                        for s in stems(w):
                            before[s] |= bit
        stem = [*sides[1], *sides[0]]
        columns = ([*sides[1].values(), *[0] * len(sides[0])], [*[0] * len(sides[1]), *sides[0].values()], [*(before[s] for s in sides[1]), *[0] * len(sides[0])])
        return pa.RecordBatch.from_arrays([pa.array(stem), *(pa.array(c, pa.int64()) for c in columns)], names=["stem", "a", "b", "before"])

    totals = {int(r[0] > 0): r[1] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return {}, np.array([math.log((n1 + 0.5) / (n0 + 0.5)), *[0.0] * len(PATTERNS)])
    df = map_arrow(sample, count, "stem string, a long, b long, before long").groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.bit_or("before").alias("before"))
    share = n1 / (n1 + n0)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    n = F.col("a") + F.col("b")
    ratio = 2 * (part(F.col("a"), n * share) + part(F.col("b"), n * (1 - share)))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    kept = df.withColumn("odds", odds).where((ratio >= EVIDENCE) & (F.col("odds") >= 3) & (F.bit_count("before") >= SPREAD * F.least("a", F.lit(24))))
    # as many as the bounded sample can confirm
    lexicon = {r["stem"]: float(r["odds"]) for r in kept.select("stem", "odds").collect()}

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array([evidence(t, lexicon) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))], names=["toxic", "x"])

    seen = map_arrow(sample, read, "toxic int, x array<double>").collect()  # at most `rows`
    seen.sort()
    return lexicon, logistic(np.array([r[1] for r in seen]), np.array([float(r[0] > 0) for r in seen]))


def score_texts(texts: list[str], lexicon: dict[str, float], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, matched clauses)."""
    x = np.array([evidence(t, lexicon) for t in texts]).reshape(-1, len(PATTERNS))
    z = weights[0] + squashed(x) @ weights[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), x[:, :-1].sum(axis=1)


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    lexicon, weights = fit(docs, labels, rows)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, n = score_texts(batch.column(1).to_pylist(), lexicon, weights)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(n.astype(np.int32))], names=["doc_id", "score", "predicted", "clauses"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), score, SCHEMA)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that score below the threshold."""
    lexicon, weights = fit(docs, labels)
    at = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, _ = score_texts([t or "" for t in batch.column(at).to_pylist()], lexicon, weights)
        return batch.filter(pa.array(p < threshold))

    return map_arrow(docs, keep, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "clauses")
