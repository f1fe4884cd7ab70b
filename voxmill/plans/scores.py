"""Error rates and vector scores (E and M families)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import distance as E
from ..functions import signals as S
from ..sources.tables import table as t


def turn_pairs(s, d):
    """Each turn with the one after it, as reference and hypothesis."""
    c = t(s, d, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis"))
    return c.select("conv_id", "turn", "role", F.col("text").alias("reference")).join(after, ["conv_id", "turn"])


def e01(s, d):
    return turn_pairs(s, d).select("conv_id", "turn", E.word_distance(E.normalized(F.col("reference")), E.normalized(F.col("hypothesis"))).alias("distance"))


def rates(policy):
    def query(s, d):
        return turn_pairs(s, d).select("conv_id", "turn", F.round(E.wer(F.col("reference"), F.col("hypothesis"), policy), 6).alias("wer"), F.round(E.cer(F.col("reference"), F.col("hypothesis"), policy), 6).alias("cer"))

    return query


def vectors(name, make, columns=("vec_id",)):
    return lambda s, d: t(s, d, "embeddings").select(*columns, make(F.col("embedding")).alias(name))


def neighbours(s, d):
    v = t(s, d, "embeddings").select("vec_id", "label", "embedding")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(other, "vec_id")


def m13(s, d):
    return neighbours(s, d).select("vec_id", F.round(A.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


def m25(s, d):
    return neighbours(s, d).select("vec_id", F.round(A.l1(F.col("embedding"), F.col("other")), 6).alias("l1"), F.round(A.mse(F.col("embedding"), F.col("other")), 6).alias("mse"))


def m04(s, d):
    """The next vector at this one's loudness."""
    return neighbours(s, d).select("vec_id", F.round(A.placed_total(A.rms_matched(F.col("other"), F.col("embedding"))), 5).alias("x"))


def m05(s, d):
    # cut or padded to 0 to 99 values; each counts by its place
    x = A.fitted(F.col("embedding"), F.col("n"))
    e = t(s, d, "embeddings").select("vec_id", "embedding", F.pmod("vec_id", F.lit(100)).cast("int").alias("n"))
    return e.select("vec_id", "n", F.size(x).alias("size"), F.round(A.total(F.transform(x, lambda v, k: v * (k + 1))), 5).alias("total"))


def m12(s, d):
    """A predicted opinion: 1 for empty audio, else a model's answer (here of the mean) within 1 to 5."""
    x = F.when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, 0)).otherwise(F.col("embedding"))
    model = lambda v: F.round(3 + 4 * A.mean(F.transform(v, lambda y: y.cast("double"))) * 10, 6)
    return t(s, d, "embeddings").select("vec_id", F.when(F.size(x) == 0, 1.0).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(5.0), model(x)))).alias("score"))


def m14(s, d):
    """Metrics that fail alone: one on every third row, one on every fourth."""

    def loudest(x, k):
        if k % 3 == 0:
            raise RuntimeError("no such model")
        return float(x.max())

    def gone(x, k):
        if k % 4 == 0:
            return None
        return 1.0

    found = S.isolated({"loudest": loudest, "middle": lambda x, k: float(x.mean()), "gone": gone})(F.col("embedding"), F.col("vec_id"))
    return t(s, d, "embeddings").select("vec_id", found.alias("m")).select("vec_id", F.round("m.loudest", 6).alias("loudest"), F.round("m.middle", 6).alias("middle"), "m.gone")


def m15(s, d):
    x = F.transform("embedding", lambda v: v.cast("double"))
    by_place = lambda y: F.round(A.total(F.transform(y, lambda v, k: v * (k + 1))), 5)
    one = lambda channels: F.transform(F.sequence(F.lit(0), F.floor(F.size(x) / channels).cast("int") - 1), lambda k: F.slice(x, k * channels + 1, F.lit(channels)))
    frames = lambda y: F.transform(y, lambda f: F.get(f, F.lit(0)) + F.when(F.size(f) > 1, F.get(f, F.lit(1))).otherwise(0.0))
    mono = F.flatten(A.remixed(one(2), 1))
    stereo = frames(A.remixed(F.transform(x, lambda v: F.array(v)), 2))
    two = F.transform(A.remixed(one(4), 2), lambda f: F.get(f, F.lit(0)) + 2 * F.get(f, F.lit(1)))
    return t(s, d, "embeddings").select("vec_id", by_place(mono).alias("mono"), by_place(stereo).alias("stereo"), by_place(two).alias("two"))


def m23(s, d):
    return t(s, d, "embeddings").select("vec_id", A.placed_total(A.peak_blended(F.col("embedding"))).cast("long").alias("x"))


def m29(s, d):
    """Levels of centred frames of 16 samples, every 8."""
    level = A.framed_rms(F.col("embedding"), 16, 8)
    return t(s, d, "embeddings").select("vec_id", F.posexplode(F.transform(level, lambda x: F.round(x, 6))).alias("frame", "rms"))


def at_rate(s, d, rate, to):
    """Vectors and their next ones, as recordings at one rate, at another."""
    heard = S.column(lambda x: S.resampled(x, rate, to))
    v = t(s, d, "embeddings").select("vec_id", heard(F.col("embedding")).alias("embedding"))
    return v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")


def m30(s, d):
    """Recordings of 24 kHz at 16 kHz, which stand for their embeddings; then cosines."""
    return at_rate(s, d, 24000, 16000).select("vec_id", F.round(A.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


def m31(s, d):
    """Pairs of 16 kHz at 24 kHz; those of which one side can't be read have no metric."""
    other = F.when(F.col("vec_id") % 6 != 0, F.col("other"))
    return at_rate(s, d, 16000, 24000).select("vec_id", F.round(A.l1(F.col("embedding"), other), 6).alias("distance"))


def p10(s, d):
    x = F.col("embedding")
    reason = F.when(F.size(x) < 32, "too short").when(A.rms(x) < 0.1, "silent").otherwise("ok")
    return t(s, d, "embeddings").select("vec_id", reason.alias("reason"))


def word_errors_sql(normal: str) -> str:
    """CTEs `pairs` (r, h: normalised texts), `sides` (their words) and `edits` (word edit distance): a row of the
    distance matrix from the one before, gaps in the reference by a running minimum."""
    said = normal.format
    return f"""both_turns AS (SELECT a.conv_id, a.turn, a.text AS reference, b.text AS hypothesis FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
pairs AS (SELECT conv_id, turn, {said('reference')} AS r, {said('hypothesis')} AS h FROM both_turns),
sides AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS p, conv_id, turn, list_filter(regexp_split_to_array(r, '[\\s\\p{{Z}}]+'), lambda x: x <> '') AS r, list_filter(regexp_split_to_array(h, '[\\s\\p{{Z}}]+'), lambda x: x <> '') AS h FROM pairs),
words AS (SELECT w, row_number() OVER (ORDER BY w)::INT AS id FROM (SELECT DISTINCT unnest(list_concat(r, h)) AS w FROM sides)),
said AS (SELECT p, i, id FROM (SELECT p, unnest(range(len(r)))::INT AS i, unnest(r) AS w FROM sides) s JOIN words ON words.w = s.w),
heard AS (SELECT p, j, id FROM (SELECT p, unnest(range(1, len(h) + 1))::INT AS j, unnest(h) AS w FROM sides) s JOIN words ON words.w = s.w),
cells AS (SELECT 0 AS i, p, unnest(range(len(h) + 1))::INT AS j, unnest(range(len(h) + 1))::INT AS c FROM sides
UNION ALL SELECT i + 1, p, j, (min(b - j) OVER (PARTITION BY p ORDER BY j) + j)::INT FROM (
SELECT d.i, d.p, d.j, least(d.c + 1, lag(d.c) OVER (PARTITION BY d.p ORDER BY d.j) + CASE WHEN s.id = h.id THEN 0 ELSE 1 END) AS b
FROM cells d JOIN said s ON s.p = d.p AND s.i = d.i LEFT JOIN heard h ON h.p = d.p AND h.j = d.j)),
edits AS (SELECT s.conv_id, s.turn, c.c AS distance, len(s.r) AS n_reference, len(s.h) AS n_hypothesis FROM cells c JOIN sides s ON s.p = c.p WHERE c.i = len(s.r) AND c.j = len(s.h))"""


#: Every character that stands in the pairs as one byte (DuckDB counts edits of bytes), and the distances of these.
CHAR_ERRORS_SQL = """symbols AS (SELECT string_agg(c, '' ORDER BY c) AS held FROM (SELECT DISTINCT unnest(string_split(r || h, '')) AS c FROM pairs) WHERE c <> ''),
coded AS (SELECT conv_id, turn, r, h, translate(r, held, one) AS a, translate(h, held, one) AS b FROM pairs, symbols, (SELECT array_to_string(list_transform(range(1, 128), lambda k: chr(k::INT)), '') AS one)),
chars AS (SELECT conv_id, turn, length(r) AS n, levenshtein(a, b) AS distance FROM coded)"""
RATES_SQL = (
    CHAR_ERRORS_SQL
    + """, rates AS (SELECT e.conv_id, e.turn, CASE WHEN p.r = '' AND p.h = '' THEN {both} WHEN p.r = '' THEN {reference} WHEN p.h = '' THEN {hypothesis} ELSE e.distance / e.n_reference END::DOUBLE AS wer,
CASE WHEN p.r = '' AND p.h = '' THEN {both_c} WHEN p.r = '' THEN {reference_c} WHEN p.h = '' THEN {hypothesis_c} ELSE c.distance / c.n END::DOUBLE AS cer
FROM edits e JOIN pairs p ON p.conv_id = e.conv_id AND p.turn = e.turn JOIN chars c ON c.conv_id = e.conv_id AND c.turn = e.turn)"""
)
NORMAL_SQL = "trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]', '', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"
WORD_ERRORS_SQL = word_errors_sql(NORMAL_SQL)


def rates_sql(policy: str) -> str:
    (b, r, h), (bc, rc, hc) = E.POLICIES[policy]
    return f"WITH RECURSIVE {WORD_ERRORS_SQL}, {RATES_SQL.format(both=b, reference=r, hypothesis=h, both_c=bc, reference_c=rc, hypothesis_c=hc)}"


def resampled_sql(x: str, rate: int, to: int) -> str:
    """A list at another rate: each value the sum of all, weighted by a Hann-windowed sinc of their distance."""
    common = math.gcd(rate, to)
    rate, to = rate // common, to // common
    cut = min(rate, to) * 0.99
    far = f"((j / {rate} - m / {to}) * {cut}::DOUBLE)"
    weight = f"CASE WHEN abs({far}) >= 6 THEN 0 WHEN {far} = 0 THEN 1 ELSE sin(pi() * {far}) / (pi() * {far}) * pow(cos({far} * pi() / 12), 2) END * {cut}::DOUBLE / {rate}"
    return f"list_transform(range(ceil(len({x}) * {to} / {rate})::BIGINT), lambda m: list_sum(list_transform(range(len({x})), lambda j: {x}[j + 1] * {weight})))"


_V = "list_transform(embedding, lambda x: x::DOUBLE)"
_NEXT = "(SELECT a.vec_id, list_transform(a.embedding, lambda x: x::DOUBLE) AS a, list_transform(b.embedding, lambda x: x::DOUBLE) AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"
QUERIES = {
    "e01_word_distance": (e01, f"WITH RECURSIVE {WORD_ERRORS_SQL} SELECT conv_id, turn, distance::INT AS distance FROM edits"),
    **{f"e02_error_rates_{p}": (rates(p), f"{rates_sql(p)} SELECT conv_id, turn, round(wer, 6) AS wer, round(cer, 6) AS cer FROM rates") for p in E.POLICIES},
    "m01_mono_peak": (vectors("x", lambda e: F.round(A.peak(A.mono(e)), 6)), f"SELECT vec_id, round(list_max(list_transform({_V}, lambda x: abs(x - m))), 6) AS x FROM (SELECT *, list_avg({_V}) AS m FROM embeddings)"),
    "m02_peak_normalized": (vectors("x", lambda e: F.round(A.placed_total(A.peak_normalized(e)), 5)), f"SELECT vec_id, round(list_sum(list_transform({_V}, lambda x, k: k * (x * least(0.95 / p, 20.0)))), 5) AS x FROM (SELECT *, list_max(list_transform({_V}, lambda x: abs(x))) AS p FROM embeddings)"),
    "m04_rms_matched": (m04, f"SELECT vec_id, round(list_sum(list_transform(b, lambda x, k: k * (x * greatest(0.25, least(4.0, ra / rb))))), 5) AS x FROM (SELECT *, sqrt(list_avg(list_transform(a, lambda x: x * x))) AS ra, sqrt(list_avg(list_transform(b, lambda x: x * x))) AS rb FROM {_NEXT})"),
    "m05_fitted": (m05, f"WITH e AS (SELECT vec_id, {_V} AS x, (vec_id % 100)::INT AS n FROM embeddings) SELECT vec_id, n, n AS size, round(coalesce(list_sum(list_transform(list_zip(x[:n], range(1, n + 1)), lambda z: z[1] * z[2])), 0), 5) AS total FROM e"),
    "m12_opinion": (m12, f"SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 1.0 ELSE greatest(1.0, least(5.0, round(3 + 4 * list_avg({_V}) * 10, 6))) END AS score FROM embeddings"),
    "m14_isolated_metrics": (m14, f"SELECT vec_id, CASE WHEN vec_id % 3 > 0 THEN round(list_max({_V}), 6) END AS loudest, round(list_avg({_V}), 6) AS middle, CASE WHEN vec_id % 4 > 0 THEN 1.0::DOUBLE END AS gone FROM embeddings"),
    "m15_channels": (m15, f"SELECT vec_id, round(list_sum(list_transform(range(1, 33), lambda k: (x[2 * k - 1] + x[2 * k]) / 2 * k)), 5) AS mono, round(list_sum(list_transform(range(1, 65), lambda k: 2 * x[k] * k)), 5) AS stereo, round(list_sum(list_transform(range(1, 17), lambda k: (x[4 * k - 3] + 2 * x[4 * k - 2]) * k)), 5) AS two FROM (SELECT vec_id, {_V} AS x FROM embeddings)"),
    "m23_peak_blend": (m23, f"SELECT vec_id, list_sum(list_transform(x, lambda v, k: k * trunc(((CASE WHEN p > 1 THEN v / p ELSE v END) / p * 0.45::DOUBLE + 0.5::DOUBLE * (CASE WHEN p > 1 THEN v / p ELSE v END)) * 32767)::BIGINT))::BIGINT AS x FROM (SELECT vec_id, x, list_max(list_transform(x, lambda v: abs(v))) AS p FROM (SELECT vec_id, {_V} AS x FROM embeddings))"),
    "m30_batch_similarity": (m30, f"SELECT vec_id, round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS similarity FROM (SELECT vec_id, {resampled_sql('a', 24000, 16000)} AS a, {resampled_sql('b', 24000, 16000)} AS b FROM {_NEXT})"),
    "m31_pairs_or_null": (m31, f"SELECT vec_id, CASE WHEN vec_id % 6 > 0 THEN round(list_avg(list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2]))), 6) END AS distance FROM (SELECT vec_id, {resampled_sql('a', 16000, 24000)} AS a, {resampled_sql('b', 16000, 24000)} AS b FROM {_NEXT})"),
    "m13_cosine": (m13, f"SELECT vec_id, round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS similarity FROM {_NEXT}"),
    "m24_pcm": (vectors("x", lambda e: A.placed_total(A.pcm16(e)).cast("long")), f"SELECT vec_id, list_sum(list_transform({_V}, lambda x, k: k * round(greatest(-1.0, least(1.0, x)) * 32767)))::BIGINT AS x FROM embeddings"),
    "m25_losses": (m25, f"SELECT vec_id, round(list_avg(list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2]))), 6) AS l1, round(list_avg(list_transform(list_zip(a, b), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS mse FROM {_NEXT}"),
    "p10_non_silent": (p10, f"SELECT vec_id, CASE WHEN len(embedding) < 32 THEN 'too short' WHEN sqrt(list_avg(list_transform({_V}, lambda x: x * x))) < 0.1 THEN 'silent' ELSE 'ok' END AS reason FROM embeddings"),
    "m29_framed_rms": (m29, f"SELECT vec_id, k::INT AS frame, round(sqrt(list_sum(list_transform(range(k * 8 - 8, k * 8 + 8), lambda i: CASE WHEN i BETWEEN 0 AND len(v) - 1 THEN v[i + 1] * v[i + 1] ELSE 0 END)) / 16), 6) AS rms FROM (SELECT vec_id, {_V} AS v, unnest(range(len(embedding) // 8 + 1)) AS k FROM embeddings)"),
}
