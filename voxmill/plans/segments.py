"""Segments, batches, masks and lengths (G family, with the T and M operators around them)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import durations as D
from ..functions import signals as S
from ..functions import tables
from ..functions import text as X
from ..functions import voice as V
from ..operators import folds, stretches
from ..operators import silence as Z
from ..operators.relational import spread, stretch_of
from ..sources.store import writer
from ..sources.tables import table as t
from .scores import resampled_sql


def g01(s, d):
    e = t(s, d, "events").where("ts is not null")
    at = F.col("ts").cast("timestamp").cast("double") / 3600
    words = e.select(F.col("user_id").alias("file"), at.alias("start"), (at + F.lit(0.5)).alias("end"), F.col("event_type").alias("word"))
    return stretches.segmented(words, "file", 3.0, 40.0, length=160.0).withColumnRenamed("file", "user_id")


def g01_sql(s, d):
    """The segments of g01 by the table function."""
    tables.register(s)
    e = t(s, d, "events").where("ts is not null")
    at = F.col("ts").cast("timestamp").cast("double") / 3600
    words = e.select("user_id", at.alias("start"), (at + F.lit(0.5)).alias("end"), F.col("event_type").alias("word"))
    return s.sql("SELECT * FROM segments(TABLE({words}) PARTITION BY user_id ORDER BY (start, word), 3.0D, 40.0D)", words=words)


def g02(s, d):
    a, b, rate = 0.25, 0.75, 64
    return t(s, d, "embeddings").select("vec_id", F.explode(F.slice("embedding", int(a * rate) + 1, int(b * rate) - int(a * rate))).alias("v")).groupBy("vec_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("v").cast("double")), 4).alias("total"))


def g03(s, d):
    cuts = S.column(lambda x: S.split_points(x, 8, quiet=-24.0, least=0.25, longest=4.0, block=0.125))
    return t(s, d, "embeddings").select("vec_id", cuts(F.col("embedding")).alias("cuts"))


def recordings(s, d):
    """Levels of ten long recordings: the vectors of each label, one after the other, in blocks of eight samples."""
    pieces = t(s, d, "embeddings").select("label", "vec_id", "embedding")
    return writer(s)(Z.blocks(pieces, "label", "vec_id", "embedding", 8))


def g03_long(s, d):
    return Z.split_points(recordings(s, d), "label", -20.0, 2, 30, length=120)


def m27_long(s, d):
    return Z.left_out(recordings(s, d), "label", -19.0, 3, 1)


def g04(s, d):
    n = F.ceil(F.char_length("text") / 200).cast("int")
    return t(s, d, "conversations").where("text <> ''").select("conv_id", "turn", F.explode(F.sequence(F.lit(0), n - 1)).alias("i")).select("conv_id", "turn", F.format_string("%d_chunk_%03d.wav", "conv_id", "i").alias("name"))


def g05(s, d):
    return t(s, d, "pages").where((F.char_length("html") > 3600) & ~F.col("url").contains("_chunk_")).select("page_id")


def g07(s, d):
    return folds.frame_batches(t(s, d, "documents"), "doc_id", "n_chars", 3840, 64)


def g08(s, d):
    return stretches.bucket_batches(t(s, d, "documents"), "doc_id", "n_chars", 20000).withColumn("length", F.col("length").cast("double"))


def g08_bucket(s, d):
    ends = t(s, d, "documents").agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    return t(s, d, "documents").crossJoin(F.broadcast(ends)).select("doc_id", folds.bucket_of(F.col("n_chars"), F.col("lo"), F.col("hi")).alias("bucket"))


def g09(s, d):
    sizes = t(s, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("name")).agg(F.sum(F.abs("s_acctbal")).alias("size"))
    return folds.balanced(sizes, "name", "size").withColumn("size", F.round("size", 2))


def g10(s, d):
    """Batches in the order of an epoch: all rows of a batch share its place, and another epoch has other places."""
    batches = g07(s, d)
    places = [F.md5(F.concat_ws(":", F.lit(666 + epoch), F.col("batch").cast("string")).cast("binary")).alias(f"place_{epoch}") for epoch in (0, 1)]
    return batches.select("id", "batch", *places).orderBy("place_0", "id")


def g11(s, d):
    """Rows that aren't valid take the next valid one's place, the last ones the first one's.  Within stretches of the key
    by a window, beyond them by the first valid key of the stretches behind."""
    o = t(s, d, "orders").select("o_orderkey", F.when(F.col("o_totalprice").between(50000, 150000), F.col("o_orderkey")).alias("good"))
    keyed = o.withColumn("_at", stretch_of(o, "o_orderkey"))
    # one row for each stretch
    first = keyed.groupBy("_at").agg(F.min("good").alias("_first"))
    # backwards: a frame up to the end is walked through anew for each row
    behind = Window.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("_at", F.coalesce(F.min("_first").over(behind), F.min("_first").over(Window.partitionBy())).alias("_then"))
    ahead = F.last("good", ignorenulls=True).over(Window.partitionBy("_at").orderBy(F.desc("o_orderkey")).rowsBetween(Window.unboundedPreceding, 0))
    return keyed.withColumn("_ahead", ahead).join(F.broadcast(first), "_at").select("o_orderkey", F.coalesce("_ahead", "_then").alias("used"))


def g06(s, d):
    """A signal of tones and pauses from each vector; the pieces between its pauses."""
    pieces = S.column(lambda v: S.slices_of_speech(spoken(v), 100, -40.0, 0.5, 0.3, 0.02, 0.4).ravel().astype(float))
    each = t(s, d, "embeddings").select("vec_id", pieces(F.col("embedding")).alias("p"))
    at = F.explode(F.sequence(F.lit(0), (F.size("p") / 2).cast("int") - 1)).alias("k")
    return each.select("vec_id", "p", at).select("vec_id", "k", F.get("p", 2 * F.col("k")).cast("long").alias("start"), F.get("p", 2 * F.col("k") + 1).cast("long").alias("end"))


def g12(s, d):
    cells = D.edited(F.col("embedding"), [(10, 20), (40, 45)])
    kept = F.filter(cells, lambda c: c["keep"])
    return t(s, d, "embeddings").select("vec_id", F.size(cells).alias("n"), F.size(kept).alias("n_kept"), F.round(F.aggregate(kept, F.lit(0.0), lambda a, c: a + c["value"]), 5).alias("total"))


def paired(s, d):
    c = t(s, d, "conversations").select("conv_id", "turn", "text")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("gen"))
    return c.withColumnRenamed("text", "ref").join(after, ["conv_id", "turn"])


def m19_bytes(s, d):
    return paired(s, d).where("ref <> ''").select("conv_id", "turn", D.frames_by_bytes(F.lit(750), F.col("ref"), F.col("gen")).alias("frames"))


def m19_words(s, d):
    return paired(s, d).select("conv_id", "turn", F.round(D.seconds_by_words(F.lit(6.0), F.col("ref"), F.col("gen")), 5).alias("seconds"))


def m22(s, d):
    x = F.col("embedding")
    return t(s, d, "embeddings").select("vec_id", F.round(D.masked_mean(x, D.span_mask(F.size(x), F.pmod("vec_id", F.lit(20)).cast("int"), F.lit(40))), 6).alias("mean"))


def m17(s, d):
    """Rows of a batch (eight vectors) are padded to its longest one."""
    e = t(s, d, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 8).alias("batch"), F.slice("embedding", F.lit(1), (F.pmod("vec_id", F.lit(30)) + 1).cast("int")).alias("x"))
    longest = e.groupBy("batch").agg(F.max(F.size("x")).alias("width"))
    wide = e.join(longest, "batch").withColumn("wide", D.padded(F.col("x"), F.col("width"), -11.512925))
    return wide.select("vec_id", F.size("x").alias("n"), F.size("wide").alias("width"), F.round(F.aggregate("wide", F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


def m18_joint(s, d):
    """Three parts of each vector, 50 ms of silence at 64 samples a second between them."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    gap = F.array_repeat(F.lit(0.0), int(0.05 * 64))
    whole = D.joined([F.slice(x, 1, 20), F.slice(x, 21, 20), F.slice(x, 41, 24)], gap)
    return t(s, d, "embeddings").select("vec_id", F.posexplode(whole).alias("k", "v")).groupBy("vec_id").agg(F.count("*").alias("n"), F.round(F.sum((F.col("k") + 1) * F.col("v")), 5).alias("total"))


def g08_order(s, d):
    """Batches of g08 in an order that a seed decides: the digest of the seed and the batch."""
    each = g08(s, d)
    return each.select("bucket", "batch", "id", F.md5(F.concat_ws(":", F.lit("666"), "bucket", "batch").cast("binary")).alias("place"))


def placed(make):
    """What an expression makes of each vector: how many values, and their sum by place."""

    def query(s, d):
        x = F.transform("embedding", lambda v: v.cast("double"))
        out = t(s, d, "embeddings").select("vec_id", make(x).alias("y"))
        return out.select("vec_id", F.size("y").cast("long").alias("n"), F.round(A.placed_total(F.col("y")), 5).alias("total"))

    return query


def signal(name, fn, places=5):
    """fn of each vector as (n, total): how many values come out, and their sum, each counted by its place."""

    def made(x):
        y = np.asarray(fn(x), float).ravel()
        return np.array([len(y), float(y @ np.arange(1, len(y) + 1))])

    def query(s, d):
        out = t(s, d, "embeddings").select("vec_id", S.column(made)(F.col("embedding")).alias("m"))
        return out.select("vec_id", F.get("m", F.lit(0)).cast("long").alias("n"), F.round(F.get("m", F.lit(1)), places).alias(name))

    return query


def pairs_of_next(v, column):
    """Each row and the next one's `column` as `other`, dealt out by their number."""
    both = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col(column).alias("other")), "vec_id")
    return spread(both, "vec_id", like=v)


def with_next(name, fn):
    """As `signal`, of each vector and the next one, or of a single value, null where there is none: how many values, and the sum of their sizes.
    They are summed up where they are made."""

    def made(a, b):
        y = fn(a, b)
        if y is None:
            return None
        y = np.abs(np.asarray(y, float).ravel())
        return np.array([len(y), y.cumsum()[-1] if len(y) else 0.0])

    def query(s, d):
        both = pairs_of_next(t(s, d, "embeddings").select("vec_id", "embedding"), "embedding")
        out = both.select("vec_id", S.column(made)(F.col("embedding"), F.col("other")).alias("m"))
        return out.select("vec_id", F.get("m", F.lit(0)).cast("int").alias("n"), F.round(F.get("m", F.lit(1)), 5).alias(name))

    return query


def spoken(v):
    """Tones as loud as each of 16 values, 0.25 s of 100 Hz each; those under 0.1 are pauses."""
    v = np.where(np.abs(v[:16]) < 0.1, 0.0, v[:16])
    return np.repeat(v, 25) * np.tile([1.0, -1.0], 200)


#: Samples a second of what vectors sing.
RATE = 8000


def sung(v, seconds=0.6):
    """A voice of five harmonics whose pitch, around 160 Hz, follows 16 values of a vector, and whose loudness the next 16."""
    at = np.linspace(0, 15, int(seconds * RATE))
    hz, loud = 160 * 2 ** np.interp(at, np.arange(16), v[:16]), 0.2 + np.abs(np.interp(at, np.arange(16), v[16:32]))
    turns = 2 * np.pi * np.cumsum(hz) / RATE
    return loud * sum(np.sin(k * turns) / k for k in range(1, 6))


def against_next(name, fn):
    def query(s, d):
        both = pairs_of_next(t(s, d, "embeddings").select("vec_id", "embedding"), "embedding")
        return both.select("vec_id", S.column(fn, "double")(F.col("embedding"), F.col("other")).alias(name))

    return query


def contours(s, d):
    """Vectors with the pitch of their voices, each found once, over all cores."""
    v = spread(t(s, d, "embeddings").select("vec_id", "embedding"), "vec_id")
    return writer(s)(v.select("vec_id", "embedding", S.column(lambda x: V.pitch(sung(x), RATE))(F.col("embedding")).alias("contour")))


def m08(s, d):
    """The contour of each voice is compared with the next one's."""
    both = pairs_of_next(contours(s, d).select("vec_id", "contour"), "contour")
    return both.select("vec_id", S.column(S.contour_similarity, "double")(F.col("contour"), F.col("other")).alias("similarity"))


def calculator(a, b, contour):
    """The metrics of a pair of voices, of which some need what others don't: a second half that is missing, short, or silent.
    The first one's contour and the function that finds the second's are given."""
    first, second = contour
    rate = RATE
    return {
        "mcd": lambda: S.cepstral_distortion(a, b, rate),
        "stoi": lambda: S.intelligibility(a, b, rate),
        "f0_correlation": lambda: S.contour_similarity(first, second()),
        "pesq": lambda: S.listening_score(a, b, rate, correlated),
    }


def m14_pairs(s, d):
    """All metrics of every voice and the next one; of every fourth pair the next is cut to 20 ms, of every fifth it is silent, and of
    every seventh it can't be read.  What fails is null, alone."""
    v = contours(s, d).select("vec_id", F.struct("embedding", "contour").alias("voice"))
    both = pairs_of_next(v, "voice")
    change = F.when(F.col("vec_id") % 7 == 0, 3).when(F.col("vec_id") % 5 == 0, 2).when(F.col("vec_id") % 4 == 0, 1).otherwise(0)

    def heard(pair, k):
        n = (len(pair) - 128) // 2
        a, b, first, second = sung(pair[:64]), sung(pair[64:128]), pair[128 : 128 + n], pair[128 + n :]
        other = (b, b[: RATE // 50], 0 * b, None)[int(k)]
        return calculator(a, other, (first, lambda: second if k == 0 else V.pitch(other, RATE)))

    metrics = {name: (lambda ready, name=name: ready[name]()) for name in ("mcd", "stoi", "f0_correlation", "pesq")}
    # contours of voices of one length are equally long
    whole = F.concat("voice.embedding", "other.embedding", "voice.contour", "other.contour")
    found = both.select("vec_id", S.isolated(metrics, heard)(whole, change).alias("m"))
    return found.select("vec_id", *[F.round(F.col("m")[name], 6).alias(name) for name in metrics])


def t25(s, d):
    stamps = X.even_timestamps(F.col("text"), F.char_length("text") / 16)
    return t(s, d, "conversations").select("conv_id", "turn", F.posexplode(stamps)).select("conv_id", "turn", "pos", "col.word", F.col("col.end").alias("end_time"))


def t26(s, d):
    e = t(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.min("event_type").alias("word"))
    raw = F.array(F.struct(F.concat(F.lit(" "), "word").alias("word"), (F.col("low") - 5).alias("start"), F.col("high").alias("end")), F.struct(F.lit(" ").alias("word"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end")))
    return e.select("user_id", F.explode(X.sane_timestamps(raw, F.lit(20.0))).alias("w")).select("user_id", "w.word", F.round("w.start", 3).alias("begin_time"), F.round("w.end", 3).alias("end_time"))


_W = "list_filter(regexp_split_to_array({0}, '[\\s\\p{{Z}}]+'), lambda x: x <> '')"
_PAIR = "(SELECT a.conv_id, a.turn, a.text AS ref, b.text AS gen FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"
_X = "list_transform(embedding, lambda x: x::DOUBLE)"
#: Rows in order of frames into batches, row by row.
_BATCHES = "WITH RECURSIVE o AS (SELECT doc_id AS id, n_chars AS frames, row_number() OVER (ORDER BY n_chars, doc_id) AS k FROM documents WHERE n_chars <= 3840), f AS (SELECT id, frames, k, 0::BIGINT AS batch, frames AS total, 1 AS n FROM o WHERE k = 1 UNION ALL SELECT o.id, o.frames, o.k, CASE WHEN f.total + o.frames > 3840 OR f.n >= 64 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.total + o.frames > 3840 OR f.n >= 64 THEN o.frames ELSE f.total + o.frames END, CASE WHEN f.total + o.frames > 3840 OR f.n >= 64 THEN 1 ELSE f.n + 1 END FROM f JOIN o ON o.k = f.k + 1) "
def log_mel_sql(edge: int, slaney: bool) -> str:
    """Log mels of 64 samples at 24 kHz: frames of 64, every 16, of the signal mirrored by `edge` at its ends; 8 bands by either scale."""
    top = 12000
    if slaney:
        last = f"(15 + ln({top} / 1000) * 27 / ln(6.4))"
        hz = f"CASE WHEN i * {last} / 9 < 15 THEN i * {last} / 9 * 200 / 3 ELSE 1000 * exp((i * {last} / 9 - 15) * ln(6.4) / 27) END"
    else:
        hz = f"700 * (pow(10, i * log10(1 + {top} / 700) / 9) - 1)"
    area = "2 / (hz[b + 3] - hz[b + 1])" if slaney else "1"
    part = "pow(list_sum(list_transform(f, lambda v, j: v * {0}(2 * pi() * (j - 1) * k / 64))), 2)"
    size = f"sqrt({part.format('cos')} + {part.format('sin')})"
    size = f"sqrt({size} * {size} + 1e-9::DOUBLE)" if slaney else size
    at = f"(t * 16 + j - {edge})"
    return f"""WITH p AS (SELECT list_transform(range(10), lambda i: {hz}) AS hz),
w AS (SELECT list_transform(range(8), lambda b: list_transform(range(33), lambda k: greatest(0, least((k * 375 - hz[b + 1]) / (hz[b + 2] - hz[b + 1]), (hz[b + 3] - k * 375) / (hz[b + 3] - hz[b + 2]))) * {area})) AS w FROM p),
f AS (SELECT vec_id, t, list_transform(range(64), lambda j: x[CASE WHEN {at} < 0 THEN -{at} WHEN {at} > 63 THEN 126 - {at} ELSE {at} END + 1] * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * j / 64))) AS f FROM (SELECT vec_id, {_X} AS x, unnest(range({2 * edge} // 16 + 1)) AS t FROM embeddings)),
m AS (SELECT vec_id, t, list_transform(range(33), lambda k: {size}) AS m FROM f),
y AS (SELECT vec_id, t, list_transform(range(8), lambda b: ln(greatest(list_sum(list_transform(m, lambda v, k: v * w[b + 1][k])), 1e-5::DOUBLE))) AS y FROM m, w)
SELECT vec_id, sum(len(y))::BIGINT AS n, round(sum(list_sum(list_transform(y, lambda v, b: (t * 8 + b) * v))), 3) AS total FROM y GROUP BY vec_id"""


#: Rows of each bucket in order of ids into batches, row by row.
_BUCKETS = "WITH RECURSIVE e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents), o AS (SELECT floor((n_chars - lo) / (hi - lo + 1) * 200)::INT AS bucket, doc_id AS id, n_chars::DOUBLE AS length FROM documents, e), r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY id) AS k FROM o), f AS (SELECT bucket, id, length, k, 0::BIGINT AS batch, length AS total FROM r WHERE k = 1 UNION ALL SELECT r.bucket, r.id, r.length, r.k, CASE WHEN f.total >= 20000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.total >= 20000 THEN r.length ELSE f.total + r.length END FROM f JOIN r ON r.bucket = f.bucket AND r.k = f.k + 1) "
#: Levels of blocks of recordings (b), their numbers (n) and the runs of those under a level (r).
_RUNS = """v AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS p, embedding AS x FROM embeddings), b AS (
  SELECT label, p * 8 + i AS k, round(20 * log10(greatest(sqrt(list_sum(list_transform(x[i * 8 + 1:i * 8 + 8], lambda y: y::DOUBLE * y::DOUBLE)) / 8), 1e-10)), 6) AS level FROM v, (SELECT unnest(range(8)) AS i)
), n AS (SELECT label, max(k) + 1 AS n FROM b GROUP BY 1), q AS (SELECT label, k, k - row_number() OVER (PARTITION BY label ORDER BY k) AS g FROM b WHERE level < {quiet}), r AS (SELECT label, min(k) AS first, max(k) + 1 AS last FROM q GROUP BY label, g)"""
#: Cuts of recordings: middles of silences, and from each on the quietest blocks where the next is too far.
_CUTS = "WITH RECURSIVE " + _RUNS.format(quiet=-20.0) + """, m AS (SELECT label, (first + last) // 2 AS cut FROM r WHERE last - first >= 2),
e AS (SELECT label, 0 AS cut FROM n UNION SELECT label, n FROM n UNION SELECT label, cut FROM m), l AS (SELECT label, list(level ORDER BY k) AS l FROM b GROUP BY 1),
i AS (SELECT label, cut AS a, lead(cut) OVER (PARTITION BY label ORDER BY cut) AS z FROM e), f AS (
  SELECT label, a, z FROM i WHERE z IS NOT NULL
  UNION ALL
  SELECT f.label, f.a + 24 + list_position(l.l[f.a + 25:f.a + 30], list_min(l.l[f.a + 25:f.a + 30])) - 1, f.z FROM f JOIN l USING (label) WHERE f.z - f.a > 30)
SELECT DISTINCT label, a AS cut FROM f UNION SELECT label, n FROM n"""
#: Words of a user from the i-th on: as many as fit into 40 hours, cut after the last pause that leaves 3 hours.
_SEGMENTS = """
WITH RECURSIVE h AS (
  SELECT user_id, epoch_us(ts) / 1e6 / 3600 AS h, event_type AS word FROM events WHERE ts IS NOT NULL
), w AS (
  SELECT user_id, list(h ORDER BY h, word) AS b, list(h + 0.5 ORDER BY h, word) AS e, list(word ORDER BY h, word) AS t FROM h GROUP BY 1
), f AS (
  SELECT user_id, 0::BIGINT AS i, 0::BIGINT AS cut, false AS good, 0::BIGINT AS number FROM w
  UNION ALL
  SELECT user_id, CASE WHEN ok THEN last ELSE i + 1 END, last, ok, number + ok::BIGINT FROM (
    SELECT *, fit > 0 AND e[last] - b[i + 1] >= 3 AND trim(array_to_string(t[i + 1:last], '')) <> '' AS ok FROM (
      SELECT *, CASE WHEN i + fit = len(b) THEN i + fit ELSE coalesce(list_max(list_filter(range(i + 1, i + fit + 1), lambda k: e[k] - b[i + 1] >= 3 AND b[k + 1] - e[k] > 0.05)), i + fit) END AS last FROM (
        SELECT f.user_id, f.i, f.number, w.b, w.e, w.t, coalesce(list_position(list_transform(w.e[f.i + 1:], lambda x: x - w.b[f.i + 1] > 40), true) - 1, len(w.b) - f.i)::BIGINT AS fit
        FROM f JOIN w USING (user_id) WHERE f.i < len(w.b)))))
SELECT user_id, number - 1 AS number, b[p] AS start, e[cut] AS "end", array_to_string(t[p:cut], ' ') AS text FROM (
  SELECT *, coalesce(lag(i) OVER (PARTITION BY user_id ORDER BY i), 0) + 1 AS p FROM f) JOIN w USING (user_id) WHERE good
"""
QUERIES = {
    "g01_segments": (g01, _SEGMENTS),
    "g01_table_function": (g01_sql, _SEGMENTS),
    "g02_slices": (g02, f"SELECT vec_id, len(list_slice(embedding, 17, 48))::BIGINT AS n, round(list_sum(list_slice({_X}, 17, 48)), 4) AS total FROM embeddings"),
    "g03_silence_cuts": (g03, None),
    "g03_long_recordings": (g03_long, _CUTS),
    "m27_long_recordings": (m27_long, f"WITH {_RUNS.format(quiet=-19.0)}, s AS (SELECT label, CASE WHEN first = 0 THEN 0 ELSE first + 1 END AS a, CASE WHEN last = n THEN n ELSE last - 1 END AS b FROM r JOIN n USING (label) WHERE last - first >= 3) SELECT label, a AS \"from\", b AS \"to\" FROM s WHERE a < b"),
    "g04_chunk_names": (g04, "SELECT conv_id, turn, printf('%d_chunk_%03d.wav', conv_id, i) AS name FROM (SELECT conv_id, turn, unnest(range(ceil(length(text) / 200)::BIGINT)) AS i FROM conversations WHERE text <> '')"),
    "g05_long_only": (g05, "SELECT page_id FROM pages WHERE length(html) > 3600 AND url NOT LIKE '%\\_chunk\\_%' ESCAPE '\\'"),
    "g06_pieces": (g06, None),
    "g07_frame_batches": (g07, _BATCHES + "SELECT id, frames::DOUBLE AS frames, batch FROM f"),
    "g08_bucket_batches": (g08, _BUCKETS + "SELECT bucket, id, length, batch FROM f"),
    "g08_buckets": (g08_bucket, "SELECT doc_id, floor((n_chars - lo) / (hi - lo + 1) * 200)::INT AS bucket FROM documents, (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)"),
    "g09_balanced": (g09, "WITH RECURSIVE z AS (SELECT s_nationkey::VARCHAR AS name, sum(abs(s_acctbal)) AS size FROM supplier GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY size DESC, name) AS k FROM z), p AS (SELECT 0::BIGINT AS k, NULL::VARCHAR AS name, NULL::DOUBLE AS size, NULL::INT AS bin, [0, 0, 0, 0, 0]::DOUBLE[] AS sums UNION ALL SELECT o.k, o.name, o.size, list_position(p.sums, list_min(p.sums))::INT - 1, list_transform(p.sums, lambda x, i: CASE WHEN i = list_position(p.sums, list_min(p.sums)) THEN x + o.size ELSE x END) FROM p JOIN o ON o.k = p.k + 1) SELECT name, round(size, 2) AS size, bin FROM p WHERE k > 0"),
    "g10_epoch_order": (g10, _BATCHES + "SELECT id, batch, md5('666:' || batch) AS place_0, md5('667:' || batch) AS place_1 FROM f"),
    "g11_skip_invalid": (g11, "WITH g AS (SELECT *, CASE WHEN o_totalprice BETWEEN 50000 AND 150000 THEN o_orderkey END AS g FROM orders) SELECT o_orderkey, coalesce(min(g) OVER (ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), min(g) OVER ()) AS used FROM g"),
    "g12_edit_mask": (g12, f"SELECT vec_id, len(embedding)::INT AS n, len(embedding)::INT - 15 AS n_kept, round(list_sum({_X}) - list_sum(list_slice({_X}, 11, 20)) - list_sum(list_slice({_X}, 41, 45)), 5) AS total FROM embeddings"),
    "m03_trimmed": (signal("total", lambda x: S.trimmed(x, 6.0, 8, 4, 4)), f"WITH x AS (SELECT vec_id, {_X} AS x FROM embeddings), l AS (SELECT vec_id, x, list_transform(range(len(x) // 4 + 1), lambda k: 20 * log10(greatest(sqrt(list_sum(list_transform(range(k * 4 - 4, k * 4 + 4), lambda i: CASE WHEN i BETWEEN 0 AND len(x) - 1 THEN x[i + 1] * x[i + 1] ELSE 0 END)) / 8), 1e-10))) AS l FROM x), f AS (SELECT vec_id, x, list_filter(range(len(l)), lambda k: l[k + 1] > list_max(l) - 6) AS f FROM l), c AS (SELECT vec_id, x, x[f[1] * 4 + 1:least(len(x), (f[-1] + 1) * 4)] AS c FROM f), t AS (SELECT vec_id, CASE WHEN len(c) >= greatest(4, 0.15 * len(x)) THEN c ELSE x END AS y FROM c) SELECT vec_id, len(y) AS n, round(list_sum(list_transform(range(1, len(y) + 1), lambda k: k * y[k])), 5) AS total FROM t"),
    "m06_time_aligned": (with_next("total", lambda a, b: np.concatenate(S.time_aligned(sung(a), sung(b, 0.5)))), None),
    "m07_prepared_pair": (with_next("total", lambda a, b: np.concatenate(S.prepared_pair(sung(a), sung(b, 0.5)))), None),
    "m10_listening_gate": (with_next("score", lambda a, b: S.listening_score(np.tile(a, 20), np.tile(b, 20) if b[0] > 0 else b, 24000 if a[0] > 0 else 8000, correlated, prepare=S.time_aligned)), None),
    "m11_intelligibility": (with_next("score", lambda a, b: [S.intelligibility(sung(a), sung(a) + 0.2 * sung(b) if b[0] > 0 else sung(b)[:900], RATE)]), None),
    "m28_clipped_reference": (signal("total", lambda x: S.clipped_reference(spoken(np.tile(x, 1)), 100, 1.0, 2.0)), None),
    "m08_contours": (m08, None),
    "m09_cepstral_distortion": (against_next("mcd", lambda a, b: S.cepstral_distortion(a, b, 16000)), None),
    "m14_pairs": (m14_pairs, None),
    "m15_resampled": (signal("total", lambda x: S.resampled(x, 24000, 16000)), f"SELECT vec_id, len(y) AS n, round(list_sum(list_transform(range(1, len(y) + 1), lambda k: k * y[k])), 5) AS total FROM (SELECT vec_id, {resampled_sql('x', 24000, 16000)} AS y FROM (SELECT vec_id, {_X} AS x FROM embeddings))"),
    "m16_log_mel": (signal("total", lambda x: S.log_mel(x, 24000, 64, 16, 8), 3), log_mel_sql(32, False)),
    "m16_log_mel_other": (signal("total", lambda x: S.log_mel(x, 24000, 64, 16, 8, centred_frames=False), 3), log_mel_sql(24, True)),
    "m17_padded": (m17, "SELECT vec_id, n::INT AS n, width::INT AS width, round(list_sum(list_slice(" + _X + ", 1, n)) + (width - n) * -11.512925::DOUBLE, 4) AS total FROM (SELECT *, max(n) OVER (PARTITION BY vec_id // 8) AS width FROM (SELECT *, vec_id % 30 + 1 AS n FROM embeddings))"),
    "m18_silent_joints": (m18_joint, f"SELECT vec_id, 70::BIGINT AS n, round(list_sum(list_transform(range(1, 65), lambda k: (k + CASE WHEN k > 40 THEN 6 WHEN k > 20 THEN 3 ELSE 0 END) * x[k])), 5) AS total FROM (SELECT vec_id, {_X} AS x FROM embeddings)"),
    "g08_seeded_order": (g08_order, _BUCKETS + "SELECT bucket, batch, id, md5('666:' || bucket || ':' || batch) AS place FROM f"),
    "m18_crossfaded": (placed(lambda x: A.crossfaded(x, F.transform(x, lambda v: -2 * v), int(0.15 * 64))), f"SELECT vec_id, 119::BIGINT AS n, round(list_sum(list_transform(range(1, 120), lambda k: k * CASE WHEN k <= 55 THEN x[k] WHEN k > 64 THEN -2 * x[k - 55] ELSE x[k] * (1 - (k - 56) / 8) - 2 * x[k - 55] * (k - 56) / 8 END)), 5) AS total FROM (SELECT vec_id, {_X} AS x FROM embeddings)"),
    "m19_frames_by_bytes": (m19_bytes, f"SELECT conv_id, turn, (750 + floor(750 / strlen(ref) * strlen(gen)))::BIGINT AS frames FROM {_PAIR} WHERE ref <> ''"),
    "m19_seconds_by_words": (m19_words, f"WITH n AS (SELECT conv_id, turn, len({_W.format('ref')}) AS r, len({_W.format('gen')}) AS g FROM {_PAIR}), v AS (SELECT *, CASE WHEN r > 0 THEN r / 6.0 ELSE 2.5 END::DOUBLE AS w FROM n) SELECT conv_id, turn, round(6.0::DOUBLE + g / w / CASE WHEN g < 3 THEN 0.3 ELSE 1.0 END::DOUBLE * (w / 4.0::DOUBLE), 5) AS seconds FROM v"),
    "m20_most_chars": (lambda s, d: t(s, d, "conversations").select("conv_id", "turn", D.most_chars(F.col("text"), F.lit(8.0)).alias("n")), "SELECT conv_id, turn, floor(strlen(text) / 8.0::DOUBLE * 14)::BIGINT AS n FROM conversations"),
    "m21_frames": (lambda s, d: t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(D.frames(F.col("l_quantity")), 4).alias("frames")), "SELECT l_orderkey, l_linenumber, round(l_quantity * 24000 / 256, 4) AS frames FROM lineitem"),
    "m22_masked_mean": (m22, f"SELECT vec_id, round(list_avg(list_slice({_X}, vec_id % 20 + 1, 40)), 6) AS mean FROM embeddings"),
    "m26_edges_trimmed": (placed(lambda x: A.edges_trimmed(x, 1, -12.0)), f"WITH x AS (SELECT vec_id, {_X} AS x FROM embeddings), l AS (SELECT vec_id, x, list_filter(range(1, len(x) + 1), lambda k: 20 * log10(greatest(abs(x[k]), 1e-10)) >= -12) AS l FROM x), c AS (SELECT vec_id, CASE WHEN len(l) > 0 THEN x[l[1]:l[-1]] ELSE [] END AS c FROM l) SELECT vec_id, len(c) AS n, round(coalesce(list_sum(list_transform(range(1, len(c) + 1), lambda k: k * c[k])), 0), 5) AS total FROM c"),
    "m27_silence_shortened": (signal("total", lambda x: S.silence_shortened(x, 16, -12.0, 0.5, 0.125, 0.0625)), None),
    "t25_even_timestamps": (t25, f"WITH w AS (SELECT conv_id, turn, length(text) / 16 AS s, {_W.format('text')} AS w FROM conversations), p AS (SELECT *, unnest(range(len(w))) AS i FROM w WHERE s > 0) SELECT conv_id, turn, i::INT AS pos, w[i + 1] AS word, round((i + 1) * (s / len(w)), 3) AS end_time FROM p"),
    "t26_sane_timestamps": (t26, "WITH e AS (SELECT user_id, greatest(0, min(value) - 5) AS b, least(20, max(value)) AS f, min(event_type) AS word FROM events GROUP BY 1) SELECT user_id, word, round(b, 3) AS begin_time, round(CASE WHEN f <= b THEN least(20, b + 0.05) ELSE f END, 3) AS end_time FROM e"),
}


def correlated(rate, a, b, band):
    """The stand-in of a listening model."""
    return float(np.corrcoef(a, b)[0, 1])
