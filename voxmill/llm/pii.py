"""Personal data: base patterns, and bootstrapped contextual extraction, with DataFrame functions only.

Base spans come from four patterns with checks (number ranges, digit counts, Luhn).  They are the seeds.  Mentions are
the seeds themselves, what stands between them in runs of tokens with digits, tokens with an at sign, and every other
token with a letter that stands behind a word which precedes `SUPPORT` different known values ("loose" tokens).  A mention
has two lexical patterns: the word before it with the shape of its characters, and that word alone (where all tokens behind it
are counted).  A pattern's
confidence is the smoothed mean over its mentions (1 for a seed, else the value's), for a word alone over its seeds and
the ordinary words behind it; a value's is the noisy-or over its
patterns, or for loose tokens 1 once found, else 0.  Values of confident patterns with enough different known values are
known from the next round on, and support further patterns; rounds go on until no value is new, and then with the loose
tokens that the new values bring, until these bring none.  Loose tokens of unknown values are counted only.

Positions: `split` gives the text between matches and `regexp_extract_all` the matches, so running lengths give starts
in code points.  The patterns are those of the contract written with possessive repeats, and tied to the start of a run
of characters (or the end of the match before), which changes no match and keeps long runs linear.

Edge cases: null text is the empty text; texts of any length are read whole; repeated rows get the same spans each; null doc_id is a key like any other;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table, whole_text

KINDS = ("email", "ip", "card", "phone", "context")
#: Confidence of a pattern, and different known values that it must have.
CONFIDENT, SUPPORT = 0.8, 5
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
MENTION = r"(?<!\S)(?=[^\s0-9]*+[0-9])\S++(?: (?=[^\s0-9]*+[0-9])\S++)*+|(?<!\S)(?=[^\s@]*+@)\S++"


def last_word(text: Column) -> Column:
    """The whole last word, with the blank behind it that parts it from what follows, if there is one."""
    blanks = "\t\n\x0b\f\r"
    plain = F.translate(text, blanks, " " * len(blanks))
    word = F.substring_index(F.rtrim(plain), " ", -1)
    return F.when(F.endswith(plain, F.lit(" ")), F.concat(word, F.lit(" "))).otherwise(word)


def placed(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match, before>>: every match with its code point range and the text before it."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # one struct for each match; the last piece has none
    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match"))
    empty = F.expr("CAST(ARRAY() AS ARRAY<STRUCT<start: INT, end: INT, match: STRING, before: STRING>>)")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["match"])
        row = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), last_word(x["gap"]).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(acc: Column, k: Column) -> Column:
        d = F.substr(digits, n - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # leading zeros allowed: a part is at most 255 when what is left without them is
        return F.forall(F.split(match, r"\."), lambda p: (F.char_length(F.ltrim(F.lit("0"), p)) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), luhn(digits)).otherwise(False)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, and `base`: array<struct<start, kind, end>> in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    digit = F.col("text").rlike("[0-9]")
    rows = rows.withColumn("_digit", digit)
    none = F.expr("CAST(ARRAY() AS ARRAY<STRUCT<start: INT, end: INT, match: STRING, before: STRING>>)")
    found = []
    for kind in KINDS[:4]:
        gate = F.lit(True) if NEEDS[kind] is None else F.contains("text", F.lit(NEEDS[kind]))
        if kind != "email":
            gate = gate & F.col("_digit")
        found.append(F.when(gate, placed(F.col("text"), PATTERNS[kind])).otherwise(none).alias(f"_{kind}"))
    rows = rows.select("doc_id", "text", "_digit", *found)

    def checked(k: int, kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", lambda m: valid(kind, m["match"])), lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))

    spans = [checked(k, kind) for k, kind in enumerate(KINDS[:4])]
    return rows.select("doc_id", "text", "_digit", F.array_sort(F.concat(*spans)).alias("base"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def word_before(text: Column) -> Column:
    return F.lower(F.rtrim(last_word(text)))


def trimmed(token: Column) -> Column:
    return F.regexp_replace(token, r"[\s\p{Punct}&&[^)]]+$", "")


def shape_of(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}++", "a"), "[0-9]++", "9")


def mentions(rows: DataFrame) -> DataFrame:
    """One row for each mention that isn't loose: place, value, word before, shape, and the seed's kind, if it is one."""
    m = rows.where("text IS NOT NULL").select("doc_id", "key", "base", F.explode(placed(F.col("text"), MENTION)).alias("m"))
    seeds = F.filter("base", lambda s: (s["start"] < F.col("m.end")) & (s["end"] > F.col("m.start")))
    m = m.select("doc_id", "key", "m", seeds.alias("seeds"))
    none = F.expr("CAST(ARRAY() AS ARRAY<STRUCT<a: INT, b: INT, kind: INT>>)")

    def part(a: Column, b: Column, kind: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), kind.cast("int").alias("kind"))

    def step(acc: Column, s: Column) -> Column:
        end = F.least(s["end"], F.col("m.end"))
        here = s["start"] >= acc["at"]
        more = F.array(part(acc["at"], s["start"], F.lit(None)), part(s["start"], end, s["kind"]))
        return F.struct(F.greatest(acc["at"], end).alias("at"), F.when(here, F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    # cut at the seeds; of overlapping ones the first counts, and of one over two mentions the first part
    parts = F.aggregate("seeds", F.struct(F.col("m.start").alias("at"), none.alias("out")), step, lambda acc: F.concat(acc["out"], F.array(part(acc["at"], F.col("m.end"), F.lit(None)))))
    m = m.select("doc_id", "key", "m", F.explode(parts).alias("p")).where("p.b > p.a")
    raw = F.substr(F.col("m.match"), F.col("p.a") - F.col("m.start") + 1, F.col("p.b") - F.col("p.a"))
    m = m.select("doc_id", "key", "p.kind", raw.alias("raw"), F.col("p.a").alias("a"), F.concat("m.before", F.substr(F.col("m.match"), F.lit(1), F.col("p.a") - F.col("m.start"))).alias("before"))
    value = F.when(F.col("kind").isNull(), trimmed(F.ltrim("raw"))).otherwise(F.col("raw"))
    m = m.select("doc_id", "key", F.col("kind").alias("seed"), value.alias("v"), word_before(F.col("before")).alias("left"), (F.col("a") + F.when(F.col("kind").isNull(), F.char_length("raw") - F.char_length(F.ltrim("raw"))).otherwise(0)).alias("start"))
    m = m.where(F.col("seed").isNotNull() | F.col("v").rlike("[0-9@]"))
    return m.select("doc_id", "key", "start", (F.col("start") + F.char_length("v")).alias("end"), F.xxhash64("v").alias("value"), F.xxhash64("left").alias("left"), F.xxhash64(shape_of(F.col("v"))).alias("shape"), "seed")


def tokens(docs: DataFrame) -> DataFrame:
    """doc_id, key, start (the token's number, with the empty ones between blanks), w, and the hash of the word before."""
    words = F.transform(F.split("text", r"\s", -1), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    words = F.filter(words, lambda x: x["w"] != "")
    pairs = F.arrays_zip(words.alias("x"), F.concat(F.array(F.lit(None).cast("struct<w:string,i:int>")), words).alias("y"))
    m = docs.select("doc_id", "key", F.explode(pairs).alias("m")).where("m.x IS NOT NULL")
    return m.select("doc_id", "key", F.col("m.x.i").alias("start"), F.col("m.x.w").alias("w"), F.xxhash64(F.lower(F.coalesce("m.y.w", F.lit("")))).alias("left"))


def is_loose(w: Column) -> Column:
    return w.rlike(r"\p{L}") & ~w.rlike("[0-9@]")


def loose_counts(docs: DataFrame, lefts: DataFrame, words: DataFrame | None) -> DataFrame:
    """left, shape, value (known ones only, else null), n: loose tokens behind `lefts`, and wherever a value is one of `words`."""
    m = tokens(docs).join(lefts.select("left", F.lit(1).alias("_l")), "left", "left")
    value, wanted = F.lit(None).cast("long"), F.col("_l") == 1
    if words is not None:
        m = m.withColumn("_h", F.xxhash64(trimmed(F.col("w")))).join(words.select(F.col("value").alias("_h"), F.lit(1).alias("_v")), "_h", "left")
        value, wanted = F.when(F.col("_v") == 1, F.col("_h")), (F.col("_l") == 1) | (F.col("_v") == 1)
    m = m.where(F.when(wanted, is_loose(F.col("w"))).otherwise(False))
    return m.groupBy("left", F.xxhash64(shape_of(trimmed(F.col("w")))).alias("shape"), value.alias("value")).agg(F.count("*").alias("n"))


def loose_hits(docs: DataFrame, good: DataFrame, lefts: DataFrame) -> DataFrame:
    """doc_id, key, start, value of the loose tokens that confident patterns reach."""
    m = tokens(docs).join(lefts, "left", "left_semi").where(is_loose(F.col("w")))
    m = m.select("doc_id", "key", "start", F.xxhash64(trimmed(F.col("w"))).alias("value"), "left", F.xxhash64(shape_of(trimmed(F.col("w")))).alias("shape"), F.lit(True).alias("_c"))
    return both_patterns(m).join(good, "pattern", "left_semi").select("doc_id", "key", "start", "value").distinct()


def both_patterns(rows: DataFrame) -> DataFrame:
    """Every row once by word and shape and, where `_c` says that all tokens behind the word are counted, by the word alone."""
    shaped, alone = F.struct(F.xxhash64("left", "shape").alias("pattern"), F.lit(False).alias("alone")), F.struct(F.xxhash64("left").alias("pattern"), F.lit(True).alias("alone"))
    return rows.withColumn("_p", F.explode(F.when(F.col("_c"), F.array(shaped, alone)).otherwise(F.array(shaped)))).select("*", "_p.pattern", "_p.alone").drop("_p")


def settled(edges: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(confident patterns, known values) when no round brings a new value; edges: pattern, alone, value, n, seed, loose.

    Behind a word alone, mentions of unknown values say nothing for or against it: the more there are, the more is found.  Ordinary words there do."""
    scores, count = None, -1
    while True:
        score = edges.join(known.withColumn("_k", F.lit(1)), "value", "left")
        if scores is not None:
            score = score.join(scores, "value", "left")
        soft = F.coalesce("_s", F.lit(0.0)) if scores is not None else F.lit(0.0)
        score = score.withColumn("score", F.when(F.col("_k") == 1, 1.0).when(F.col("loose"), 0.0).otherwise(soft))
        counts = F.when(F.col("alone") & F.col("_k").isNull() & ~F.col("loose"), 0).otherwise(F.col("n"))
        totals = score.groupBy("pattern").agg((F.sum(counts * F.col("score")) / (F.sum(counts) + 1)).alias("confidence"), F.count_distinct(F.when(F.col("_k") == 1, F.col("value"))).alias("known"))
        patterns = durable(totals.where("confidence > 0"), "pii-patterns")
        good = patterns.where((F.col("confidence") >= CONFIDENT) & (F.col("known") >= SUPPORT)).select("pattern")
        known = durable(known.union(edges.where("value IS NOT NULL").join(good, "pattern", "left_semi").select("value")).distinct(), "pii-known")
        now = known.count()
        if now == count:
            return good, known
        count = now
        scores = durable(edges.where("seed IS NULL AND NOT loose").join(patterns, "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("_s")), "pii-values")


def discovered(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Places (doc_id, key, start, end) of mentions that confident patterns reach."""
    spots = durable(found.groupBy("left", "shape", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-edges")
    known = spots.where("seed IS NOT NULL").select("value").distinct()
    loose, words, hits, good, old = None, None, None, None, None
    while True:
        seen = spots.select("left", "value")
        if loose is not None:
            seen = seen.union(loose.where("value IS NOT NULL").select("left", "value"))
        # the start of a text is no word
        seen = seen.where(F.col("left") != F.xxhash64(F.lit(""))).join(known, "value", "left_semi")
        lefts = durable(seen.groupBy("left").agg(F.count_distinct("value").alias("k")).where(F.col("k") >= SUPPORT).select("left"), "pii-words")
        size = (lefts.count(), 0 if words is None else words.count())
        if size == old or size[0] == 0:
            break
        old = size
        loose = durable(loose_counts(docs, lefts, words), "pii-loose")
        flag = lefts.select("left", F.lit(True).alias("_f"))
        rows = spots.withColumn("loose", F.lit(False)).unionByName(loose.select("left", "shape", "value", "n", F.lit(None).cast("int").alias("seed"), F.lit(True).alias("loose")))
        rows = rows.join(flag, "left", "left").withColumn("_c", F.coalesce("_f", F.lit(False))).where("_c OR NOT loose")
        edges = durable(both_patterns(rows).select("pattern", "alone", "value", "n", "seed", "loose"), "pii-graph")
        good, known = settled(edges, known)
        if edges.where("loose").join(good, "pattern", "left_semi").limit(1).count():
            hits = durable(loose_hits(docs, good, lefts), "pii-hits")
            words = durable(hits.select("value").distinct(), "pii-loose-known")
            known = known.union(words).distinct()
    if good is None:
        good, _ = settled(spots.withColumn("_c", F.lit(False)).withColumn("loose", F.lit(False)).transform(both_patterns).select("pattern", "alone", "value", "n", "seed", "loose"), known)
    behind = lefts.select("left", F.lit(True).alias("_f"))
    mine = found.where("seed IS NULL").join(behind, "left", "left").withColumn("_c", F.coalesce("_f", F.lit(False)))
    out = both_patterns(mine).join(good, "pattern", "left_semi").select("doc_id", "key", "start", "end").distinct()
    if hits is None:
        return out
    # a loose token's number becomes its place: the tokens before it, and one blank behind each
    at = hits.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("start").alias("_i"))
    texts = docs.join(at, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("doc_id", "key", F.split("text", r"\s", -1).alias("w"), F.explode("_i").alias("i"))
    start = F.when(F.col("i") == 0, 0).otherwise(F.char_length(F.array_join(F.slice("w", F.lit(1), F.col("i")), " ")) + 1)
    return out.unionByName(texts.select("doc_id", "key", start.alias("start"), (start + F.char_length(trimmed(F.get("w", F.col("i"))))).alias("end")).distinct())


def find(docs: DataFrame) -> DataFrame:
    rows = base_spans(docs).withColumn("key", F.xxhash64("text"))
    # the texts themselves go no further than the mentions
    held = F.col("_digit") | F.contains("text", F.lit("@"))
    slim = durable(rows.select("doc_id", "key", "base", F.when(held, F.col("text")).alias("text")), "pii-base")
    found = durable(mentions(slim), "pii-mentions")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("key", F.xxhash64("text"))
    extra = discovered(found, whole).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", F.lit(4).alias("kind"), "end")).alias("extra"))
    base = slim.select("doc_id", "key", "base")
    both = base.join(extra.withColumnRenamed("doc_id", "_id").withColumnRenamed("key", "_key"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra")))

    def count(k: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    counts = [count(k, kind) for k, kind in enumerate(KINDS[:4])]
    return both.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(spans).alias("spans"), F.when(F.col("extra").isNull(), 0).otherwise(F.size("extra")).cast("long").alias("n_context"), F.size(spans).cast("long").alias("n_found"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
