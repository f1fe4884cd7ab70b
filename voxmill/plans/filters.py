"""Filters, predicates and projections (P, U and S families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import distance as E
from ..functions import text as X
from ..operators import relational as R
from ..sources.tables import table as t
from .scores import RATES_SQL, WORD_ERRORS_SQL, turn_pairs

PRESETS = {"prepare": (2, 30), "short": (1, 30), "corpus": (0.4, 30), "training": (0.3, 30)}
DURATION_SQL = "l_quantity BETWEEN {} AND {}"


def band(preset):
    lo, hi = PRESETS[preset]
    return lambda s, d: t(s, d, "lineitem").where(F.col("l_quantity").between(lo, hi)).select("l_orderkey", "l_linenumber", "l_quantity")


def p02(s, d):
    return t(s, d, "documents").where(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", "") != "").select("doc_id")


def p03(s, d):
    docs = t(s, d, "documents")
    reason = F.when(~F.col("n_chars").between(200, 3000), "duration").when(F.trim("text") == "", "empty_text").when(F.col("lang") != "en", "errors").otherwise("ok")
    return docs.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def p04(s, d):
    docs = t(s, d, "documents")
    reason = F.when(F.col("source").isNull(), "missing path").when(F.col("n_chars") <= 0, "bad duration").when(F.col("n_chars") > 3000, "too long").when(F.col("n_chars") < 100, "too short").when(F.char_length("text") < 3, "short text")
    return docs.select("doc_id", reason.alias("reason"))


def p05(s, d):
    docs = t(s, d, "documents").select("doc_id", F.size(F.filter(F.split("text", "[ \\n]+"), lambda w: w != "")).alias("n_words"), (F.col("n_chars") / 20).alias("seconds"))
    rate = F.col("n_words") / F.col("seconds")
    return docs.select("doc_id", "n_words", F.when(F.col("seconds") <= 0, True).otherwise((rate > 8) | (rate < 1)).alias("anomalous"))


def closing(s, d):
    """Turns, every third one an invented closing line in some dress."""
    said = F.element_at(F.array(*[F.lit(x) for x in X.OUTROS]), (F.pmod("turn", F.lit(len(X.OUTROS))) + 1).cast("int"))
    dressed = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit('"'), F.initcap(said), F.lit('."'))).otherwise(F.concat(F.lit("ừ, "), F.upper(said), F.lit(".")))
    return t(s, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, dressed).otherwise(F.col("text")).alias("text"))


def p06(s, d):
    return closing(s, d).select("conv_id", "turn", X.is_outro(F.col("text")).alias("outro"))


def p07(s, d):
    # every other text is said twice
    said = F.when(F.col("turn") % 2 == 0, F.concat_ws(" ", "text", "text")).otherwise(F.col("text"))
    return t(s, d, "conversations").select("conv_id", "turn", X.repeats_word_ngram(said).alias("repeats"))


def p08(s, d):
    return t(s, d, "documents").select("doc_id", X.repeats_char_ngram(F.col("text"), F.when(F.col("lang") == "en", 4).otherwise(2)).alias("repeats"))


def p09(s, d):
    blocked = t(s, d, "labels").where("quality = 0").select("doc_id")
    docs = t(s, d, "documents")
    by_lang = F.when(F.col("lang") == "en", F.contains("text", F.lit("GNU"))).when(F.col("lang") == "de", F.contains("text", F.lit("CC BY"))).otherwise(False)
    return docs.join(blocked, "doc_id", "left_anti").where(~by_lang).select("doc_id", "lang")


def p11(s, d):
    wer = E.wer(F.col("reference"), F.col("hypothesis"), "filter")
    return turn_pairs(s, d).select("conv_id", "turn", F.when(wer > 0.95, "error").otherwise("kept").alias("route"))


#: What messages of unreadable audio say.
CORRUPT = ["format not recognised", "invalid data", "no such file", "cannot read audio", "failed to decode"]


def p12(s, d):
    said = F.element_at(F.array(*[F.lit(x) for x in (*CORRUPT, "out of memory", "timeout")]), (F.pmod("event_id", F.lit(7)) + 1).cast("int"))
    message = F.concat(F.lit("Error: "), F.initcap(said), F.lit(" in "), "event_type")
    return t(s, d, "events").select("event_id", F.lower(message).rlike("|".join(CORRUPT)).alias("corrupt"))


def p13(s, d):
    return t(s, d, "events").where("event_type = 'click'").select("event_id", "user_id")


def p14(s, d):
    return t(s, d, "labels").where("toxic is not null").groupBy("quality").agg(F.count("*").alias("n"))


def p15(s, d):
    return t(s, d, "part").select(F.col("p_partkey").alias("id"), F.coalesce("p_name", F.lit("")).alias("text"), F.coalesce("p_brand", F.lit("unknown")).alias("speaker"), F.coalesce("p_type", F.lit("unknown")).alias("gender"))


def p16(s, d):
    # the index counts within the source
    docs = R.numbered(t(s, d, "documents").select("doc_id", "source"), "doc_id", ["source"])
    return docs.select("doc_id", F.concat_ws("_", F.replace("source", F.lit("."), F.lit("_")), F.lpad(F.col("_k").cast("string"), 6, "0")).alias("sample_id"))


#: The forms of a channel's address, and its page of videos.
CHANNELS = [r"youtube\.com/(@[\w.-]+)", r"youtube\.com/channel/(UC[\w-]+)", r"youtube\.com/c/([\w.-]+)", r"youtube\.com/user/([\w.-]+)"]


def canonical(url):
    """The address of a channel's videos, null for what is no channel."""
    plain = F.url_decode(F.replace(F.regexp_replace(F.trim(url), "/+$", ""), F.lit("+"), F.lit("%2B")))

    def address(u):
        name = F.coalesce(*[F.nullif(F.regexp_extract(u, "(?U)" + form, 1), F.lit("")) for form in CHANNELS])
        base = F.concat(F.lit("https://www.youtube.com/"), F.when(F.startswith(name, F.lit("@")) | F.startswith(name, F.lit("UC")), name).otherwise(F.concat(F.lit("c/"), name)))
        return F.when(F.endswith(u, F.lit("/videos")), u).otherwise(F.concat(base, F.lit("/videos")))

    return X.bound(plain, address)


def p17(s, d):
    name = F.regexp_extract("url", "//([^/?#]+)", 1)
    form = F.element_at(F.array(*[F.lit(x) for x in ("https://www.youtube.com/%40{}/", " http://youtube.com/channel/UC{}//", "youtube.com/c/{}/about", "https://m.youtube.com/user/{}", "https://www.youtube.com/@{}/videos/", "https://example.com/{}")]), (F.pmod("page_id", F.lit(6)) + 1).cast("int"))
    return t(s, d, "pages").select("page_id", canonical(F.replace(form, F.lit("{}"), name)).alias("canonical"))


def p18(s, d):
    """Addresses of channels from those of pages: by id, by either form of a name, with both, and without."""
    k, n = F.col("page_id") % 5, F.col("page_id").cast("string")
    tail = F.when(k == 0, F.concat(F.lit("/channel/UC_"), n, F.lit("-x/videos"))).when(k == 1, F.concat(F.lit("/@née.user-"), n, F.lit("/about"))).when(k == 2, F.concat(F.lit("/c/shop."), n)).when(k == 3, F.concat(F.lit("/c/old"), n, F.lit("/@new"), n, F.lit("?a=/channel/XX1"))).otherwise("/watch")
    url = F.concat("url", tail)
    return t(s, d, "pages").select("page_id", X.channel_id(url).alias("channel"), X.channel_user(url).alias("user"))


def p19(s, d):
    """Channels by what their scan found: no name, an error, videos, none at all, or only ones of other channels."""
    # a customer is a channel, its orders are what was listed; open ones are of another channel
    o = t(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("listed"), F.count_if(F.col("o_orderstatus") == "F").alias("found"))
    c = t(s, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_acctbal", F.coalesce("listed", F.lit(0)).alias("listed"), F.coalesce("found", F.lit(0)).alias("found"))
    kind = F.when(F.col("c_custkey") % 10 == 0, "rejected").when(F.col("c_acctbal") < 0, "error").when(F.col("found") > 0, "success").when(F.col("listed") == 0, "empty").otherwise("all_skipped")
    scanned = ~kind.isin("rejected", "error")
    return c.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum(F.when(scanned, F.col("found")).otherwise(0)).alias("n_found"), F.sum(F.when(scanned, F.col("listed") - F.col("found")).otherwise(0)).alias("n_skipped"))


#: Places and the dialects spoken there, in the order in which parts of a name are looked for.
DIALECTS = {
    "hanoi": "bắc", "ha noi": "bắc", "bac": "bắc", "north": "bắc", "haiphong": "bắc", "hai phong": "bắc", "quangninh": "bắc", "quang ninh": "bắc",
    "thaibinh": "bắc", "thai binh": "bắc", "namdinh": "bắc", "nam dinh": "bắc", "ninhbinh": "bắc", "ninh binh": "bắc", "langson": "bắc", "lang son": "bắc",
    "hue": "trung", "thua thien hue": "trung", "danang": "trung", "da nang": "trung", "quangnam": "trung", "quang nam": "trung", "nghean": "trung", "nghe an": "trung",
    "hatinh": "trung", "ha tinh": "trung", "quangbinh": "trung", "quang binh": "trung", "central": "trung", "trung": "trung",
    "hcm": "nam", "ho chi minh": "nam", "saigon": "nam", "sai gon": "nam", "cantho": "nam", "can tho": "nam", "binhduong": "nam", "binh duong": "nam",
    "dongnai": "nam", "dong nai": "nam", "longan": "nam", "long an": "nam", "south": "nam", "nam": "nam",
}


def dialect(name, default: str = "bắc"):
    """By the whole name, else by the first place that it holds."""
    low = F.trim(F.lower(F.coalesce(name, F.lit(""))))
    table_ = F.create_map(*[F.lit(x) for pair in DIALECTS.items() for x in pair])
    places = F.array(*[F.lit(k) for k in DIALECTS])
    return X.bound(low, lambda x: F.coalesce(F.element_at(table_, x), F.element_at(table_, F.get(F.filter(places, lambda k: F.contains(x, k)), F.lit(0))), F.lit(default)))


def p20(s, d):
    places = list(DIALECTS)
    name = F.element_at(F.array(*[F.lit(x) for x in places]), (F.pmod(F.col("c_custkey") * 7, F.lit(len(places))) + 1).cast("int"))
    said = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.upper(name), F.lit(" "))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("Tp "), name, F.lit(" tinh"))).when(F.col("c_custkey") % 5 == 0, None).otherwise(F.col("c_name"))
    return t(s, d, "customer").select("c_custkey", dialect(said).alias("dialect"))


def p21(s, d):
    return t(s, d, "conversations").select("conv_id", "turn", F.concat(F.lit("<"), F.col("role"), F.lit("> "), F.col("text")).alias("tagged"))


def p22(s, d):
    return t(s, d, "part").select("p_partkey", X.safe_name(F.concat("p_name", F.lit("//v1:"), "p_brand")).alias("safe"))


def p23(s, d):
    """Texts by their digests; the second of a name is its __dup2, in order of ids.  Places are counted by stretches of ids, as all
    empty texts have one name."""
    named = R.numbered(t(s, d, "documents").select("doc_id", F.md5("text").alias("name")), "doc_id", ["name"])
    return named.select("doc_id", F.concat("name", F.when(F.col("_k") > 0, F.concat(F.lit("__dup"), (F.col("_k") + 1).cast("string"))).otherwise("")).alias("name"))


def p24(s, d):
    return t(s, d, "pages").select("page_id", F.concat(F.lit("ds_"), F.replace(F.regexp_replace("url", "^[a-z]+://", ""), F.lit("/"), F.lit("_"))).alias("name"))


def p25(s, d):
    c = t(s, d, "conversations")
    return c.select("conv_id", "turn", F.when(~F.col("role").isin("user", "assistant"), "unknown model").when(F.trim("text") == "", "blank text").when((F.col("role") == "user") & (F.col("turn") > 6), "reference missing").alias("reason"))


def p26(s, d):
    return t(s, d, "nation").where("n_name <> 'CHINA'").select("n_nationkey", "n_name")


def p28(s, d):
    return t(s, d, "region").where("r_name <> 'ASIA'").select(F.lower("r_name").alias("project"))


def u01(s, d):
    a = t(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("src"))
    b = t(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("src"))
    return a.unionByName(b).unionByName(t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit("nation").alias("src")))


def u02(s, d):
    a = t(s, d, "customer").select(F.col("c_name").alias("name"))
    return a.unionByName(t(s, d, "supplier").select(F.col("s_name").alias("name"))).where(~F.col("name").endswith("1"))


def u04(s, d):
    return t(s, d, "labels").select("doc_id").union(t(s, d, "documents").where("lang = 'de'").select("doc_id")).distinct()


_OUTRO = "[" + ", ".join(f"'{x}'" for x in X.OUTROS) + "]"
_PLACES = "[" + ", ".join(f"'{k}'" for k in DIALECTS) + "]"
_SPOKEN = "[" + ", ".join(f"'{v}'" for v in DIALECTS.values()) + "]"
_CORRUPT = "[" + ", ".join(f"'{x}'" for x in (*CORRUPT, "out of memory", "timeout")) + "]"
QUERIES = {
    **{f"p01_duration_{k}": (band(k), f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN {a} AND {b}") for k, (a, b) in PRESETS.items()},
    "p02_non_empty_text": (p02, "SELECT doc_id FROM documents WHERE regexp_replace(coalesce(text, ''), '[\\s\\p{Z}]+', '', 'g') <> ''"),
    "p03_cascade_reasons": (p03, "SELECT CASE WHEN NOT n_chars BETWEEN 200 AND 3000 THEN 'duration' WHEN trim(text) = '' THEN 'empty_text' WHEN lang <> 'en' THEN 'errors' ELSE 'ok' END AS reason, count(*) AS n FROM documents GROUP BY 1"),
    "p04_error_reason": (p04, "SELECT doc_id, CASE WHEN source IS NULL THEN 'missing path' WHEN n_chars <= 0 THEN 'bad duration' WHEN n_chars > 3000 THEN 'too long' WHEN n_chars < 100 THEN 'too short' WHEN length(text) < 3 THEN 'short text' END AS reason FROM documents"),
    "p05_speech_rate": (p05, "WITH w AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda x: x <> ''))::INT AS n_words, n_chars / 20 AS seconds FROM documents) SELECT doc_id, n_words, CASE WHEN seconds <= 0 THEN true ELSE n_words / seconds > 8 OR n_words / seconds < 1 END AS anomalous FROM w"),
    "p06_outro": (p06, f"WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN text WHEN conv_id % 2 = 0 THEN '\"' || {_OUTRO}[turn % 6 + 1] || '.\"' ELSE 'ừ, ' || {_OUTRO}[turn % 6 + 1] || '.' END AS t FROM conversations) SELECT conv_id, turn, len(list_filter({_OUTRO}, lambda o: contains(lower(t), o))) > 0 AS outro FROM c"),
    "p07_repeated_words": (p07, "WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text || ' ' || text ELSE text END AS t FROM conversations), w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(t), '[\\s\\p{Z}]+'), lambda x: x <> '') AS w FROM c), g AS (SELECT conv_id, turn, list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k+7], ' ')) AS g FROM w) SELECT conv_id, turn, len(list_distinct(g)) < len(g) AS repeats FROM g"),
    "p08_repeated_chars": (p08, "WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN lang = 'en' THEN 4 ELSE 2 END AS l FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, length(text) - l + 2), lambda k: substring(text, k, l))) AS g FROM d), n AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT doc_id, max(n) > 10 AS repeats FROM n GROUP BY 1) SELECT d.doc_id, coalesce(repeats, false) AS repeats FROM d LEFT JOIN m ON m.doc_id = d.doc_id"),
    "p09_blocklists": (p09, "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND NOT CASE lang WHEN 'en' THEN contains(text, 'GNU') WHEN 'de' THEN contains(text, 'CC BY') ELSE false END"),
    "p11_error_route": (p11, f"WITH RECURSIVE {WORD_ERRORS_SQL}, {RATES_SQL.format(both=0, reference=1, hypothesis=1, both_c=0, reference_c=1, hypothesis_c=1)} SELECT conv_id, turn, CASE WHEN wer > 0.95 THEN 'error' ELSE 'kept' END AS route FROM rates"),
    "p12_corrupt_words": (p12, f"SELECT event_id, regexp_matches(lower('Error: ' || {_CORRUPT}[event_id % 7 + 1] || ' in ' || event_type), '{'|'.join(CORRUPT)}') AS corrupt FROM events"),
    "p13_status": (p13, "SELECT event_id, user_id FROM events WHERE event_type = 'click'"),
    "p14_non_null": (p14, "SELECT quality, count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY 1"),
    "p15_defaults": (p15, "SELECT p_partkey AS id, coalesce(p_name, '') AS text, coalesce(p_brand, 'unknown') AS speaker, coalesce(p_type, 'unknown') AS gender FROM part"),
    "p16_sample_ids": (p16, "SELECT doc_id, replace(source, '.', '_') || '_' || lpad((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::VARCHAR, 6, '0') AS sample_id FROM documents"),
    "p17_canonical_url": (p17, "WITH u AS (SELECT page_id, page_id % 6 AS k, regexp_extract(url, '//([^/?#]+)', 1) AS n FROM pages) SELECT page_id, CASE k WHEN 0 THEN 'https://www.youtube.com/@' || n || '/videos' WHEN 1 THEN 'https://www.youtube.com/UC' || regexp_extract(n, '^[\\w-]+') || '/videos' WHEN 2 THEN 'https://www.youtube.com/c/' || n || '/videos' WHEN 3 THEN 'https://www.youtube.com/c/' || n || '/videos' WHEN 4 THEN 'https://www.youtube.com/@' || n || '/videos' END AS canonical FROM u"),
    "p18_channel_id": (p18, "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'UC_' || page_id || '-x' ELSE '' END AS channel, CASE page_id % 5 WHEN 1 THEN 'née.user-' || page_id WHEN 2 THEN 'shop.' || page_id WHEN 3 THEN 'new' || page_id ELSE '' END AS user FROM pages"),
    "p19_scan_classes": (p19, "WITH o AS (SELECT o_custkey, count(*) AS listed, count(*) FILTER (o_orderstatus = 'F') AS found FROM orders GROUP BY 1), c AS (SELECT c_custkey, c_acctbal, coalesce(listed, 0) AS listed, coalesce(found, 0) AS found FROM customer LEFT JOIN o ON c_custkey = o_custkey), k AS (SELECT *, CASE WHEN c_custkey % 10 = 0 THEN 'rejected' WHEN c_acctbal < 0 THEN 'error' WHEN found > 0 THEN 'success' WHEN listed = 0 THEN 'empty' ELSE 'all_skipped' END AS kind FROM c) SELECT kind, count(*) AS n, sum(CASE WHEN kind IN ('rejected', 'error') THEN 0 ELSE found END)::BIGINT AS n_found, sum(CASE WHEN kind IN ('rejected', 'error') THEN 0 ELSE listed - found END)::BIGINT AS n_skipped FROM k GROUP BY 1"),
    "p20_dialect": (p20, f"WITH p AS (SELECT {_PLACES} AS k, {_SPOKEN} AS v), c AS (SELECT c_custkey, k, v, trim(lower(coalesce(CASE WHEN c_custkey % 3 = 0 THEN k[c_custkey * 7 % len(k) + 1] WHEN c_custkey % 3 = 1 THEN 'tp ' || k[c_custkey * 7 % len(k) + 1] || ' tinh' WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END, ''))) AS x FROM customer, p) SELECT c_custkey, coalesce(v[list_position(k, x)], v[list_position(k, list_filter(k, lambda y: contains(x, y))[1])], 'bắc') AS dialect FROM c"),
    "p21_tagged": (p21, "SELECT conv_id, turn, '<' || role || '> ' || text AS tagged FROM conversations"),
    "p22_safe_name": (p22, "SELECT p_partkey, coalesce(nullif(trim(regexp_replace(regexp_replace(p_name || '//v1:' || p_brand, '[^\\p{L}\\p{N}_\\-.]', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'unknown_model') AS safe FROM part"),
    "p23_free_names": (p23, "SELECT doc_id, md5(text) || CASE WHEN k > 1 THEN '__dup' || k ELSE '' END AS name FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents)"),
    "p24_flat_names": (p24, "SELECT page_id, 'ds_' || replace(regexp_replace(url, '^[a-z]+://', ''), '/', '_') AS name FROM pages"),
    "p25_request_reason": (p25, "SELECT conv_id, turn, CASE WHEN role NOT IN ('user', 'assistant') THEN 'unknown model' WHEN trim(text) = '' THEN 'blank text' WHEN role = 'user' AND turn > 6 THEN 'reference missing' END AS reason FROM conversations"),
    "p26_without_baseline": (p26, "SELECT n_nationkey, n_name FROM nation WHERE n_name <> 'CHINA'"),
    "p28_projects": (p28, "SELECT lower(r_name) AS project FROM region WHERE r_name <> 'ASIA'"),
    "u01_union": (u01, "SELECT c_custkey AS id, c_name AS name, 'customer' AS src FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier UNION ALL SELECT n_nationkey::BIGINT, n_name, 'nation' FROM nation"),
    "u02_mixed": (u02, "SELECT name FROM (SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier) WHERE name NOT LIKE '%1'"),
    "u04_processed_keys": (u04, "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE lang = 'de'"),
}
