"""Joins, set differences and first-row rules (J and D families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources.tables import table as t


def host(c="url"):
    return F.regexp_extract(c, "^[a-z]+://([^/?#]+)", 1)


def j01(s, d):
    return R.pending(t(s, d, "documents"), t(s, d, "labels"), "doc_id").select("doc_id")


def j02(s, d):
    p = t(s, d, "pages").select("page_id", "url")
    return p.join(p.where("page_id % 3 = 0").select("url"), "url", "left_anti").join(p.where("page_id % 5 = 0").select("url"), "url", "left_anti")


def j03(s, d):
    long = t(s, d, "labels").selectExpr("doc_id", "stack(2, 'quality', quality, 'toxic', nullif(toxic, 1)) as (metric, value)").where("value is not null")
    done = long.groupBy("doc_id").agg(F.count_distinct("metric").alias("k")).where("k = 2")
    return t(s, d, "documents").join(done, "doc_id", "left_anti").select("doc_id")


def j04(s, d):
    docs, labels = t(s, d, "documents").select("doc_id"), t(s, d, "labels").select("doc_id", F.lit(True).alias("_there"))
    return docs.join(labels, "doc_id", "left").select("doc_id", F.coalesce("_there", F.lit(False)).alias("paired"))


def j05(s, d):
    long = t(s, d, "labels").selectExpr("doc_id", "stack(2, 'quality', quality, 'toxic', toxic) as (metric, value)")
    return R.wide(long, ["doc_id"], "metric", "value", ["quality", "toxic"])


def j06(s, d):
    work = t(s, d, "region").select("r_regionkey").crossJoin(F.broadcast(t(s, d, "nation").select("n_nationkey")))
    made = t(s, d, "nation").select(F.col("n_nationkey").alias("_n"), F.col("n_regionkey").alias("_r"), "n_name")
    return work.join(made, (F.col("_n") == F.col("n_nationkey")) & (F.col("_r") == F.col("r_regionkey")), "left").select("r_regionkey", "n_nationkey", "n_name")


def j07(s, d):
    return t(s, d, "region").select("r_name").crossJoin(F.broadcast(t(s, d, "nation").select("n_name")))


def chars(df):
    return df.select(F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").distinct()


def j08(s, d):
    docs = t(s, d, "documents")
    return chars(docs.where("lang = 'de'")).join(chars(docs.where("lang = 'en'")), "ch", "left_anti")


def j09(s, d):
    docs = t(s, d, "conversations").where("role = 'user'")
    seen = docs.select("conv_id", "turn", F.posexplode(F.split("text", "")).alias("pos", "ch")).where("ch <> ''").groupBy("ch").agg(F.min(F.struct("conv_id", "turn", "pos")).alias("f"))
    known = chars(t(s, d, "documents").where("lang = 'en'"))
    return seen.join(known, "ch", "left_anti").select("ch", "f.conv_id", "f.turn", "f.pos")


def j10(s, d):
    vocab = chars(t(s, d, "documents").where("lang = 'en'")).select("ch", F.ascii("ch").alias("id"))
    return chars(t(s, d, "conversations")).join(vocab, "ch", "left").select("ch", F.coalesce("id", F.lit(0)).alias("id"))


def j11(s, d):
    return t(s, d, "documents").join(t(s, d, "labels"), "doc_id", "left_semi").select("doc_id")


def j12(s, d):
    o = t(s, d, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice", "o_orderstatus")
    a = o.where("o_orderstatus = 'F'").groupBy("k").agg(F.max("o_totalprice").alias("base"))
    b = o.where("o_orderstatus = 'O'").groupBy("k").agg(F.max("o_totalprice").alias("other"))
    return a.join(b, "k", "full").select("k", F.when(F.col("base").isNull() | F.col("other").isNull(), "FAILED").otherwise("OK").alias("status"))


def j13(s, d):
    voices = s.createDataFrame([("user", "voice_a")], "role string, voice string")
    return t(s, d, "conversations").join(F.broadcast(voices), "role", "left").select("conv_id", "turn", F.coalesce("voice", F.lit("main")).alias("voice"))


def j14(s, d):
    return t(s, d, "documents").join(t(s, d, "labels").where("quality is not null"), "doc_id", "left_anti").select("doc_id")


def d01(s, d):
    # digests, counted before they are sent: copies of one text, or no text, never meet in one task
    return t(s, d, "documents").groupBy(F.sha2("text", 256).alias("_text")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def d02(s, d):
    return t(s, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


def d03(s, d):
    return t(s, d, "pages").select(host().alias("host")).distinct().withColumn("marker", F.lit("done"))


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
_CH = "SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM {}"
QUERIES = {
    "j01_pending": (j01, "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "j02_two_sets": (j02, "SELECT url, page_id FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) AND url NOT IN (SELECT url FROM pages WHERE page_id % 5 = 0)"),
    "j03_any_metric_missing": (j03, "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL AND toxic <> 1)"),
    "j04_paired": (j04, "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS paired FROM documents"),
    "j05_wide": (j05, "SELECT doc_id, quality, toxic FROM labels"),
    "j06_pairs": (j06, "SELECT r_regionkey, w.n_nationkey, n.n_name FROM region CROSS JOIN nation w LEFT JOIN nation n ON n.n_nationkey = w.n_nationkey AND n.n_regionkey = r_regionkey"),
    "j07_work_list": (j07, "SELECT r_name, n_name FROM region CROSS JOIN nation"),
    "j08_new_symbols": (j08, f"SELECT ch FROM ({_CH.format("documents WHERE lang = 'de'")}) WHERE ch NOT IN ({_CH.format("documents WHERE lang = 'en'")})"),
    "j09_missing_symbols": (j09, f"WITH x AS (SELECT conv_id, turn, string_split(text, '') AS c FROM conversations WHERE role = 'user'), e AS (SELECT conv_id, turn, unnest(range(len(c))) AS pos, unnest(c) AS ch FROM x), r AS (SELECT ch, conv_id, turn, pos::INT AS pos, row_number() OVER (PARTITION BY ch ORDER BY conv_id, turn, pos) AS k FROM e) SELECT ch, conv_id, turn, pos FROM r WHERE k = 1 AND ch NOT IN ({_CH.format("documents WHERE lang = 'en'")})"),
    "j10_token_ids": (j10, f"SELECT c.ch, coalesce(v.id, 0) AS id FROM ({_CH.format('conversations')}) c LEFT JOIN (SELECT ch, unicode(ch) AS id FROM ({_CH.format("documents WHERE lang = 'en'")})) v ON c.ch = v.ch"),
    "j11_existing": (j11, "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"),
    "j12_compare_two": (j12, "WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS base FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_totalprice) AS other FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, CASE WHEN base IS NULL OR other IS NULL THEN 'FAILED' ELSE 'OK' END AS status FROM a FULL JOIN b ON a.k = b.k"),
    "j13_voices": (j13, "SELECT conv_id, turn, CASE role WHEN 'user' THEN 'voice_a' ELSE 'main' END AS voice FROM conversations"),
    "j14_first_metric_only": (j14, "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)"),
    "d01_first_wins": (d01, "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text"),
    "d02_last_wins": (d02, "SELECT user_id, event_type AS last_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1"),
    "d03_seeded": (d03, f"SELECT DISTINCT {_HOST} AS host, 'done' AS marker FROM pages"),
}
