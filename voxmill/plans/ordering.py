"""Ordering, limits, prefixes, splits and islands (O and W families)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources.tables import table as t
from .joins import host


def o02(s, d):
    return t(s, d, "orders").orderBy("o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


def o03(s, d):
    return t(s, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total")).orderBy(F.desc("total"), "l_suppkey").limit(10)


def o04(s, d):
    p = t(s, d, "pages").select("page_id", "url")
    marker = p.agg(F.min(F.when(F.col("page_id") == 20, F.col("url"))).alias("_m"))
    return p.crossJoin(F.broadcast(marker)).where("_m is null or url > _m").select("page_id")


def o05(s, d):
    return t(s, d, "orders").where("o_orderkey > 200").select("o_orderkey")


def o06(s, d):
    # the first row that isn't done bounds the prefix: one minimum instead of a window over all rows
    o = t(s, d, "orders")
    stop = o.where("o_orderstatus = 'P'").agg(F.min("o_orderkey").alias("_stop"))
    return o.crossJoin(F.broadcast(stop)).where("_stop is null or o_orderkey < _stop").agg(F.max("o_orderkey").alias("checkpoint"), F.count("*").alias("n"))


def o07(s, d):
    return R.capped(t(s, d, "pages").select("page_id", host().alias("host")), "host", ["page_id"], 5, 60).select("page_id", "host")


def o08(s, d):
    n = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    return t(s, d, "part").select("p_partkey", F.when(F.col("p_size") < 5, 0).when(F.col("p_size") > 45, 2).otherwise(1).alias("rank"), n.alias("step")).orderBy("rank", "step", "p_partkey")


def o09(s, d):
    return R.numbered(t(s, d, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", F.pmod("_k", F.lit(4)).cast("int").alias("shard"))


def o10(s, d):
    o = t(s, d, "orders").select("o_orderkey")
    each = F.floor(F.lit(o.count()) / 4) + 1
    return R.numbered(o, "o_orderkey").select("o_orderkey", F.floor(F.col("_k") / each).cast("int").alias("chunk"))


def o11(s, d):
    return t(s, d, "supplier").agg(F.coalesce(F.max(F.regexp_extract("s_name", "([0-9]+)$", 1).cast("long")) + 1, F.lit(0)).alias("next_index"))


def o12(s, d):
    o = t(s, d, "orders")
    done = o.where("o_orderkey % 3 = 0").groupBy("o_orderstatus").agg(F.count("*").alias("_done"))
    pending = R.numbered(o.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus"), "o_orderkey", ["o_orderstatus"]).join(F.broadcast(done), "o_orderstatus", "left")
    return pending.select("o_orderkey", "o_orderstatus", (F.coalesce("_done", F.lit(0)) + F.col("_k")).alias("turn")).orderBy("turn", "o_orderstatus")


def o13(s, d):
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_partkey")))
    return t(s, d, "part").where("p_size < 40").withColumn("k", k).where("k > 3").select("p_partkey", "p_brand")


def o14(s, d):
    rank = F.when(F.col("p_size") > 45, 2).when(F.col("p_size") > 5, 1).otherwise(0)
    return t(s, d, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct(rank, "p_partkey")).alias("latest"))


def w01(s, d):
    e = t(s, d, "events").select("user_id", "ts", "event_id", (F.col("value") < 10).alias("quiet"))
    return R.islands(e.where("quiet is not null"), ["user_id"], ["ts", "event_id"], "quiet").where("quiet and n >= 2").select("user_id", "run", "n")


QUERIES = {
    "o02_prefix": (o02, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY 1 LIMIT 50"),
    "o03_top_speakers": (o03, "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1 ORDER BY total DESC, l_suppkey LIMIT 10"),
    "o04_after_marker": (o04, "SELECT page_id FROM pages WHERE (SELECT min(url) FROM pages WHERE page_id = 20) IS NULL OR url > (SELECT min(url) FROM pages WHERE page_id = 20)"),
    "o05_high_water": (o05, "SELECT o_orderkey FROM orders WHERE o_orderkey > 200"),
    "o06_done_prefix": (o06, "SELECT max(o_orderkey) AS checkpoint, count(*) AS n FROM orders WHERE o_orderkey < coalesce((SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'P'), 9223372036854775807)"),
    "o07_capped": (o07, "WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages), k AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS k FROM h), g AS (SELECT *, row_number() OVER (ORDER BY host, k) AS r FROM k WHERE k <= 5) SELECT page_id, host FROM g WHERE r <= 60"),
    "o08_pinned_sort": (o08, "SELECT p_partkey, CASE WHEN p_size < 5 THEN 0 WHEN p_size > 45 THEN 2 ELSE 1 END AS rank, regexp_extract(p_brand, '([0-9]+)', 1)::INT AS step FROM part ORDER BY 2, 3, 1"),
    "o09_round_robin": (o09, "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) % 4)::INT AS shard FROM orders"),
    "o10_chunks": (o10, "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // (count(*) OVER () // 4 + 1))::INT AS chunk FROM orders"),
    "o11_next_index": (o11, "SELECT coalesce(max(try_cast(nullif(regexp_extract(s_name, '([0-9]+)$', 1), '') AS BIGINT)) + 1, 0) AS next_index FROM supplier"),
    "o12_fair_schedule": (o12, "WITH d AS (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), p AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders WHERE o_orderkey % 3 <> 0) SELECT o_orderkey, p.o_orderstatus, coalesce(n, 0) + k - 1 AS turn FROM p LEFT JOIN d ON p.o_orderstatus = d.o_orderstatus ORDER BY turn, 2"),
    "o13_expired": (o13, "SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS k FROM part WHERE p_size < 40) WHERE k > 3"),
    "o14_latest": (o14, "SELECT p_brand, p_partkey AS latest FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size > 45 THEN 2 WHEN p_size > 5 THEN 1 ELSE 0 END DESC, p_partkey DESC) AS k FROM part) WHERE k = 1"),
    "w01_quiet_runs": (w01, "WITH e AS (SELECT user_id, ts, event_id, value < 10 AS q FROM events WHERE value IS NOT NULL), m AS (SELECT *, CASE WHEN lag(q) OVER w IS NULL OR lag(q) OVER w <> q THEN 1 ELSE 0 END AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m) SELECT user_id, run::BIGINT AS run, count(*) AS n FROM r WHERE q GROUP BY 1, 2 HAVING count(*) >= 2"),
}
