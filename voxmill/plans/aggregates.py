"""Aggregations and reports (A family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import distance as E
from ..functions.durations import real_time_factor
from ..operators import quantiles as Q
from ..sources.store import writer
from ..sources.tables import table as t
from .scores import rates_sql, turn_pairs


def stats(c):
    return [F.round(F.avg(c), 4).alias("mean"), F.round(F.stddev_pop(c), 4).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")]


STATS_SQL = "round(avg({0}), 4) AS mean, round(stddev_pop({0}), 4) AS std, min({0}) AS min, max({0}) AS max"


def a01(s, d):
    long = t(s, d, "lineitem").selectExpr("stack(3, 'quantity', l_quantity, 'discount', l_discount, 'tax', l_tax) as (metric, value)")
    return long.where("value is not null").groupBy("metric").agg(*stats("value"))


def a02(s, d):
    return t(s, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(*stats("o_totalprice"), F.count("o_totalprice").alias("n"))


def a03(s, d):
    return t(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.avg("l_extendedprice"), 2).alias("mean"))


def a04(s, d):
    return t(s, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))


def a05(s, d):
    p = t(s, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.round(F.avg("l_quantity"), 3))
    return p.select("l_returnflag", *[F.coalesce(F.format_string("%.3f", F.col(c)), F.lit("N/A")).alias(f"status_{c.lower()}") for c in ("F", "O")])


def a06(s, d):
    return t(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))


def a07(s, d):
    return t(s, d, "events").agg(F.count("*").alias("total_files"), F.round(F.sum(F.coalesce("value", F.lit(0.0))), 2).alias("total"), F.round(F.when(F.count("*") > 0, F.sum(F.coalesce("value", F.lit(0.0))) / F.count("*")).otherwise(0.0), 2).alias("average"))


def a08(s, d):
    return t(s, d, "events").agg(F.round(F.sum("value"), 3).alias("total"), *stats("value"), F.count_if(F.col("value").isNull()).alias("errors"))


def a09(s, d):
    edge = F.when(F.col("l_quantity") < 2, 0).when(F.col("l_quantity") < 5, 1).when(F.col("l_quantity") < 10, 2).otherwise(3)
    counts = t(s, d, "lineitem").groupBy(edge.alias("bucket")).agg(F.count("*").alias("n"))
    every = s.range(4).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(F.broadcast(counts), "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))
    return filled.crossJoin(F.broadcast(filled.agg(F.sum("n").alias("_all")))).select("bucket", "n", F.round(100 * F.col("n") / F.col("_all"), 3).alias("percent"))


def a10(s, d):
    b = turn_pairs(s, d).select(E.cer(F.col("reference"), F.col("hypothesis"), "phase").alias("cer"))
    bands = [F.count_if(F.col("cer") < 0.05).alias("excellent"), F.count_if((F.col("cer") >= 0.05) & (F.col("cer") < 0.1)).alias("good"), F.count_if((F.col("cer") >= 0.1) & (F.col("cer") < 0.2)).alias("acceptable"), F.count_if(F.col("cer") >= 0.2).alias("poor")]
    return b.agg(*bands, F.round(F.avg("cer"), 6).alias("mean"), F.round(F.min("cer"), 6).alias("min"), F.round(F.max("cer"), 6).alias("max"))


def a11(s, d):
    return t(s, d, "pages").groupBy(F.coalesce(F.nullif(F.element_at(F.split("url", "/"), -2), F.lit("")), F.lit("unknown")).alias("speaker")).agg(F.sum(F.char_length("html")).alias("total"))


def a12(s, d):
    return t(s, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 1).alias("size"), F.count("*").alias("files"))


def a13(s, d):
    # the order of UTF-8 is that of code points
    return t(s, d, "documents").select(F.explode(F.array_distinct(F.split("text", ""))).alias("ch")).where("ch <> ''").distinct().orderBy("ch")


def a14(s, d):
    return turn_pairs(s, d).agg(F.round(F.avg(E.wer(F.col("reference"), F.col("hypothesis"), "filter")), 5).alias("metric"))


def a15(s, d):
    """Running sums of every kind of event over how many there are, 0 for a kind without any."""
    e = t(s, d, "events")
    kinds = e.select("event_type").distinct().unionByName(s.range(1).select(F.lit("nothing").alias("event_type")))
    sums = e.groupBy(F.col("event_type").alias("kind")).agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    return kinds.join(sums, F.col("event_type").eqNullSafe(F.col("kind")), "left").select("event_type", F.round(F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(0.0), 6).alias("mean"))


def symbols(rows, *by):
    """The different characters of the texts (of each group), one row each."""
    return rows.select(*by, F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), ""))).alias("symbol")).where("symbol <> ''").distinct()


def a16(s, d):
    docs = t(s, d, "documents")
    size = symbols(docs).agg(F.count("*").alias("vocabulary"))
    return docs.agg(F.round(F.sum("n_chars") / 3600, 2).alias("hours"), F.count("*").alias("samples")).crossJoin(size)


def a17(s, d):
    """Shards (here: sources) are counted alone; rows and bad ones add up, vocabularies are united."""
    docs = t(s, d, "documents")
    shards = docs.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_if(F.col("n_chars") < 100).alias("bad"))
    sizes = symbols(docs, "source").groupBy("source").agg(F.count("*").alias("vocabulary"))
    each = shards.join(sizes, "source", "left").select("source", "n_rows", "bad", F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"))
    # united from the shards' own vocabularies, not from the texts again
    whole = symbols(docs, "source").select("symbol").distinct().agg(F.count("*").alias("vocabulary"))
    return each.unionByName(shards.agg(F.lit("all").alias("source"), F.sum("n_rows").alias("n_rows"), F.sum("bad").alias("bad")).crossJoin(whole))


def a18(s, d):
    r = t(s, d, "documents").agg(F.max("n_chars").alias("longest"), F.sum("n_chars").alias("frames"))
    per = F.ceil(F.col("frames") / 38400)
    return r.select("longest", per.alias("updates_per_epoch"), F.floor(1_200_000 / per).alias("epochs"))


def a19(s, d):
    r = t(s, d, "labels").agg(F.count("quality").alias("q"), F.count("toxic").alias("x"))
    return r.select(F.least("q", "x").alias("completed"))


def a20(s, d):
    """Box plots: quartiles, and whiskers at the last values within one and a half times their distance."""
    rows = t(s, d, "lineitem").select("l_returnflag", "l_extendedprice")
    box = Q.quantiles(rows, ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "median": 0.5, "q3": 0.75}, writer(s))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x, flag = F.col("l_extendedprice"), F.col("l_returnflag")
    met = rows.join(box.select(flag.alias("flag"), "q1", "q3"), flag.eqNullSafe(F.col("flag")))
    ends = met.groupBy("flag").agg(F.min(F.when(x >= F.col("q1") - reach, x)).alias("low"), F.max(F.when(x <= F.col("q3") + reach, x)).alias("high"), F.count_if((x < F.col("q1") - reach) | (x > F.col("q3") + reach)).alias("outliers"))
    return box.join(ends, flag.eqNullSafe(F.col("flag"))).select("l_returnflag", "q1", "median", "q3", "low", "high", "outliers", Q.bins_for(F.col("n")).alias("bins"))


def a20_histogram(s, d):
    return Q.histogram(t(s, d, "lineitem"), ["l_returnflag"], "l_extendedprice").select("l_returnflag", "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


#: What takes each metric to 0 to 1 (lower is better for the first two): shift and scale.
AXES = {"mcd": "1 - x / 15", "wer": "1 - x", "pesq": "(x + 0.5) / 5", "stoi": "x", "utmos": "(x - 1) / 4", "f0_correlation": "(x + 1) / 2"}


def axis(metric, value):
    """A metric's value on its axis from 0 to 1; an unknown metric's value as it is, within 0 and 1."""
    on = value
    for name, formula in AXES.items():
        on = F.when(metric == name, F.expr(formula)).otherwise(on)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), on))


def a21(s, d):
    names = F.array(*[F.lit(x) for x in (*AXES, "other")])
    rows = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(names, (F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(AXES) + 1)) + 1).cast("int")).alias("metric"), (F.col("l_quantity") / 10 - 0.5).alias("x"))
    return rows.select("l_orderkey", "l_linenumber", "metric", F.round(axis(F.col("metric"), F.col("x")), 6).alias("axis"))


def a22(s, d):
    return t(s, d, "events").groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.round(F.avg("value"), 4)).select("user_id", F.coalesce("click", F.lit(0.0)).alias("click"), F.coalesce("view", F.lit(0.0)).alias("view_"))


def a23(s, d):
    known = s.createDataFrame([("click",), ("purchase",)], "event_type string")
    return t(s, d, "events").join(F.broadcast(known), "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


METRICS = ("click", "purchase")


def a23_files(s, d):
    """Results by files (here: events by type): a sample of a metric that is unknown keeps a row without one, and its value goes
    to the sample's other metrics only if these are known."""
    e = t(s, d, "events").where("value is not null").select(F.pmod("event_id", F.lit(997)).alias("sample_id"), "event_id", "event_type", "value")
    cells = [F.max_by(F.when(F.col("event_type") == m, F.col("value")), F.when(F.col("event_type") == m, F.col("event_id"))).alias(m) for m in METRICS]
    return e.groupBy("sample_id").agg(*cells)


def a26(s, d):
    """Real-time factors: seconds of synthesis (here: prices) for a second of sound."""
    rtf = real_time_factor(F.col("l_extendedprice") / 1000, F.col("l_quantity") - 1)
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber", rtf.alias("rtf"))


def a24(s, d):
    h = t(s, d, "documents").agg((F.sum("n_chars") / 3600.0).alias("hours"))
    return h.select(F.ceil(1000 / F.greatest("hours", F.lit(0.01))).alias("epochs"))


def a25(s, d):
    """The report's total: the one it had, or the pairs there are and those processed that were moved away, if that is more."""
    # labels are the pairs there are, documents the ones processed; the old report counted every third document twice
    pairs, done = t(s, d, "labels").select("doc_id").distinct(), t(s, d, "documents").select("doc_id").distinct()
    old = done.where("doc_id % 3 = 0").agg((2 * F.count("*")).alias("old"))
    moved = done.join(pairs, "doc_id", "left_anti").agg(F.count("*").alias("moved"))
    return pairs.agg(F.count("*").alias("now")).crossJoin(moved).crossJoin(old).select("old", "now", "moved", F.greatest("old", F.col("now") + F.col("moved")).alias("total"))


QUERIES = {
    "a01_metric_summary": (a01, f"SELECT metric, {STATS_SQL.format('value')} FROM (SELECT unnest(['quantity', 'discount', 'tax']) AS metric, unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem) WHERE value IS NOT NULL GROUP BY 1"),
    "a02_grouped_summary": (a02, f"SELECT o_orderstatus, o_orderpriority, {STATS_SQL.format('o_totalprice')}, count(o_totalprice) AS n FROM orders GROUP BY 1, 2"),
    "a03_group_mean": (a03, "SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 2) AS mean FROM lineitem GROUP BY 1, 2"),
    "a04_pivot": (a04, 'SELECT o_orderpriority, nullif(count(*) FILTER (o_orderstatus = \'F\'), 0) AS "F", nullif(count(*) FILTER (o_orderstatus = \'O\'), 0) AS "O", nullif(count(*) FILTER (o_orderstatus = \'P\'), 0) AS "P" FROM orders GROUP BY 1'),
    "a05_mean_or_na": (a05, "SELECT l_returnflag, coalesce(printf('%.3f', round(avg(l_quantity) FILTER (l_linestatus = 'F'), 3)), 'N/A') AS status_f, coalesce(printf('%.3f', round(avg(l_quantity) FILTER (l_linestatus = 'O'), 3)), 'N/A') AS status_o FROM lineitem GROUP BY 1"),
    "a06_value_counts": (a06, "SELECT lang, count(*) AS n FROM documents GROUP BY 1"),
    "a07_stats": (a07, "SELECT count(*) AS total_files, round(sum(coalesce(value, 0)), 2) AS total, round(CASE WHEN count(*) > 0 THEN sum(coalesce(value, 0)) / count(*) ELSE 0 END, 2) AS average FROM events"),
    "a08_duration_stats": (a08, f"SELECT round(sum(value), 3) AS total, {STATS_SQL.format('value')}, count(*) FILTER (value IS NULL) AS errors FROM events"),
    "a09_histogram": (a09, "WITH c AS (SELECT CASE WHEN l_quantity < 2 THEN 0 WHEN l_quantity < 5 THEN 1 WHEN l_quantity < 10 THEN 2 ELSE 3 END AS bucket, count(*) AS n FROM lineitem GROUP BY 1), f AS (SELECT b.bucket::INT AS bucket, coalesce(n, 0) AS n FROM (SELECT unnest(range(4)) AS bucket) b LEFT JOIN c ON b.bucket = c.bucket) SELECT bucket, n, round(100 * n / sum(n) OVER (), 3) AS percent FROM f"),
    "a10_error_bands": (a10, f"{rates_sql('phase')} SELECT count(*) FILTER (cer < 0.05) AS excellent, count(*) FILTER (cer >= 0.05 AND cer < 0.1) AS good, count(*) FILTER (cer >= 0.1 AND cer < 0.2) AS acceptable, count(*) FILTER (cer >= 0.2) AS poor, round(avg(cer), 6) AS mean, round(min(cer), 6) AS min, round(max(cer), 6) AS max FROM rates"),
    "a11_per_speaker": (a11, "SELECT coalesce(nullif(string_split(url, '/')[-2], ''), 'unknown') AS speaker, sum(length(html))::BIGINT AS total FROM pages GROUP BY 1"),
    "a12_sizes": (a12, "SELECT l_suppkey, round(sum(l_extendedprice), 1) AS size, count(*) AS files FROM lineitem GROUP BY 1"),
    "a13_vocabulary": (a13, "SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents"),
    "a14_micro_average": (a14, f"{rates_sql('filter')} SELECT round(avg(wer), 5) AS metric FROM rates"),
    "a15_mean_or_zero": (a15, "SELECT event_type, round(coalesce(sum(value) / nullif(count(value), 0), 0), 6) AS mean FROM events GROUP BY 1 UNION ALL SELECT 'nothing', 0.0::DOUBLE"),
    "a16_hours": (a16, "SELECT round(sum(n_chars) / 3600, 2) AS hours, count(*) AS samples, (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '') AS vocabulary FROM documents"),
    "a17_shard_merge": (a17, "WITH c AS (SELECT DISTINCT source, unnest(string_split(text, '')) AS c FROM documents), v AS (SELECT source, count(*) AS v FROM c WHERE c <> '' GROUP BY 1) SELECT d.source, count(*) AS n_rows, count(*) FILTER (n_chars < 100) AS bad, coalesce(max(v), 0) AS vocabulary FROM documents d LEFT JOIN v ON v.source = d.source GROUP BY 1 UNION ALL SELECT 'all', count(*), count(*) FILTER (n_chars < 100), (SELECT count(DISTINCT c) FROM c WHERE c <> '') FROM documents"),
    "a18_training_plan": (a18, "WITH r AS (SELECT max(n_chars) AS longest, ceil(sum(n_chars) / 38400)::BIGINT AS u FROM documents) SELECT longest, u AS updates_per_epoch, floor(1200000 / u)::BIGINT AS epochs FROM r"),
    "a19_completed": (a19, "SELECT least(count(quality), count(toxic)) AS completed FROM labels"),
    "a20_quartiles": (a20, "WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3, count(*) AS n FROM lineitem GROUP BY 1) SELECT q.l_returnflag, q1, median, q3, min(l_extendedprice) FILTER (l_extendedprice >= q1 - (q3 - q1) * 1.5::DOUBLE) AS low, max(l_extendedprice) FILTER (l_extendedprice <= q3 + (q3 - q1) * 1.5::DOUBLE) AS high, count(*) FILTER (l_extendedprice < q1 - (q3 - q1) * 1.5::DOUBLE OR l_extendedprice > q3 + (q3 - q1) * 1.5::DOUBLE) AS outliers, greatest(5, least(20, n // 2))::INT AS bins FROM lineitem l JOIN q ON l.l_returnflag IS NOT DISTINCT FROM q.l_returnflag GROUP BY ALL"),
    "a20_histogram": (a20_histogram, "WITH e AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, greatest(5, least(20, count(*) // 2))::INT AS bins FROM lineitem GROUP BY 1), c AS (SELECT l.l_returnflag, least(bins - 1, floor((l_extendedprice - lo) / ((hi - lo) / bins)))::INT AS bin, count(*) AS n FROM lineitem l JOIN e ON l.l_returnflag = e.l_returnflag GROUP BY 1, 2), b AS (SELECT *, unnest(range(bins))::INT AS bin FROM e) SELECT b.l_returnflag, b.bin, round(lo + (hi - lo) / bins * b.bin, 6) AS low, round(lo + (hi - lo) / bins * (b.bin + 1), 6) AS high, coalesce(n, 0) AS n FROM b LEFT JOIN c ON b.l_returnflag = c.l_returnflag AND b.bin = c.bin"),
    "a21_radar_axis": (a21, "WITH l AS (SELECT l_orderkey, l_linenumber, ['mcd', 'wer', 'pesq', 'stoi', 'utmos', 'f0_correlation', 'other'][(l_orderkey + l_linenumber) % 7 + 1] AS metric, l_quantity / 10 - 0.5::DOUBLE AS x FROM lineitem) SELECT l_orderkey, l_linenumber, metric, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE metric WHEN 'mcd' THEN 1 - x / 15 WHEN 'wer' THEN 1 - x WHEN 'pesq' THEN (x + 0.5::DOUBLE) / 5 WHEN 'utmos' THEN (x - 1) / 4 WHEN 'f0_correlation' THEN (x + 1) / 2 ELSE x END)), 6) AS axis FROM l"),
    "a22_model_comparison": (a22, "SELECT user_id, coalesce(round(avg(value) FILTER (event_type = 'click'), 4), 0.0) AS click, coalesce(round(avg(value) FILTER (event_type = 'view'), 4), 0.0) AS view_ FROM events GROUP BY 1"),
    "a23_known_metrics": (a23, "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1"),
    "a23_by_files": (a23_files, "SELECT event_id % 997 AS sample_id, arg_max(value, event_id) FILTER (event_type = 'click') AS click, arg_max(value, event_id) FILTER (event_type = 'purchase') AS purchase FROM events WHERE value IS NOT NULL GROUP BY 1"),
    "ext_real_time_factor": (a26, "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 1 THEN l_extendedprice / 1000 / (l_quantity - 1) END AS rtf FROM lineitem"),
    "a24_epochs": (a24, "SELECT ceil(1000 / greatest(sum(n_chars) / 3600.0, 0.01))::BIGINT AS epochs FROM documents"),
    "a25_report_total": (a25, "WITH r AS (SELECT (SELECT 2 * count(*) FROM documents WHERE doc_id % 3 = 0) AS old, (SELECT count(DISTINCT doc_id) FROM labels) AS now, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS moved) SELECT old, now, moved, greatest(old, now + moved) AS total FROM r"),
}
