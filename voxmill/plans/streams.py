"""Structured Streaming queries (R family) over the events table; each runs through what is there and reads its output."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.store import exists, place
from ..sources.tables import table as t
from ..streaming import jobs, timers


def events(s, d, files=None):
    return jobs.followed(s, d, t(s, d, "events").schema, glob="events.parquet", files=files)


def r01(s, d):
    out = place(s)
    jobs.saved(events(s, d).where("value > 10").select("event_id", "user_id", "value"), f"{out}/rows", f"{out}/state").awaitTermination()
    return s.read.parquet(f"{out}/rows")


def r03(s, d):
    out, state = place(s), place(s)
    for _ in range(2):
        jobs.saved_batches(events(s, d).select("event_id", "event_type"), out, state).awaitTermination()
    return s.read.parquet(out).select("event_id", "event_type")


def r05(s, d):
    out = place(s)
    jobs.saved_batches(events(s, d, 1), out, f"{out}-state", lambda b: b.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))).awaitTermination()
    return s.read.parquet(out).groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("v"), 4).alias("total"))


def r06(s, d):
    out = place(s)
    jobs.charted(events(s, d).groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("most")), f"{out}/chart", f"{out}/state").awaitTermination()
    return s.read.parquet(f"{out}/chart")


def r06_progress(s, d):
    """Files read a micro-batch each; what the listener heard of them, to the last share of the whole."""
    at = place(s)
    rows = t(s, d, "events").select("event_id", "event_type")
    rows.repartition(6, "event_type").write.parquet(f"{at}/in")
    heard = []
    with jobs.watched(s, jobs.Progress(rows.count(), lambda seen, share: heard.append((seen, share)))) as progress:
        jobs.saved(jobs.followed(s, f"{at}/in", rows.schema, files=1), f"{at}/out", f"{at}/state").awaitTermination()
        told = progress.rows(s)
    last = s.createDataFrame([max(heard, default=(0, None))], "seen long, share double")
    return told.agg(F.sum("rows").alias("n_rows")).crossJoin(F.broadcast(last))


#: Event types that end a job, and the hours after which silence does.
ENDS, PATIENCE = {"purchase": "completed", "error": "failed"}, 12


def r07(s, d):
    """Jobs (users) whose events come in four lots of time, each a run of the same query on one checkpoint."""
    at = place(s)
    rows = t(s, d, "events").select(F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"), F.col("event_type").alias("status"))
    low, high = rows.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    lot = F.floor((F.unix_millis("ts") - F.lit(low or 0)) / F.lit(float((high or 0) - (low or 0) + 1)) * 4)
    with timers.rocks(s):
        for k in range(4):
            rows.where(lot == k).write.mode("append").parquet(f"{at}/in")
            states = timers.job_states(jobs.followed(s, f"{at}/in", rows.schema), ENDS, PATIENCE * 3_600_000)
            saved = jobs.saved_batches(states, f"{at}/out", f"{at}/state")
            saved.awaitTermination()
    found = s.read.schema("job_id long, status string, n long, batch long").parquet(f"{at}/out")
    return found.groupBy("job_id").agg(F.max_by("status", "batch").alias("status"), F.max_by("n", "batch").alias("n"))


def r10(s, d):
    from ..functions.models import first_good

    c = t(s, d, "conversations")
    primary, secondary = F.when(F.col("turn") % 3 != 0, F.col("text")), F.concat(F.lit("~ "), "text")
    said = first_good([primary, secondary], lambda x: F.char_length(x).between(20, 400))
    return c.select("conv_id", "turn", said.alias("said"), F.when(said.isNull(), "rejected").when(said == primary, "primary").otherwise("secondary").alias("route"))


def r11(s, d):
    from ..functions.text import uniform

    e = t(s, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    made = e.withColumn("reference", F.floor(uniform(F.col("s_suppkey"), F.col("attempt")) * 100).cast("int"))
    return made.where("reference < 60").groupBy("s_suppkey").agg(F.min("attempt").alias("attempt"), F.min_by("reference", "attempt").alias("reference"))


def r02(s, d):
    """A folder that is polled for ever: stopped here once all that is there was read."""
    out = place(s)
    q = jobs.saved(events(s, d).where("event_id % 2 = 0").select("event_id", "user_id"), f"{out}/rows", f"{out}/state", every="1 second")
    q.processAllAvailable()
    q.stop()
    return s.read.parquet(f"{out}/rows")


def r04(s, d):
    """What was read is moved to an archive, never deleted: in the end each row was read once, and stands in one of the folders."""
    at = place(s)
    rows = t(s, d, "supplier").select("s_suppkey", "s_name")
    for k in range(3):
        rows.where(F.col("s_suppkey") % 3 == k).coalesce(1).write.parquet(f"{at}/in/{k}")
        follow = jobs.followed(s, f"{at}/in", rows.schema, glob="*.parquet", files=1, archive=f"{at}/done", deep=True)
        jobs.saved(follow, f"{at}/out", f"{at}/state").awaitTermination()
    kept = s.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(at + "/in", *([f"{at}/done"] if exists(s, f"{at}/done") else []))
    return s.read.parquet(f"{at}/out").join(kept.groupBy("s_suppkey").agg(F.count("*").alias("copies")), "s_suppkey").select("s_suppkey", "s_name", "copies")


def r08(s, d):
    """Chunks of what is said, in order, and behind the last one a mark that the text is over."""
    from ..functions.text import bound, chunks

    c = t(s, d, "conversations").where("text <> ''")
    parts = bound(chunks(F.col("text"), 60), lambda p: F.concat(F.transform(p, lambda x: F.struct(x.alias("chunk"), F.lit(False).alias("end"))), F.array(F.struct(F.lit(None).cast("string").alias("chunk"), F.lit(True).alias("end")))))
    each = c.select("conv_id", "turn", F.posexplode(parts).alias("seq", "x"))
    # what a reader needs: all that was said, whether the mark comes last, and once
    return each.groupBy("conv_id", "turn").agg(F.max_by("x.end", "seq").alias("ended"), F.count_if("x.end").alias("marks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x.chunk"))), lambda y: F.regexp_replace(F.coalesce(y["chunk"], F.lit("")), r"(?U)\s", "")), "").alias("said"))


def r12(s, d):
    """Requests for models in their order; one model is held, and another one takes its place."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("event_type").over(w)
    loads = F.when(before.isNull() | (before != F.col("event_type")), 1).otherwise(0)
    return t(s, d, "events").where("event_type is not null").select("user_id", "event_type", loads.alias("load"), F.when(before.isNotNull() & (before != F.col("event_type")), 1).otherwise(0).alias("evict")).groupBy("user_id").agg(F.sum("load").alias("loads"), F.sum("evict").alias("evictions"), F.count("*").alias("requests"))


QUERIES = {
    "r01_available_now": (r01, "SELECT event_id, user_id, value FROM events WHERE value > 10"),
    "r02_polled": (r02, "SELECT event_id, user_id FROM events WHERE event_id % 2 = 0"),
    "r04_archived": (r04, "SELECT s_suppkey, s_name, 1::BIGINT AS copies FROM supplier"),
    "r08_chunked_output": (r08, "SELECT conv_id, turn, true AS ended, 1::BIGINT AS marks, regexp_replace(text, '[\\s\\p{Z}]', '', 'g') AS said FROM conversations WHERE text <> ''"),
    "r12_single_slot": (r12, "WITH e AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events WHERE event_type IS NOT NULL) SELECT user_id, count(*) FILTER (b IS NULL OR b <> event_type) AS loads, count(*) FILTER (b <> event_type) AS evictions, count(*) AS requests FROM e GROUP BY 1"),
    "r03_exactly_once": (r03, "SELECT event_id, event_type FROM events"),
    "r05_batch_saves": (r05, "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"),
    "r06_live_chart": (r06, "SELECT event_type, count(*) AS n, max(value) AS most FROM events GROUP BY 1"),
    "r06_progress": (r06_progress, "SELECT count(*) AS n_rows, count(*) AS seen, 1.0::DOUBLE AS share FROM events"),
    "r07_job_states": (r07, f"WITH e AS (SELECT user_id, epoch_ms(ts) AS ms, event_type, row_number() OVER w AS k, lead(epoch_ms(ts)) OVER w AS then_ms FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE CASE WHEN coalesce(then_ms, (SELECT max(ms) - 1000 FROM e)) - ms >= {PATIENCE * 3_600_000} THEN 'timeout' END END AS ended FROM e) SELECT user_id AS job_id, coalesce(arg_min(ended, k) FILTER (ended IS NOT NULL), 'processing') AS status, coalesce(min(k) FILTER (ended IS NOT NULL), count(*)) AS n FROM s GROUP BY 1"),
    "r10_fallbacks": (r10, "WITH c AS (SELECT *, CASE WHEN turn % 3 <> 0 AND length(text) BETWEEN 20 AND 400 THEN text END AS p, CASE WHEN length('~ ' || text) BETWEEN 20 AND 400 THEN '~ ' || text END AS q FROM conversations) SELECT conv_id, turn, coalesce(p, q) AS said, CASE WHEN p IS NOT NULL THEN 'primary' WHEN q IS NOT NULL THEN 'secondary' ELSE 'rejected' END AS route FROM c"),
    "r11_retries": (r11, "WITH a AS (SELECT s_suppkey, unnest([1, 2, 3]) AS attempt FROM supplier), h AS (SELECT *, floor(('0x' || substr(md5(s_suppkey || ':' || attempt), 1, 8))::BIGINT / 4294967296 * 100)::INT AS reference FROM a) SELECT s_suppkey, min(attempt)::INT AS attempt, arg_min(reference, attempt) AS reference FROM h WHERE reference < 60 GROUP BY 1"),
}
