"""Sources and sinks (S family, with H, J and R operators on files): each query writes files made of the tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import sinks, store, tables
from ..sources.tables import table as t


def lines(rows, path: str, *columns) -> str:
    """Text lines of the columns, parted by `|`."""
    rows.select(F.concat_ws("|", *columns)).write.text(path)
    return path


def customers(s, d):
    return t(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment")


def s01(s, d):
    # Arrow shards beside Parquet ones are not read
    at = store.place(s)
    customers(s, d).where("c_custkey % 2 = 0").write.parquet(f"{at}/x/parquet")
    tables.write_shards(customers(s, d), f"{at}/x/arrow")
    return tables.columnar(s, f"{at}/x")


def s02(s, d):
    at = store.place(s)
    customers(s, d).where("c_custkey % 2 = 0").write.parquet(f"{at}/x/parquet")
    tables.write_shards(customers(s, d).where("c_custkey % 2 = 1").drop("c_mktsegment"), f"{at}/x/arrow")
    return tables.columnar(s, f"{at}/x", both=True)


def s03(s, d):
    at = store.place(s)
    tables.write_shards(customers(s, d), f"{at}/arrow")
    return tables.columnar(s, at, "c_custkey long, c_name string, c_mktsegment string")


def s04(s, d):
    at = store.place(s)
    store.write_files(t(s, d, "nation").select(F.concat("n_name", F.lit(".csv")).alias("name"), F.concat(F.lit("key,name\n"), "n_nationkey", F.lit(","), "n_name", F.lit("\n")).alias("content")), at)
    paths = [r[0] for r in tables.files(s, at, "*A*.csv").select("uri").orderBy("path").collect()]
    return tables.matched_files(s, paths).select(F.col("key").cast("int").alias("n_nationkey"), F.col("name").alias("n_name"))


#: Bytes of samples that stand in a file of speech_folder as they are; silence behind them is told by its length.
STORED = 1600


def speech_folder(s, d) -> str:
    """wavs/<nation>/<supplier>.wav of s_suppkey / 100 seconds, and texts beside those of suppliers that owe nothing.

    All that is heard is silence, so longer files are lists of a tenth of a second of samples and a silence that lasts for the rest: the files
    would else grow with the square of the suppliers.
    """
    at = f"{store.place(s)}/corpus"
    sup = t(s, d, "supplier").select("s_suppkey", "s_acctbal", F.concat(F.lit("wavs/"), F.col("s_nationkey"), F.lit("/"), F.replace("s_name", F.lit("#"), F.lit("_"))).alias("stem"))

    def little(n, width: int):
        h = F.lpad(F.hex(n.cast("long")), width * 2, "0")
        return F.concat(*[F.substring(h, 2 * k + 1, 2) for k in range(width - 1, -1, -1)])

    def hexed(b: bytes):
        return F.lit("".join(f"{x:02X}" for x in b))

    size = F.col("s_suppkey").cast("long") * 160
    fmt = b"fmt " + (16).to_bytes(4, "little") + (1).to_bytes(2, "little") * 2 + (8000).to_bytes(4, "little") + (16000).to_bytes(4, "little") + b"\2\0\20\0"
    # an odd chunk whose content looks like the head of another one stands before the samples
    note = b"LIST" + (9).to_bytes(4, "little") + b"data\1\0\0\0x" + b"\0"
    plain = F.concat(hexed(b"data"), little(size, 4), F.repeat(F.lit("00"), F.least(size, F.lit(STORED)).cast("int")))
    listed = b"LIST" + (24 + STORED).to_bytes(4, "little") + b"wavldata" + STORED.to_bytes(4, "little") + bytes(STORED) + b"slnt" + (4).to_bytes(4, "little")
    longer = size > STORED
    samples = F.when(longer, F.concat(hexed(listed), little((size - STORED) / 2, 4))).otherwise(plain)
    head = F.concat(hexed(b"RIFF"), little(F.when(longer, len(listed) + 4).otherwise(size + 8) + 4 + len(fmt) + len(note), 4), hexed(b"WAVE" + fmt + note))
    wav = sup.select(F.concat("stem", F.lit(".wav")).alias("name"), F.unhex(F.concat(head, samples)).alias("content"))
    texts = sup.where("s_acctbal >= 0").select(F.concat("stem", F.lit(".txt")).alias("name"), F.concat(F.lit("said "), F.col("s_suppkey")).alias("content"))
    store.write_files(wav.unionByName(texts.withColumn("content", F.col("content").cast("binary"))), at)
    return at


def s05(s, d):
    pairs, missing = tables.sidecars(s, speech_folder(s, d))
    return pairs.select("stem", "text").unionByName(missing.select("stem", F.lit(None).cast("string").alias("text")))


def s06(s, d):
    return tables.wav_durations(s, speech_folder(s, d)).select("path", F.round("seconds", 6).alias("seconds"))


def s07(s, d):
    at = store.place(s)
    docs = t(s, d, "customer")
    path = F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.concat(F.lit("wavs/"), "c_name", F.lit(".wav")))
    lines(docs, at, path, F.when(F.col("c_custkey") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.col("c_mktsegment"), F.lit(' "x"'))), F.lit("1.5"))
    there = docs.where("c_custkey % 3 <> 0").select(F.concat(F.lit("wavs/"), "c_name", F.lit(".wav")).alias("path"))
    return tables.manifest(s, at, there)


def s08(s, d):
    at = store.place(s)
    rows = t(s, d, "nation").orderBy("n_nationkey").select(F.concat("n_name", F.lit('|"say ""'), "n_nationkey", F.lit('"" | now"')).alias("x"))
    store.write_bytes(s, f"{at}/m.csv", ("﻿wav|text\n" + "\n".join(r[0] for r in rows.collect()) + "\n").encode())
    return tables.headed_manifest(s, f"{at}/m.csv")


def s09(s, d):
    at = store.place(s)
    lines(t(s, d, "customer"), at, F.col("c_name"), F.col("c_mktsegment"), F.when(F.col("c_custkey") % 4 == 0, "third"))
    return tables.strict_manifest(s, at)


def s10(s, d):
    at = store.place(s)
    lines(t(s, d, "customer"), at, F.col("c_name"), F.col("c_mktsegment"), F.lower("c_mktsegment"))
    return tables.three_fields(s, at)


def s11(s, d):
    at = store.place(s)
    lines(t(s, d, "customer"), at, F.concat(F.lit("u"), "c_custkey"), F.lit("prompt"), F.lit("p.wav"), F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("own/"), "c_custkey", F.lit(".wav"))))
    return tables.listed_utterances(s, at)


def s12(s, d):
    at = store.place(s)
    utt = F.concat_ws("-", "s_nationkey", "s_suppkey", F.lit("0001"))
    t(s, d, "supplier").select(F.concat_ws("\t", utt, F.lit("2.5"), F.lit("ref"), utt, F.lit("3.5"), F.lower("s_name"))).write.text(at)
    return tables.spoken_chapters(s, at, "clean")


def s13(s, d):
    at = store.place(s)
    store.write_files(t(s, d, "supplier").select(F.concat("s_suppkey", F.lit(".txt")).alias("name"), F.concat(F.lit("a"), "s_suppkey", F.lit("\t said "), "s_suppkey", F.lit(" \nsecond\tline\n")).alias("content")), at)
    return tables.first_lines(s, at)


def s14(s, d):
    at = store.place(s)
    rows = t(s, d, "conversations").select(F.to_json(F.struct(F.col("role").alias("language"), F.concat_ws("-", "conv_id", "turn").alias("wav"), "text", (F.char_length("text") / 16).alias("duration"))).alias("value"), "turn")
    rows.select(F.when(F.col("turn") % 4 == 3, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))).write.text(at)
    return tables.json_lines(s, at, "language string, wav string, text string, duration double").select("language", "wav", F.char_length("text").alias("n_chars"), F.round("duration", 4).alias("duration"))


def urls(s, d):
    return t(s, d, "pages").select("page_id", F.concat(F.lit(" "), F.regexp_extract("url", "^([a-z]+://[^/?#]+)", 1), F.lit(" ")).alias("url"))


def s15(s, d):
    """A list for each 40 pages: their sites, before them the first one again, an empty text and a number."""
    at = store.place(s)
    sites = urls(s, d).withColumn("list", F.floor(F.col("page_id") / 40).cast("string"))
    each = sites.groupBy("list").agg(F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("held"))
    whole = F.concat(F.array(F.col("held")[0]["url"], F.lit(""), F.lit("7")), F.col("held.url"))
    store.write_files(each.select(F.concat("list", F.lit(".json")).alias("name"), F.replace(F.to_json(whole), F.lit('"7"'), F.lit("7")).alias("content")), at)
    return tables.url_lists(s, at)


def s16(s, d):
    # a document each, some of them broken, some of another kind: these count as empty
    at = store.place(s)
    value = F.when(F.col("n_nationkey") % 5 == 0, "{broken").when(F.col("n_nationkey") % 5 == 1, "[1, 2]").otherwise(F.to_json(F.struct(F.col("n_name").alias("name"))))
    store.write_files(t(s, d, "nation").select(F.concat("n_nationkey", F.lit(".json")).alias("name"), value.alias("content")), at)
    read = s.read.text(at, wholetext=True).select(F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -1), ".", 1).cast("int").alias("n_nationkey"), "value")
    return read.select("n_nationkey", F.from_json("value", "name string").getField("name").alias("name"))


def s17(s, d):
    at = store.place(s)
    urls(s, d).select(F.when(F.col("page_id") % 6 == 0, None).when(F.col("page_id") % 6 == 1, "  ").otherwise(F.col("url")).alias("url"), F.lit("x").alias("title")).write.option("header", True).csv(at)
    return tables.sheet(s, at)


def s18(s, d):
    """A report of all metrics but one, that nothing measured; texts with quotes and line breaks come back as they were."""
    at = store.place(s)
    n, q = F.col("n_chars"), F.col("quality")
    both = t(s, d, "documents").join(t(s, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")), "doc_id")
    rows = both.select(F.concat(F.lit("sample "), "doc_id").alias("sample_id"), "text", (n / 100).alias("mcd"), F.when(F.col("toxic") == 0, 1.5 + 2 * q).alias("pesq"), (1 / (1 + q)).alias("stoi"), (n % 5).alias("utmos"), (n % 200 / 100 - 1).alias("f0_correlation"), F.when(n > 500, n % 7 / 4).alias("wer"))
    sinks.metric_report(rows, at)
    read = sinks.read_report(s, at)
    return read.select("sample_id", F.md5("text").alias("text"), *sinks.METRICS)


def s19(s, d):
    at = f"{store.place(s)}/deep/stats.json"
    for n in (0, t(s, d, "documents").count()):  # the second document takes the first one's place
        sinks.document(s, at, {"total": n, "names": [r[0] for r in t(s, d, "region").select("r_name").orderBy("r_name").collect()]})
    found = sinks.read_document(s, at, {})
    return s.createDataFrame([(found["total"], name) for name in found["names"]], "total long, name string")


def s20(s, d):
    at = store.place(s)
    rows = t(s, d, "events").select("event_id", "event_type")
    sinks.appended(rows.where("event_id % 2 = 0").select("event_id"), at)
    sinks.appended(rows.where("event_id % 2 = 1"), at)
    store.write_bytes(s, f"{at}/part-broken.json", b"not json\n")
    return sinks.history(s, at, "event_id long, event_type string")


def s21(s, d):
    at = store.place(s)
    sinks.prepared(t(s, d, "conversations").select("conv_id", "turn", "text", (F.char_length("text") / 16).alias("duration")), at)
    symbols = s.read.text(f"{at}/vocab").agg(F.count_distinct("value").alias("n")).select(F.lit("symbols").alias("what"), "n")
    seconds = s.read.json(f"{at}/duration").agg(F.round(F.sum("duration") * 16, 0).cast("long").alias("n")).select(F.lit("chars").alias("what"), "n")
    return s.read.parquet(f"{at}/raw").agg(F.count("*").alias("n")).select(F.lit("rows").alias("what"), "n").unionByName(symbols).unionByName(seconds)


def s22(s, d):
    at = store.place(s)
    sinks.per_folder(t(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), at, "o_orderstatus")
    return tables.files(s, at, "*.parquet").select(F.substring_index("path", "/", 1).alias("folder")).distinct().join(s.read.parquet(at).groupBy(F.concat(F.lit("o_orderstatus="), "o_orderstatus").alias("folder")).agg(F.count("*").alias("n")), "folder")


def s23(s, d):
    at = store.place(s)
    rows = t(s, d, "labels").select("doc_id", "quality")
    sinks.metric_lines(rows, at, "quality", rows.agg(F.round(F.avg("quality"), 4)).first()[0])
    # rows, and the one line that isn't JSON
    text = s.read.option("pathGlobFilter", "*.json").text(at)
    return text.select(F.when(F.startswith("value", F.lit("{")), "rows").otherwise(F.col("value")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))


def s24(s, d):
    # embedded bytes go to files as they are
    at = store.place(s)
    part = t(s, d, "part").select("p_partkey", F.concat(F.pmod("p_partkey", F.lit(1000)), F.lit("/"), "p_partkey", F.lit(".bin")).alias("name"))
    store.write_files(part.select("name", F.unhex(F.repeat(F.hex("p_partkey"), 2)).alias("content")), at)
    return store.read_files(part, at).select("p_partkey", F.md5("content").alias("digest"))


#: The order in which checkpoints are used, by the names of this query's folders.
PRIORITY = ["ASIA", "NOWHERE", "EUROPE", "AFRICA"]


def s25(s, d):
    at = f"{store.place(s)}/models"
    both = t(s, d, "nation").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suffix = F.when(F.col("r_name") == "EUROPE", ".txt").otherwise(".pt")
    store.write_files(both.select(F.concat("r_name", F.lit("/"), F.replace("n_name", F.lit(" "), F.lit("_")), suffix).alias("name"), F.lit("x").alias("content")), at)
    first = tables.files(s, at, "*.pt").groupBy(F.substring_index("path", "/", 1).alias("name")).agg(F.min("path").alias("path"))
    order = s.createDataFrame(list(enumerate(PRIORITY)), "rank int, name string")
    return F.broadcast(order).join(first, "name").select("rank", "name", "path")


def s26(s, d):
    at = f"{store.place(s)}/models"
    sup = t(s, d, "supplier").select("s_suppkey", F.concat(F.lit("tts-"), "s_suppkey").alias("name"))
    model = sup.select(F.concat("name", F.when(F.col("s_suppkey") % 3 == 0, F.lit("/other.pt")).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("/model_"), "s_suppkey", F.lit(".pt"))).otherwise(F.lit("/readme.md"))).alias("name"))
    vocab = sup.where("s_suppkey % 2 = 0").select(F.concat("name", F.lit("/vocab.txt")).alias("name"))
    parent = s.createDataFrame([("vocab.txt",), ("samples/x.pt",)], "name string")
    store.write_files(model.unionByName(vocab).unionByName(parent).withColumn("content", F.lit("x")), at)
    found = tables.files(s, at).select(F.substring_index("path", "/", 1).alias("name"), "path")
    step = F.concat("name", F.lit("/model_"), F.substring_index("name", "-", -1), F.lit(".pt"))
    models = found.where("path LIKE '%/%.pt' AND name <> 'samples'").groupBy("name").agg(F.coalesce(F.max(F.when(F.col("path") == step, F.col("path"))), F.min("path")).alias("model"))
    own = found.where(F.col("path") == F.concat("name", F.lit("/vocab.txt"))).select("name", F.col("path").alias("own"))
    shared = found.where("path = 'vocab.txt'").select(F.col("path").alias("shared"))
    joined = models.join(own, "name", "left").join(F.broadcast(shared), F.lit(True), "left")
    return joined.select("name", "model", F.coalesce("own", "shared").alias("vocab")).where("vocab is not null")


#: Suffixes of audio files, in the order in which they are tried.
AUDIO = ["wav", "mp3", "aac", "flac", "m4a", "alac", "ogg", "aiff", "wma", "amr"]


def s27(s, d):
    named = t(s, d, "nation").select("n_nationkey", F.concat(F.when(F.col("n_nationkey") % 4 == 0, "/abs/").otherwise(""), F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))), F.when(F.col("n_nationkey") % 4 < 2, ".flac").otherwise("")).alias("given"))
    at = store.place(s)
    # files that are there: two suffixes for some names
    there = named.where("n_nationkey % 4 = 2").select("given", F.explode(F.array(F.lit(".ogg"), F.lit(".mp3"))).alias("suffix")).select(F.concat(F.lit("wavs/"), "given", "suffix").alias("name"), F.lit("x").alias("content"))
    store.write_files(there, at)
    listed = tables.files(s, at).select("path")
    suffixes = s.createDataFrame(list(enumerate(AUDIO)), "rank int, suffix string")
    tried = named.join(F.broadcast(suffixes)).select("n_nationkey", "rank", F.concat(F.lit("wavs/"), "given", F.lit("."), "suffix").alias("path"))
    first = tried.join(listed, "path", "left_semi").groupBy("n_nationkey").agg(F.min_by("path", "rank").alias("first"))
    known = F.col("given").rlike(r"\.(" + "|".join(AUDIO) + ")$")
    absolute = F.startswith("given", F.lit("/"))
    path = F.when(known & absolute, F.col("given")).when(known, F.concat(F.lit("wavs/"), "given")).when(~absolute, F.coalesce("first", F.concat(F.lit("wavs/"), "given", F.lit(".wav"))))
    return named.join(first, "n_nationkey", "left").select("n_nationkey", path.alias("path"))


def settings(given: dict, config: dict, default: dict) -> dict:
    """An argument, else the configured value, else the default; empty values count as not given.  In order of the defaults."""
    return {k: given.get(k) or config.get(k) or v for k, v in default.items()}


def s28(s, d):
    at = f"{store.place(s)}/conf.json"
    sinks.document(s, at, {"model": "config", "speed": 0, "steps": 32, "unknown": 1})
    made = settings({"model": "argument", "steps": None}, sinks.read_document(s, at, {}), {"model": "base", "speed": 1, "steps": 16, "seed": t(s, d, "region").count()})
    return s.createDataFrame([(k, name, str(v)) for k, (name, v) in enumerate(made.items())], "pos int, name string, value string")


def h07(s, d):
    # defaults overlaid by the file, last wins, in the order of the defaults
    at = store.place(s)
    default = [("epochs", "100"), ("batch", "3200"), ("rate", "1e-5"), ("logger", "none")]
    s.createDataFrame([(k, a, b) for k, (a, b) in enumerate([("rate", "x"), ("batch", "1600"), ("extra", "1"), ("rate", "7.5e-5")])], "pos int, name string, value string").write.json(at)
    over = s.read.json(at).groupBy("name").agg(F.max_by("value", "pos").alias("over"))
    base = s.createDataFrame([(k, a, b) for k, (a, b) in enumerate(default)], "pos int, name string, value string")
    return base.join(over, "name", "left").select("pos", "name", F.coalesce("over", "value").alias("value"))


def generated(s, d):
    listed = t(s, d, "customer").select("c_custkey", F.concat(F.lit("out/"), "c_name", F.lit(".wav")).alias("path"))
    return listed, listed.where("c_custkey % 9 <> 0").select("path")


def s29_skip(s, d):
    listed, there = generated(s, d)
    return listed.join(there, "path", "left_semi")


def required(listed, there, key: str):
    """listed, or an error that names a row which isn't there."""
    marked = listed.join(there.select(key, F.lit(True).alias("_there")), key, "left")
    checked = F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit("missing: "), F.col(key)))).otherwise(F.col(key))
    return marked.select(checked.alias(key), *[c for c in listed.columns if c != key])


def s29_raise(s, d):
    listed, there = generated(s, d)
    return required(listed.join(there, "path", "left_semi"), there, "path")


def s30(s, d):
    at = store.place(s)
    rows = t(s, d, "supplier").select(F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("wavs/"), "s_suppkey", F.lit(".wav"))).alias("path"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("  "), "s_name", F.lit(" "))).alias("text"))
    store.write_files(rows.where("path is not null and text is not null").select(F.concat(tables.stem(F.col("path")), F.lit(".txt")).alias("name"), F.trim("text").alias("content")), at)
    return s.read.option("recursiveFileLookup", "true").text(at, wholetext=True).select(F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("name"), F.col("value").alias("text"))


def s31(s, d):
    # no pair lies in the folder itself, so those below it count
    return tables.flat_or_deep(s, speech_folder(s, d)).select("stem", "text")


def s32(s, d):
    at = speech_folder(s, d)
    before = tables.is_corpus(s, at)
    store.write_bytes(s, f"{at}/metadata.csv", b"wav|text\n")
    return s.createDataFrame([("without a manifest", before), ("with both", tables.is_corpus(s, at)), ("elsewhere", tables.is_corpus(s, f"{at}/wavs"))], "folder string, good boolean")


def s33(s, d):
    at = speech_folder(s, d)
    # files without a head: as many seconds as bytes, none for the empty one
    store.write_files(t(s, d, "region").select(F.concat(F.lit("raw/"), "r_regionkey", F.lit(".wav")).alias("name"), F.repeat(F.lit("x"), F.col("r_regionkey")).alias("content")), at)
    return tables.probed_durations(s, at, lambda content: float(len(content))).select("path", F.round("seconds", 6).alias("seconds"))


def s34(s, d):
    at = store.place(s)
    rows = t(s, d, "labels").select(F.when(F.col("doc_id") % 2 == 0, "m/1").otherwise("m 2").alias("model"), F.lit("wer").alias("metric"), F.col("doc_id").alias("sample_id"), F.col("quality").alias("value"))
    from ..functions.text import safe_name

    sinks.named_results(rows.withColumn("model", safe_name(F.col("model"))), at)
    return s.read.json(at).select("model", "metric", "sample_id", "value")


def s35(s, d):
    # what was collected before, and what was downloaded, isn't collected again
    at = store.place(s)
    pages = t(s, d, "pages").select("page_id", "url")
    pages.where("page_id % 3 = 0").select("url").write.json(f"{at}/collected")
    pages.where("page_id % 4 = 0").select("url").write.json(f"{at}/downloaded")
    done = s.read.json(f"{at}/collected").union(s.read.json(f"{at}/downloaded")).distinct()
    return pages.join(done, "url", "left_anti")


def j15(s, d):
    """Saved results of suppliers, every second one broken; asked for those of all customers' numbers, too."""
    at = store.place(s)
    sup = t(s, d, "supplier").select(F.concat("s_suppkey", F.lit("/v 1")).alias("model"), "s_suppkey")
    samples = F.to_json(F.struct(F.array_repeat(F.struct(F.col("s_suppkey").alias("value")), (F.col("s_suppkey") % 5).cast("int") + 1).alias("samples")))
    name = sinks.result_name_of(F.col("model"), "wer")
    store.write_files(sup.select(name.alias("name"), F.when(F.col("s_suppkey") % 2 == 1, F.lit("{broken")).otherwise(samples).alias("content")), at)
    asked = t(s, d, "customer").select(F.concat("c_custkey", F.lit("/v 1")).alias("model"))
    found = sinks.existing_results(s, at, asked, "wer")
    left = tables.files(s, at, "*.json.backup").select(F.regexp_replace("path", r"\.backup$", "").alias("file"), F.lit(True).alias("aside"))
    each = found.withColumn("file", sinks.result_name_of(F.col("model"), "wer")).join(left, "file", "left")
    return each.select("model", F.json_array_length(F.get_json_object("result", "$.samples")).cast("double").alias("samples"), F.coalesce("aside", F.lit(False)).alias("aside"))


def r09(s, d):
    at = store.place(s)
    sinks_in = t(s, d, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("value"))
    sinks_in.select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("<"), "value")).otherwise(F.col("value"))).write.text(at)
    good, bad = sinks.split_broken(s, at, "event_id long, event_type string")
    return good.select("event_id", "event_type", F.lit("good").alias("route")).unionByName(bad.select(F.regexp_extract("value", "([0-9]+)", 1).cast("long").alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit("quarantine").alias("route")))


_STEM = "'wavs/' || s_nationkey || '/' || replace(s_name, '#', '_')"
_URL = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
QUERIES = {
    "s01_parquet_first": (s01, "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0"),
    "s02_both_kinds": (s02, "SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer"),
    "s03_arrow_shards": (s03, "SELECT c_custkey, c_name, c_mktsegment FROM customer"),
    "s04_matched_files": (s04, "SELECT n_nationkey, n_name FROM nation WHERE contains(n_name, 'A')"),
    "s05_sidecars": (s05, f"SELECT {_STEM} AS stem, CASE WHEN s_acctbal >= 0 THEN 'said ' || s_suppkey END AS text FROM supplier"),
    "s06_wav_seconds": (s06, f"SELECT {_STEM} || '.wav' AS path, round(s_suppkey * 160 / 16000, 6) AS seconds FROM supplier"),
    "s07_manifest": (s07, "SELECT c_name AS sample_id, 'wavs/' || c_name || '.wav' AS audio_path, c_mktsegment || ' \"x\"' AS text FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 3 <> 0"),
    "s08_headed_manifest": (s08, "SELECT n_name AS wav, 'say \"' || n_nationkey || '\" | now' AS text FROM nation"),
    "s09_strict_manifest": (s09, "SELECT c_name AS audio_path, c_mktsegment AS text FROM customer WHERE c_custkey % 4 <> 0"),
    "s10_three_fields": (s10, "SELECT 'wavs/' || c_name || '.wav' AS audio_path, lower(c_mktsegment) AS text FROM customer"),
    "s11_utterances": (s11, "SELECT 'u' || c_custkey AS utt, 'prompt' AS prompt_text, 'p.wav' AS prompt_wav, c_mktsegment AS gen_text, CASE WHEN c_custkey % 2 = 0 THEN 'own/' || c_custkey || '.wav' ELSE 'wavs/u' || c_custkey || '.wav' END AS gt_wav FROM customer"),
    "s12_spoken_chapters": (s12, "WITH u AS (SELECT *, s_nationkey || '-' || s_suppkey || '-0001' AS u FROM supplier) SELECT u AS utt, 'ref' AS ref_text, 'clean/' || s_nationkey || '/' || s_suppkey || '/' || u || '.flac' AS ref_wav, ' ' || lower(s_name) AS gen_text, 'clean/' || s_nationkey || '/' || s_suppkey || '/' || u || '.flac' AS gen_wav FROM u"),
    "s13_first_lines": (s13, "SELECT 'a' || s_suppkey || '.wav' AS audio, 'said ' || s_suppkey AS text FROM supplier"),
    "s14_json_lines": (s14, "SELECT role AS language, conv_id || '-' || turn AS wav, length(text)::INT AS n_chars, round(length(text) / 16, 4) AS duration FROM conversations WHERE turn % 4 <> 3"),
    "s15_url_list": (s15, f"WITH u AS (SELECT (page_id // 40)::VARCHAR AS list, {_URL} AS url, row_number() OVER (PARTITION BY page_id // 40 ORDER BY page_id) + 2 AS k FROM pages), a AS (SELECT list, url, k FROM u UNION ALL SELECT list, url, 0 FROM u WHERE k = 3 UNION ALL SELECT DISTINCT list, '7', 2 FROM u) SELECT list, url, min(k)::INT AS pos FROM a GROUP BY 1, 2"),
    "s16_tolerant_json": (s16, "SELECT n_nationkey, CASE WHEN n_nationkey % 5 > 1 THEN n_name END AS name FROM nation"),
    "s17_sheet": (s17, f"SELECT {_URL} AS url FROM pages WHERE page_id % 6 > 1"),
    "s18_csv_report": (s18, "SELECT 'sample ' || doc_id AS sample_id, md5(nullif(text, '')) AS text, n_chars / 100 AS mcd, CASE WHEN toxic = 0 THEN 1.5::DOUBLE + 2 * quality END AS pesq, 1 / (1 + quality) AS stoi, (n_chars % 5)::DOUBLE AS utmos, n_chars % 200 / 100 - 1 AS f0_correlation, CASE WHEN n_chars > 500 THEN n_chars % 7 / 4 END AS wer, NULL::DOUBLE AS cer FROM documents JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id)"),
    "s19_atomic_json": (s19, "SELECT (SELECT count(*) FROM documents) AS total, r_name AS name FROM region"),
    "s20_history": (s20, "SELECT event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events"),
    "s21_prepared": (s21, "SELECT 'rows' AS what, count(*) AS n FROM conversations UNION ALL SELECT 'symbols', count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM conversations) WHERE c <> chr(10) UNION ALL SELECT 'chars', sum(length(text))::BIGINT FROM conversations"),
    "s22_folders": (s22, "SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS n FROM orders GROUP BY 1"),
    "s23_metric_line": (s23, "SELECT 'rows' AS line, count(*) AS n FROM labels UNION ALL SELECT 'QUALITY: ' || round(avg(quality), 4), 1 FROM labels"),
    "s24_raw_bytes": (s24, "SELECT p_partkey, md5(unhex(repeat(CASE WHEN length(h) % 2 = 1 THEN h ELSE h END, 2))) AS digest FROM (SELECT p_partkey, printf('%X', p_partkey) AS h FROM part)"),
    "s25_checkpoints": (s25, "WITH f AS (SELECT r_name AS name, r_name || '/' || min(replace(n_name, ' ', '_')) || '.pt' AS path FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE' GROUP BY 1) SELECT rank::INT AS rank, f.name, path FROM f JOIN (SELECT unnest(['ASIA', 'NOWHERE', 'EUROPE', 'AFRICA']) AS name, unnest(range(4)) AS rank) o ON o.name = f.name"),
    "s26_models": (s26, "SELECT 'tts-' || s_suppkey AS name, 'tts-' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '/other.pt' ELSE '/model_' || s_suppkey || '.pt' END AS model, CASE WHEN s_suppkey % 2 = 0 THEN 'tts-' || s_suppkey || '/vocab.txt' ELSE 'vocab.txt' END AS vocab FROM supplier WHERE s_suppkey % 3 < 2"),
    "s27_audio_paths": (s27, "WITH g AS (SELECT n_nationkey, n_nationkey % 4 AS k, lower(replace(n_name, ' ', '_')) AS n FROM nation) SELECT n_nationkey, CASE k WHEN 0 THEN '/abs/' || n || '.flac' WHEN 1 THEN 'wavs/' || n || '.flac' WHEN 2 THEN 'wavs/' || n || '.mp3' ELSE 'wavs/' || n || '.wav' END AS path FROM g"),
    "s28_settings": (s28, "SELECT unnest(range(4))::INT AS pos, unnest(['model', 'speed', 'steps', 'seed']) AS name, unnest(['argument', '1', '32', (SELECT count(*) FROM region)::VARCHAR]) AS value"),
    "s29_skipped": (s29_skip, "SELECT 'out/' || c_name || '.wav' AS path, c_custkey FROM customer WHERE c_custkey % 9 <> 0"),
    "s29_required": (s29_raise, "SELECT 'out/' || c_name || '.wav' AS path, c_custkey FROM customer WHERE c_custkey % 9 <> 0"),
    "s30_text_files": (s30, "SELECT s_suppkey || '.txt' AS name, s_name AS text FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0"),
    "s31_flat_or_deep": (s31, f"SELECT {_STEM} AS stem, 'said ' || s_suppkey AS text FROM supplier WHERE s_acctbal >= 0"),
    "s32_format_gate": (s32, "SELECT unnest(['without a manifest', 'with both', 'elsewhere']) AS folder, unnest([false, true, false]) AS good"),
    "s33_probed": (s33, f"SELECT {_STEM} || '.wav' AS path, round(s_suppkey * 160 / 16000, 6) AS seconds FROM supplier WHERE s_suppkey > 0 UNION ALL SELECT 'raw/' || r_regionkey || '.wav', r_regionkey::DOUBLE FROM region WHERE r_regionkey > 0"),
    "s34_named_results": (s34, "SELECT CASE WHEN doc_id % 2 = 0 THEN 'm_1' ELSE 'm_2' END AS model, 'wer' AS metric, doc_id AS sample_id, quality::BIGINT AS value FROM labels"),
    "s35_preloaded": (s35, "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0 OR page_id % 4 = 0)"),
    "h07_overlaid": (h07, "SELECT unnest(range(4))::INT AS pos, unnest(['epochs', 'batch', 'rate', 'logger']) AS name, unnest(['100', '1600', '7.5e-5', 'none']) AS value"),
    "j15_existing_results": (j15, "SELECT c_custkey || '/v 1' AS model, CASE WHEN s_suppkey % 2 = 0 THEN (s_suppkey % 5 + 1)::DOUBLE END AS samples, coalesce(s_suppkey % 2 = 1, false) AS aside FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"),
    "r09_quarantine": (r09, "SELECT event_id, CASE WHEN event_id % 10 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 10 > 0 THEN 'good' ELSE 'quarantine' END AS route FROM events"),
}
