"""Text, JSON and number operators (T and H families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import han as H
from ..functions import numbers as N
from ..functions import tables
from ..functions import text as X
from ..operators import relational as R
from ..sources.tables import table as t

_C = ("conv_id", "turn")
NORMAL_SQL = "trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]', '', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"


def conv(s, d):
    return t(s, d, "conversations")


def column(name, make):
    return lambda s, d: conv(s, d).select(*_C, make(F.col("text")).alias(name))


def sql(name, expression):
    return f"SELECT conv_id, turn, {expression} AS {name} FROM conversations"


def t12(s, d):
    return t(s, d, "orders").select("o_orderkey", N.spoken(F.col("o_orderkey") * 37 - 5000).alias("said"))


def title_of(title):
    """A title's JSON: the first run's text, else the simple text, else the value itself."""
    run, simple = (F.get_json_object(title, path) for path in ("$.runs[0].text", "$.simpleText"))
    return F.when(F.startswith(title, F.lit("{")), F.coalesce(run, simple, F.lit(""))).otherwise(title)


def h04(s, d):
    p = F.col("n_name")
    runs = F.to_json(F.struct(F.array(F.struct(p.alias("text")), F.struct(F.lit("more").alias("text"))).alias("runs"), F.lit("no").alias("simpleText")))
    title = F.when(F.col("n_nationkey") % 4 == 0, runs).when(F.col("n_nationkey") % 4 == 1, F.to_json(F.struct(p.alias("simpleText")))).when(F.col("n_nationkey") % 4 == 2, p).otherwise(F.lit('{"runs":[]}'))
    return t(s, d, "nation").select("n_nationkey", title_of(title).alias("title"))


def h05(s, d):
    name = lambda outer, inner, value: F.concat(F.lit(f'"{outer}":{{"{inner}":{{"title":"'), value, F.lit('"}}'))
    header = name("header", "c4TabbedHeaderRenderer", F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.col("n_name")))
    micro = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(","), name("microformat", "microformatDataRenderer", F.concat(F.lit("m "), "n_name"))))
    data = F.concat(F.lit("{"), header, F.coalesce(micro, F.lit("")), F.lit("}"))
    found = F.coalesce(F.nullif(F.get_json_object(data, "$.header.c4TabbedHeaderRenderer.title"), F.lit("")), F.get_json_object(data, "$.microformat.microformatDataRenderer.title"), F.lit("fallback"))
    return t(s, d, "nation").select("n_nationkey", found.alias("name"))


def t18(s, d):
    dressed = F.concat(F.lit("“a” ‘b’; ，！？"), "text")
    return conv(s, d).select(*_C, F.translate(dressed, ";“”‘’", ",\"\"''").alias("quotes"), F.translate(dressed, "，！？", ",!?").alias("wide"))


def t20(s, d):
    # padded to the longest of the conversation, which is the batch
    ids = X.byte_ids(F.col("text"))
    wide = conv(s, d).groupBy("conv_id").agg(F.max(F.octet_length("text")).alias("width"))
    rows = conv(s, d).join(wide, "conv_id").select(*_C, "width", ids.alias("ids"))
    padded = F.concat("ids", F.array_repeat(F.lit(-1), F.col("width") - F.size("ids")))
    return rows.select(*_C, F.size(padded).alias("n"), F.aggregate(padded, F.lit(0).cast("long"), lambda a, x: F.pmod(a * 31 + x + 1, F.lit(1_000_003))).alias("digest"))


def t21(s, d):
    """Characters as numbers of a vocabulary (of German texts, in order of code points), 0 for others, -1 behind the end."""
    held = t(s, d, "documents").where("lang = 'de'").select(F.explode(F.array_distinct(F.split("text", ""))).alias("symbol")).where("symbol <> ''").distinct()
    # as many as there are code points, at most
    numbers = held.agg(F.array_sort(F.collect_set("symbol")).alias("v")).select(F.posexplode("v").alias("id", "symbol"))
    wide = conv(s, d).groupBy("conv_id").agg(F.max(F.char_length("text")).alias("width"))
    # a row of cells is walked once: beside each cell the whole of it would be carried along
    own = F.when(F.col("text") != "", F.split("text", "")).otherwise(F.array().cast("array<string>"))
    row = F.concat(F.coalesce(own, F.array().cast("array<string>")), F.array_repeat(F.lit(None).cast("string"), F.col("width") - F.coalesce(F.char_length("text"), F.lit(0))))
    cells = conv(s, d).join(wide, "conv_id").select(*_C, F.posexplode(row).alias("pos", "symbol"))
    # a vocabulary has as many rows as there are code points, at most
    found = cells.join(F.broadcast(numbers), "symbol", "left")
    return found.select(*_C, "pos", F.when(F.col("symbol").isNull(), -1).otherwise(F.coalesce("id", F.lit(0))).alias("id"))


def segments(text):
    """A text's sentences as heard segments, a word of blanks in each."""
    words = lambda x: F.concat(F.transform(F.split(x, " "), lambda w, i: F.struct(F.concat(F.lit(" "), w).alias("word"), (i / 3).alias("start"), ((i + 1) / 3).alias("end"), (1 / (i + 1.5)).alias("probability"))), F.array(F.struct(F.lit("  ").alias("word"), F.lit(0.0).alias("start"), F.lit(0.0).alias("end"), F.lit(0.5).alias("probability"))))
    return F.transform(F.split(text, r"\. "), lambda x, i: F.struct(i.cast("double").alias("start"), (i + 1.0).alias("end"), F.concat(F.lit(" "), x, F.lit("  ")).alias("text"), words(x).alias("words")))


def t27(s, d):
    return conv(s, d).select(*_C, X.joined(F.transform(segments(F.col("text")), lambda g: g["text"])).alias("said"))


def t28(s, d):
    w = conv(s, d).select(*_C, F.posexplode(X.heard(segments(F.col("text")))).alias("pos", "w"))
    return w.select(*_C, "pos", "w.word", F.col("w.end").alias("end_time"), "w.probability")


def t29(s, d):
    """Texts in slices of 100, in their order; a slice is converted at once."""
    rows = R.numbered(t(s, d, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.floor(F.col("_k") / 100).cast("int").alias("slice"), F.pmod("_k", F.lit(100)).cast("int").alias("pos"), F.md5(F.coalesce(F.lower("text"), F.lit(""))).alias("converted"))


def t10(s, d):
    parts = F.split("text", r"\. ")
    return conv(s, d).select(*_C, F.posexplode(parts).alias("pos", "part"))


_NAMES = "['" + "', '".join(N.DIGITS) + "']"
#: Number words by groups of three digits, for numbers under a billion.
_SPOKEN = f"""WITH n AS (SELECT o_orderkey, o_orderkey * 37 - 5000 AS x, abs(o_orderkey * 37 - 5000) AS n, {_NAMES} AS d FROM orders),
g AS (SELECT o_orderkey, x, d, unnest([{{'v': n // 1000000, 'u': 'triệu', 'f': false, 'k': 0}}, {{'v': n // 1000 % 1000, 'u': 'nghìn', 'f': n >= 1000000, 'k': 1}}, {{'v': n % 1000, 'u': NULL, 'f': n >= 1000, 'k': 2}}]) AS g FROM n),
p AS (SELECT o_orderkey, x, d, g.k AS k, g.v AS v, g.u AS unit, g.v // 100 AS h, g.v % 100 // 10 AS t, g.v % 10 AS u, g.f AS f FROM g),
w AS (SELECT o_orderkey, x, k, v, concat_ws(' ', CASE WHEN h > 0 OR f THEN d[h + 1] || ' trăm' END, CASE WHEN t = 0 THEN CASE WHEN u > 0 AND (h > 0 OR f) THEN 'lẻ' END WHEN t = 1 THEN 'mười' ELSE d[t + 1] || ' mươi' END, CASE WHEN u = 0 THEN NULL WHEN u = 1 AND t > 1 THEN 'mốt' WHEN u = 4 AND t > 1 THEN 'tư' WHEN u = 5 AND t > 0 THEN 'lăm' ELSE d[u + 1] END, unit) AS w FROM p)
SELECT o_orderkey, CASE WHEN any_value(x) = 0 THEN 'không' ELSE CASE WHEN any_value(x) < 0 THEN 'âm ' ELSE '' END || string_agg(w, ', ' ORDER BY k) FILTER (v > 0) END AS said FROM w GROUP BY 1"""
_WORDS = "len(list_filter(regexp_split_to_array({0}, '[\\s\\p{{Z}}]+'), lambda w: w <> ''))"
#: Sentences folded from the left: what is done, and what is open.
_SENTENCES = f"""WITH p AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(regexp_replace(text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), '([.!?;])[\\s\\p{{Z}}]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS p FROM conversations),
f AS (SELECT conv_id, turn, list_reduce(list_transform(p, lambda x: {{'done': []::VARCHAR[], 'open': x}}), lambda a, x: CASE WHEN {_WORDS.format("concat_ws(' ', nullif(a.open, ''), x.open)")} >= 10 THEN {{'done': list_append(a.done, concat_ws(' ', nullif(a.open, ''), x.open)), 'open': ''}} ELSE {{'done': a.done, 'open': concat_ws(' ', nullif(a.open, ''), x.open)}} END, {{'done': []::VARCHAR[], 'open': ''}}) AS f FROM p),
s AS (SELECT conv_id, turn, CASE WHEN f.open = '' THEN f.done WHEN len(f.done) = 0 THEN [f.open] ELSE list_append(f.done[:len(f.done) - 1], f.done[len(f.done)] || ' ' || f.open) END AS s FROM f)
SELECT conv_id, turn, unnest(range(len(s)))::INT AS pos, unnest(s) AS sentence FROM s"""


#: Words of a small dictionary, how often they are seen, and their readings.
WORDS = [
    ("中", 60, "zhong1"), ("国", 50, "guo2"), ("中国", 400, "zhong1 guo2"), ("人", 300, "ren2"), ("中国人", 90, "zhong1 guo2 ren2"), ("国人", 8, "guo2 ren2"),
    ("大", 200, "da4"), ("学", 80, "xue2"), ("生", 90, "sheng1"), ("大学", 160, "da4 xue2"), ("学生", 150, "xue2 sheng1"), ("大学生", 40, "da4 xue2 sheng1"), ("生活", 120, "sheng1 huo2"),
    ("长", 70, "chang2"), ("长大", 30, "zhang3 da4"), ("成长", 25, "cheng2 zhang3"), ("银行", 45, "yin2 hang2"), ("行", 110, "xing2"), ("行人", 20, "xing2 ren2"), ("音乐", 60, "yin1 yue4"), ("乐", 50, "le4"), ("快乐", 75, "kuai4 le4"),
]


def t19_readings(s, d):
    """Readings of texts in which two of three words are put in Chinese, by their check sums."""
    words = s.createDataFrame([(w, n, r.split()) for w, n, r in WORDS], "word string, n long, readings array<string>")
    put = lambda w: F.crc32(w.cast("binary"))
    said = F.transform(F.split("text", " "), lambda w: F.when(put(w) % 3 == 0, w).otherwise(F.element_at(F.array(*[F.lit(w) for w, _, _ in WORDS]), (put(w) % len(WORDS) + 1).cast("int"))))
    found = conv(s, d).select(*_C, H.symbols_column(words)(F.array_join(said, "")).alias("symbols"))
    return found.select(*_C, F.size("symbols").alias("n"), F.array_join("symbols", "").alias("x"))


def t06_sql(s, d):
    """Sentences by the table function."""
    tables.register(s)
    return s.sql("SELECT c.conv_id, c.turn, x.pos, x.sentence FROM {turns} c, LATERAL sentences(c.text, 10) x", turns=conv(s, d))


QUERIES = {
    "t01_normalized": (column("x", X.normalized), sql("x", NORMAL_SQL.format("text"))),
    "t02_first_line": (column("x", X.first_line), sql("x", "trim(regexp_replace(replace(regexp_replace(lower(string_split(text, chr(10))[1]), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '_', ' '), '[\\s\\p{Z}]+', ' ', 'g'))")),
    "t03_lower_unquoted": (column("x", lambda c: F.replace(F.trim(F.lower(c)), F.lit('"'), F.lit(""))), sql("x", "replace(trim(lower(text)), '\"', '')")),
    "t04_word_count": (column("n", X.word_count), sql("n", "len(list_filter(regexp_split_to_array(text, '[\\s\\p{Z}]+'), lambda x: x <> ''))::INT")),
    "t05_words_per_second": (column("wps", lambda c: X.words_per_second(c, F.char_length(c) / 16)), sql("wps", "CASE WHEN length(text) > 0 THEN round(len(list_filter(regexp_split_to_array(text, '[\\s\\p{Z}]+'), lambda x: x <> '')) / (length(text) / 16), 2) ELSE 0.0 END")),
    "t06_table_function": (t06_sql, _SENTENCES),
    "t06_sentences": (lambda s, d: conv(s, d).select(*_C, F.posexplode(X.sentences(F.col("text"))).alias("pos", "sentence")), _SENTENCES),
    "t12_number_words": (t12, _SPOKEN),
    "t13_digits_spelled": (column("x", lambda c: X.digits_spelled(F.char_length(c).cast("string"), N.DIGITS)), sql("x", "array_to_string(list_transform(string_split(length(text)::VARCHAR, ''), lambda c: ['không', 'một', 'hai', 'ba', 'bốn', 'năm', 'sáu', 'bảy', 'tám', 'chín'][c::INT + 1]), ' ')")),
    "t14_decimal_comma": (column("x", lambda c: F.translate(F.format_string("%.1f", F.char_length(c) / 10), ".", ",")), sql("x", "replace(printf('%.1f', length(text) / 10), '.', ',')")),
    "t18_translated": (t18, "SELECT conv_id, turn, '\"a\" ''b'', ，！？' || translate(text, ';“”‘’', ',\"\"''''') AS quotes, '“a” ‘b’; ,!?' || translate(text, '，！？', ',!?') AS wide FROM conversations"),
    "t20_byte_ids": (t20, "WITH c AS (SELECT conv_id, turn, hex(encode(text)) AS h, max(strlen(text)) OVER (PARTITION BY conv_id) AS w FROM conversations), b AS (SELECT conv_id, turn, w, list_concat(list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT), list_transform(range(w - length(h) // 2), lambda k: -1::BIGINT)) AS x FROM c) SELECT conv_id, turn, w::INT AS n, list_reduce(x, lambda a, y: (a * 31 + y + 1) % 1000003, 0::BIGINT) AS digest FROM b"),
    "t22_terminated": (column("x", X.terminated), sql("x", "CASE WHEN text LIKE '%. ' OR text LIKE '%。' THEN text WHEN text LIKE '%.' THEN text || ' ' ELSE text || '. ' END")),
    "t23_spoken": (column("x", lambda c: X.spoken_time(F.char_length(c) * 7.25)), sql("x", "CASE WHEN length(text) * 7.25 >= 3600 THEN floor(length(text) * 7.25 / 3600)::INT || 'h ' ELSE '' END || CASE WHEN length(text) * 7.25 >= 60 THEN floor((length(text) * 7.25) % 3600 / 60)::INT || 'm ' ELSE '' END || printf('%.2fs', ((length(text) * 7.25) % 60)::DOUBLE)")),
    "t23_clock": (column("x", lambda c: X.clock(F.char_length(c))), sql("x", "printf('%02d:%02d:%02d', length(text) // 3600, (length(text) % 3600) // 60, length(text) % 60)")),
    "t08_reading_chunks": (lambda s, d: conv(s, d).select(*_C, F.posexplode(X.reading_chunks(F.col("text"))).alias("pos", "chunk")), None),
    "t19_readings": (t19_readings, None),
    "t19_symbols": (column("x", X.spaced_symbols), sql("x", "regexp_replace(translate(text, ';“”‘’', ',\"\"'''''), '([^ :''\"A-Za-z0-9])([A-Za-z0-9]{{2,}})', '\\1 \\2', 'g')".replace("{{", "{").replace("}}", "}"))),
    "t21_vocabulary_ids": (t21, "WITH v AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS id FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents WHERE lang = 'de') WHERE c <> ''), w AS (SELECT conv_id, turn, text, max(length(text)) OVER (PARTITION BY conv_id) AS w FROM conversations), p AS (SELECT conv_id, turn, text, unnest(range(w)) AS pos FROM w) SELECT conv_id, turn, pos::INT AS pos, CASE WHEN pos >= length(text) THEN -1 ELSE coalesce(id, 0) END::INT AS id FROM p LEFT JOIN v ON v.c = substr(text, pos + 1, 1)"),
    "t27_joined_segments": (t27, sql("said", "array_to_string(list_filter(list_transform(string_split(text, '. '), lambda x: trim(x)), lambda x: x <> ''), ' ')")),
    "t28_heard_words": (t28, "WITH g AS (SELECT conv_id, turn, list_transform(string_split(text, '. '), lambda x: string_split(x, ' ')) AS g FROM conversations), f AS (SELECT conv_id, turn, flatten(list_transform(g, lambda w: list_transform(range(1, len(w) + 1), lambda i: {'word': w[i], 'e': round(i / 3, 3), 'p': round(1 / (i + 0.5::DOUBLE), 4)}))) AS f FROM g), k AS (SELECT conv_id, turn, list_filter(f, lambda x: x.word <> '') AS f FROM f) SELECT conv_id, turn, unnest(range(len(f)))::INT AS pos, unnest(list_transform(f, lambda x: x.word)) AS word, unnest(list_transform(f, lambda x: x.e)) AS end_time, unnest(list_transform(f, lambda x: x.p)) AS probability FROM k"),
    "t29_slices": (t29, "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::INT AS slice, ((row_number() OVER (ORDER BY doc_id) - 1) % 100)::INT AS pos, md5(coalesce(lower(text), '')) AS converted FROM documents"),
    "t10_parts": (t10, "SELECT conv_id, turn, unnest(range(len(p)))::INT AS pos, unnest(p) AS part FROM (SELECT conv_id, turn, string_split(text, '. ') AS p FROM conversations)"),
    "t12_small_numbers": (lambda s, d: t(s, d, "nation").select("n_nationkey", N.spoken(F.col("n_nationkey") % 10).alias("said")), "SELECT n_nationkey, ['không', 'một', 'hai', 'ba', 'bốn', 'năm', 'sáu', 'bảy', 'tám', 'chín'][n_nationkey % 10 + 1] AS said FROM nation"),
    "h04_title": (h04, "SELECT n_nationkey, CASE WHEN n_nationkey % 4 < 3 THEN n_name ELSE '' END AS title FROM nation"),
    "h05_channel_name": (h05, "SELECT n_nationkey, CASE WHEN n_nationkey % 3 > 0 THEN n_name WHEN n_nationkey % 2 = 0 THEN 'm ' || n_name ELSE 'fallback' END AS name FROM nation"),
}
