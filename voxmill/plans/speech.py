"""Chunking, tags, templates, generated numbers, embedded JSON, vocabularies and samples (T, H, U, E and O operators)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import distance as E
from ..functions import sentences as Y
from ..functions import text as X
from ..operators import variants as V
from ..operators.relational import spread
from ..sources.store import writer
from ..sources.tables import table as t
from .scores import CHAR_ERRORS_SQL, turn_pairs, word_errors_sql
from .texts import title_of

_C = ("conv_id", "turn")
def conv(s, d):
    return t(s, d, "conversations").select(*_C, "text")


def pieces(make):
    return lambda s, d: conv(s, d).select(*_C, F.posexplode(make(F.col("text"))).alias("pos", "piece"))


def tagged(s, d):
    """Three styles over the parts of a text before and behind its 12th character."""
    both = conv(s, d).select(*_C, F.concat(F.lit("start "), F.lit("{Sad} "), F.substring("text", 1, 12), F.lit(" {Angry}"), F.expr("substring(text, 13)")).alias("text"))
    return both.select(*_C, F.posexplode(X.styled(F.col("text")))).select(*_C, "pos", "col.style", "col.text")


def voices(s, d):
    both = t(s, d, "conversations").select(*_C, F.concat(F.lit("intro [user] yes ["), "role", F.lit("] no [ghost] who")).alias("text"))
    return both.select(*_C, F.posexplode(X.voiced(F.col("text"), ["user", "assistant"]))).select(*_C, "pos", F.col("col.voice").alias("voice"), F.col("col.text").alias("said"))


def t16(s, d):
    return t(s, d, "part").select("p_partkey", Y.category(F.col("p_partkey")).alias("category"))


def t15(s, d):
    return t(s, d, "part").select("p_partkey", Y.template(F.col("p_partkey"), Y.category(F.col("p_partkey"))).alias("template"))


def t15_sentences(s, d):
    return t(s, d, "part").select("p_partkey", Y.sentence(F.col("p_partkey")).alias("x")).select("p_partkey", "x.*")


def t17(s, d):
    k = F.col("c_custkey")
    return t(s, d, "customer").select("c_custkey", Y.phone(k)["written"].alias("phone"), Y.between(k, "year", 1, 9999).alias("year"), Y.between(k, "amount", 1, 9_999_999_999).alias("amount"), Y.singles(k)["written"].alias("singles"))


def t17_spoken(s, d):
    k = F.col("c_custkey")
    kinds = {"phone": Y.phone(k), "percentage": Y.percentage(k), "simple": Y.simple(k), "plain_single": Y.singles(k)}
    return spread(t(s, d, "customer").select("c_custkey"), "c_custkey", each=10_000).select("c_custkey", F.explode(F.array(*[F.struct(F.lit(name).alias("kind"), v["written"].alias("written"), v["said"].alias("said")) for name, v in kinds.items()])).alias("x")).select("c_custkey", "x.*")


def t24(s, d):
    return conv(s, d).select(*_C, X.unpunctuated(F.col("text")).alias("x"))


def e03(s, d):
    distance = E.word_distance(X.unpunctuated(F.col("reference")), X.unpunctuated(F.col("hypothesis")))
    return turn_pairs(s, d).select(*_C, F.round(distance / F.greatest(X.word_count(X.unpunctuated(F.col("reference"))), F.lit(1)), 6).alias("wer"))


def e04(s, d):
    return turn_pairs(s, d).select(*_C, F.round(F.levenshtein("reference", "hypothesis") / F.greatest(F.char_length("reference"), F.lit(1)), 4).alias("cer"))


def embedded(html):
    """The page's data: an object assigned to its variable, or to a key of the window; null without one or where it is broken."""
    forms = (r"(?s)var pageData\s*=\s*(\{.*?\});\s*</script>", r"(?s)window\[\"pageData\"\]\s*=\s*(\{.*?\});\s*</script>")
    found = F.coalesce(*[F.nullif(F.regexp_extract(html, form, 1), F.lit("")) for form in forms])
    return F.when(F.get_json_object(found, "$").isNotNull(), found)


def h01(s, d):
    k = F.pmod("event_id", F.lit(4))
    script = F.when(k == 0, F.concat(F.lit("var pageData = "), "props", F.lit(";\n"))).when(k == 1, F.concat(F.lit('window["pageData"] =\n'), "props", F.lit(";"))).when(k == 2, F.concat(F.lit("var pageData = {broken "), "props", F.lit(";"))).otherwise("var other = 1;")
    html = F.concat(F.lit("<html><script>"), script, F.lit("</script><p>x</p>"))
    return t(s, d, "events").select("event_id", F.get_json_object(embedded(html), "$.k").alias("k"))


#: What a video may be, the first of an item's counting, and where the next page is asked for.
VIDEOS, NEXT = ("lockupViewModel", "videoRenderer", "gridVideoRenderer"), "continuationItemRenderer"


def listed(nodes, key: str, put):
    """(key, pos, video, title, token) of the items below the nodes, in order, however deep they lie.

    An item's video is its lockup, else its renderer, else the one of the old layout, each if it isn't empty; an item without
    one may carry a token, and the last of a page is where the next page is asked for.
    """
    each = V.found(nodes, key, (*VIDEOS, NEXT), put).where("to_json(node) <> '{}'")
    text = lambda path: F.expr(f"try_variant_get(node, '{path}', 'string')")
    lockup = F.col("name") == VIDEOS[0]
    title = F.when(lockup, text("$.metadata.lockupMetadataViewModel.title.content")).otherwise(title_of(F.to_json(F.expr("try_variant_get(node, '$.title', 'variant')"))))
    rank = F.array_position(F.array(*map(F.lit, VIDEOS)), F.col("name"))
    video = F.when(rank > 0, F.struct(rank.alias("rank"), "path", F.nullif(F.when(lockup, text("$.contentId")).otherwise(text("$.videoId")), F.lit("")).alias("id"), F.coalesce(title, F.lit("")).alias("title")))
    token = F.when(F.col("name") == NEXT, F.struct("path", F.nullif(text("$.continuationEndpoint.continuationCommand.token"), F.lit("")).alias("token")))
    items = each.groupBy(key, "item").agg(F.min(video).alias("v"), F.max(token).alias("t"))
    # a page's items
    pos = (F.row_number().over(Window.partitionBy(key).orderBy("item")) - 1).alias("pos")
    return items.select(key, pos, F.col("v.id").alias("video"), F.col("v.title").alias("title"), F.col("t.token").alias("token"))


def videos(found, key: str):
    """The videos of a page in order, each with the page's last token."""
    last = found.where("video is null and token is not null").groupBy(key).agg(F.max_by("token", "pos").alias("token"))
    return found.where("video is not null").select(key, "pos", "video", "title").join(last, key, "left")


def crafted(s, d):
    """Lists of items as JSON: both layouts, a lockup beside a renderer, an item without an id, and two tokens."""
    k, n = F.col("n_nationkey").cast("string"), F.col("n_name")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    items = [
        text('{"richItemRenderer":{"content":{"videoRenderer":{"videoId":"v', k, '","title":{"runs":[{"text":"', n, '"}]}}}}}'),
        text('{"richItemRenderer":{"content":{"videoRenderer":{"videoId":"no","title":"no"},"lockupViewModel":{"contentId":"l', k, '","metadata":{"lockupMetadataViewModel":{"title":{"content":"lock ', n, '"}}}}}}}'),
        text('{"gridVideoRenderer":{"videoId":"g', k, '","title":{"simpleText":"grid ', n, '"}}}'),
        text('{"continuationItemRenderer":{"continuationEndpoint":{"continuationCommand":{"token":"first ', k, '"}}}}'),
        text('{"richItemRenderer":{"content":{"videoRenderer":{"title":"no id"}}}}'),
        text('{"continuationItemRenderer":{"continuationEndpoint":{"continuationCommand":{"token":"last ', k, '"}}}}'),
    ]
    return t(s, d, "nation").select("n_nationkey", text("[", F.concat_ws(",", *items), "]").alias("items"))


def wrapped(items):
    """The list of every third page, a level deeper than any layout that is known."""
    return F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('[{"shelf":{"rows":[{"entries":'), items, F.lit("}]}}]"))).otherwise(items)


def h02(s, d):
    put = writer(s)
    rows = crafted(s, d)
    rich = F.concat(F.lit('{"tabRenderer":{"content":{"richGridRenderer":{"contents":'), wrapped(F.col("items")), F.lit("}}}}"))
    old = F.concat(F.lit('{"tabRenderer":{"content":{"sectionListRenderer":{"contents":[{"itemSectionRenderer":{"contents":[{"gridRenderer":{"items":'), wrapped(F.col("items")), F.lit("}}]}}]}}}}"))
    data = F.concat(F.lit('{"contents":{"twoColumnBrowseResultsRenderer":{"tabs":[{"tabRenderer":{"title":"Home"}},'), F.when(F.col("n_nationkey") % 2 == 0, rich).otherwise(old), F.lit("]}}}"))
    grids = ("richGridRenderer", "gridRenderer")
    grid = V.first_found(V.found(V.rooted(rows, "n_nationkey", data), "n_nationkey", grids, put), "n_nationkey", grids)
    return videos(listed(grid, "n_nationkey", put), "n_nationkey")


def h03(s, d):
    data = F.concat(F.lit('{"onResponseReceivedActions":[{"other":1},{"appendContinuationItemsAction":{"continuationItems":'), wrapped(F.col("items")), F.lit("}}]}"))
    put = writer(s)
    more = V.found(V.rooted(crafted(s, d), "n_nationkey", data), "n_nationkey", ("appendContinuationItemsAction",), put)
    return videos(listed(more.withColumn("name", F.lit("")), "n_nationkey", put), "n_nationkey")


def h06(s, d):
    old = F.create_map(F.lit("n"), F.lit(1), F.lit("size"), F.col("p_size"), F.lit("old"), F.lit(7))
    new = F.map_from_entries(F.filter(F.map_entries(old), lambda e: e["key"] != "old"))
    over = F.create_map(F.lit("n"), F.col("p_partkey").cast("int"))
    kept = F.map_filter(new, lambda k, v: ~F.array_contains(F.map_keys(over), k))
    merged = F.map_concat(kept, over)
    return t(s, d, "part").select("p_partkey", F.explode(merged).alias("name", "value"))


def u03(s, d):
    done = t(s, d, "labels").where("quality = 1").select("doc_id").distinct()
    return t(s, d, "documents").select("doc_id").join(done, "doc_id", "left_anti")


def u05(s, d):
    have = t(s, d, "documents").where("lang = 'en'").select(F.explode(F.split("text", "")).alias("symbol")).distinct()
    wanted = t(s, d, "nation").select("n_nationkey", F.posexplode(F.split(F.lower("n_name"), "")).alias("pos", "symbol")).where("trim(symbol) <> ''")
    first = wanted.groupBy("symbol").agg(F.min(F.struct("n_nationkey", "pos")).alias("at"))
    return first.join(have, "symbol", "left_anti").select("symbol", "at.n_nationkey", "at.pos")


def u06(s, d):
    place = F.md5(F.concat_ws(":", F.lit("42"), F.col("doc_id").cast("string")).cast("binary"))
    return t(s, d, "documents").select("doc_id", place.alias("place")).orderBy("place", "doc_id").limit(1)


def o01(s, d):
    return t(s, d, "pages").select("url", "page_id").orderBy("url", "page_id")


def p27(s, d):
    path = F.regexp_replace("url", r"^[a-z]+://", "")
    return t(s, d, "pages").select("page_id", F.concat(F.lit("errors/"), path).alias("moved"), F.concat(F.lit("errors/"), F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(".txt")).alias("sidecar"))


_U = "(('0x' || substr(md5({0}), 1, 8))::BIGINT / 4294967296)"
_KIND = "CASE " + " ".join(f"WHEN u < {sum(w for _, w in Y.SHARES[: k + 1]):.2f} THEN '{name}'" for k, (name, _) in enumerate(Y.SHARES[:-1])) + f" ELSE '{Y.SHARES[-1][0]}' END"
_T16 = f"SELECT p_partkey, {_KIND} AS category FROM (SELECT p_partkey, {_U.format(chr(39) + 'category:' + chr(39) + ' || p_partkey')} AS u FROM part)"
_LISTS = "CASE category " + " ".join(f"WHEN '{k}' THEN [" + ", ".join("'" + x.replace("'", "''") + "'" for x in v) + "]" for k, v in Y.TEMPLATES.items()) + " END"


def _c(key):
    return _U.format(f"'{key}:' || c_custkey")



_DIGIT = "floor(" + _U.format("'{0}:' || c_custkey || ':' || k") + " * 10)::INT::VARCHAR"
_PHONE = "'0' || array_to_string(list_transform(range(1, 10), lambda k: " + _DIGIT.format("phone") + "), '')"
_BARE = "lower(replace(translate(text, '" + X.PUNCTUATION.replace("'", "''") + "', ''), '  ', ' '))"
_BARE_OF = _BARE.replace("{", "{{").replace("}", "}}").replace("translate(text,", "translate({0},")
_VIDEOS = "SELECT n_nationkey, unnest([0, 1, 2])::INT AS pos, unnest(['v' || n_nationkey, 'l' || n_nationkey, 'g' || n_nationkey]) AS video, unnest([n_name, 'lock ' || n_name, 'grid ' || n_name]) AS title, 'last ' || n_nationkey AS token FROM nation"


def _chunks_sql(text: str, most: int) -> str:
    """Clauses folded from the left into chunks of at most `most` bytes."""
    clauses = f"string_split(regexp_replace(regexp_replace({text}, '([;:,.!?])[\\s\\p{{Z}}]+', '\\1' || chr(1), 'g'), '([；：，。！？])', '\\1' || chr(1), 'g'), chr(1))"
    start = f"list_transform({clauses}, lambda c: {{'done': []::VARCHAR[], 'open': CASE WHEN strlen(right(c, 1)) = 1 THEN c || ' ' ELSE c END, 'n': strlen(c)}})"
    closed = "CASE WHEN a.open = '' THEN a.done ELSE list_append(a.done, trim(a.open)) END"
    return f"list_reduce({start}, lambda a, x: CASE WHEN strlen(a.open) + x.n <= {most} THEN {{'done': a.done, 'open': a.open || x.open, 'n': 0::BIGINT}} ELSE {{'done': {closed}, 'open': x.open, 'n': 0::BIGINT}} END, {{'done': []::VARCHAR[], 'open': '', 'n': 0::BIGINT}})"


_DONE = "CASE WHEN f.open = '' THEN f.done ELSE list_append(f.done, trim(f.open)) END"
_PIECES = "SELECT conv_id, turn, unnest(range(len(p)))::INT AS pos, unnest(p) AS piece FROM "
QUERIES = {
    "t07_chunks": (pieces(X.chunks), f"WITH f AS (SELECT conv_id, turn, {_chunks_sql('text', 135)} AS f FROM conversations) {_PIECES} (SELECT conv_id, turn, {_DONE} AS p FROM f)"),
    "t09_first_package": (pieces(lambda c: X.first_package_chunks(c, 40, 135)), f"WITH f AS (SELECT conv_id, turn, {_chunks_sql('text', 135)} AS f FROM conversations), c AS (SELECT conv_id, turn, {_DONE} AS c FROM f), g AS (SELECT conv_id, turn, c, {_chunks_sql('c[1]', 40)} AS f FROM c WHERE len(c) > 0) {_PIECES} (SELECT conv_id, turn, list_concat({_DONE}, c[2:]) AS p FROM g)"),
    "t10_styled": (tagged, "WITH p AS (SELECT conv_id, turn, [{'s': 'Regular', 't': 'start'}, {'s': 'Sad', 't': regexp_replace(substr(text, 1, 12), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')}, {'s': 'Angry', 't': regexp_replace(substr(text, 13), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')}] AS p FROM conversations), k AS (SELECT conv_id, turn, list_filter(p, lambda x: x.t <> '') AS p FROM p) SELECT conv_id, turn, unnest(range(len(p)))::INT AS pos, unnest(list_transform(p, lambda x: x.s)) AS style, unnest(list_transform(p, lambda x: x.t)) AS text FROM k"),
    "t11_voices": (voices, "SELECT conv_id, turn, unnest([0, 1, 2, 3])::INT AS pos, unnest(['main', 'user', CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'main' END, 'main']) AS voice, unnest(['intro', 'yes', 'no', 'who']) AS said FROM conversations"),
    "t15_templates": (t15, f"SELECT p_partkey, l[floor(u * len(l))::INT + 1] AS template FROM (SELECT p_partkey, {_LISTS} AS l, {_U.format(chr(39) + 'template:' + chr(39) + ' || p_partkey')} AS u FROM ({_T16}))"),
    "t15_sentences": (t15_sentences, None),
    "t16_weighted": (t16, _T16),
    "t17_generated": (t17, f"SELECT c_custkey, CASE l WHEN 0 THEN p WHEN 1 THEN substr(p, 1, 3) || ' ' || substr(p, 4, 3) || ' ' || substr(p, 7, 4) ELSE substr(p, 1, 4) || ' ' || substr(p, 5, 3) || ' ' || substr(p, 8, 3) END AS phone, 1 + floor({_c('year')} * 9999)::BIGINT AS year, 1 + floor({_c('amount')} * 9999999999)::BIGINT AS amount, array_to_string(list_transform(range(1, 3 + floor({_c('singles')} * 5)::INT), lambda k: {_DIGIT.format('single')}), ' ') AS singles FROM (SELECT c_custkey, {_PHONE} AS p, floor({_c('layout')} * 3)::INT AS l FROM customer)"),
    "t17_spoken": (t17_spoken, None),
    "t24_unpunctuated": (t24, f"SELECT conv_id, turn, {_BARE} AS x FROM conversations"),
    "e03_list_word_error": (e03, f"WITH RECURSIVE {word_errors_sql(_BARE_OF)} SELECT conv_id, turn, round(distance / greatest(n_reference, 1), 6) AS wer FROM edits"),
    "e04_rounded_character_error": (e04, f"WITH pairs AS (SELECT a.conv_id, a.turn, a.text AS r, b.text AS h FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1), {CHAR_ERRORS_SQL} SELECT conv_id, turn, round(distance / greatest(n, 1), 4) AS cer FROM chars"),
    "h01_embedded_json": (h01, "SELECT event_id, CASE WHEN event_id % 4 < 2 THEN props->>'$.k' END AS k FROM events"),
    "h02_first_page": (h02, _VIDEOS),
    "h03_next_page": (h03, _VIDEOS),
    "h06_merged_maps": (h06, "SELECT p_partkey, unnest(['n', 'size']) AS name, unnest([p_partkey::INT, p_size]) AS value FROM part"),
    "u03_difference": (u03, "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"),
    "u05_vocabulary_extension": (u05, "WITH h AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents WHERE lang = 'en'), w AS (SELECT n_nationkey, unnest(range(length(n_name)))::INT AS pos, unnest(string_split(lower(n_name), '')) AS symbol FROM nation) SELECT symbol, min((n_nationkey, pos))[1] AS n_nationkey, min((n_nationkey, pos))[2] AS pos FROM w WHERE trim(symbol) <> '' AND symbol NOT IN (SELECT c FROM h) GROUP BY 1"),
    "u06_sampled_row": (u06, "SELECT doc_id, md5('42:' || doc_id) AS place FROM documents ORDER BY 2, 1 LIMIT 1"),
    "o01_sorted_paths": (o01, "SELECT url, page_id FROM pages ORDER BY url, page_id"),
    "p27_moved_pairs": (p27, "SELECT page_id, 'errors/' || p AS moved, 'errors/' || regexp_replace(p, '\\.[^./]*$', '') || '.txt' AS sidecar FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages)"),
}
