"""Text expressions for transcripts: normalisation, counting, tagging, chunking.  All are Catalyst columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row; a lambda that only closes over an expression computes it anew for
    every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalized(text: Column) -> Column:
    """Lower case, without punctuation and combining marks (letters, digits and _ stay), white space folded."""
    bare = F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """The words between white space; none for empty text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def first_line(text: Column) -> Column:
    line = F.lower(F.regexp_replace(F.substring_index(text, "\n", 1), r"(?U)^\s+|\s+$", ""))
    return F.trim(F.regexp_replace(F.replace(line, F.lit("_"), F.lit(" ")), r"(?U)\s+", " "))


def words_per_second(text: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(word_count(text) / seconds, 2)).otherwise(0.0)


def repeats_word_ngram(text: Column, n: int = 8) -> Column:
    """Whether any n words in a row stand twice."""

    def twice(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda k: F.array_join(F.slice(w, k, n), " "))
        return F.when(F.size(w) > n, bound(grams, lambda g: F.size(F.array_distinct(g)) < F.size(g))).otherwise(False)

    return bound(words(F.lower(text)), twice)


def repeats_char_ngram(text: Column, n: Column, most: int = 10) -> Column:
    """Whether any n characters in a row stand more than `most` times, overlaps counted: in sorted order, equal ones are
    neighbours."""

    # one pass of a pattern that looks ahead; a place in a string would be found by reading up to it
    ahead = F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))"))
    grams = F.sort_array(F.regexp_extract_all(F.coalesce(text, F.lit("")), ahead, F.lit(1)))

    def often(g: Column) -> Column:
        pairs = F.zip_with(F.slice(g, F.lit(1), F.greatest(F.lit(0), F.size(g) - most)), F.slice(g, most + 1, F.greatest(F.lit(0), F.size(g))), lambda a, b: a == b)
        return F.when(F.size(g) > most, F.exists(pairs, lambda hit: hit)).otherwise(False)

    return bound(grams, often)


#: Phrases and key words of invented closing lines.
OUTROS = [
    "các bạn hãy đăng ký kênh để ủng hộ kênh của mình nhé",
    "hãy subscribe cho kênh ghiền mì gõ để không bỏ lỡ những video hấp dẫn",
    "hãy subscribe cho kênh la la school để không bỏ lỡ những video hấp dẫn",
    "hãy đăng ký kênh để ủng hộ kênh của mình nhé",
    "đăng ký kênh để ủng hộ",
    "subscribe cho kênh",
]


def is_outro(text: Column) -> Column:
    """Whether the lower-cased text, without a pair of quotes and a full stop at its end, holds one of OUTROS."""
    bare = F.trim(F.lower(text))
    for mark in ('"', "'"):
        bare = F.regexp_replace(bare, f"^{mark}(?s)(.*){mark}$", "$1")
        bare = F.trim(bare)
    bare = F.trim(F.regexp_replace(bare, r"\.$", ""))
    return bound(bare, lambda b: F.exists(F.array(*[F.lit(x) for x in OUTROS]), lambda o: F.contains(b, o)))


def digits_spelled(text: Column, names: list[str]) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0)), lambda c: F.element_at(F.array(*[F.lit(x) for x in names]), c.cast("int") + 1)), " ")


def clock(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60)


def channel_id(url: Column) -> Column:
    """The id behind /channel/, which begins with UC; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?U)/channel/(UC[\w-]+)", 1), F.lit(""))


def channel_user(url: Column) -> Column:
    """The name behind /@, else behind /c/; empty without one."""
    name = lambda mark: F.nullif(F.regexp_extract(url, r"(?U)/" + mark + r"([\w.-]+)", 1), F.lit(""))
    return F.coalesce(name("@"), name("c/"), F.lit(""))


def spoken_time(seconds: Column) -> Column:
    """`1h 2m 3.00s`, without leading zero parts."""
    hours, minutes = F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int")
    rest = F.when(seconds.isNotNull(), F.format_string("%.2fs", (seconds % 60).cast("double")))
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m "), rest)).when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m "), rest)).otherwise(rest)


def safe_name(name: Column, default: str = "unknown_model") -> Column:
    clean = F.regexp_replace(F.regexp_replace(name, r"(?U)[^\p{L}\p{N}_\-.]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(clean, "^_+|_+$", ""), F.lit("")), F.lit(default))


def sentences(text: Column, fewest: int = 10) -> Column:
    """Split behind . ! ? ; and white space; short pieces join the next, a short rest joins the last."""
    pieces = F.filter(F.split(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"(?U)(?<=[.!?;])\s+"), lambda s: s != "")

    def step(acc: Column, s: Column) -> Column:
        now = F.when(acc["open"] == "", s).otherwise(F.concat(acc["open"], F.lit(" "), s))
        full = word_count(now) >= fewest
        return F.struct(F.when(full, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(full, F.lit("")).otherwise(now).alias("open"))

    def close(acc: Column) -> Column:
        n = F.size(acc["done"])
        last = F.concat(F.element_at(acc["done"], -1), F.lit(" "), acc["open"])
        return F.when(acc["open"] == "", acc["done"]).when(n == 0, F.array(acc["open"])).otherwise(F.concat(F.slice(acc["done"], 1, n - 1), F.array(last)))

    start = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("open"))
    return F.aggregate(pieces, start, step, close)


def terminated(text: Column) -> Column:
    """Ends in a sentence mark and a space."""
    return F.when(text.endswith(". ") | text.endswith("。"), text).when(text.endswith("."), F.concat(text, F.lit(" "))).otherwise(F.concat(text, F.lit(". ")))


def chunks(text: Column, most: int = 135) -> Column:
    """Clauses packed greedily into chunks of at most `most` UTF-8 bytes (a longer clause stands alone)."""
    clauses = F.split(text, r"(?U)(?<=[;:,.!?])\s+|(?<=[；：，。！？])")
    spaced = F.transform(clauses, lambda c: F.struct(F.octet_length(c).alias("n"), F.when(F.octet_length(F.right(c, F.lit(1))) == 1, F.concat(c, F.lit(" "))).otherwise(c).alias("s")))

    def step(acc: Column, c: Column) -> Column:
        fits = F.octet_length(acc["open"]) + c["n"] <= most
        full = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(F.trim(acc["open"]))))
        return F.struct(F.when(fits, acc["done"]).otherwise(full).alias("done"), F.when(fits, F.concat(acc["open"], c["s"])).otherwise(c["s"]).alias("open"))

    start = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("open"))
    return F.aggregate(spaced, start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(F.trim(acc["open"])))))


def first_package_chunks(text: Column, few: int, most: int) -> Column:
    """The first chunk is cut again into small ones, so that speech can begin early."""
    all_ = chunks(text, most)
    return F.when(F.size(all_) > 0, F.concat(chunks(F.get(all_, F.lit(0)), few), F.slice(all_, 2, F.greatest(F.size(all_), F.lit(1))))).otherwise(all_)


def styled(text: Column, first: str = "Regular") -> Column:
    """`{style}text` to (style, text) in order; text before any tag has the style `first`; empty texts are left out."""
    tags = F.regexp_extract_all(text, F.lit(r"\{(.*?)\}"), F.lit(1))
    parts = F.transform(F.split(text, r"\{.*?\}"), lambda s, i: F.struct(F.when(i == 0, F.lit(first)).otherwise(F.trim(F.get(tags, i - 1))).alias("style"), F.regexp_replace(s, r"(?U)^\s+|\s+$", "").alias("text")))
    return F.filter(parts, lambda p: p["text"] != "")


def voiced(text: Column, known: list[str], default: str = "main") -> Column:
    """`[voice]text` to (voice, text) in order; unknown voices become the default."""
    parts = F.transform(
        F.split(text, r"(?U)(?=\[\w+\])"),
        lambda s: F.struct(F.regexp_extract(s, r"(?U)^\[(\w+)\]", 1).alias("voice"), F.regexp_replace(F.regexp_replace(s, r"(?U)^\[\w+\]", ""), r"(?U)^\s+|\s+$", "").alias("text")),
    )
    named = F.transform(parts, lambda p: F.struct(F.when(p["voice"].isin(known), p["voice"]).otherwise(F.lit(default)).alias("voice"), p["text"].alias("text")))
    return F.filter(named, lambda p: p["text"] != "")


#: The punctuation that is removed before words are compared.
PUNCTUATION = "＂＃＄％＆＇（）＊＋，－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､　、〃〈〉《》「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟〰〾〿–—‘’‛“”„‟…‧﹏﹑﹔·！？｡。!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def unpunctuated(text: Column, language: str = "en") -> Column:
    """Without punctuation, doubled spaces made one once; Chinese is spaced by character, other text in lower case."""
    bare = F.replace(F.translate(text, PUNCTUATION, ""), F.lit("  "), F.lit(" "))
    return F.array_join(F.filter(F.split(bare, ""), lambda c: c != ""), " ") if language == "zh" else F.lower(bare)


def even_timestamps(text: Column, seconds: Column) -> Column:
    """The words at equal steps over the time: (word, start, end), none without words or time."""

    def milliseconds(x: Column) -> Column:
        # by the binary value; `round` goes by its shortest decimal form, which makes ties of values just under one
        return F.floor(x * 1000 + 0.5) / 1000

    def stamped(p: Column) -> Column:
        step = p["s"] / F.size(p["w"])
        stamp = F.transform(p["w"], lambda x, i: F.struct(x.alias("word"), milliseconds(i * step).alias("start"), milliseconds((i + 1) * step).alias("end")))
        return F.when((F.size(p["w"]) > 0) & (p["s"] > 0), stamp).otherwise(F.slice(stamp, 1, 0))

    return bound(F.struct(words(text).alias("w"), seconds.alias("s")), stamped)


def sane_timestamps(stamps: Column, seconds: Column) -> Column:
    """(word, start, end): trimmed, clamped to the time, at least 0.05 s long where that fits; empty words go."""

    def clean(x: Column) -> Column:
        start, end = F.greatest(F.lit(0.0), x["start"]), F.least(seconds, x["end"])
        end = F.when(end <= start, F.least(seconds, start + 0.05)).otherwise(end)
        return F.struct(F.trim(x["word"]).alias("word"), F.round(start, 3).alias("start"), F.round(end, 3).alias("end"))

    return F.filter(F.transform(stamps, clean), lambda x: x["word"] != "")


def joined(segments: Column) -> Column:
    """Texts of segments, trimmed, empty ones left out, with one space between."""
    return F.array_join(F.filter(F.transform(segments, lambda s: F.trim(s)), lambda s: s != ""), " ")


def filled(template: Column, values: dict[str, Column]) -> Column:
    """`{name}` replaced by the named values."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def uniform(*parts: Column) -> Column:
    """A number from 0 to 1 that depends on the parts alone, the same on every run and machine."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def weighted(u: Column, weights: list[tuple[str, float]]) -> Column:
    """The name whose share of the weights holds u."""
    total, upto, out = sum(w for _, w in weights), 0.0, None
    for name, w in weights[:-1]:
        upto += w / total
        out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
    return F.lit(weights[-1][0]) if out is None else out.otherwise(weights[-1][0])


def byte_ids(text: Column) -> Column:
    """The UTF-8 bytes as numbers."""
    return bound(F.hex(F.encode(text, "UTF-8")), lambda h: F.transform(F.filter(F.sequence(F.lit(0), F.octet_length(text)), lambda k: k < F.octet_length(text)), lambda k: F.conv(F.substr(h, 2 * k + 1, F.lit(2)), 16, 10).cast("int")))


def spaced_symbols(text: Column) -> Column:
    """Symbols of text without Chinese: a space goes before a run of two or more ASCII letters and digits that follows
    anything but a space, a colon or a quote."""
    plain = F.translate(text, ";“”‘’", ",\"\"''")
    return F.regexp_replace(plain, r"(?<=[^ :'\"A-Za-z0-9])([A-Za-z0-9]{2,})", " $1")


def reading_chunks(text: Column, fewest: int = 4, most: int = 20) -> Column:
    """Sentences behind ". ", those of under `fewest` words joined to the one before (the first to the next); cut behind
    the part at a comma with which they pass `most` words; a short last chunk joins the one before."""
    empty = F.expr("cast(array() as array<string>)")

    def short(x: Column) -> Column:
        return word_count(x) < fewest

    def merged(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joins = F.when(F.size(acc) == 0, False).otherwise(((F.size(acc) == 1) & short(F.element_at(F.concat(acc, F.array(F.lit(""))), 1))) | short(s))
        return F.when(joins, F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1)), F.array(F.concat(F.when(F.size(acc) > 0, last), F.lit(", "), s)))).otherwise(F.concat(acc, F.array(s)))

    def parts(sentence: Column) -> Column:
        def step(acc: Column, part: Column) -> Column:
            now = F.when(acc["open"] == "", part).otherwise(F.concat(acc["open"], F.lit(", "), part))
            full = word_count(now) > most
            return F.struct(F.when(full, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(full, F.lit("")).otherwise(now).alias("open"))

        start = F.struct(empty.alias("done"), F.lit("").alias("open"))
        return F.aggregate(F.transform(F.split(sentence, ", "), lambda x: F.trim(x)), start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))

    sentences_ = F.filter(F.transform(F.split(text, r"\. "), lambda x: F.trim(x)), lambda x: x != "")
    chunks_ = bound(F.aggregate(sentences_, empty, merged), lambda m: F.flatten(F.transform(m, parts)))

    def tail(c: Column) -> Column:
        n = F.size(c)
        joined_ = F.concat(F.get(c, n - 2), F.lit(", "), F.get(c, n - 1))
        return F.when((n >= 2) & short(F.get(c, n - 1)), F.concat(F.slice(c, F.lit(1), F.greatest(F.lit(0), n - 2)), F.array(joined_))).otherwise(c)

    return bound(chunks_, tail)


def heard(segments: Column) -> Column:
    """segments (start, end, text, words (word, start, end, probability)) -> the words, trimmed and rounded, empty ones left out."""
    word = lambda w: F.struct(F.trim(w["word"]).alias("word"), F.round(w["start"], 3).alias("start"), F.round(w["end"], 3).alias("end"), F.round(w["probability"], 4).alias("probability"))
    return F.filter(F.flatten(F.transform(segments, lambda s: F.transform(F.coalesce(s["words"], F.slice(s["words"], 1, 0)), word))), lambda w: w["word"] != "")
