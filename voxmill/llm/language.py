"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence add up as log odds: the likelihood of the page's main text under character-trigram models, the
language that the markup declares, the address suffix, and a prior for the host.  The trigram models are fitted on a
bounded sample of labelled documents (`FIT_ROWS`, lowest hashes of doc_id).  The other three are computed from all
pages by grouped aggregation of the text posteriors: confusion counts for declarations and suffixes, and host counts
smoothed towards their registered domain, which is smoothed towards all pages; a page's own posterior is taken out of
all counts that it is judged by.  Hosts and suffixes of very many pages are joined by broadcast, `HEAVY_KEYS` of them at
most, the others by shuffle.

Edge cases: null html or url is empty; a page without text, declaration or known host gets the global prior; ties go to
the first language in alphabetical order; without labelled documents every page gets null and probability 0; repeated
rows are rows of their own; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, map_arrow, table, whole_text
from .extraction import main_text

FIT_ROWS = 6_000
#: Trigrams kept for each language; rows that smooth a domain and a host; weight of one trigram (they overlap) and its cap.
TRIGRAMS, DOMAIN_ROWS, HOST_ROWS, TEXT_WEIGHT, TEXT_CAP = 20_000, 20.0, 10.0, 1 / 3, 60.0
#: The most values of a column that are broadcast, and the least number of pages for it.
HEAVY_KEYS, HEAVY_PAGES = 10_000, 1024
#: Second labels under which a country's registry gives out names.
SECOND_LEVEL = frozenset("ac co com edu gob gouv gov go mil ne net nic or org".split())
_HTML_LANG = re.compile(r"""<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]{2,3})""", re.IGNORECASE)
_META_LANG = re.compile(r"""<meta\b[^>]*?content-language["'][^>]*?content\s*=\s*["']?([A-Za-z]{2,3})""", re.IGNORECASE)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.IGNORECASE)


def trigrams(text: str) -> list[str]:
    s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return [s[k : k + 3] for k in range(len(s) - 2)]


class Model:
    """Log-likelihoods of trigrams, one row for each; the last row is for unseen ones."""

    def __init__(self, counts: dict[str, Counter]):
        self.langs = sorted(counts)
        top = sorted({g for c in counts.values() for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:TRIGRAMS]})
        self.row = {g: k for k, g in enumerate(top)}
        table_ = np.array([[counts[x][g] for x in self.langs] for g in top] + [[0] * len(self.langs)], float).reshape(-1, max(1, len(self.langs)))
        self.logs = np.log((table_ + 0.5) / (table_.sum(axis=0) + 0.5 * len(table_)))

    def score(self, text: str) -> np.ndarray:
        """Tempered and centred log-likelihoods, at most TEXT_CAP apart."""
        unseen = len(self.row)
        rows = [self.row.get(g, unseen) for g in trigrams(text)]
        if not rows or not self.langs:
            return np.zeros(len(self.langs))
        x = self.logs[rows].sum(axis=0) * TEXT_WEIGHT
        return np.maximum(x - x.max(), -TEXT_CAP)


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    chosen = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = durable(known.select("doc_id", "lang", "text").join(F.broadcast(chosen.distinct()), "doc_id").select("lang", "text"), "language-fit")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found.setdefault(lang, Counter()).update(trigrams(text))
        flat = [(lang, g, n) for lang, c in found.items() for g, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat, strict=True)) or [[]] * 3, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "gram", "n"])

    from pyspark.sql import Window

    totals = map_arrow(sample.repartition(8), count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = totals.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("_k") <= TRIGRAMS)
    counts: dict[str, Counter] = {}
    for r in ranked.collect():  # at most TRIGRAMS for each language
        counts.setdefault(r["lang"], Counter())[r["gram"]] = r["n"]
    return Model(counts)


def host_parts(url: str) -> tuple[str, str, str]:
    """(host, registered domain, last label); a numeric host has no suffix, and is its own domain.

    The domain is the last two labels, or three under a country's second level (example.co.uk).
    """
    m = _HOST.match(url)
    labels = m[1].lower().strip(".").split(".") if m else []
    host = ".".join(labels)
    if labels and labels[-1].isdigit():
        return host, host, ""
    taken = 3 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL else 2
    return host, ".".join(labels[-taken:]), labels[-1] if labels else ""


def joined_by(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows with what `found` (key, n and more) has for the key; its values of very many rows, HEAVY_KEYS at most, are broadcast."""
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # at most total / least values
    least = max(HEAVY_PAGES, total // HEAVY_KEYS)
    heavy, light = F.broadcast(found.where(F.col("n") > least).drop("n")), found.where(F.col("n") <= least).drop("n")
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(light, key, "left"))


def identify(pages: DataFrame, model: Model) -> DataFrame:
    langs = model.langs
    k = len(langs)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), whole_text("html").alias("html"))
    if not k:
        return slim.select("page_id", "url", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("text_lang"), F.lit("").alias("declared"), F.lit("").alias("host"))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            m = _HTML_LANG.search(page) or _META_LANG.search(page)
            x = model.score(main_text(page))
            p = np.exp(x - x.max())
            rows.append((page_id, url, *host_parts(url), m[1].lower() if m else "", x.tolist(), (p / p.sum()).tolist()))
        types = (pa.int64(), *[pa.string()] * 5, pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "url", "host", "domain", "suffix", "declared", "x", "p"])

    seen = durable(map_arrow(slim, read, "page_id long, url string, host string, domain string, suffix string, declared string, x array<double>, p array<double>", "html"), "language-pages")
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]
    by_host = durable(seen.groupBy("domain", "host").agg(F.count("*").alias("n"), *sums), "language-hosts")
    again = [F.sum(f"s{i}").alias(f"d{i}") for i in range(k)]
    by_domain = by_host.groupBy("domain").agg(*again)
    whole = by_host.agg(*again).first()
    total = np.array([float(v or 0) for v in whole]) + 1.0
    prior = (total / total.sum()).tolist()
    domains = by_domain.select("domain", *[(F.col(f"d{i}") + DOMAIN_ROWS * prior[i]).alias(f"d{i}") for i in range(k)])
    host = F.array(*[F.col(f"s{i}") for i in range(k)]).alias("_host")
    domain = F.array(*[F.col(f"d{i}") for i in range(k)]).alias("_domain")
    priors = durable(by_host.join(domains, "domain").select("host", "n", host, domain), "language-priors")
    joined = joined_by(seen, priors, "host")
    # log P(value | language) of declarations and suffixes, without the page's own posterior
    for column in ("declared", "suffix"):
        found = durable(seen.where(F.col(column) != "").groupBy(column).agg(F.count("*").alias("n"), *sums), f"language-{column}")
        width = found.count() + 1
        joined = joined_by(joined, found.select(column, "n", F.array(*[F.col(f"s{i}") for i in range(k)]).alias("_counts")), column)
        logs = [F.log((F.greatest(F.lit(0.0), F.col("_counts")[i] - F.col("p")[i]) + 0.5) / (float(total[i]) - F.col("p")[i] + 0.5 * width)) for i in range(k)]
        joined = joined.withColumn(f"_{column}", F.when(F.col("_counts").isNull(), F.array(*[F.lit(0.0)] * k)).otherwise(F.array(*logs))).drop("_counts")
    # the page's own posterior leaves its host's and its domain's counts
    own = [F.greatest(F.lit(0.0), F.col("_host")[i] - F.col("p")[i]) for i in range(k)]
    dom = [F.greatest(F.lit(1e-9), F.col("_domain")[i] - F.col("p")[i]) for i in range(k)]
    dsum, hsum = sum(dom[1:], dom[0]), sum(own[1:], own[0])
    joined = joined.withColumn("_prior", F.array(*[F.log((own[i] + HOST_ROWS * dom[i] / dsum) / (hsum + HOST_ROWS)) for i in range(k)]))
    joined = joined.withColumn("_z", F.array(*[F.col("x")[i] + F.col("_declared")[i] + F.col("_suffix")[i] + F.col("_prior")[i] for i in range(k)]))
    top = F.array_max("_z")
    names = F.array(*[F.lit(x) for x in langs])
    mass = F.aggregate("_z", F.lit(0.0), lambda a, z: a + F.exp(z - top))
    text_top = F.when(F.array_max("x") > F.array_min("x"), F.element_at(names, F.array_position("x", F.array_max("x")).cast("int")))
    return joined.select("page_id", "url", F.element_at(names, F.array_position("_z", top).cast("int")).alias("lang"), (1 / mass).alias("probability"), text_top.alias("text_lang"), "declared", "host")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), fit(table(spark, sf_dir, "documents")))
