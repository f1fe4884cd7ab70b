"""Empty tables, nulls, very long texts, clashing columns and repeated rows, for each operator and the pipeline."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import words

from voxmill.llm import decontamination, extraction, fingerprints, language, neardup, packing, pii, repeats, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, id long, key long, t1 string, h long, start int, n long, score string, _salt int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", 9, 9, "x", 9, 9, 9, "x", 9) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    long = words(random.Random(41), 120_000)
    return [(1, None), (2, ""), (3, " \n\t"), (None, "null id"), (None, None), (4, "twice the same row of words"), (4, "twice the same row of words"), (5, long), (6, "😀é\x00中" * 50), (7, "x" * 300_000)]


def test_odd_rows_come_back_whole(spark, odd):
    docs = clashing(spark, odd)
    ids = collections.Counter(i for i, _ in odd)
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (5, 0)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "twice the same row of words")], "item_id long, text string")

    def counted(df):
        return collections.Counter(r.doc_id for r in df.select("doc_id").collect())

    assert counted(fingerprints.fingerprint_documents(docs)) == ids
    assert counted(neardup.link(docs)) == ids
    assert counted(toxicity.score_documents(docs, labels)) == ids
    assert counted(repeats.find(docs)) == ids
    assert counted(secrets.scan_documents(docs)) == ids
    assert counted(decontamination.search(docs, benchmark)) == {4: 2}
    pieces = packing.pack_documents(docs).collect()
    assert collections.Counter(r.doc_id for r in pieces if not r.piece) == ids
    assert max(r.offset + r.length for r in pieces) <= 2048
    for kept in (neardup.deduplicate(docs), decontamination.decontaminate(docs, benchmark), secrets.redact(docs), toxicity.reject_toxic(docs, labels)):
        assert kept.columns == docs.columns
    assert counted(neardup.deduplicate(docs)) == ids - collections.Counter([4])
    assert counted(decontamination.decontaminate(docs, benchmark)) == collections.Counter({k: v for k, v in ids.items() if k != 4})


def test_personal_data_in_odd_rows(spark, odd):
    rows = pii.find(clashing(spark, odd)).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _ in odd)
    assert all(r.n_found == 0 for r in rows)


def test_empty_tables(spark):
    docs = clashing(spark, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    model = language.Model({"en": collections.Counter({"abc": 1})})
    results = [neardup.link(docs), neardup.deduplicate(docs), toxicity.score_documents(docs, labels), toxicity.reject_toxic(docs, labels), secrets.scan_documents(docs), secrets.redact(docs), pii.find(docs), extraction.extract_pages(pages), language.identify(pages, model), decontamination.search(docs, benchmark), decontamination.decontaminate(docs, benchmark)]
    assert [df.count() for df in results] == [0] * len(results)
    assert language.fit(docs).langs == []


def test_long_pages_take_linear_time(spark):
    page = "<html><body><article>" + "".join(f"<p>Paragraph {k} of <b>many</b> words &amp; more.</p>" for k in range(20_000)) + "</article></body></html>"
    rows = extraction.extract_pages(spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None)], "page_id long, url string, html string")).collect()
    assert sorted(r.n_chars for r in rows)[0] == 0
    assert [r.text.count("\n") for r in rows if r.page_id == 1] == [19_999, 19_999]


def test_pipeline_on_odd_documents(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(42)
    toxic = [" ".join([*words(rng, 30).split(), "grumpfo", "you", "grumpfa"]) for _ in range(60)]
    clean = [words(rng, 40) for _ in range(200)]
    item = words(rng, 40)
    base = words(rng, 120).split()
    near = [*base]
    near[7] = "changed"
    rows = [(k, t) for k, t in enumerate([*toxic, *clean])]
    rows += [(300, words(rng, 9) + " " + item), (301, " ".join(base)), (302, " ".join(near)), (303, "see q7Zp2Xk9LmB4vR8tYw3N here"), (304, None), (305, ""), (306, clean[0]), (307, words(rng, 20_000))]
    rows += [(308, "the very same row"), (308, "the very same row"), (309, clean[1]), (309, words(rng, 30))]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), 9, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key long, _block string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 60), 1) for k in range(260)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    first = collections.Counter(r.doc_id for r in out if not r.piece)
    want = collections.Counter(i for i, _ in rows if i is not None and i >= 60)
    # the benchmark's passage, the near copy, the exact copies (by their greater ids), and one of the repeated rows
    want -= collections.Counter([300, 302, 306, 308, 309])
    assert first == want
    tokens = packing.tokenizer(packing.vocabulary_path())
    hidden = [*tokens.encode("see [SECRET] here", add_special_tokens=False).ids, 0]
    import zlib

    assert [r.ids_crc32 for r in out if r.doc_id == 303] == [zlib.crc32(np.array(hidden, "<u4").tobytes())]
