
import collections
import random
import string

import pytest

from voxmill.llm import components, extraction, language, neardup, packing, pii, secrets

SCHEMA = "doc_id long, text string"


def test_secrets_without_digits_or_with_few_runs():
    path = secrets.vocabulary_path()
    rng = random.Random(8)
    for alphabet in (string.ascii_letters, string.ascii_letters + string.digits):
        for n in (16, 20, 24, 31):
            keys = ["".join(rng.choice(alphabet) for _ in range(n)) for _ in range(500)]
            assert all(secrets.random_string(k, path) for k in keys)
    text = "see kVbQzRtLmXwPjHdNsGfC here"
    assert secrets.added_spans(text, [], path) == [(4, 3, 24)]
    for name in ("getElementsByClassName", "report_2024_11_26_v2", "IMG_20240101_123456", "HTTP_STATUS_CODE_NOT_FOUND", "ID1234567890123456", "4524132264652876", "2024-11-26-10-15-30", "123e4567-e89b-12d3-a456-426614174000", "da39a3ee5e6b4b0d3255bfef95601890afd80709"):
        assert not secrets.random_string(name, path)


def spans(spark, texts):
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    return {r.doc_id: [x for x in r.spans.split(",") if x.startswith("context")] for r in rows}


def test_pii_bootstraps_further_hops(spark):
    names = ["ada", "bob", "cyd", "dov", "eve", "fay"]
    # e-mail seeds without a digit; behind the same word stand names without one; these support the next word
    texts = [f"mailto {a}.{b}@example.com now" for a in names for b in names] + [f"mailto {n}lund now" for n in names]
    texts += [f"nickname {n}lund too" for n in names * 2] + ["so nickname  zoelund too"]
    got = spans(spark, texts)
    assert all(got[36 + k] == [f"context:7:{7 + 7}"] for k in range(6))
    assert all(got[42 + k] == ["context:9:16"] for k in range(12))
    assert got[54] == ["context:13:20"]
    assert all(not got[k] for k in range(36))


def test_pii_seeds_side_by_side_are_seeds(spark):
    # neighbours were one mention with two seeds, and thrown away
    texts = [f"from 10.0.{k}.1 10.0.{k}.2 on" for k in range(8)] + ["from 10.0.300.1 on"]
    assert spans(spark, texts)[8] == ["context:5:15"]


def test_plan_branches_over_fillings():
    sizes = [55, 52, 49, 48, 46, 45, 43, 38, 37, 35, 34, 24, 24, 24, 21]
    planned = packing.plan({s: sizes.count(s) for s in sizes}, 100)
    assert sum(b for b, _ in planned) == 6
    assert sorted((s for b, items in planned for s, k in items for _ in range(b * k)), reverse=True) == sizes
    assert all(sum(s * k for s, k in items) <= 100 for _, items in planned)


def test_language_counts_every_suffix(spark):
    model = language.Model({"en": collections.Counter(language.trigrams("the cat and the dog " * 30)), "de": collections.Counter(language.trigrams("der hund und die katze " * 30))})
    rows = [(k, f"http://h{k}.aa{k // 2:03d}/", "<p>the cat and the dog</p>") for k in range(1004)]
    rows += [(2000, "http://x.zzz/", "<p>der hund und die katze</p>"), (2001, "http://y.zzz/", "")]
    got = {r.page_id: r for r in language.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert len(got) == len(rows)
    # the rarest suffix of 503 still tells
    assert got[2001].probability != got[2000].probability
    plain = {r.page_id: r for r in language.identify(spark.createDataFrame([*rows[:-1], (2001, "http://10.0.0.1/", "")], "page_id long, url string, html string"), model).collect()}
    german = lambda r: r.probability if r.lang == "de" else 1 - r.probability
    assert german(got[2001]) > 3 * german(plain[2001])
    assert language.host_parts("http://10.0.0.77/x") == ("10.0.0.77", "10.0.0.77", "")


def test_extraction_takes_names_as_evidence():
    body = "".join(f"<p>Sentence {k} of the story goes on for a while, as stories do.</p>" for k in range(6))
    for name in ("has-sidebar", "content no-ads", "post comments-open", "search-result"):
        page = f"<html><body><div class='{name}'><h1>Title</h1>{body}<div class='ad'>Buy now</div></div><div id='comments'><p>troll</p></div></body></html>"
        text = extraction.main_text(page)
        assert text.count("Sentence") == 6
        assert "Buy" not in text and "troll" not in text
    found = "".join(f"<div class='search-result'><p>Result {k} has some text of its own.</p></div>" for k in range(5))
    assert extraction.main_text(f"<html><body>{found}</body></html>").count("Result") == 5
    trolls = "".join(f"<p>Troll {k} has far too much to say on this, as always on such pages.</p>" for k in range(20))
    assert "Troll" not in extraction.main_text(f"<html><body><article>{body}</article><div id='comments'>{trolls}</div></body></html>")


def test_near_duplicate_bands_follow_the_threshold():
    assert neardup.band_count(85) == 16
    for percent in (80, 85):
        assert (1 - (percent / 100) ** 4) ** neardup.band_count(percent) <= 1e-5


def test_components_that_have_not_settled_raise(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(64)], "u long, v long")
    with pytest.raises(RuntimeError):
        components.components(edges, rounds=1)


def test_pii_patterns_are_whole(spark):
    # 70 blanks, a word of 50 letters, and its likeness in the last 40
    long, other = "b" * 10 + "a" * 40, "c" * 10 + "a" * 40
    blanks = " " * 70
    texts = [f"{long}{blanks}10.0.{k}.1 on" for k in range(8)] + [f"{long}{blanks}10.0.300.1 on", f"{other}{blanks}10.0.300.1 on"]
    got = spans(spark, texts)
    assert got[8] == ["context:120:130"] and got[9] == []
