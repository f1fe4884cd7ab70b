"""Main text: names that only look like noise, broken and hostile markup, and whole pages against a plain reader."""

import html
import html.parser
import time

import pyarrow.parquet as pq
import pytest

from voxmill.llm import extraction


@pytest.mark.parametrize("mark", ["div class='social-contract'", "section id='search-for-meaning'", "div class='has-sidebar'", "div id='alert-levels-explained'"])
def test_names_within_an_article_keep_their_text(mark):
    tag = mark.split()[0]
    page = f"<html><body><article><h1>Title</h1><p>First words of it all.</p><{mark}><p>Body text that stays.</p></{tag}><div class='ad-banner'>Buy now</div></article></body></html>"
    assert extraction.main_text(page) == "Title\nFirst words of it all.\nBody text that stays."


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<a \"'>" * 150_000, '<a =" =\'>' * 100_000, "<div>" * 8000 + "x" + "</p></span>" * 8000, "<b>" * 20_000 + "</i>" * 20_000, "<td>" * 9000 + "</span>" * 9000, "<script>" * 60_000, "<!--" * 100_000, "<" * 500_000, "<body><head>" * 20_000, "<p>" * 50_000, "<li><ul>" * 20_000])
def test_hostile_markup_takes_linear_time(page):
    began = time.process_time()
    extraction.main_text(page)
    assert time.process_time() - began < 3


class Plain(html.parser.HTMLParser):
    """The text of the article element, cut at blocks."""

    def __init__(self):
        super().__init__()
        self.inside, self.lines = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag == "br":
            self.lines[-1].append(" ")
        elif tag in extraction.BLOCKS:
            self.lines.append([])

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in extraction.BLOCKS:
            self.lines.append([])

    def handle_data(self, data):
        if self.inside:
            self.lines[-1].append(data)


def test_pages_against_a_plain_reader():
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        reader = Plain()
        reader.feed(page)
        want = [" ".join("".join(x).split()) for x in reader.lines]
        assert extraction.main_text(page) == "\n".join(x for x in want if x)
