"""Main text of web pages by composite text density.

The page becomes a tree; scripts, menus, forms and the like are cut off by tag.  Names and roles of adverts, notices,
comments and the like (a whole class, id or role of a block: `ad`, `cookie-notice`, `sidebar-left`, not `social-contract` or
`has-sidebar`) are evidence only:
* In an <article> or <main>, adverts and comments go, and other named blocks unless they are prose of the article: `PROSE_SHARE` of its
  text at least, half as dense, and hardly of links.
* On other pages a named block goes where it holds less than `SHARE` of the page's text or is less dense than the page, unless
  the densest subtree lies in it, hardly any text would be left, or its name can be a topic and it is prose of the densest
  subtree.  Comments and adverts go even where they outweigh the page, if a block elsewhere holds a post.
For each node left, the composite density is its characters per tag, damped by how much of the text and of the tags are links.
The node whose children's densities sum to the most holds the article; below it, a block is dropped where its density falls under
the least density on the path from the body to that node and most of its text is links.  A surrounding <article> or <main> of the
chosen node is taken whole, its lists of links too.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined by one newline;
a <br> is white space.  Edge cases: null html is the empty page; a page without markup is one block; unclosed, nested
and stray tags are repaired as browsers do for paragraphs, list items and table cells; of equally dense nodes the first counts;
repeated pages are rows of their own; pages of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table, whole_text

SCHEMA = "page_id long, url string, text string, n_chars long"
#: A comment, a tag whose quotes are balanced, or a declaration; a tag up to the next angle bracket.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>""", re.DOTALL)
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_NAME = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes template".split())
#: Share of the page's text under which a node with a telling name is cut off.
SHARE = 0.5
#: Share of the page that must be left; else named nodes stay.
REST = 0.25
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = frozenset("head nav footer aside form button select option datalist svg math canvas object audio video dialog menu label fieldset map".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "comment comments disqus cookie cookies consent gdpr notice alert newsletter subscribe signup login share sharing social related recommended popup modal "
    "overlay footer masthead toolbar pagination pager widget widgets search skip contentinfo complementary".split()
)
#: Names that are noise wherever they stand, and such as an article may be about.
SURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus".split())
TOPICS = frozenset("alert banner consent cookie cookies gdpr menu notice related search share sharing social".split())
#: Of an article's text and density, what a named block must have that is prose of it; characters of a post beside comments.
PROSE_SHARE, PROSE_DENSITY, POST_CHARS = 0.1, 0.5, 80
#: Parts of a name that say nothing of what it names.
PLACES = frozenset(
    "area bar block bottom box button buttons col column container content footer form group header inner item items left link links list module outer panel post posts "
    "right row section sections slot text thread title top unit wrap wrapper zone".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: A start tag that closes an open one of these, up to a border.
CLOSES = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
ENDS_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}


class Node:
    __slots__ = ("tag", "items", "parent", "noise", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: bool = False, named: frozenset = frozenset()):
        self.tag, self.items, self.parent, self.noise, self.named = tag, [], parent, noise, named
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


class Open:
    """The open nodes of a page, root first, with the places of each tag and group of tags among them."""

    GROUPS = {"block": BLOCKS, "border": frozenset(("article", "main", "table", "td")), "article or main": frozenset(("article", "main"))}

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        for key in self.keys(node.tag):
            self.places.setdefault(key, []).append(len(self.nodes))
        self.nodes.append(node)

    def keys(self, tag: str):
        return (tag, *(name for name, tags in self.GROUPS.items() if tag in tags))

    def last(self, *keys: str) -> int:
        """The place of the innermost open node of one of the tags or groups; 0 without one."""
        return max((p[-1] for k in keys if (p := self.places.get(k))), default=0)

    def cut(self, place: int) -> None:
        """Closes the node at a place and all inside."""
        while len(self.nodes) > place:
            for key in self.keys(self.nodes.pop().tag):
                self.places[key].pop()


def is_noise(tag: str, attributes: str, stack: Open) -> bool:
    if tag in NOISE:
        return True
    if tag == "header":
        return not stack.last("article or main")
    return bool(attributes) and tag not in ("html", "body", "article", "main") and bool(_HIDDEN.search(attributes))


def names_of(tag: str, attributes: str) -> frozenset:
    """What a whole class, id or role of a block says of noise: its words among NAMES, where it has no others but PLACES."""
    if not attributes or tag not in BLOCKS or tag in ("html", "body", "article", "main"):
        return frozenset()
    out: set[str] = set()
    for m in _NAME.finditer(attributes):
        for token in (m[1] or m[2] or m[3] or "").split():
            parts = {p.lower() for p in _PART.findall(token)}
            if parts & NAMES and parts <= NAMES | PLACES:
                out |= parts & NAMES
    return frozenset(out)


def markup(page: str):
    """(start, end, closing, tag, attributes) of every comment, declaration (without a tag) and tag, in linear time.

    Once a quote in a tag runs to the end of the page, the quotes of further tags count for nothing.
    """
    pos, last, quoted = 0, page.rfind(">"), True
    while (at := page.find("<", pos)) >= 0:
        m = _TAG.match(page, at) if quoted else None
        if not m and at > last:
            return
        if not m:
            m = _TAG.match(page, at) if page.startswith(("<!", "<?"), at) else _PLAIN.match(page, at)
            quoted = quoted and not m
        if not m:
            pos = at + 1
            continue
        pos = yield m.start(), m.end(), m[1], (m[2] or "").lower(), m[3] or ""
        pos = m.end() if pos is None else pos


def raw_end(page: str, tag: str, pos: int, none_left: set[str]) -> tuple[int, int]:
    """Where the raw text of a tag ends and where its end tag does; the page's end without one, which is looked for once."""
    end = None if tag in none_left else re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, pos)
    if not end:
        none_left.add(tag)
        return len(page), len(page)
    close = page.find(">", end.start())
    return end.start(), close + 1 if close >= 0 else len(page)


def parse(page: str) -> Node:
    root = Node("body", None)
    stack = Open(root)
    at, none_left = 0, set()
    found = markup(page)
    step = next(found, None)
    while step is not None:
        start, end, closing, tag, attributes = step
        if start > at:
            stack.nodes[-1].items.append(page[at:start])
        at, jump = end, None
        if not tag or tag in ("html", "body") and closing:
            pass
        elif closing:
            place = stack.last(tag)
            # an inline tag doesn't close what lies outside of its cell or article
            if place and (tag in BLOCKS or place > stack.last("border") or tag in Open.GROUPS["border"]):
                stack.cut(place)
        elif tag in RAW:
            _, jump = raw_end(page, tag, end, none_left)
            at = jump
        elif tag in ("html", "body"):
            # their start tags also end an unclosed head
            if place := stack.last("head"):
                stack.cut(place)
        elif tag == "br":
            stack.nodes[-1].items.append(" ")
        elif tag not in VOID or tag == "hr":
            if tag in ENDS_P:
                place = stack.last("p")
                if place and place == stack.last("block"):
                    stack.cut(place)
                if stack.nodes[-1].tag == "head":
                    stack.cut(len(stack.nodes) - 1)
            if tag in CLOSES:
                ends, borders = CLOSES[tag]
                place = stack.last(*ends)
                if place > stack.last(*borders):
                    stack.cut(place)
            node = Node(tag, stack.nodes[-1], is_noise(tag, attributes, stack), names_of(tag, attributes))
            stack.nodes[-1].items.append(node)
            if tag != "hr" and not (attributes.endswith("/") and tag in ("svg", "path")):
                stack.push(node)
        try:
            step = found.send(jump)
        except StopIteration:
            step = None
    if at < len(page):
        stack.nodes[-1].items.append(page[at:])
    return root


def measure(root: Node) -> list[Node]:
    """Fills the counts and densities; returns the nodes that aren't cut off, parents first."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [x for x in n.items if isinstance(x, Node) and not x.noise]
    for n in reversed(order):
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        n.density = n.total = 0.0
        for x in n.items:
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            elif not x.noise:
                n.chars += x.chars
                n.tags += x.tags + 1
                n.link_chars += x.link_chars
                n.link_tags += x.link_tags + (x.tag == "a")
        if n.tag == "a":
            n.link_chars = n.chars
    base = root.link_chars / max(1, root.chars)
    for n in order:
        if n.chars:
            tags, links, link_tags = max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
            plain = max(1, n.chars - n.link_chars)
            inner = n.chars / plain * n.link_chars + base * n.chars + math.e
            n.density = n.chars / tags * math.log(max(1.0, n.chars / links * tags / link_tags) + 1e-9, max(1.001, math.log(inner)) + 1)
    for n in order:
        n.total = sum(x.density for x in n.items if isinstance(x, Node) and not x.noise)
    return order


def blocks(root: Node, least: float) -> list[str]:
    """The texts of blocks below a node, in page order."""
    out: list[str] = []
    line: list[str] = []

    def close() -> None:
        if line:
            # references are decoded before white space is folded: a decoded blank is white space too
            joined = " ".join(entities.unescape("".join(line)).split())
            if joined:
                out.append(joined)
            line.clear()

    todo: list = [root]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
        elif not x.noise:
            block = x.tag in BLOCKS
            if block:
                close()
                if x is not root and x.density < least and x.link_chars * 2 > x.chars:
                    continue
                todo.append(None)
            todo += reversed(x.items)
    close()
    return out


def densest(order: list[Node]) -> Node:
    return max((n for n in order if n.tag in BLOCKS), key=lambda n: n.total)


def around(n: Node | None, tags: tuple[str, ...] = ()) -> list[Node]:
    """A node and those it lies in, or only those of some tags."""
    out = []
    while n is not None:
        if not tags or n.tag in tags:
            out.append(n)
        n = n.parent
    return out


def is_prose(n: Node, of: Node) -> bool:
    """Whether a block reads like a part of a text, and is no small part of it."""
    return n.chars >= PROSE_SHARE * of.chars and n.density >= PROSE_DENSITY * of.density and 3 * n.link_chars <= n.chars


def without_comments(root: Node, order: list[Node]) -> list[Node]:
    """Cuts all adverts and comments, if the densest node lies in one and the rest holds a post; returns the nodes left."""
    marked = [x for x in order if x.tag in ("article", "main") and x.chars]
    best = densest(order)
    if not any(n.named & SURE for n in around(best)):
        return order
    dense, sure = best.density, [n for n in order if n.named & SURE]
    for n in sure:
        n.noise = True
    left = measure(root)
    post = densest(left)
    if post.chars - post.link_chars >= POST_CHARS and post.density >= PROSE_DENSITY * dense and (not marked or around(post, ("article", "main"))):
        return left
    for n in sure:
        n.noise = False
    return measure(root)


def cut_named(root: Node, order: list[Node]) -> list[Node]:
    """Cuts the named nodes that are noise; returns the nodes left."""
    order = without_comments(root, order)
    marked = [x for x in order if x.tag in ("article", "main") and x.chars]
    best = densest(marked or order)
    below = [best]
    for x in below:
        below += [y for y in x.items if isinstance(y, Node) and not y.noise]
    holders = {id(n) for top in (best, densest([x for x in below if x.tag in BLOCKS])) for n in around(top)}

    def stays(n: Node) -> bool:
        if id(n) in holders:
            return True
        if marked:
            inside = around(n, ("article", "main"))
            return bool(inside) and not n.named & SURE and is_prose(n, inside[-1])
        if n.chars >= SHARE * root.chars and n.density >= root.density:
            return True
        return n.named <= TOPICS and best is not root and any(x is best for x in around(n)) and is_prose(n, best)

    cut = [n for n in order if n.named and not stays(n)]
    if not cut:
        return order
    whole = root.chars
    for n in cut:
        n.noise = True
    # adverts and comments count for nothing; a cut node's own parts are counted with it
    sure = sum(n.chars for n in cut if n.named & SURE and not any(x.noise for x in around(n.parent)))
    left = measure(root)
    if not marked and root.chars < REST * (whole - sure):
        for n in cut:
            n.noise = bool(n.named & SURE)
        left = measure(root)
    return left


def main_text(page: str) -> str:
    root = parse(page)
    order = cut_named(root, measure(root))
    best = densest(order)
    marked = around(best, ("article", "main"))
    if marked:
        return "\n".join(blocks(marked[-1], 0.0))
    if not best.total:
        best = root
    return "\n".join(blocks(best, min(n.density for n in around(best))))


def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(h) for h in batch.column(2).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", whole_text("html").alias("html")), extract, SCHEMA, "html")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
