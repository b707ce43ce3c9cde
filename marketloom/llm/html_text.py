"""HTML extraction (operator 2): the maximum-scoring run of a page's tokens.

A page becomes tokens: words and tags. Words score positive and tags negative, by how much
more often pages with a marked article hold them inside it than outside. Words in links
and in boxes (menus, adverts, forms, notices, comments ...) are classes of their own, which
come out negative. One scan finds the best contiguous run; its ends are widened to the borders
of article elements that lie mostly in it or hold most of it, and its boxes are left out.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Labelled pages that the weights are counted on, at most about so many.
SAMPLE_PAGES = 2000

# Names of HTML elements, and words in class, id and role that name a box.
RAW = {"script", "style", "iframe", "textarea", "title"}
#: Not raw text, but left out as a whole where they are closed.
SKIPPED = {"noscript", "template", "svg", "math", "object", "canvas"}
BOXES = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
}
BOX_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "menubar", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "sidebars", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget", "alert", "contentinfo", "complementary",
    "adsbygoogle", "gdpr", "cta", "discussion", "discussions",
}
#: Words that a class made of several may have besides those; any other, as in no-sidebar, says something else.
PLACE_WORDS = {
    "", "site", "page", "top", "bottom", "left", "right", "main", "primary", "secondary", "global", "box", "slot", "unit", "container",
    "wrapper", "wrap", "inner", "outer", "list", "links", "link", "bar", "block", "area", "section", "region", "panel", "posts", "articles",
    "icons", "buttons", "button", "form", "google", "mobile", "desktop", "js", "inline", "x",
}
#: Readers' words, which are no main text even where they are most of a page.
READER_WORDS = {"comment", "comments", "discussion", "discussions", "disqus", "replies", "reply", "respond"}
#: Elements that can hold a whole page.
CONTAINERS = {"div", "section", "article", "main", "form", "fieldset", "table", "td", "tr"}
BOX_TAGS = {"div", "section", "ul", "ol", "p", "article", "table", "span", "details", "dl", "figure", "td", "tr", "li", "h2", "h3", "ins"}
ARTICLES = {"article", "main"}
#: Tags inside running text, and what a tag scores that the labelled pages don't show.
TEXT_TAGS = INLINE - {"a"} | {"p", "br", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "hr", "img", "figcaption"}
TEXT_TAG, OTHER_TAG = -0.1, -1.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^<>\"'])*+)>|[^<]++|<", re.S
)
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: An element that is not shown says so by an attribute, or in its style.
_UNSEEN, _NO_DISPLAY = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I), re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")


@dataclass
class Token:
    kind: str  # "word" (a text of one word or more), "tag"
    name: str  # the class that is scored
    text: str = ""
    words: int = 0
    link: bool = False
    box: bool = False
    stop: bool = False  # ends a block


@dataclass
class Page:
    tokens: list[Token] = field(default_factory=list)
    articles: list[tuple[int, int]] = field(default_factory=list)  # token ranges


def _is_box_name(name: str) -> bool:
    """Whether a class, id or role names a box: box words, and nothing else but words of places and numbers."""
    parts = set(re.split(r"[^a-z]+", name))
    return bool(parts & BOX_WORDS) and parts <= BOX_WORDS | PLACE_WORDS


def _names(attributes: str) -> Iterator[str]:
    for m in _NAMED.finditer(attributes):
        yield from (m[1] or m[2] or m[3] or "").lower().split()


def _is_box(tag: str, attributes: str) -> bool:
    if tag in BOXES or not attributes.strip():
        return tag in BOXES
    return _is_unseen(attributes) or tag in BOX_TAGS and any(map(_is_box_name, _names(attributes)))


def _is_unseen(attributes: str) -> bool:
    return bool(_UNSEEN.search(_QUOTED.sub("=", attributes)) or _NO_DISPLAY.search(attributes))


@dataclass
class Box:
    start: int  # token
    tag: str
    level: int  # of its tag, when it began
    may_open: bool
    end: int = 0


def parse(html: str) -> Page:
    """Tokens of a page, and where its article elements are. A container with most of its plain words is no box.

    All boxes are kept while the page is read once, and decided from the outside in: a box
    that is one hides those in it, one with most of the words gives way to them.
    """
    page, boxes, begun, entries = Page(), [], [], []
    opened: list[Box] = []
    of_tag: dict[str, list[Box]] = defaultdict(list)
    level: Counter = Counter()

    def shut(box: Box, closed: bool) -> None:
        """End a box and those in it; without a closing tag it ends where an article starts."""
        end = len(page.tokens)
        while opened:
            last = opened.pop()
            of_tag[last.tag].pop()
            last.end = end
            if not (closed and last is box):
                at = bisect_right(entries, last.start)
                last.end = min(entries[at], end) if at < len(entries) else end
            if last is box:
                break
        while begun and begun[-1] > box.start:
            page.articles.append((begun.pop(), end))

    at, n, links = 0, len(html), 0
    unclosed: set[str] = set()
    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            raw = m[0]
            if raw[0] == "<" and len(raw) > 1:
                continue
            text = unescape(raw)
            page.tokens.append(Token("word", "word:link" if links else "word", text, len(text.split()), bool(links)))
            continue
        closing = bool(m[1])
        token = Token("tag", tag, stop=tag not in INLINE)
        if not closing and tag in RAW | SKIPPED and tag not in unclosed and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if end or tag in RAW:
                at = end.end() if end else n
                token.stop = True
                page.tokens.append(token)
                continue
            unclosed.add(tag)
        void = tag in VOID or m[3].rstrip().endswith("/") and tag not in INLINE
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag == "body" and of_tag["head"]:
            shut(of_tag["head"][0], True)  # these two end without a closing tag
        if of_tag["p"] and not closing and tag not in INLINE | VOID:
            shut(of_tag["p"][0], True)
        if void:
            page.tokens.append(token)
            continue
        level[tag] += -1 if closing else 1
        if closing:
            if tag in ARTICLES and begun:
                page.articles.append((begun.pop(), len(page.tokens) + 1))
            page.tokens.append(token)
            if of_tag[tag] and of_tag[tag][-1].level > level[tag]:
                shut(of_tag[tag][-1], True)
            continue
        if _is_box(tag, m[3]):
            readers = any(READER_WORDS & set(re.split(r"[^a-z]+", name)) for name in _names(m[3]))
            boxes.append(Box(len(page.tokens), tag, level[tag], tag in CONTAINERS and not readers))
            opened.append(boxes[-1])
            of_tag[tag].append(boxes[-1])
        elif tag in ARTICLES:
            entries.append(len(page.tokens))
        if tag in ARTICLES:
            begun.append(len(page.tokens))
        page.tokens.append(token)
    if opened:
        shut(opened[0], False)
    page.articles += [(b, len(page.tokens)) for b in begun]
    plain = [0, *itertools.accumulate(0 if t.link else t.words for t in page.tokens)]
    shown = 0
    for box in boxes:
        if box.start < shown or box.may_open and 2 * (plain[box.end] - plain[box.start]) > plain[-1]:
            continue
        for t in page.tokens[box.start : box.end]:
            t.box = True
            t.name = "word:box" if t.kind == "word" else t.name
        shown = box.end
    page.articles = [a for a in page.articles if not page.tokens[a[0]].box]
    return page


def count_classes(html: str) -> Counter:
    """(class, inside the article) -> count, for a page that marks one article; else nothing."""
    page, found = parse(html), Counter()
    outer: list[tuple[int, int]] = []
    for a in sorted(page.articles, key=lambda a: (a[0], -a[1])):
        if not outer or a[1] > outer[-1][1]:
            outer.append(a)
    if len(outer) == 1:
        start, end = outer[0]
        for i, t in enumerate(page.tokens):
            if t.kind == "tag" or t.words:
                found[t.name, start <= i < end and not t.box] += t.words or 1
    return found


def weights(counts: dict[tuple[str, bool], float]) -> dict[str, float]:
    """Log-odds of each class; words outside links and boxes are positive, tags negative."""
    totals = {inside: sum(v for (_, i), v in counts.items() if i == inside) + 50.0 for inside in (True, False)}
    found = {"word": 1.0, "word:link": -0.5, "word:box": -2.0}
    for name in {k for k, _ in counts} | set(found):
        odds = math.log((counts.get((name, True), 0) + 1) / totals[True]) - math.log((counts.get((name, False), 0) + 1) / totals[False])
        if not counts and name in found:
            continue
        low, high = (0.5, 3.0) if name == "word" else (-4.0, -0.5) if name == "word:box" else (-3.0, 1.0) if name == "word:link" else (-3.0, -0.02)
        found[name] = min(max(odds, low), high)
    return found


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest sum, in one scan; (0, 0) if no sum is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, span = total, (start, i + 1)
    return span


def snapped(run: tuple[int, int], articles: list[tuple[int, int]], scores: list[float]) -> tuple[int, int]:
    """A run, widened to the borders of the articles that lie mostly in it; nothing of it is left out.

    If none of these has half of the run, it is widened to the smallest article that has.
    """
    sums = [0.0, *itertools.accumulate(max(s, 0.0) for s in scores)]
    value = lambda a, b: max(sums[b] - sums[a], 0.0) if a < b else 0.0
    shared = lambda a: value(max(a[0], run[0]), min(a[1], run[1]))
    met = [a for a in articles if shared(a) > 0]
    inside = {a for a in met if 2 * shared(a) >= value(*a)}
    around = [a for a in met if 2 * shared(a) >= value(*run)]
    if around and inside.isdisjoint(around):
        inside.add(min(around, key=lambda a: a[1] - a[0]))
    return min([run[0], *(a[0] for a in inside)]), max([run[1], *(a[1] for a in inside)])


def main_text(html: str, weight: dict[str, float]) -> str:
    """The main text of one page: blocks joined by one space, white space inside them made one space."""
    page = parse(html)
    unseen = lambda t: TEXT_TAG if t.name in TEXT_TAGS else OTHER_TAG
    scores = [weight.get(t.name, unseen(t)) * (t.words if t.kind == "word" else 1) for t in page.tokens]
    start, end = snapped(best_run(scores), page.articles, scores)
    blocks, now = [], []
    for t in page.tokens[start:end]:
        if t.stop:
            blocks.append("".join(now))
            now = []
        if t.kind == "word" and not t.box:
            now.append(t.text)
    blocks.append("".join(now))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())


def learn_weights(pages: DataFrame, rows: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from about ``rows`` pages at most that mark their article, chosen by a hash of the html."""
    labelled = pages.where(text_of(pages, "html").rlike("(?i)<(article|main)[\\s>]")).select(F.col("html").cast("string"))
    share = rows / max(labelled.count(), 1)
    chosen = labelled.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Counter()
        for batch in batches:
            for html in batch["html"]:
                total.update(count_classes(html))
        yield pd.DataFrame([(k, inside, v) for (k, inside), v in total.items()], columns=["name", "inside", "n"])

    sums = chosen.mapInPandas(counted, "name string, inside boolean, n bigint").groupBy("name", "inside").agg(F.sum("n").alias("n"))
    # Classes are tag names, no more than the sample holds.
    return weights({(r["name"], r["inside"]): r["n"] for r in sums.collect()})


def extract(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null and empty html, and pages without positive words, have an empty text; nothing of
    the main text is cut. Repeated rows give a row each; other columns are not used.
    """

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, weight) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    rows = pages.select("page_id", "url", text_of(pages, "html").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInPandas(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
