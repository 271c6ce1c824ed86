"""HTML extraction: text-to-tag ratios over streaming parser events.

The standard library's parser streams a page's events into *lines*: the text between two
block-level tags, character references decoded and white space collapsed, with the number of
tags met.  A line's text-to-tag ratio is smoothed over its neighbours by a Gaussian and the
smoothed ratios are clustered in two around a threshold; lines above it are content.

The ratio is taken as a logarithm, so that one giant paragraph does not hide the others.  The
names of elements, their classes, ids and roles only shift a line's score: down inside menus,
headers, footers, sidebars, notices, adverts, forms and reader comments, before the smoothing and
after it.  A class or id counts if all of its words speak of such things ("social-science" does
not), and if the lines that go for that reason hold far more text than the content found, the
shift is taken back and the page is clustered again.  Lines of elements that are such things by
their own name or role, and readers' comments, take part in the clustering but are never content.
Scripts, styles and hidden elements have no text.

The content lines are the result, with the short lines that belong to them: the unshifted lines
of the main or article elements that hold most of the content, or, on a page without such, those
of the innermost element that does (the body: between its first, with the heading before it, and
its last content line), but for lines of links.

Defined results: null or empty html, and a page without text, gives the empty text; broken
markup is read as far as it goes (an end tag without a start is ignored, an open element ends
with its parent), in time that grows with the page; a page whose only text lies in such
elements gives the empty text, one whose only text lies in elements of such a class gives that
text's densest lines; null ids and urls stay; repeated rows are extracted each; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INVISIBLE = frozenset("head script style noscript template iframe object svg canvas select textarea math video audio".split())
FRAMES = frozenset("nav footer aside form button dialog menu".split())
# Elements that end an open one of the same kind without an end tag.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# A start of these ends an open paragraph.
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul".split())
SCOPES = frozenset("html body table ul ol dl div section article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                  "menubar toolbar tablist".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond discussion".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar sidenav menu submenu nav navbar navigation navi breadcrumb breadcrumbs pagination pager footer "
    "masthead topbar toolbar share sharing social related recommended recommendations login search skip "
    "widget widgets".split())
# Words that say nothing beside one of those.
PLAIN_WORDS = frozenset(
    "bar bars box block blocks area areas section item items list lists links link top bottom left right inner outer wrap "
    "button buttons btn icon icons group row col column columns unit units slot zone module panel panels card cards form site "
    "page global primary secondary main text title heading message container wrapper posts articles stories google header "
    "the to us by more policy bg fixed sticky mobile desktop small large".split())
HEADER_WORDS = frozenset(["header"])
# ... unless it is the article's own, such as "entry-header".
ARTICLE_WORDS = frozenset("article post entry story".split())

# Words of the element around such things, as in "has-comments", and of those who comment.
WRAPS = frozenset("has no with without".split())
READERS = frozenset("user users reader readers fb wp facebook count form thread".split())

_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

# What a line is shifted for: nothing, the words of a class or id, or its element, role or a
# reader's comment, which is never taken back.
PLAIN, WORDS, FRAME = 0, 1, 2
SHIFT = 3.0
# A shift by words is taken back if its lines are so many and hold this many times the text of the
# content: a region, not a line of advertising beside a short article.
REGION_LINES = 3
FAR_MORE = 2
SIGMA = 1.0
RADIUS = 2


def name_words(value: str) -> set[str]:
    return {w.lower() for w in _NAME.findall(value)}


class Line(NamedTuple):
    text: str
    tags: int
    element: int
    kind: int
    source: int  # the element for whose words the line is shifted
    linked: bool  # links make up most of the text


class Lines(HTMLParser):
    """Collects the page's lines; elements are numbered, ``parent`` and ``region`` tell each one's
    parent and the main or article element around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # name, element, invisible, kind, source; and the places of each name and of the blocks in it
        self.stack: list[tuple[str, int, bool, int, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.parent, self.region = [-1], [-1]
        self.kind = ["main?"]
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.tags = self.links = 0

    def top(self) -> tuple[str, int, bool, int, int]:
        return self.stack[-1] if self.stack else ("", 0, False, PLAIN, 0)

    def push(self, entry: tuple[str, int, bool, int, int]) -> None:
        self.places[entry[0]].append(len(self.stack))
        if entry[0] not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(entry)

    def cut(self, at: int) -> None:
        for name, *_ in reversed(self.stack[at:]):
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()
        del self.stack[at:]

    def place(self, name: str) -> int:
        """Where the innermost open element of that name stands, -1 if none is open."""
        return self.places[name][-1] if self.places.get(name) else -1

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not used

    def end_line(self) -> None:
        if not self.text and not self.tags:
            return
        text = " ".join("".join(self.text).split())
        if text or self.tags:
            _, element, _, kind, source = self.top()
            self.lines.append(Line(text, self.tags, element, kind, source, 5 * self.links >= 4 * len(text)))
        self.text, self.tags, self.links = [], 0, 0

    def handle_data(self, data: str) -> None:
        if self.top()[2]:
            return
        self.text.append(data)
        if any(entry[0] == "a" for entry in self.stack[-3:]):
            self.links += len(data.strip())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in INLINE and not attrs:
            self.tags += 1
            if tag not in VOID:
                self.push((tag, *self.top()[1:]))
            return
        invisible, kind = judged(tag, attrs, self.region[self.top()[1]] >= 0)
        if tag not in INLINE or invisible or kind:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_open({"p"})
        if tag in SIBLINGS:
            self.close_open(SIBLINGS[tag])
        if tag in ("article", "main"):  # a menu left open doesn't swallow the article
            self.close_open({"nav", "header", "ul"}, within=frozenset(["body", "html"]))
        _, outer, hidden, above, source = self.top()
        number = outer
        if tag not in INLINE:
            self.parent.append(outer)
            inside = self.region[outer]
            number = len(self.parent) - 1
            starts = not (hidden or invisible or above or kind) and inside < 0 and (tag in ("article", "main") or ("role", "main") in attrs)
            self.region.append(number if starts else inside)
            self.kind.append(tag)
        if kind == WORDS and above == PLAIN:
            source = len(self.parent) if tag in INLINE else number
        self.push((tag, number, hidden or invisible, max(above, kind), source))

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.end_line()
            return
        at = self.place(tag)
        if at < 0:
            return
        if tag in INLINE:
            # a stray end of an inline element never closes a block around it
            if self.blocks and self.blocks[-1] > at:
                return
            outer = self.stack[at - 1] if at else ("", 0, False, PLAIN, 0)
            if self.stack[at][2:4] != outer[2:4]:
                self.end_line()
            self.tags += 1
        else:
            self.end_line()
            self.tags += 1
        self.cut(at)

    def close_open(self, names: set[str], within: frozenset = SCOPES) -> None:
        """End the innermost open element of ``names``, if none of ``within`` stands between."""
        at = max(self.place(n) for n in names)
        if at >= 0 and at >= max(self.place(w) for w in within):
            self.end_line()
            self.cut(at)

    def finish(self) -> None:
        self.close()
        self.end_line()


def judged(tag: str, attrs: list, in_article: bool) -> tuple[bool, int]:
    """(invisible, kind): whether the element has no text, and what its lines are shifted for."""
    if tag in INVISIBLE:
        return True, PLAIN
    if tag in FRAMES or tag == "header" and not in_article:
        return False, FRAME
    if tag in ("html", "body"):
        return False, PLAIN
    kind = PLAIN
    for key, value in attrs:
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True, PLAIN
        if not value:
            continue
        if key == "style" and _HIDDEN.search(value):
            return True, PLAIN
        if key == "role" and value.lower() in ROLES:
            kind = FRAME
        elif key in ("class", "id"):
            for token in value.split():
                kind = max(kind, token_kind(name_words(token), in_article))
    return False, PLAIN if kind == WORDS and tag in ("article", "main") else kind


def token_kind(words: set[str], in_article: bool) -> int:
    """What one class or id tells about an element."""
    if words & COMMENT_WORDS and not words & WRAPS and not words - COMMENT_WORDS - PLAIN_WORDS - ARTICLE_WORDS - READERS:
        return FRAME
    words = {w for w in words if len(w) > 2 or w == "ad"}
    if words & HEADER_WORDS and not words & ARTICLE_WORDS and not in_article and not words - PLAIN_WORDS:
        return WORDS
    return WORDS if words & BOILERPLATE_WORDS and not words - BOILERPLATE_WORDS - PLAIN_WORDS else PLAIN


def clustered(scores: np.ndarray) -> np.ndarray:
    """True at the lines whose score belongs to the upper of two clusters."""
    if not len(scores):
        return np.zeros(0, dtype=bool)
    low, high = scores.min(), scores.max()
    while True:  # two means on a line: the threshold moves up or down until it stays
        above = scores >= (low + high) / 2
        if above.all():
            return above
        means = scores[~above].mean(), scores[above].mean()
        if means == (low, high):
            return above
        low, high = means


def smoothed(values: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.arange(-RADIUS, RADIUS + 1) ** 2 / (2 * SIGMA**2))
    return np.convolve(np.pad(values, RADIUS), kernel / kernel.sum(), mode="valid")


def content_lines(lines: list[Line], lifted: frozenset[int] = frozenset()) -> np.ndarray:
    """True at the lines whose shifted, smoothed text-to-tag ratio is in the upper cluster; lines
    shifted by the words of the ``lifted`` elements count as plain ones."""
    if not lines:
        return np.zeros(0, dtype=bool)
    shift = np.array([0.0 if x.kind == PLAIN or x.kind == WORDS and x.source in lifted else SHIFT for x in lines])
    ratio = np.array([math.log1p(len(x.text) / max(1, x.tags)) for x in lines])
    return clustered(smoothed(np.maximum(0, ratio - shift)) - shift)


def extract(html: str | None) -> str:
    """The page's main text."""
    parser = Lines()
    parser.feed(html or "")
    parser.finish()
    chosen = choose(parser)
    size = sum(len(x.text) for x in chosen)
    held: dict[int, list[int]] = defaultdict(list)
    for x in parser.lines:
        if x.kind == WORDS and x.text:
            held[x.source].append(len(x.text))
    lifted = frozenset(e for e, n in held.items() if len(n) >= REGION_LINES and sum(n) > FAR_MORE * size)
    if lifted:
        chosen = choose(parser, lifted)
    return " ".join(x.text for x in chosen)


def choose(parser: Lines, lifted: frozenset[int] = frozenset()) -> list[Line]:
    """The content lines and the short ones that belong to them, in page order."""
    lines = parser.lines
    content = [bool(c and x.text and x.kind != FRAME) for c, x in zip(content_lines(lines, lifted), lines)]
    marked = [x for x, c in zip(lines, content) if c]
    if not marked:
        return []
    own = [x.text and (x.kind == PLAIN or x.kind == WORDS and x.source in lifted) for x in lines]
    total = sum(len(x.text) for x in marked)
    within = [x for x in marked if parser.region[x.element] >= 0]
    if 2 * sum(len(x.text) for x in within) > total:
        regions = {parser.region[x.element] for x in within}
        wanted = {r for r in regions if parser.kind[r] != "article"} or regions
        return [x for x, c, o in zip(lines, content, own) if c or o and parser.region[x.element] in wanted]
    region = innermost(parser, marked)
    inside = descendants(parser, region)
    at = [i for i, (x, c) in enumerate(zip(lines, content)) if c and inside[x.element]]
    first, last = (at[0], at[-1]) if at else (0, -1)
    if parser.kind[region] not in ("main?", "html", "body"):
        first, last = -1, len(lines)  # an element of the content alone: all its lines
    else:
        before = next((i for i in range(first - 1, -1, -1) if lines[i].text), -1)
        if before >= 0 and own[before] and parser.kind[lines[before].element] in HEADINGS:
            first = before - 1
    return [x for i, (x, c, o) in enumerate(zip(lines, content, own))
            if c or o and first < i < last and inside[x.element] and not x.linked]


HEADINGS = frozenset("h1 h2 h3".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption address".split())


def innermost(parser: Lines, marked: list[Line]) -> int:
    """The deepest element that holds more than half of the marked text; a single line is no region."""
    held = [0] * len(parser.parent)
    for x in marked:
        held[x.element] += len(x.text)
    total, lines = sum(held), {x.element for x in marked}
    for e in range(len(held) - 1, 0, -1):  # children are numbered after their parents
        held[parser.parent[e]] += held[e]
    return max((e for e, n in enumerate(held) if 2 * n > total and not (e in lines and parser.kind[e] in LEAVES)), default=0)


def descendants(parser: Lines, element: int) -> list[bool]:
    """True at the element and all inside it."""
    inside = [False] * len(parser.parent)
    for e, p in enumerate(parser.parent):
        inside[e] = e == element or e > element and p >= 0 and inside[p]
    return inside


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars): one row per page."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(cols: dict) -> dict:
        texts = [extract(h) for h in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(rows, run, "page_id bigint, url string, text string, n_chars bigint", rows=200)
