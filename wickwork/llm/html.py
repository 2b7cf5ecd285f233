"""Main text of web pages by minimum-cut labelling.

A page becomes blocks of text in page order. Consecutive blocks of one container are one
node. A small fixed classifier (where the node stands, links, length) gives each node the
cost of calling it content and of calling it boilerplate; these are its capacities to the
two terminals. Neighbours in page order, and nodes whose containers are near in the DOM,
are joined by smoothness edges. The minimum cut, found by maximum flow, labels all
nodes of a page at the least total cost; the content side is the main text. A page
without a content side, as a very short one, gives its blocks that are neither marked as
something else nor mostly links.

Scripts, styles, form controls and other elements that show no text are left out while
parsing, and do not end the block they stand in; formulas, drawings' words, buttons and
fallback texts of objects stay in their line. Character references are decoded, white space in a block becomes one blank, and
blocks are joined by one line feed. A null or empty page, and one without content, has the
empty text. Every page stands alone, so repeated rows, ids and other columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SILENT = set("script style noscript template head title iframe select option textarea datalist".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var math svg object canvas button audio video map".split())
#: Whatever is inside these is part of the line they stand in.
_IN_LINE_WHOLE = set("math svg".split())
_LEAF = set("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary address legend".split())
_AWAY = set("nav footer aside form menu dialog fieldset".split())
_MAIN = set("article main".split())
#: Words of class, id and role that name what is not the article. The first set holds whatever is inside,
#: but not where the same name tells of a layout, as in has-sidebar; comments hold articles, too.
_AWAY_NAMES = set("nav navbar navigation menu footer sidebar aside comment comments disqus reply replies respond advert adverts advertisement ad ads adsense cookie consent breadcrumb breadcrumbs newsletter subscribe signup login popup modal share sharing social related recommended promo promoted sponsor sponsored".split())
_COMMENT_NAMES = set("comment comments disqus reply replies respond".split())
_LAYOUT_WORDS = set("has have with without no not enabled disabled wrap wrapper container page layout outer inner site".split())
_SOFT_NAMES = set("header masthead banner notice alert toolbar widget teaser pagination pager tags meta byline".split())
_MAIN_NAMES = set("article content main post entry story body".split())

_BASE, _INSIDE, _OUTSIDE, _LINKS, _PER_WORD, _MAX_WORDS = -1.0, 5.0, -6.0, -4.0, 0.08, 60
_ADJACENT, _DOM = 0.5, 1.0
_UNIT = 1000  # capacities are whole thousandths, so the cut is exact


def _words(names: str) -> list[set[str]]:
    """The words of each name."""
    return [set(re.split(r"[^a-z0-9]+", name)) - {""} for name in names.lower().split()]


class _Element:
    """An open element: -1 away from the article, 0 unknown, 1 in it; and whether that holds for all inside.

    Tags and names of comments hold whatever is inside. Of other names, only a whole one does, and
    a main element inside is the article all the same. An article is not away by what
    it is about, only as a comment.
    """

    __slots__ = ("tag", "parent", "depth", "place", "hard")

    def __init__(self, tag: str, parent: _Element | None, names: list[set[str]]):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        place, hard = (parent.place, parent.hard) if parent else (0, "")
        every = set().union(*names)
        away = set().union(*(n for n in names if not n & _LAYOUT_WORDS)) & _AWAY_NAMES
        if tag in _MAIN:
            away &= _COMMENT_NAMES
        if tag == "main" and hard == "name":
            hard = ""
        if not hard:
            if tag in _AWAY or away and tag not in ("body", "html"):
                # A wrapper that is named after its sidebar may still hold the article.
                place = -1
                hard = "tag" if tag in _AWAY or away & _COMMENT_NAMES else "name" if not every & _MAIN_NAMES else ""
            elif tag in _MAIN or "main" in every:
                place = 1
            elif tag == "header" and place <= 0 or every & _SOFT_NAMES and tag not in ("body", "html"):
                place = -1
            elif every & _MAIN_NAMES and tag != "body":
                place = 1
        self.place, self.hard = place, hard


class _Blocks(HTMLParser):
    """Blocks of a page as (text, container, characters inside links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [_Element("html", None, [])]
        self.links = self.silent = self.whole = self.link_chars = 0
        self.parts: list[str] = []
        self.blocks: list[tuple[str, _Element, int]] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            at = self.open[-1]
            while at.parent and (at.tag in _LEAF | _INLINE or at.tag[:1] in "!="):
                at = at.parent
            self.blocks.append((text, at, self.link_chars))
        self.parts, self.link_chars = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            self.parts.append(" ")
            return
        values = dict(attrs)
        if self.silent or tag in _SILENT:  # shows nothing, and does not end the block it stands in
            self.silent += 1
            self.open.append(_Element("!" + tag, self.open[-1], []))
            return
        if self.whole or tag in _IN_LINE_WHOLE:
            self.whole += 1
            self.open.append(_Element("=" + tag, self.open[-1], []))
            return
        if tag not in _INLINE:
            self._flush()
            if self.open[-1].tag == "p" or tag in ("li", "dt", "dd", "td", "th", "tr") and self.open[-1].tag == tag:
                self.open.pop()
            else:
                for i in range(len(self.open) - 1, max(len(self.open) - 8, 0), -1):  # <p> ends at the next block
                    if self.open[i].tag == "p":
                        self._close(i)
                        break
                    if self.open[i].tag not in _INLINE:
                        break
        if "hidden" in values:
            self.silent += 1
            self.open.append(_Element("!" + tag, self.open[-1], []))
            return
        self.links += tag == "a"
        self.open.append(_Element(tag, self.open[-1], _words(" ".join(values.get(k) or "" for k in ("class", "id", "role")))))

    def _close(self, i: int) -> None:
        for x in self.open[i:]:
            self.links -= x.tag == "a"
            self.silent -= x.tag[:1] == "!"
            self.whole -= x.tag[:1] == "="
        del self.open[i:]

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            own = self.open[i].tag
            if own.lstrip("!=") == tag:
                if own == tag not in _INLINE:
                    self._flush()
                self._close(i)
                return

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)


def blocks_of(page: str) -> list[tuple[str, _Element, int]]:
    parser = _Blocks()
    parser.feed(page)
    parser.close()
    parser._flush()
    return parser.blocks


def _near(a: _Element, b: _Element) -> int:
    """Steps between two elements of the DOM."""
    steps = 0
    while a is not b:
        a, b = (a.parent, b) if a.depth >= b.depth else (a, b.parent)
        steps += 1
    return steps


class MinCut:
    """Maximum flow by shortest augmenting levels; the cut is read off the last search."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def join(self, a: int, b: int, there: int, back: int = 0) -> None:
        for x, y, room in ((a, b, there), (b, a, back)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.room.append(room)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in self.edges[x]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        while (level := self._levels(source))[sink] >= 0:
            tried = [0] * len(self.edges)
            path: list[int] = []
            at = source
            while True:
                if at == sink:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    cut = next(i for i, e in enumerate(path) if not self.room[e])
                    at = self.to[path[cut] ^ 1]
                    del path[cut:]
                elif tried[at] < len(self.edges[at]):
                    e = self.edges[at][tried[at]]
                    if self.room[e] and level[self.to[e]] == level[at] + 1:
                        path.append(e)
                        at = self.to[e]
                    else:
                        tried[at] += 1
                elif path:
                    at = self.to[path.pop() ^ 1]
                    tried[at] += 1
                else:
                    break
        return [x >= 0 for x in level]


def score_of(place: int, chars: int, link_chars: int, words: int) -> float:
    """Above 0: content. The classifier's weights are fixed values."""
    linked = link_chars / max(chars, 1)
    return _BASE + {1: _INSIDE, 0: 0.0, -1: _OUTSIDE}[place] + _LINKS * linked + _PER_WORD * min(words, _MAX_WORDS)


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    nodes: list[list] = []  # container, chars, linked chars, words, texts
    for text, at, linked in blocks:
        if not nodes or nodes[-1][0] is not at:
            nodes.append([at, 0, 0, 0, []])
        own = nodes[-1]
        own[1] += len(text)
        own[2] += linked
        own[3] += text.count(" ") + 1
        own[4].append(text)
    n = len(nodes)
    graph = MinCut(n + 2)
    for i, (at, chars, linked, words, _) in enumerate(nodes):
        score = round(_UNIT * score_of(at.place, chars, linked, words))
        if score > 0:
            graph.join(n, i, score)
        else:
            graph.join(i, n + 1, -score)
    last = defaultdict(lambda: -1)
    for i, (at, *_) in enumerate(nodes):
        if i:
            weight = _ADJACENT + _DOM / (1 + _near(at, nodes[i - 1][0]))
            graph.join(i - 1, i, round(_UNIT * weight), round(_UNIT * weight))
        if 0 <= last[at] < i - 1:  # the container goes on after something else
            graph.join(last[at], i, round(_UNIT * _DOM), round(_UNIT * _DOM))
        last[at] = i
    side = graph.source_side(n, n + 1)
    if not any(side[:n]):  # nothing tells the article
        return "\n".join(text for text, at, linked in blocks if at.place >= 0 and 2 * linked < len(text))
    return "\n".join(text for i, node in enumerate(nodes) if side[i] for text in node[4])


def _main_texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in parts:
        yield pages.map(main_text)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of `html` in `out`."""
    return pages.withColumn(out, F.pandas_udf(_main_texts, "string")(F.coalesce(F.col(html), F.lit(""))))
