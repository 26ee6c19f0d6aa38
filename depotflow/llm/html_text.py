"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text.  Elements that never hold main text (menus, page
headers and footers, sidebars, notices, adverts, forms, scripts, comments) leave empty lines in their place.
The lengths of the lines, links outside articles not counted, are summed over sliding windows.  Text surges where a window's
sum rises from zero and dives where it falls to zero again; the lines between form a stretch.

On a page with articles the elements decide: the article with most text belongs to an outermost <article> or
<main>, and that one's text and that of its siblings is kept whole.  On other pages the stretches decide: those
with a peak comparable to the largest are main ones, and so is every stretch between two of them or in the same
container as one of them.  An element that looks like a menu or form but holds nearly all of the page's text is
a wrapper, and is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window, and the peak that a stretch outside articles needs, as a share of the largest.
WINDOW, PEAK = 3, 0.3

#: A marked element outside articles with so many times the text outside it is a wrapper.
WRAPS = 4

#: Share of link characters from which a line counts as a menu.
LINKED = 0.6

#: Elements by their role.
_RAW = frozenset("script style noscript template svg math iframe object canvas audio video title textarea select".split())
_ASIDE = frozenset("nav aside form dialog menu button footer header fieldset datalist".split())
_MAIN = frozenset("article main".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 head hr html li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul nav aside form dialog menu footer header "
    "fieldset legend option caption".split()
)

#: Words in class, id or role that mark elements without main text.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation navi menu menubar sidebar sidebars aside footer masthead topbar toolbar breadcrumb breadcrumbs cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup signin login share sharing social related recommended recommendations comment comments commentlist "
    "discussion disqus replies reply respond widget widgets pager pagination search searchform form skip contentinfo "
    "complementary".split()
)
_HEADER_MARKS = frozenset("header banner".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAMES = re.compile(r"[a-z]+")

#: Elements that hold blocks side by side; first words of class names that only state something; and
#: elements that wrap a whole page at times although they never hold main text.
_CONTAINERS = frozenset("article main section div body html td th form fieldset details blockquote center".split())
_STATES = frozenset("has no not is with without".split())
_WRAPPERS = frozenset("form fieldset".split())
_CLOSES = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)


def _marked(name: str, rest: str, in_article: bool) -> bool:
    """The element never holds main text."""
    if name in _ASIDE:
        return not (name == "header" and in_article)
    if not rest or name in ("html", "body"):
        return False
    for _, a, b, c in _ATTRIBUTE.findall(rest):
        for token in (a or b or c).lower().split():
            found = _NAMES.findall(token)
            if found and found[0] in _STATES:  # has-sidebar
                continue
            if any(w in _STATES for w in found[1:-1]):  # layout-with-sidebar
                continue
            if any(w in _MARKS or (w in _HEADER_MARKS and not in_article and name not in _MAIN) for w in found):
                return True
    return bool(_HIDDEN.search(rest))


class _Lines:
    """Lines of a page: text, counted length, and the article or part of the page that holds them."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.lengths: list[int] = []
        self.parts: list[int] = []
        self.containers: list[int] = []
        self.roots: dict[int, tuple[int, int]] = {}  # article: outermost one that holds it, and its container
        self.skipped: dict[int, int] = {}  # characters in marked elements that may be wrappers, by place
        self.chunks: list[str] = []
        self.linked = 0

    def flush(self, part: int, container: int) -> None:
        if self.chunks:
            text = " ".join("".join(self.chunks).split())
            if text:
                linked = not part and self.linked >= LINKED * len(text)
                self.texts.append(text)
                self.lengths.append(0 if linked else len(text) if part else max(len(text) - self.linked, 1))
                self.parts.append(part)
                self.containers.append(container)
            self.chunks, self.linked = [], 0

    def gap(self) -> None:
        if self.texts and (len(self.texts) < WINDOW or any(self.texts[-WINDOW:])):
            self.texts += [""] * WINDOW
            self.lengths += [0] * WINDOW
            self.parts += [-1] * WINDOW
            self.containers += [-1] * WINDOW


def lines_of(html: str, wrappers: frozenset[int] = frozenset()) -> tuple[_Lines, int]:
    """Lines of a page in order, and how many articles it has.  Parts 1 to that number are articles.

    Elements that begin at the places ``wrappers`` are read whatever their marks.
    """
    lines = _Lines()
    open_elements: list[tuple[str, int, bool, int]] = []  # name, article, marked, container
    container, wrapper = 0, -1
    articles = skipped = article = links = 0
    at, n = 0, len(html)
    while at < n:
        found = _MARKUP.search(html, at)
        if not found:
            break
        if found.start() > at and not skipped:
            text = unescape(html[at : found.start()])
            lines.chunks.append(text)
            if links:
                lines.linked += len(text.strip())
        elif wrapper >= 0 and found.start() > at:
            lines.skipped[wrapper] = lines.skipped.get(wrapper, 0) + len(html[at : found.start()].strip())
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            if not skipped:
                lines.chunks.append(" ")
            continue
        if found["end"]:
            if name in _BLOCK and not skipped:
                lines.flush(article, container)
            place = next((i for i in range(len(open_elements) - 1, -1, -1) if open_elements[i][0] == name), None)
            if place is None:
                continue
            for _, _, marked, _ in open_elements[place:]:
                skipped -= marked
            if any(marked for _, _, marked, _ in open_elements[place:]) and not skipped:
                lines.gap()
            del open_elements[place:]
            article = open_elements[-1][1] if open_elements else 0
            container = open_elements[-1][3] if open_elements else 0
            links = sum(e[0] == "a" for e in open_elements) if links else 0
            continue
        rest = found["rest"] or ""
        if name in _RAW:
            close = _CLOSES[name].search(html, at)
            at = close.start() if close else n if name != "title" else at
            continue
        if name in _MAIN and skipped and not article:
            # Markup that is left open ends where the article begins.
            open_elements = [e for e in open_elements if not e[2]]
            skipped = 0
            container = open_elements[-1][3] if open_elements else 0
            lines.gap()
        if name in _BLOCK and not skipped:
            lines.flush(article, container)
        if name in _VOID or rest.endswith("/"):
            continue
        marked = found.start() not in wrappers and _marked(name, rest, article > 0)
        if marked and not skipped:
            wrapper = -1 if article or (name in _ASIDE and name not in _WRAPPERS) or _HIDDEN.search(rest) else found.start()
            lines.flush(article, container)
            lines.gap()
        skipped += marked
        inner = article
        if name in _MAIN and not skipped and (not article or name == "article"):
            articles += 1
            lines.roots[articles] = lines.roots.get(article, (articles, container))
            inner = article = articles
        if name == "a":
            links += 1
        if name in ("p", "li", "td", "th", "dt", "dd", "option") and open_elements and open_elements[-1][0] == name:
            skipped -= open_elements.pop()[2]
            container = open_elements[-1][3] if open_elements else 0
        if name in _CONTAINERS:
            container = found.end()
        open_elements.append((name, inner, marked, container))
    if at < n and not skipped:
        lines.chunks.append(unescape(html[at:]))
    lines.flush(article, container)
    return lines, articles


def stretches(lengths: list[int]) -> list[tuple[int, int, int]]:
    """From surge to dive: first line, line behind the last, and peak of the sliding sums."""
    if not lengths:
        return []
    sums = np.convolve(lengths, np.ones(WINDOW, dtype=np.int64))  # sum of the WINDOW lines up to each place
    inside = sums > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    out = []
    for surge, dive in zip(edges[::2], edges[1::2]):
        out.append((int(surge), min(int(dive) - WINDOW + 1, len(lengths)), int(sums[surge:dive].max())))
    return out


def main_text(html: str | None) -> str:
    """Blocks of the main text, joined by two line feeds; empty where there is none."""
    if not html:
        return ""
    lines, articles = lines_of(html)
    wrappers: frozenset[int] = frozenset()
    while not articles and lines.skipped:
        outside = sum(lines.lengths)
        place, inside = max(lines.skipped.items(), key=lambda x: (x[1], -x[0]))
        others = sum(lines.skipped.values()) - inside
        if inside < WRAPS * max(outside + others, 1):
            break
        wrappers |= {place}
        lines, articles = lines_of(html, wrappers)
    found = stretches(lines.lengths)
    if not found:
        return ""
    weights: dict[int, int] = {}
    for part, length in zip(lines.parts, lines.lengths):
        if part > 0:
            weights[part] = weights.get(part, 0) + length
    if weights:
        _, container = lines.roots[max(weights, key=lambda p: (weights[p], -p))]
        return "\n\n".join(t for t, p in zip(lines.texts, lines.parts) if p > 0 and container == lines.roots[p][1])
    peak = max(p for _, _, p in found)
    main = [top >= PEAK * peak for _, _, top in found]
    first, last = main.index(True), len(main) - main[::-1].index(True)
    inside = lambda k: {lines.containers[i] for i in range(*found[k][:2]) if lines.lengths[i]}
    own = set().union(*(inside(k) for k in range(len(found)) if main[k]))
    kept = []
    for k, (surge, dive, _) in enumerate(found):
        between = first <= k < last
        kept += [lines.texts[i] for i in range(surge, dive) if lines.lengths[i] and (between or lines.containers[i] in own)]
    return "\n\n".join(t for t in kept if t)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Append ``text``, the main text of each page.

    Null and empty pages have an empty text.  All columns and repeated rows are kept (a column named ``text``
    is replaced); an empty table stays empty.
    """

    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in parts:
            yield series.map(main_text, na_action=None).astype(object)

    return pages.withColumn("text", texts(F.col(html)))
