"""Main text of web pages by the distribution of line blocks.

Markup is stripped: a block element begins a new line, and elements that never hold the article (scripts, forms, menus,
adverts, comments and the like) leave blank lines, as many as lines they hold, so that distances stay. Over the lines, the
lengths of the texts in a sliding window are summed; links count nothing, but headings do. The distribution dives where a
block without text begins and surges where the last such block ends; the lines between a surge and a dive are a span.

Elements that mark content (``article``, ``main``, content-named ones) are weighed by the text they hold. Inside the one
that wins, every span is the article's, so what goes are runs of links as long as a block. Where none wins, the page's
other lines are read alike: spans go by the largest block sum in them, against the largest of the page.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
from pyspark.sql import DataFrame

from trackflow.llm.work import map_rows

WINDOW = 3
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.DOTALL)
UNFINISHED = re.compile(r"<[a-zA-Z!?/][^<>]*\Z")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

# Names of elements in the public HTML standard, and of roles and classes in common use.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "script style head title nav header footer aside form menu noscript template iframe object embed svg math canvas audio video map button select option optgroup textarea "
    "input label fieldset dialog search frameset noframes applet datalist meter progress output".split()
)
RAW = frozenset("script style textarea title".split())
SAME = frozenset("li dt dd tr td th option".split())
#: Elements for content by rank, content-named ones have rank 1.
CONTENT = {"article": 3, "main": 2}
#: Text in an element for content weighs as much as this many times the text outside of all of them.
BOOST = 8
#: A span is the article's if its largest block sum is at least this part of the page's largest ...
STRONG = 0.25
#: ... or if it holds a sentence of this length and lies within two blocks of such a span.
SENTENCE = 60
CONTENT_NAMES = frozenset("article content story post entry maincontent articlebody postbody".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar tablist note status".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion promoted banner banners nav navbar navigation navi menu menus submenu topnav "
    "breadcrumb breadcrumbs header masthead topbar footer foot bottombar sidebar sidebars sidenav aside rail widget widgets related recommended recommendations popular trending teaser teasers "
    "comment comments commentlist respond response responses reply replies disqus conversation conversations discussion discussions thread threads feedback reactions share sharing social sociallinks follow subscribe subscription newsletter signup login register "
    "cookie cookies cookiebar consent gdpr notice notices alert alerts popup popups modal overlay toast disclaimer legal copyright license pagination pager paging tags tagcloud toc skip hidden "
    "form forms search searchbox searchform print tools toolbar byline-social outbrain taboola".split()
)

#: Beside these, a part of a class or id says what an element has or lacks, not what it is.
BESIDE = frozenset("no not non without with has".split())


class Lines:
    """Lines of a page: the text of each block, blank where it is boilerplate, with the element for content around it."""

    def __init__(self, html: str) -> None:
        self.open: list[tuple[str, bool, int]] = []  # tag, boilerplate, element for content
        self.count: Counter[str] = Counter()
        self.state = (False, 0)
        self.line: list[str] = []
        self.texts: list[str] = []
        self.within: list[int] = []
        self.parents, self.kinds = [0], [0]  # elements for content in page order, with their rank; 0 is the page
        self.links: list[int] = []
        self.link = 0
        at, n = 0, len(html)
        while at < n:
            tag = TAG.search(html, at)
            self.data(html[at : tag.start() if tag else n])
            if not tag:
                break
            at = tag.end()
            closing, name = tag[1], (tag[2] or "").lower()
            if not name:
                continue
            if closing:
                self.end(name)
            else:
                self.start(name, tag[3])
                if name in RAW:  # up to the end tag nothing is markup
                    end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                    at = end.start() if end else n
        self.end_line()

    def data(self, text: str) -> None:
        if text:
            text = unescape(text)
            self.line.append(text)
            if self.count["a"] and not any(self.count[h] for h in HEADINGS):
                self.link += len(text)

    def end_line(self) -> None:
        text = " ".join("".join(self.line).split()) if self.line else ""
        if text:
            away, element = self.state
            self.texts.append("" if away else text)
            self.within.append(element)
            self.links.append(min(self.link, len(text)))
        self.line, self.link = [], 0

    def cut(self, k: int) -> None:
        """Close all from the k-th open element on."""
        for tag, _, _ in self.open[k:]:
            self.count[tag] -= 1
        del self.open[k:]
        now = self.open[-1][1:] if self.open else (False, 0)
        if now != self.state:
            self.end_line()
            self.state = now

    def start(self, tag: str, rest: str) -> None:
        block = tag in BLOCKS or tag in NEVER
        if block:
            self.end_line()
        if tag in VOID:
            return
        if block and self.count["p"]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    self.cut(k)
                    break
                if self.open[k][0] in BLOCKS:
                    break
        if tag in SAME and self.open and self.open[-1][0] == tag:  # an item ends the one before
            self.cut(len(self.open) - 1)
        away, element = self.state
        rank = self.kinds[element]
        attributes = [(m[1].lower(), next((v for v in m.groups()[1:] if v is not None), None)) for m in ATTRIBUTE.finditer(rest)] if rest.strip(" /") else []
        names = {w for key, value in attributes if key in ("class", "id") for w in words_of(value)}
        own = CONTENT.get(tag, 1 if tag in ("div", "section", "td") and not CONTENT_NAMES.isdisjoint(names) else 0)
        never = tag in NEVER and not (tag == "header" and rank)  # the article's own header holds its title
        if not away and tag not in ("html", "body"):
            away = never or hidden(attributes) or tag not in HEADINGS and bool(boilerplate(tag, attributes) - ({"header"} if rank else set()))
        if not away and (own > rank or tag == "article"):
            self.parents.append(element)
            self.kinds.append(own)
            element = len(self.kinds) - 1
        state = (away, element)
        if state != self.state:
            self.end_line()
            self.state = state
        self.open.append((tag, *state))
        self.count[tag] += 1

    def end(self, tag: str) -> None:
        block = tag in BLOCKS or tag in NEVER
        if block:
            self.end_line()
        if not self.count[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.cut(k)
                return
            if not block and self.open[k][0] in BLOCKS:
                return  # an inline end tag closes nothing outside of its block


def words_of(value: str | None) -> set[str]:
    """A class or id as names: the whole in lower case, and its parts between hyphens, underscores, digits and humps."""
    out = set()
    for name in (value or "").split():
        plain = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()
        out |= {plain, *re.split(r"[-_:\d]+", plain)}
    return out


def boilerplate(tag: str, attributes: list[tuple[str, str | None]]) -> set[str]:
    """Names of boilerplate among classes and ids: a whole one, or its first or last part; content elements only by whole ones."""
    values = [name for key, value in attributes if key in ("class", "id") for name in (value or "").split()]
    content = tag in CONTENT or any(v.lower() in CONTENT_NAMES for v in values)
    out = set()
    for value in values:
        plain = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", value).lower()
        parts = [x for x in re.split(r"[-_:\d]+", plain) if x]
        out |= {plain, value.lower()}
        if parts and not content and BESIDE.isdisjoint(parts):
            out |= {parts[0], parts[-1]}
    return out & NAMES


def hidden(attributes: list[tuple[str, str | None]]) -> bool:
    for key, value in attributes:
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and (value or "").strip().lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "", re.IGNORECASE):
            return True
    return False


def content_of(page: Lines) -> set[int]:
    """The elements whose lines are the article's; only 0, the page itself, if its other text outweighs the elements for content.

    The outermost element with most text wins, and so do others with at least half as much. Inside of it, an element of a
    higher rank that holds more than half of the text takes its place. An element of a higher rank with less than an eighth of
    what its surroundings hold themselves is a card, an article inside of an article with less text than that a comment.
    """
    n = len(page.kinds)
    direct = [0] * n
    for text, element in zip(page.texts, page.within, strict=True):
        direct[element] += len(text)
    total = direct.copy()
    inner: list[list[int]] = [[] for _ in range(n)]
    for e in range(n - 1, 0, -1):  # an element comes after the one around it
        inner[page.parents[e]].append(e)
        if page.parents[e]:
            total[page.parents[e]] += total[e]
    most = max((total[e] for e in inner[0]), default=0)
    if not most or direct[0] > BOOST * most:
        return {0}
    chosen = set()
    for e in (e for e in inner[0] if 2 * total[e] >= most):
        while nearer := [i for i in inner[e] if page.kinds[i] > page.kinds[e] and 2 * total[i] > total[e]]:
            e = nearer[0]
        left = [e]
        while left:
            e = left.pop()
            chosen.add(e)
            least = {i: direct[e] if page.kinds[i] == page.kinds[e] else direct[e] / 8 for i in inner[e]}
            left += [i for i in inner[e] if total[i] >= least[i]]
    return chosen


def block_sums(counts: list[int], window: int, edge: int) -> np.ndarray:
    """Sums over all blocks of ``window`` lines that meet a line, the first ending with line 0; beyond the ends each line counts ``edge``."""
    beyond = np.full(window - 1, edge, dtype=np.int64)
    total = np.concatenate(([0], np.cumsum(np.concatenate((beyond, np.array(counts, dtype=np.int64), beyond)))))
    return total[window:] - total[:-window]


def spans_of(sums: np.ndarray, window: int) -> list[tuple[int, int]]:
    """First and last line between each surge and the next dive: the runs of lines that no empty block covers."""
    empty = np.concatenate(([0], np.cumsum(sums == 0)))
    on = np.concatenate(([False], empty[window:] == empty[:-window], [False]))
    edges = np.flatnonzero(on[1:] != on[:-1])
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def article(texts: list[str], counts: list[int], window: int = WINDOW) -> list[str]:
    """The lines of a page without an element for content that are its article.

    Where only blank lines lie between a dive and the next surge, boilerplate stands inside of the text, and both sides are one
    span. Spans stay if their largest block sum reaches ``STRONG`` of the page's, or if they hold a ``SENTENCE`` (on pages of
    smaller blocks: ``STRONG`` of these) at most two blocks away from a span that stays.
    """
    sums = block_sums(counts, window, 0)
    if not sums.any():
        return []
    spans: list[tuple[int, int]] = []
    for a, b in spans_of(sums, window):
        if spans and not any(texts[spans[-1][1] + 1 : a]):
            a = spans.pop()[0]
        spans.append((a, b))
    peaks = [sums[a : b + window].max() for a, b in spans]
    strong = STRONG * sums.max()
    stays = [p >= strong for p in peaks]
    for order in (range(1, len(spans)), range(len(spans) - 2, -1, -1)):  # from the spans that stay, forwards and backwards
        step = -order.step  # towards the span before
        for k in order:
            (_, dive), (surge, _) = sorted((spans[k], spans[k + step]))
            stays[k] = stays[k] or stays[k + step] and peaks[k] >= min(strong, SENTENCE) and surge - dive - 1 <= 2 * window
    return [t for (a, b), stay in zip(spans, stays, strict=True) if stay for t in texts[a : b + 1] if t]


def inside(texts: list[str], counts: list[int], window: int = WINDOW) -> list[str]:
    """The lines of the winning elements without runs of links as long as a block; all of them if there are but links."""
    if not any(counts):
        return texts
    spans = spans_of(block_sums(counts, window, 1), window)
    return [t for a, b in spans for t in texts[a : b + 1]]


def main_text(html: str | None, window: int = WINDOW) -> str:
    page = Lines(UNFINISHED.sub("", html or ""))
    content = content_of(page)
    counts = [max(len(t) - k, 0) if t else 0 for t, k in zip(page.texts, page.links, strict=True)]
    if content == {0}:
        reach = [e == 0 for e in page.within]  # elements for content that lost leave blank lines
        return " ".join(article([t if r else "" for t, r in zip(page.texts, reach, strict=True)], [c if r else 0 for c, r in zip(counts, reach, strict=True)], window))
    lines = [(t, c) for t, c, e in zip(page.texts, counts, page.within, strict=True) if t and e in content]
    return " ".join(inside([t for t, _ in lines], [c for _, c in lines], window))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The id, the columns in ``keep`` and ``main_text`` of every whole page; one output row for each input row.

    Null and empty pages, and pages of boilerplate only, have an empty text. Broken markup is read as far as it goes: open
    elements end with the page, an unfinished tag at its end is no text. Other columns are not read.
    """
    names = [id_col, *(keep or [])]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names) + ", main_text string"
    return map_rows(pages.select(*names, html_col), lambda *columns: [*columns[:-1], [main_text(h) for h in columns[-1]]], schema)
