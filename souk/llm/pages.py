"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's parser streams a page into lines, one per block, each with its text, its number of tags,
its link text and the elements around it. Lines in elements that are never the article (menus, forms and the
like, by element name or role) carry no text. Words in a class or id (adverts, comments) only mark an element: what it
holds is left out if that is the smaller part of the page's unlinked text. The text-to-tag ratios of the other lines
are smoothed with a Gaussian kernel; lines above the threshold form the content cluster. The content region is
the innermost element that holds all of the cluster, or every article element that holds a part of it if articles hold
most of its text, and all its lines are kept, so that a short paragraph between long ones is not lost.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_batches

#: Kernel width in lines, share of the ratios' mean that is the threshold, and share of the cluster's text that articles hold if they are the region.
SIGMA = 1.0
THRESHOLD = 0.5
REGION = 0.6
#: Link text above this share makes a line outside an article a list of links.
LINKS = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset(
    "head title script style noscript template iframe object canvas svg math audio video select option button textarea datalist dialog "
    "search".split()
)
#: Elements and roles for side matter. A page may stand in one as a whole, or one may never be closed: they are left out like marked
#: ones, by what they hold, and one is no side matter only with so many characters of unlinked text at least.
SIDE = frozenset("nav menu footer aside form".split())
LEAST = 140
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
#: Words that mark an element as outside the article when its class or id consists of them.
HIDDEN_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted cookie cookies consent "
    "gdpr notice notices notification popup modal overlay lightbox sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs topbar "
    "toolbar footer masthead comment comments commentlist disqus respond reply replies discussion share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup signin login pagination pager widget widgets hidden skip announcement "
    "disclaimer paywall".split()
)
#: Words beside them that do not change what an element is: a class is read whole, so "with-sidebar" or "related-work" marks nothing.
FRAME_WORDS = frozenset(
    "box container wrapper wrap block area list bar section panel group item items inner outer link links icon icons button buttons btn form "
    "title heading text left right top bottom primary secondary site page post posts entry article articles story stories blog global mobile "
    "desktop sticky fixed unit slot google leaderboard column col row recent popular more module message dialog sign up in email fb twitter "
    "facebook".split()
)
#: Words that are also plain titles: as the id of a section they name it, and mark nothing.
TITLE_WORDS = frozenset("announcement disclaimer discussion hidden notice notices notification related replies reply sharing skip social".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A marked element with more than this share of the page's unlinked text is no side matter.
MOST = 0.5
#: These mark page heads unless they are inside an article, whose own head holds its title.
HEAD_WORDS = frozenset("header head".split())
ARTICLES = frozenset("article main".split())
#: The words that mark an article element.
ARTICLE_WORDS = frozenset("comment comments reply ad advert promo related".split())
IMPLIED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPES = frozenset("html body div section article main ul ol dl table blockquote nav aside footer header form td th li dd figure details".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


@dataclass
class Element:
    name: str
    parent: Element | None
    hidden: bool
    in_article: bool
    depth: int
    marked: bool = False
    side: bool = False


@dataclass
class Line:
    element: Element
    tags: int
    parts: list[tuple[str, Element, bool]] = field(default_factory=list)
    links: int = 0
    text: str = ""
    heading: bool = False


class Lines(HTMLParser):
    """One ``Line`` per block of a page, in page order; hidden elements give none, marked ones only if they hold most of the text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        root = Element("", None, False, False, 0)
        self.open, self.lines, self._line, self._tags, self._anchors = [root], [], None, 0, 0
        self._elements, self._names = [root], Counter()

    def _break(self) -> None:
        if self._line is not None:
            self._line.tags = self._tags
            self.lines.append(self._line)
            self._line, self._tags = None, 0

    def _pop_to(self, at: int) -> None:
        for element in self.open[at:]:
            self._anchors -= element.name == "a"
            self._names[element.name] -= 1
        del self.open[at:]

    def _close_implied(self, name: str) -> None:
        closing = IMPLIED.get(name, "").split()
        for at in range(len(self.open) - 1, 0, -1):
            one = self.open[at].name
            if one in closing or (one == "p" and name in BLOCKS):
                self._pop_to(at)
                return
            if one in SCOPES:
                return

    @staticmethod
    def _is_hidden(name: str, attrs: dict[str, str | None]) -> bool:
        if name in ("html", "body", *ARTICLES) and "hidden" not in attrs:
            return False
        if name in HIDDEN:
            return True
        style = (attrs.get("style") or "").replace(" ", "").lower()
        return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style

    @staticmethod
    def _is_side(name: str, attrs: dict[str, str | None], in_article: bool) -> bool:
        if name in ("html", "body", *ARTICLES):
            return False
        return name in SIDE or (name == "header" and not in_article) or (attrs.get("role") or "").lower() in SIDE_ROLES

    @staticmethod
    def _is_marked(name: str, attrs: dict[str, str | None], in_article: bool) -> bool:
        if name in ("html", "body", "main"):
            return False
        of_class, of_id = (set(map(_words, (attrs.get(k) or "").split())) for k in ("class", "id"))
        if name in HEADINGS or (name == "section" and in_article):
            of_id = set()
        elif name == "section":
            of_id = {w for w in of_id if not w <= TITLE_WORDS}
        heads = HEAD_WORDS if not in_article and name in ("div", "section", "table") else frozenset()
        side = ARTICLE_WORDS if name == "article" else HIDDEN_WORDS | heads
        return any(words & side and words <= side | FRAME_WORDS for words in of_class | of_id)

    def handle_starttag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if name in BLOCKS:
            self._break()
            self._close_implied(name)
        elif name == "br":
            self.handle_data(" ")
        if name in VOID:
            return
        parent = self.open[-1]
        hidden = parent.hidden or self._is_hidden(name, dict(attrs))
        side = not hidden and self._is_side(name, dict(attrs), parent.in_article)
        marked = side or (not hidden and self._is_marked(name, dict(attrs), parent.in_article))
        in_article = parent.in_article or (name in ARTICLES and not marked)
        self.open.append(Element(name, parent, hidden, in_article, parent.depth + 1, marked, side))
        self._elements.append(self.open[-1])
        self._names[name] += 1
        self._anchors += name == "a"

    def handle_startendtag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(name, attrs)
        if name not in VOID and self.open[-1].name == name:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, name: str) -> None:
        self._tags += 1
        if name in BLOCKS:
            self._break()
        if not self._names[name]:
            return  # nothing of that name is open
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].name == name:
                self._pop_to(at)
                return
            if name not in SCOPES and self.open[at].name in SCOPES:
                return  # a stray inline end tag closes nothing outside its block

    def handle_data(self, data: str) -> None:
        inner = self.open[-1]
        if inner.hidden:
            return
        if self._line is None:
            if not data.strip():
                return
            block = inner
            while block.parent is not None and block.name not in BLOCKS:
                block = block.parent
            self._line = Line(block, 0, heading=block.name in ("h1", "h2"))
        self._line.parts.append((data, inner, self._anchors > 0))

    def close(self) -> None:
        super().close()
        self._break()
        self._leave_out_marked()

    def _leave_out_marked(self) -> None:
        """Write the lines' text without that of marked elements, unless one holds most of the page or nothing else is left.

        The page is its articles, if they hold any unlinked text: an advert longer than the article stays out. Side elements stay
        out even if nothing else is left.
        """
        held: Counter[int] = Counter()
        total = 0
        articles = any(element.in_article and data.strip() and not linked for line in self.lines for data, element, linked in line.parts)
        for line in self.lines:
            for data, element, linked in line.parts:
                weight = 0 if linked or (articles and not element.in_article) else len(data.strip())
                total += weight
                held[id(element)] += weight
        for element in reversed(self._elements[1:]):  # children come after their parents
            held[id(element.parent)] += held[id(element)]

        def left_out(sides: bool) -> set[int]:
            """Elements that go, with what is in them: all marked ones, or side elements alone."""
            out = set()
            for element in self._elements[1:]:
                own = held[id(element)]
                goes = element.side if sides else element.marked
                if id(element.parent) in out or (goes and (own <= MOST * total or (element.side and own < LEAST))):
                    out.add(id(element))
            return out

        out = left_out(sides=False)
        if not any(data.strip() and id(element) not in out for line in self.lines for data, element, _ in line.parts):
            out = left_out(sides=True)
        lines, tags = [], 0
        for line in self.lines:
            parts = [(data, linked) for data, element, linked in line.parts if id(element) not in out]
            line.text = " ".join("".join(data for data, _ in parts).split())
            line.links = sum(len(data.strip()) for data, linked in parts if linked)
            line.tags += tags
            tags = 0 if line.text else line.tags
            line.parts = []
            if line.text:
                lines.append(line)
        self.lines = lines


def _words(token: str) -> frozenset[str]:
    """The words of one class or id; a token that is a word itself stays one."""
    if token.lower() in HIDDEN_WORDS:
        return frozenset([token.lower()])
    return frozenset(w.lower() for w in _PARTS.findall(token) if not w.isdigit())


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the lines, with the kernel renormalised at both ends."""
    radius = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    middle = slice(radius, radius + len(values))
    weight = np.convolve(np.ones(len(values)), kernel)[middle]
    return np.convolve(values, kernel)[middle] / weight


def _unlinked(line: Line) -> int:
    return max(0, len(line.text) - line.links)


def _outermost(element: Element | None, name: str) -> Element | None:
    """The outermost unmarked element of a name around an element."""
    found = None
    while element is not None:
        if element.name == name and not element.marked:
            found = element
        element = element.parent
    return found


def _around(elements: list[Element]) -> Element:
    """The innermost element that holds all. Elements known to be inside are not climbed from again."""
    region, known = elements[0], {id(elements[0])}
    for other in elements[1:]:
        path = []
        while id(other) not in known and other.depth > region.depth:
            path.append(other)
            other = other.parent
        while id(other) not in known:
            if region.depth >= other.depth:
                region = region.parent
                known.add(id(region))
            else:
                path.append(other)
                other = other.parent
        known.update(map(id, path))
    return region


def main_text(html: str) -> str:
    """The article's blocks, joined by an empty line; empty if the page has no text outside hidden elements."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratios = smoothed(np.array([len(x.text) / max(1, x.tags) for x in lines]))
    content = ratios >= THRESHOLD * ratios.mean()
    cluster = [x for x, c in zip(lines, content) if c and x.links <= LINKS * len(x.text)]
    cluster = cluster or [x for x, c in zip(lines, content) if c]
    total = sum(map(_unlinked, cluster))
    regions: set[int] = set()
    for name in ("article", "main"):
        held = [(x, e) for x in cluster if (e := _outermost(x.element, name)) is not None]
        if not regions and held and sum(_unlinked(x) for x, _ in held) >= REGION * total:
            regions = {id(e) for _, e in held}
    if not regions:
        region = _around([line.element for line in cluster])
        if region.name in ("p", "span", "h1", "h2", "li", "td") and region.parent is not None:
            region = region.parent
        regions = {id(region)}

    within: set[int] = set()
    for element in parser._elements:
        if id(element) in regions or id(element.parent) in within:
            within.add(id(element))
    chosen = [id(x.element) in within for x in lines]
    first = chosen.index(True)
    title = next((i for i in range(first - 1, -1, -1) if lines[i].heading), None)
    if title is not None and not any(x.heading and c for x, c in zip(lines, chosen)):
        chosen[title] = True
    kept = [x.text for x, c in zip(lines, chosen) if c and (x.element.in_article or x.heading or x.links <= LINKS * len(x.text))]
    return "\n\n".join(kept)


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points) of the main text of each page.

    A null or empty page gives an empty text; text without any markup is kept as it is, in one block. Pages are
    read whole, one at a time; repeated rows give repeated rows, null keys stay, other columns are ignored.
    """
    kept = df.select(*keep, F.coalesce(F.col(html), F.lit("")).alias("_html"))
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != "_html") + ", text string, n_chars bigint"

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h.as_py()) for h in batch.column("_html")]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text", "n_chars"])

        return step

    return map_batches(kept, start, schema)
