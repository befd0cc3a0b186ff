"""Main text of HTML pages by text-to-tag ratios.

The standard library's streaming parser emits the page as lines: one line per
block of text, with its container, its characters, its link characters and
the tags met in it. Each line's text-to-tag ratio is smoothed by a Gaussian
over its neighbours, and lines above a threshold (the standard deviation of
the smoothed ratios) form the content cluster. The elements that hold most of
that cluster are the content region: all articles with cluster lines, or else
the <main>, or else the innermost element. Every line of the region that is not
part of a menu, header, footer, sidebar, notice, advert, form or reader comment
is kept, short or long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.storage import free

#: Width (in lines) of the Gaussian, and lines on each side that it covers.
SIGMA, REACH = 1.0, 2

SILENT = frozenset("script style template noscript head iframe object svg math canvas audio video select textarea button "
                   "datalist map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section "
                   "summary table tbody td tfoot th thead tr ul caption".split())
#: Elements that may stand in a head; any other start tag ends one that is open.
IN_HEAD = frozenset("head title meta link script style base noscript template object".split())
#: Elements that a page uses for what is not its article, and those that may also hold the whole page.
ASIDE = frozenset("nav footer aside menu dialog search".split())
WRAPPERS = frozenset(["form"])
#: Words of a class, id, role or label that name such a part.
ASIDE_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer sidebar aside "
                        "notice cookie cookies consent gdpr popup modal overlay alert newsletter subscribe signup "
                        "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted "
                        "comment comments discussion disqus replies respond share sharing social related recommended "
                        "recommendations widget toolbar pagination pager search login form copyright contentinfo "
                        "complementary skip hidden".split())
#: Those of them that are also given to what holds a page's text.
LOOSE_WORDS = frozenset("header masthead banner widget overlay modal popup search login form toolbar pager pagination "
                        "promo promotion promoted social share sharing subscribe signup skip".split())
HEADINGS = frozenset("header masthead banner".split())
#: A class that begins so (has-sidebar, no-comments) says what a page has or lacks, not what the element is.
SAYS_OF = frozenset("has have no non not with without".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that end an open <p>, and items that end an open item of their kind.
ENDS_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
#: An open item is looked for no further out than these.
LIMITS = frozenset("ul ol menu dl table body article section div".split())
REGIONS = frozenset("article main section div td body html".split())
_WORDS = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    parent: int
    silent: bool
    aside: bool
    named: bool  # put aside by a name of its own, where nothing speaks against it
    loose: bool  # named by words that say little
    region: int  # the nearest element that may be a content region, itself included


@dataclass
class Line:
    element: int
    text: list[str] = field(default_factory=list)
    tags: int = 0
    links: int = 0


class Lines(HTMLParser):
    """Feeds a page and collects its block lines and element tree."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1, False, False, False, False, 0)]
        self.open = [0]
        self.open_tags: Counter[str] = Counter()
        self.head = 0  # depth of an open <head>
        self.lines: list[Line] = []
        self.line = Line(0)

    def end_line(self) -> None:
        if self.line.text:
            self.lines.append(self.line)
            self.line = Line(self.open[-1])
        else:
            self.line.element = self.open[-1]

    def close_to(self, depth: int) -> None:
        for at in self.open[depth:]:
            self.open_tags[self.elements[at].tag] -= 1
        del self.open[depth:]
        if depth <= self.head:
            self.head = 0

    @property
    def in_link(self) -> bool:
        return self.open_tags["a"] > 0

    def close_last(self, tags: tuple[str, ...], limits: frozenset[str] = LIMITS) -> None:
        if not any(self.open_tags[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.elements[self.open[depth]].tag
            if tag in tags:
                self.close_to(depth)
                return
            if tag in limits:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.line.tags += 1
        if self.head and tag not in IN_HEAD and self.elements[self.open[-1]].tag in ("head", "title"):
            self.close_to(self.head)
        if tag in BLOCKS:
            self.end_line()
        elif tag == "br":
            self.handle_data(" ")
        if tag in ENDS_P:
            self.close_last(("p",))
        if tag in ENDS_SAME:
            self.close_last(ENDS_SAME[tag], frozenset(("ul", "ol", "menu", "dl", "table", "select")))
        if tag in VOID:
            return
        up = self.elements[self.open[-1]]
        names: set[str] = set()
        hidden = False
        for name, value in attrs:
            if name in ("class", "id", "role", "aria-label"):
                for one in (value or "").lower().split():
                    words = _WORDS.findall(one)
                    names.update(() if words and words[0] in SAYS_OF and name == "class" else words)
            hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or \
                name == "style" and "display:none" in (value or "").replace(" ", "").lower()
        within = self.inside_article()
        if within:  # the heading of the article itself
            names -= HEADINGS
        aside = tag in ASIDE or hidden or tag == "header" and not within
        names &= ASIDE_WORDS
        named = tag in WRAPPERS or tag not in ("html", "body", "article", "main", "h1") and bool(names)
        at = len(self.elements)
        self.elements.append(Element(tag, self.open[-1], up.silent or tag in SILENT, up.aside or aside, named,
                                     named and names <= LOOSE_WORDS, at if tag in REGIONS else up.region))
        if tag == "head":
            self.head = len(self.open)
        self.open.append(at)
        self.open_tags[tag] += 1
        if tag in BLOCKS:
            self.line.element = at

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "span", "li"):  # a slash closes foreign elements only
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if tag in BLOCKS:
            self.end_line()
        for depth in range(len(self.open) - 1, 0, -1) if self.open_tags[tag] else ():
            name = self.elements[self.open[depth]].tag
            if name == tag:
                self.close_to(depth)
                break
            if tag not in BLOCKS and name in BLOCKS:  # a stray inline end tag closes no block
                break
        if tag in BLOCKS:
            self.line.element = self.open[-1]

    def inside_article(self) -> bool:
        return self.open_tags["article"] + self.open_tags["main"] > 0

    def handle_data(self, data: str) -> None:
        up = self.elements[self.open[-1]]
        if up.silent:
            return
        if not self.line.text:
            self.line.element = self.open[-1]
            if data.isspace():
                return
        self.line.text.append(data)
        if self.in_link:
            self.line.links += len(data)

    def done(self) -> None:
        self.close()
        self.end_line()


def _ratios(lines: list[Line], texts: list[str], aside: np.ndarray) -> np.ndarray:
    """Smoothed text-to-tag ratio of each line; marked-out lines and link text count as nothing."""
    size = np.array([max(0, len(t) - n.links) for t, n in zip(texts, lines, strict=True)], float)
    ratio = np.where(aside, 0.0, size / np.maximum([n.tags for n in lines], 1))
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratio, REACH), kernel / kernel.sum(), mode="valid")


def _up(elements: list[Element], e: int) -> Iterator[int]:
    """An element and those it lies in."""
    while e >= 0:
        yield e
        e = elements[e].parent


def _inside(elements: list[Element], which: set[int]) -> list[bool]:
    """Whether each element is one of ``which`` or lies in one (parents come before their children)."""
    flags = [0 in which]
    for i in range(1, len(elements)):
        flags.append(i in which or flags[elements[i].parent])
    return flags


def _totals(elements: list[Element], at: np.ndarray, mass: np.ndarray) -> dict[int, float]:
    """Mass of the lines within each element that has any."""
    total: dict[int, float] = {}
    for e, m in zip(at.tolist(), mass.tolist(), strict=True):
        total[e] = total.get(e, 0.0) + m
    for i in range(len(elements) - 1, 0, -1):
        if i in total:
            up = elements[i].parent
            total[up] = total.get(up, 0.0) + total[i]
    return total


def _cluster(smooth: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """Mass of the lines above the threshold."""
    cluster = ~aside & (smooth >= smooth.std())
    return np.where(cluster if cluster.any() else ~aside, smooth, 0.0)


def _put_aside(elements: list[Element], lines: list[Line], texts: list[str], at: np.ndarray) -> None:
    """Puts aside what a name says is no content, but no element around the page's content.

    That is one with half of the cluster around the <main> or <h1> (or, without
    these, the first article). On pages without <article> and <main>, half of the
    cluster is enough for a form and for names that say little; where all lines
    would go, for any.
    """
    named = [i for i, e in enumerate(elements) if e.named and not e.aside]
    if not named:
        return
    before = [e.aside for e in elements]
    first = {t: next((i for i, e in enumerate(elements) if e.tag == t and not e.aside), -1) for t in ("main", "h1", "article")}
    centres = [i for i in (first["main"], first["h1"]) if i >= 0] or [first["article"]]

    def settle(spared: set[int]) -> np.ndarray:
        for i, e in enumerate(elements):
            e.aside = before[i] or e.named and i not in spared or e.parent >= 0 and elements[e.parent].aside
        return np.array([elements[e].aside for e in at])

    def heavy(which: set[int]) -> set[int]:
        aside = settle(which)
        total = _totals(elements, at, _cluster(_ratios(lines, texts, aside), aside))
        return {i for i in which if total.get(i, 0.0) > 0 and 2 * total[i] >= total[0]}

    around = {x for i in centres for x in _up(elements, i)}.intersection(named)
    spared = heavy(around) if around else around
    aside = settle(spared)
    if not any(elements[e].tag in ("article", "main") and not elements[e].aside for e in range(len(elements))):
        # without the page's own marks, what is loosely named goes by its mass
        loose = heavy(spared | {i for i in named if elements[i].loose})
        if loose - spared:
            spared = spared | loose
        aside = settle(spared)
    if aside.all():
        settle(heavy(set(named)))


def _region(elements: list[Element], at: np.ndarray, mass: np.ndarray) -> set[int]:
    """Elements whose lines are content: all articles with cluster lines, and the headings before them in their <main>;
    if they hold less than half of the mass, the <main>; or else the innermost element that holds half of it."""
    total = _totals(elements, at, mass)
    whole = total.get(0, 0.0)
    for tag in ("article", "main"):
        found = {e for e, m in total.items() if elements[e].tag == tag and m > 0 and not elements[e].aside}
        below = _inside(elements, found) if found else []
        outer = {e for e in found if not below[elements[e].parent]}
        if outer and 2 * sum(total[e] for e in outer) >= whole:
            holds = set(outer)  # and all that they lie in
            for e in outer:
                for x in _up(elements, elements[e].parent):
                    if x in holds:
                        break
                    holds.add(x)
            mains = {e for e in holds if elements[e].tag == "main"}
            within = _inside(elements, mains)
            return outer | {i for i in range(min(outer)) if elements[i].tag in TITLES and within[i]}
    inner = [e for e, m in total.items() if m >= 0.5 * whole and elements[e].tag in REGIONS | {""}]
    return {max(inner)} if inner else {0}


def main_text(html: str | None) -> str:
    """Main text of one page: its content blocks in page order, joined by newlines."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.done()
    lines, elements = page.lines, page.elements
    texts = [_SPACES.sub(" ", "".join(n.text)).strip() for n in lines]
    keep = [i for i, t in enumerate(texts) if t]
    lines, texts = [lines[i] for i in keep], [texts[i] for i in keep]
    if not lines:
        return ""
    at = np.array([n.element for n in lines])
    _put_aside(elements, lines, texts, at)
    aside = np.array([elements[e].aside for e in at])
    region = _region(elements, at, _cluster(_ratios(lines, texts, aside), aside))

    held = _inside(elements, region)
    return "\n".join(t for t, e, a in zip(texts, at.tolist(), aside.tolist(), strict=True) if not a and held[e])


def extract(pages: DataFrame, html: str = "html", text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with the main text in column ``text``.

    Null and empty pages, and pages without any content line, give an empty
    text. Broken nesting: an element left open ends with the one around it, a
    stray end tag ends nothing, a head ends at the first tag that cannot stand
    in one. The work is linear in the page. A column already called ``text`` is replaced; keys may be null or
    repeated, every row is extracted for itself. Narrow: no shuffle, one Arrow
    batch of pages in memory.
    """
    kept = [c for c in (keep or pages.columns) if c != text]
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(x.as_py()) for x in b.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), pa.array(out, pa.string())],
                                             [*kept, text])

    return pages.select(*(pages[c] for c in kept), pages[html].alias(free(pages, "__html")[0])).mapInArrow(run, schema)
