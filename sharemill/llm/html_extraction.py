"""The main text of web pages: parser events, text-to-tag ratio by line, smoothing, and a threshold.

The standard library's parser turns a page into a stream of events. They are cut into lines: runs of text between the
starts and ends of block elements, whatever line breaks the source has (pages come without any, or with too many). Each
line has a ratio, its characters to the tags met in it and since the line before. The ratios of a page are smoothed
with a Gaussian kernel, and lines at or above the standard deviation are content. Their clusters point to a region: the
article or main element that holds them, or else the innermost element that holds most of their text. All of the
region's lines are returned, since a short paragraph between long ones, or a heading, is part of the article, except
what stands in elements that are no article by their tag, role, class or id (menus, footers, forms, comments, ...) and
runs of mere links.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "page_id bigint, url string, text string, n_chars bigint"

# Element names of HTML.
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody td tfoot th thead title tr ul""".split()
)
NO_TEXT = frozenset("applet audio canvas embed head iframe noframes noscript object script style svg template title video".split())
NO_ARTICLE = frozenset("aside button datalist dialog footer form input menu nav select textarea".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first kind ends an open element of the second, unless one of the third lies between.
IMPLIED_ENDS = (
    (BLOCKS - {"head", "html", "body", "option", "optgroup"}, {"p"}, frozenset("article aside body button div fieldset footer form header main nav section table td th li dd blockquote".split())),
    ({"li"}, {"li"}, frozenset("ul ol menu dir table body".split())),
    ({"dd", "dt"}, {"dd", "dt"}, frozenset("dl table body".split())),
    ({"td", "th"}, {"td", "th"}, frozenset("tr table body".split())),
    ({"tr"}, {"td", "th"}, frozenset("table body".split())),
    ({"tr"}, {"tr"}, frozenset("table body".split())),
    ({"option", "optgroup"}, {"option"}, frozenset("select datalist optgroup body".split())),
    (BLOCKS - {"head", "html", "title"}, {"head"}, frozenset()),
)
#: End tags don't reach beyond these.
OUTER = frozenset(("article", "main", "body"))
CELLS = OUTER | {"table"}
TABLES = frozenset(("table", "tbody", "thead", "tfoot"))
BARRIERS = {"article": OUTER, "main": frozenset(("body",)), "body": frozenset(), "html": frozenset(), "head": frozenset()}
#: Elements nested deeper are read as if their tags weren't there, as browsers do.
DEEPEST = 512
#: What a region can be.
REGIONS = frozenset("div section center fieldset figure details form header td th dd".split())

# Words that classes, ids and roles are made of, for what is not the article itself.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit sponsor sponsored
    sponsors promo promos promoted promotion promotions commercial
    nav navs navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs toc pagination pager skip skiplink
    sidebar sidebars aside rail widget widgets related recommended recommendations recirculation trending popular
    share sharing social follow
    header masthead topbar toolbar footer footers colophon copyright imprint contentinfo complementary
    notice notices cookie cookies consent gdpr banner banners alert alerts alertdialog dialog popup popups modal overlay toast
    paywall newsletter subscribe subscription signup signin login search searchbox searchform form
    comment comments commentlist commenter disqus respond reply replies responses guestbook""".split()
)
STEMS = ("advert", "breadcrumb", "comment", "cookie", "footer", "navbar", "newsletter", "sidebar", "sponsor")
#: Of these, also an article or a main element may be marked: one reader's comment, an advert in the form of an article.
MARKS_OF_ARTICLES = frozenset(
    """ad ads advert advertisement sponsored promo promoted related recommended teaser comment comments reply replies response
    responses""".split()
)
NEGATIONS = ("has", "no", "not", "with", "without", "hide", "show")
#: Headings after which readers speak, to the end of the element they are in.
COMMENT_HEADINGS = re.compile(
    r"(?P<number>\d+\s+)?(?P<asked>(?:reader|readers|user|post a|add a|leave a|write a|join the)\s+)?"
    r"(?:comments?|reply|replies|responses|discussion|kommentare?|commentaires?|comentarios?)(?P<count>\s*\(\d+\))?\s*:?",
    re.I,
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())


@dataclass
class Line:
    """Pieces of text with the place (number) of the innermost element around each, the tags met, linked characters."""

    parts: list[tuple[int, str]] = field(default_factory=list)
    tags: int = 0
    linked: int = 0


@dataclass
class Element:
    tag: str
    above: int
    #: no content by its tag (2) or by its class, id or role (1), as far as the start tag tells
    off: int
    #: whether its own end tag, or the start that stands for it, was met
    ended: bool = False


def names(value: str | None) -> set[str]:
    """Words of a class or id attribute in lower case; of a name that begins with a negation, none."""
    found: set[str] = set()
    for one in (value or "").split():
        words = [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", one)]
        if words and words[0] not in NEGATIONS:
            found.update(words)
    return found


class Events(HTMLParser):
    """Lines and elements of a page, in one pass over the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.line = Line()
        self.elements = [Element("", -1, 0)]
        self.stack = [0]
        self.open: Counter[str] = Counter()
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.line.tags += 1
            if tag == "br":
                self.line.parts.append((self.stack[-1], " "))
            elif tag == "hr":
                self._cut()
            return
        self._imply(tag)
        if tag in BLOCKS:
            self._cut()
        self.line.tags += 1
        if len(self.stack) >= DEEPEST and (self.silent or tag not in NO_TEXT):
            return
        self.elements.append(Element(tag, self.stack[-1], self._off(tag, dict(attrs))))
        self.stack.append(len(self.elements) - 1)
        self.open[tag] += 1
        self.silent += tag in NO_TEXT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # as browsers do: the slash means nothing on elements of HTML
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCKS:
            self._cut()
        self.line.tags += 1
        self._end(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.line.parts.append((self.stack[-1], data))
            if self.open["a"]:
                self.line.linked += len(data)

    def handle_comment(self, data: str) -> None:
        self.line.tags += 1

    def unknown_decl(self, data: str) -> None:
        self.line.tags += 1

    def read(self, html: str) -> None:
        """All of a page, with some malformed markup mended that the parser has no events for, or takes quadratic time on."""
        # a comment that nobody closes ends at the next >, and so does a marked section
        closed = html.rfind("-->") + 3 if "-->" in html else 0
        html = (html[:closed] + html[closed:].replace("<!--", "<!-")).replace("<![", "<!-[")
        whole = html.rfind(">") + 1
        self.feed(html[:whole])
        self.close()
        # what follows the last > holds no tag, and from the beginning of an unfinished one on nothing
        self.handle_data(unescape(re.split("<[a-zA-Z/!?]", html[whole:], maxsplit=1)[0]))
        self._cut()

    def _cut(self) -> None:
        if any(not data.isspace() for _, data in self.line.parts):
            self.lines.append(self.line)
            self.line = Line()
        else:  # its tags count with the next line
            self.line.parts.clear()

    def _end(self, tag: str) -> None:
        """Closes the innermost element of that name, unless a larger one lies between."""
        if not self.open[tag]:
            return
        stops = BARRIERS.get(tag, OUTER if tag in TABLES else CELLS)
        inline = tag not in BLOCKS and tag not in NO_TEXT and tag not in NO_ARTICLE
        for at in range(len(self.stack) - 1, 0, -1):
            found = self.elements[self.stack[at]].tag
            if found == tag:
                self._close(at)
                return
            if found in stops or inline and found in BLOCKS:
                return

    def _imply(self, tag: str) -> None:
        for starts, ends, stops in IMPLIED_ENDS:
            if tag in starts and any(self.open[name] for name in ends):
                for at in range(len(self.stack) - 1, 0, -1):
                    found = self.elements[self.stack[at]].tag
                    if found in ends:
                        self._cut()
                        self._close(at)
                        break
                    if found in stops:
                        break

    def _close(self, at: int) -> None:
        self.elements[self.stack[at]].ended = True
        while len(self.stack) > at:
            tag = self.elements[self.stack.pop()].tag
            self.open[tag] -= 1
            self.silent -= tag in NO_TEXT

    def _off(self, tag: str, given: dict[str, str | None]) -> int:
        if tag in NO_TEXT or tag in NO_ARTICLE or "hidden" in given or given.get("aria-hidden") == "true":
            return 2
        if re.search(r"display\s*:\s*none", given.get("style") or "", re.I):
            return 2
        if tag in ("html", "body"):
            return 0
        inside = self.open["article"] or self.open["main"]
        if tag == "header":
            return 0 if inside else 2
        classes, ids = names(given.get("class")), names(given.get("id"))
        if tag in ("article", "main"):
            return int(bool((classes | ids) & MARKS_OF_ARTICLES) or given.get("itemprop") == "comment")
        if tag in HEADINGS:
            return int(bool(classes & MARKS_OF_ARTICLES))
        if inside:  # sections are named for what they are about; an article has a header of its own
            ids &= MARKS_OF_ARTICLES | {"sidebar", "footer"}
            classes -= {"header"}
        words = classes | ids
        marked = words & MARKS or any(w.startswith(STEMS) for w in words)
        return int(bool(marked) or (given.get("role") or "") in ROLES or given.get("itemprop") == "comment")


def smoothed(ratios: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """A Gaussian kernel over the ratios; beyond the ends it is cut off and weighs the rest accordingly."""
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    return np.convolve(ratios, kernel, "full")[radius : radius + len(ratios)] / np.convolve(np.ones(len(ratios)), kernel, "full")[radius : radius + len(ratios)]


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by line feeds; within a block white space is one space. Empty if there is none."""
    events = Events()
    events.read(html or "")
    lines, elements = events.lines, events.elements
    for lenient in (False, True):
        off = _switched_off(elements, lenient)
        kept = [[part for part in line.parts if not off[part[0]]] for line in lines]
        texts = [" ".join("".join(data for _, data in parts).split()) for parts in kept]
        places = [next((place for place, data in parts if not data.isspace()), 0) for parts in kept]
        texts = _without_comments(texts, places, elements)
        usable = np.array([bool(text) for text in texts], bool)
        if usable.any():
            break
    else:
        return ""
    # lines that can't be content pull down those beside them, as tags do
    level = smoothed(np.array([len(text) / max(line.tags, 1) for text, line in zip(texts, lines, strict=True)]))
    content = usable & (level >= min(level.std(), level[usable].max()))
    region = _region(elements, texts, places, content, off)
    chosen = [at for at in np.flatnonzero(usable) if places[at] in region]
    links = [line.linked >= 0.9 * sum(len(data) for _, data in line.parts) for line in lines]
    return "\n".join(texts[at] for at in _without_menus(chosen, links))


def _switched_off(elements: list[Element], lenient: bool) -> list[bool]:
    """For each element, whether it or one around it is no content.

    A form around an article is none to leave out. What nobody closed (a menu, an advert) ends where an article starts.
    ``lenient``, for pages of which nothing is left otherwise: neither what holds an article, main element or first
    heading nor what nobody closed is left out.
    """
    around: set[int] = set()
    for at, element in enumerate(elements):
        if element.tag in ("article", "main") or lenient and element.tag == "h1":
            while at > 0 and at not in around:
                around.add(at)
                at = elements[at].above
    off = [False] * len(elements)
    for at, element in enumerate(elements[1:], 1):
        own = bool(element.off)
        if at in around and (lenient or element.tag == "form") or lenient and not element.ended and element.tag not in NO_TEXT:
            own = False
        above = element.above
        if element.tag in ("article", "main") and not own:
            while above > 0 and elements[above].off and not elements[above].ended:
                above = elements[above].above
        off[at] = own or off[above]
    return off


def _without_comments(texts: list[str], places: list[int], elements: list[Element]) -> list[str]:
    """Empties the lines from a heading that announces comments to the end of the element it stands in; a heading that may
    as well be the article's own (without number or request) counts only if that element begins with it."""
    out, seen, ends = list(texts), set(), {}
    for at, (text, place) in enumerate(zip(texts, places, strict=True)):
        if not text:
            continue
        above = place
        while above > 0 and above not in ends:
            above = elements[above].above
        if above > 0:
            out[at] = ""
            continue
        heading = place
        while heading > 0 and elements[heading].tag not in BLOCKS:
            heading = elements[heading].above
        parent = elements[heading].above if heading > 0 else 0
        if elements[heading].tag in HEADINGS and len(text) <= 80 and (found := COMMENT_HEADINGS.fullmatch(text)):
            first = parent not in seen and elements[parent].tag not in ("", "html", "body", "article", "main")
            if first or found["number"] or found["asked"] or found["count"]:
                ends[parent if parent > 0 else heading] = at
                out[at] = ""
        while place > 0 and place not in seen:
            seen.add(place)
            place = elements[place].above
    return out


def _region(elements: list[Element], texts: list[str], places: list[int], content: np.ndarray, off: list[bool]) -> set[int]:
    """The elements of the region: articles with content lines, or main elements, or the innermost element that holds
    more than half of all content."""
    size, mass = [0] * len(elements), [0] * len(elements)
    for text, place, good in zip(texts, places, content, strict=True):
        size[place] += len(text)
        mass[place] += len(text) if good else 0
    for at in range(len(elements) - 1, 0, -1):
        size[elements[at].above] += size[at]
        mass[elements[at].above] += mass[at]
    for tag in ("article", "main"):
        known = [at for at, e in enumerate(elements) if e.tag == tag and not off[at] and size[at]]
        if known:
            return _within(elements, [at for at in known if mass[at]] or known)
    inner: dict[int, int] = {}
    for at, element in enumerate(elements[1:], 1):
        if element.tag in REGIONS and 2 * mass[at] > mass[0]:
            inner[element.above] = at
        elif 2 * mass[at] > mass[0] and element.tag in ("html", "body", "table", "tbody", "tr"):
            inner[element.above] = at
    at = 0
    while at in inner:
        at = inner[at]
    return _within(elements, [at])


def _within(elements: list[Element], roots: list[int]) -> set[int]:
    inside = set(roots)
    for at, element in enumerate(elements):
        if element.above in inside:
            inside.add(at)
    return inside


def _without_menus(chosen: list[int], links: list[bool], run: int = 3) -> list[int]:
    """Leaves out ``run`` or more lines in a row that are links and nothing else, unless nothing else is there."""
    out: list[int] = []
    held: list[int] = []
    for at in chosen:
        if links[at]:
            held.append(at)
            continue
        out += (held if len(held) < run else []) + [at]
        held = []
    return out + (held if len(held) < run or not out else [])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Columns page_id, url, text (empty if none) and n_chars (code points of the text), a row for each row of ``pages``.

    A null page has an empty text. Repeated rows and ids are extracted each; other columns are ignored; an empty table
    gives an empty table. Malformed pages (unclosed or stray tags, no tags at all) have a text as well.
    """
    slim = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return slim.mapInArrow(_extract, OUT)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])
