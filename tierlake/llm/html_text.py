"""Main text of web pages by smoothed text-to-tag ratios (operator 3).

The standard library's streaming parser turns a page into *lines*, one a block,
each with its text, its number of tags, its text inside links, and the element
it stands in. Lines inside menus, footers, adverts and the like can never be
content. The ratio of text to tags of every line is smoothed with a Gaussian
over its neighbours, and the lines at or above the standard deviation of the
smoothed ratios are the content cluster. The *regions* the cluster lies in are
the main text: marked ones (``article``, ``main``) if it reaches any, else the
elements around its lines. Of a chosen region every line stays, short ones too, but for
parts of a marked one whose name may mean a menu, a box or reader comments and
whose ratios or links say the same.
On a page without marks, all of the cluster stays that lies in the element
around the chosen regions, so a short paragraph may have an element of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by what they mean for text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select textarea iframe "
    "object svg canvas audio video dialog menu search datalist".split()
)
# An opening tag ends an open element of these names, up to the element that holds them.
IMPLIED = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
HOLDERS = frozenset("ul ol dl table menu select div section article main body".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
    "status note".split()
)
# Words of class and id values that mark what is not main text.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations pager "
    "pagination toolbar copyright disclaimer skip paywall toc".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
# Those of them that may as well name a part of an article.
MAYBE = frozenset(
    "promo promotion widget menu nav navigation notice notices notification alert popup modal overlay "
    "share sharing social related recommended recommendations toolbar copyright disclaimer skip toc "
    "subscription signup login reply replies respond discussion".split()
)
HEADERS = frozenset(["header"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SIGMA = 1.0
#: Part of a line's characters that links hold at least in a menu without marks.
LINKED = 0.7


@dataclass(slots=True)
class Open:
    """An element that is open."""

    tag: str
    noise: bool
    comments: bool
    region: int
    marked: int
    #: In a form that is not part of a marked region.
    form: bool = False
    #: Number of the outermost part of a marked region that may be noise; 0 is none.
    maybe: int = 0


@dataclass(slots=True)
class Line:
    text: str
    tags: int
    linked: int
    noise: bool
    region: int
    marked: int
    tag: str
    heading: bool
    form: bool
    maybe: int


class Lines(HTMLParser):
    """Parser events to lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Open("", False, False, 0, 0)]
        #: Of each region, the one around it, which has a smaller number.
        self.around = [0]
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.at = self.stack[0]
        self.heading = False
        self.parts_in_doubt = 0

    def parse_html_declaration(self, i: int) -> int:
        """Of ``<!...`` the parser knows comments, DOCTYPE and CDATA; all else ends at its ``>``."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            at = self.at
            self.lines.append(
                Line(
                    text, self.tags, self.linked, at.noise, at.region, at.marked, at.tag, self.heading,
                    at.form, at.maybe,
                )
            )
        self.parts.clear()
        self.tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self.close_to("head")
        if tag in IMPLIED:
            self.close_implied(IMPLIED[tag])
        if tag in BLOCKS:
            self.close_implied(("p",))
            self.end_line()
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        self.stack.append(self.opened(tag, dict(attrs)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "g", "use", "rect", "circle"):
            self.handle_endtag(tag)

    def opened(self, tag: str, attrs: dict[str, str | None]) -> Open:
        above = self.stack[-1]
        role = (attrs.get("role") or "").lower()
        names = {
            w.lower() for k in ("class", "id") for w in WORDS.findall(attrs.get(k) or "")
        }
        hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true"
        hidden |= "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
        plain = tag not in ("html", "body", "main")
        form = tag == "form" or role == "form"
        own = hidden or tag in NEVER - {"form"} or role in ROLES or (form and above.marked > 0)
        # In a marked region some names are not enough.
        doubt = MAYBE if above.marked else frozenset()
        comments = above.comments or (plain and bool(names & COMMENTS - doubt))
        own |= plain and bool(names & NOISE - doubt)
        maybe = above.maybe
        if plain and not maybe and names & doubt:
            self.parts_in_doubt += 1
            maybe = self.parts_in_doubt
        if not above.marked:
            own |= tag == "header" or bool(names & HEADERS) and tag not in ("html", "body", "main", "article")
        article = tag == "article" or attrs.get("itemprop") == "articleBody"
        mark = 2 if article else 1 if tag == "main" or role == "main" else 0
        form |= above.form
        if mark and not own and not comments:
            # A wrapper named after a sidebar beside the article is no sidebar, a form around it none.
            noise, form = any(o.tag in NEVER - {"form"} for o in self.stack), False
        else:
            noise = above.noise or own or comments
        region, marked = above.region, above.marked
        if mark or tag in ("div", "section", "body", "td") and not marked:
            self.around.append(region)
            region, marked = len(self.around) - 1, max(mark, marked)
        return Open(tag, noise, comments, region, marked, form, maybe)

    def close_implied(self, names: tuple[str, ...]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k].tag
            if tag in names:
                self.close_from(k)
                return
            if tag in HOLDERS or tag in NEVER:
                return

    def close_to(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                self.close_from(k)
                return

    def close_from(self, k: int) -> None:
        gone = self.stack[k:]
        if any(o.tag in BLOCKS for o in gone):
            self.end_line()
        self.links -= sum(o.tag == "a" for o in gone)
        del self.stack[k:]

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        inline = tag not in BLOCKS
        for k in range(len(self.stack) - 1, 0, -1):
            held = self.stack[k].tag
            if held == tag:
                self.close_from(k)
                return
            if inline and held in BLOCKS:  # a stray end tag ends nothing around its block
                return

    def handle_data(self, data: str) -> None:
        if not data:
            return
        if not any(self.parts) or not "".join(self.parts).strip():
            self.at = self.block()
            self.heading = any(o.tag in HEADINGS for o in self.stack[-3:])
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())

    def block(self) -> Open:
        """The innermost open element; its flags hold for the text."""
        return self.stack[-1]


def ratios(lines: list[Line]) -> np.ndarray:
    """Characters outside links per tag; nothing for lines that can't be content."""
    return np.array(
        [0.0 if x.noise else max(0, len(x.text) - x.linked) / max(1, x.tags) for x in lines]
    )


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the window ends where the page does, and weights add up to one."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones_like(values), kernel, mode="full")[reach : reach + len(values)]
    return np.convolve(values, kernel, mode="full")[reach : reach + len(values)] / weight


def container(around: list[int], chosen: set[int], able: list[int]) -> np.ndarray:
    """Whether each region lies in the innermost one that holds all ``chosen`` ones.

    A wrapper of a single line is not that one; ``able`` has each line's region.
    """
    first, last = min(chosen), max(chosen)
    # Regions are numbered as they open: what holds these two holds all between them.
    while first != last:
        if first < last:
            last = around[last]
        else:
            first = around[first]
    held = np.bincount(able, minlength=len(around))
    for k in range(len(around) - 1, 0, -1):
        held[around[k]] += held[k]
    while first and held[first] < 2:
        first = around[first]
    inside = np.zeros(len(around), dtype=bool)
    inside[first] = True
    for k in range(first + 1, len(around)):
        inside[k] = inside[around[k]]
    return inside


def without_forms(lines: list[Line]) -> None:
    """Text in forms is noise, unless forms wrap most of the page's text."""
    able = [x for x in lines if not x.noise]
    inside = sum(len(x.text) for x in able if x.form)
    if 2 * inside <= sum(len(x.text) for x in able):
        for line in able:
            line.noise |= line.form


def without_doubtful(lines: list[Line]) -> None:
    """Parts whose names may mean noise are noise if they are mostly links or tags.

    A part is tags if the smoothed ratio of none of its lines reaches the
    threshold of the page.
    """
    parts: dict[int, list[int]] = {}
    for k, line in enumerate(lines):
        if line.maybe and not line.noise:
            parts.setdefault(line.maybe, []).append(k)
    if not parts:
        return
    score = smoothed(own := ratios(lines))
    for places in parts.values():
        held = [lines[k] for k in places]
        links = sum(x.linked for x in held) >= LINKED * sum(len(x.text) for x in held)
        if links or max(min(score[k], own[k]) for k in places) < score.std():
            for line in held:
                line.noise = True


def main_text(html: str | None) -> str:
    """The main text of a page, blocks joined by line feeds; empty if there is none."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_line()
    lines = parser.lines
    without_forms(lines)
    without_doubtful(lines)
    able = np.array([not x.noise for x in lines], dtype=bool)
    if not able.any():
        return ""
    own = ratios(lines)
    score = smoothed(own)
    cluster = able & (score >= score.std())
    if not cluster.any():
        cluster = able & (score >= score[able].max())
    # A menu beside a long paragraph is raised by it, but has no such line itself.
    strong = cluster & (own >= score.std())
    reached = [x for x, c in zip(lines, strong if strong.any() else cluster, strict=True) if c]
    best = max(x.marked for x in reached)
    if not best:  # the cluster may have missed a short article
        best = max(x.marked for x, a in zip(lines, able, strict=True) if a)
        reached = reached if not best else [x for x, a in zip(lines, able, strict=True) if a]
    chosen = {x.region for x in reached if x.marked == best}
    also = np.zeros(len(lines), dtype=bool)
    if best == 2:
        # Around an article, its page's main element may hold the heading and more text.
        also |= [x.marked == 1 and (bool(c) or x.tag == "h1") for x, c in zip(lines, cluster, strict=True)]
    elif not best:
        regions = [x.region for x in lines]
        able_regions = [r for r, a in zip(regions, able, strict=True) if a]
        also |= cluster & container(parser.around, chosen, able_regions)[regions]
        # A menu before or after the text is raised by it; it is links and what divides them.
        text = np.flatnonzero(strong if strong.any() else cluster)
        menu = np.array([x.linked >= LINKED * len(x.text) and not x.heading for x in lines])
        menu[text[0] : text[-1]] = False
        also &= ~menu
    kept = [
        x.text
        for x, a, c in zip(lines, able, also, strict=True)
        if a and (c or x.region in chosen)
    ]
    return "\n".join(kept)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    A null or empty page, or one without main text, has the empty text. Broken
    markup is read as far as it goes: tags that are never closed end with what
    holds them or with the page. Repeated rows are extracted each; an empty
    table gives an empty result.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
    )

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [main_text(html) for html in frame["html"]]
            yield frame[["page_id", "url"]].assign(text=found, n_chars=[len(t) for t in found])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInPandas(
        texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
