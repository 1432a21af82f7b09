"""Main text of web pages from parser events and the text-to-tag ratio of lines.

A streaming parser of the standard library turns a page into lines, one per block element, each with its
characters and tags and the region it stands in. The ratios are smoothed by a Gaussian kernel and
split by two-means clustering into content and the rest; a region is content if most of its
characters outside links are on content lines. Elements that are never content (menus, forms, notices, comments and the like, by
tag, role, class or id) are left out whatever their ratio; class and id alone never exclude `main`, `article`, what holds the
page's own or what holds most of the text. A page's `main` or `article`, if it has one, is a single region.

Every page is handled alone, in Arrow batches, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the markup language by their part in a page.
NEVER = frozenset(
    "head title nav header footer aside form script style noscript template iframe object svg canvas button select textarea option dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
REGIONS = frozenset("article main section div td body".split())
MAIN = frozenset(("article", "main"))
# Class tokens and ids of what is never content: the whole token, or its first part where that says enough alone.
MARKED = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|widget|footer|header|masthead|cookies?|consent|notice|"
    r"popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|replies|disqus|copyright|legal)",
    re.IGNORECASE,
)
REPLIES = re.compile(r"(?:comments?|replies|disqus)(?![a-z])", re.IGNORECASE)
# First parts that name a topic or a layout as often as a part of a page: `social-science`, `side-by-side`, `modal-verbs`.
TOPICS = frozenset("social legal notice share side consent promo banner login overlay modal".split())
# Second parts that name a part of a page whatever stands before them.
PARTS = frozenset(
    "area bar bars block box btn button buttons container content icon icons inner item items link links list menu nav panel popup "
    "section unit widget widgets wrap wrapper".split()
)
BORDER = re.compile(r"[_-]+")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SPACE = re.compile(r"\s+")
SIGMA = 1.0


def marked(names: str) -> bool:
    """Whether a class list or id has a token that names what is never content."""
    for token in names.split():
        parts = [part for part in BORDER.split(token) if part]
        if parts and MARKED.fullmatch(parts[0]):
            if len(parts) == 1 or parts[0].lower() not in TOPICS or all(part.lower() in PARTS or part.isdigit() for part in parts[1:]):
                return True
    return False


class PageLines(HTMLParser):
    """Lines of a page as [region, text, tags, characters in links, marks]; region -1 is never content.

    `marks` are the numbers of the elements around a line that only their class or id excludes.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.open: list[tuple[str, int, tuple[int, ...]]] = []  # element, region, marks
        self.n_marks = 0
        self.replies: set[int] = set()  # marks of comments
        self.around: list[tuple[int, ...]] = []  # marks of the elements around each `article`
        self.holders: set[int] = set()  # marks of the elements around `main`
        self.main: set[int] = set()
        self.regions = 0
        self.links = 0
        self.parts: list[str] = []
        self.tags = self.linked = 0

    @property
    def region(self) -> int:
        return self.open[-1][1] if self.open else 0

    @property
    def marks(self) -> tuple[int, ...]:
        return self.open[-1][2] if self.open else ()

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append([self.region, text, self.tags, self.linked, self.marks])
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        if tag == "p" and any(name == "p" for name, *_ in self.open[-3:]):
            self.close_to("p")
        named = {k: v or "" for k, v in attrs}
        never = tag in NEVER or named.get("role", "").lower() in ROLES or "hidden" in named or named.get("aria-hidden") == "true"
        never = never or "display:none" in named.get("style", "").replace(" ", "").lower()
        region, marks = self.region, self.marks
        if tag == "body" and region < 0:
            self.open = []  # a head that was not closed
            region, marks = 0, ()
        elif tag == "main" and region < 0 and not never:
            self.open = [entry for entry in self.open if entry[1] >= 0]
            region, marks = self.region, self.marks
        if never:
            region = -1
        elif tag == "main":
            self.holders.update(marks)
        elif tag == "article":
            self.around.append(marks)
        elif tag not in ("html", "body") and any(marked(named.get(k, "")) for k in ("class", "id")):
            self.n_marks += 1
            if any(REPLIES.match(token) for k in ("class", "id") for token in named.get(k, "").split()):
                self.replies.add(self.n_marks)
            marks = (*marks, self.n_marks)
        if never:
            pass
        elif region >= 0 and tag in REGIONS and region not in self.main:
            self.regions += 1
            region = self.regions
            if tag in MAIN:
                self.main.add(region)
        self.open.append((tag, region, marks))
        self.links += tag == "a"

    def close_to(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.flush()
                self.links -= sum(name == "a" for name, *_ in self.open[at:])
                del self.open[at:]
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            self.close_to(tag)
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self.links -= tag == "a"
                del self.open[at]
                return
            if name in BLOCKS and name != "p":
                return

    def handle_data(self, data):
        if not self.open or self.open[-1][0] not in ("script", "style"):
            self.parts.append(data)
            if self.links > 0:
                self.linked += len(data)

    def unknown_decl(self, data):
        pass


def page_lines(html: str) -> tuple[list[list], set[int]]:
    """(lines, regions of `main` and `article`) of a page; lines are [region, text, tags, characters in links]."""
    for source in (html, html.replace("<![", "&lt;![")):
        parser = PageLines()
        try:
            parser.feed(source)
            parser.close()
        except AssertionError:  # a marked section the parser does not know
            continue
        parser.flush()
        return without_marked(parser), parser.main
    return [], set()


def without_marked(parser: PageLines) -> list[list]:
    """The lines, those in marked elements in region -1, unless the element holds `main`, the page's article or most of its free text.

    The page's articles are those in the fewest marked elements: others are teasers or comments.
    """
    held: Counter[int] = Counter()
    total, plain = 0, False
    for region, text, _, linked, marks in parser.lines:
        if region >= 0:
            free = max(len(text) - linked, 0)
            total += free
            held.update({mark: free for mark in marks})
            plain = plain or (region in parser.main and not marks)
    spared = set(parser.holders)
    if not plain and not parser.holders and parser.around:
        least = min(map(len, parser.around))
        spared.update(*(marks for marks in parser.around if len(marks) == least))
    spared |= {mark for mark, free in held.items() if 2 * free > total and not (plain and mark in parser.replies)}
    return [[region if spared.issuperset(marks) else -1, *rest] for region, *rest, marks in parser.lines]


def content_lines(lines: list[list], sigma: float = SIGMA) -> np.ndarray:
    """Which lines are content by their smoothed ratio of characters outside links to tags."""
    ratio = np.array([max(len(text) - linked, 0) / max(tags, 1) for _, text, tags, linked in lines], float)
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.log1p(np.convolve(ratio, kernel / kernel.sum(), "full")[reach : reach + len(ratio)])
    low, high = smooth.min(), smooth.max()
    for _ in range(50):
        middle = (low + high) / 2
        upper = smooth >= middle
        if upper.all():
            break
        moved = smooth[~upper].mean(), smooth[upper].mean()
        if np.allclose(moved, (low, high)):
            break
        low, high = moved
    return smooth >= (low + high) / 2


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """Blocks of the content regions in page order, joined by line ends; empty if there are none."""
    lines, main = page_lines(html or "")
    if not lines:
        return ""
    content = content_lines(lines, sigma)
    own = {line[0] for line in lines}
    if main & own:
        # Several articles of one page: all those that are content by their ratio, and the longest.
        candidates = main & own
    else:
        candidates = {region for region in own if region >= 0}
    size = {region: [0, 0] for region in candidates}
    for (region, text, _, linked), good in zip(lines, content, strict=True):
        if region in size:
            free = max(len(text) - linked, 0)
            size[region][0] += free
            size[region][1] += free * bool(good)
    longest = max(candidates, key=lambda r: (size[r][0], -r), default=None)
    chosen = {r for r, (free, good) in size.items() if r == longest or (free and 2 * good >= free)}
    return "\n".join(text for region, text, _, _ in lines if region in chosen)


def extract_main_text(pages: DataFrame, sigma: float = SIGMA) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars.

    `pages` needs page_id, url and html; further columns are ignored. NULL and empty pages, and those without content, have an empty text.
    """

    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(html, sigma) for html in batch], dtype=object)

    text = F.pandas_udf(made, "string")(F.col("html"))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
