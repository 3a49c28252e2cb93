"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one per block element,
each with its text, the number of tags in it and the element that encloses it. Text in
elements that are never content (navigation, forms, controls, scripts, comments, ...) is
dropped piece by piece as it is read, within a line too; a line of such text alone is marked.
Names of classes and ids only hint at such elements: a hint is void where its element
wraps the page's main part (see ``_Lines.void_hints``), and on headings and paragraphs, whose
ids are made from what they say. In an article a section hints only by a class that names
reader comments.
The text-to-tag ratio per line is smoothed with a Gaussian kernel and split into two
clusters at a threshold; a region (an article or main element, or where a page has none,
a run of lines under one parent) is content if its best line lies in the upper cluster.
All unmarked lines of a content region are kept, so that short paragraphs survive. On a page
without an article, regions that hold a heading or paragraph of more than links stay as well:
a title or a short last section in an element of its own is text too.

A page is one row and its parse one pass in one task: nothing is shuffled.

Defined cases: null html is an empty page; a page without text, or with marked lines
only, has the empty text, but where hints alone mark every line the outermost are void; long pages are parsed whole; truncated and unbalanced markup is
read as far as it goes; repeated rows give repeated results; an empty table gives an
empty result; other columns are not returned.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never main text.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea dialog menu svg math canvas "
    "iframe object audio video title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
#: Parts of class and id names that mark what is not the article.
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|"
    r"newsletter|subscribe|subscription|popup|modal|overlay|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"masthead|footer|comments?|commentlist|discussion|replies|disqus|related|recommended|share|sharing|social|"
    r"widget|toolbar|skip|login|signup|paywall)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Names that say what a wrapper has or lacks, or its state, not what it is.
STATE = re.compile(r"(?:^|[_-])(?:has|no|not|with|without)[_-]|[_-](?:open|closed|enabled|disabled)$", re.IGNORECASE)
#: A start tag of the key closes an open element of the same name below these parents.
SIBLINGS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
    "th": ("tr", "table"), "option": ("select",),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Class names of a section of an article that mark reader comments.
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|replies|disqus)(?:$|[\s_-])", re.IGNORECASE)
SIGMA = 1.0
REACH = 2


def hinted(value: str) -> bool:
    """Whether a class or id value names something that is not the article."""
    return bool(HINT.search(value)) and any(HINT.search(x) and not STATE.search(x) for x in value.split())


class _Lines(HTMLParser):
    """Collects (pieces, tags, marked, region, solid) per block in page order.

    A piece is (text, hint, whether in a link). ``hint`` is the innermost open element whose
    class or id hints that it is no content, by its number; -1 is none. Numbers ascend, so
    parents come before their children. ``solid``: the block is a heading or paragraph.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int, bool]], int, bool, tuple[bool, int], bool]] = []
        self.open: list[tuple[str, bool, tuple[bool, int], int]] = []
        self.parents: list[int] = []  # of each hint
        self.wraps: list[bool] = []  # a main element, by hint
        self.heads: list[bool] = []  # an h1, by hint
        self.articles: dict[tuple[bool, int], int] = {}  # hint around each article region
        self.marked = 0
        self.links = 0
        self.text: list[tuple[str, int, bool]] = []
        self.noise: list[str] = []
        self.tags = 0
        self.elements = 0

    def flush(self) -> None:
        region = self.open[-1][2] if self.open else (False, 0)
        if any(text and not text.isspace() for text, _, _ in self.text):
            block = next((x[0] for x in reversed(self.open) if x[0] in BLOCKS), "")
            self.lines.append((self.text, self.tags, False, region, block == "p" or block in HEADINGS))
            self.tags = 0
        elif any(x and not x.isspace() for x in self.noise):
            self.lines.append(([("".join(self.noise), -1, False)], self.tags, True, region, False))
            self.tags = 0
        self.text, self.noise = [], []

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, mark, _, _ = self.open.pop()
            self.marked -= mark
            self.links -= tag == "a"

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        block = tag in BLOCKS
        if block:
            self.flush()
            # An open paragraph ends where a block begins.
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name == "p":
                    self.close_to(i)
                    break
                if name in BLOCKS:
                    break
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        if tag in SIBLINGS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self.close_to(i)
                    break
                if self.open[i][0] in SIBLINGS[tag]:
                    break
        above = self.open[-1][2] if self.open else (False, 0)
        hint = self.open[-1][3] if self.open else -1
        names = [value for name, value in attrs if name in ("class", "id") and value]
        main = tag == "main" or ("role", "main") in attrs
        if hint >= 0:
            self.wraps[hint] |= main
            self.heads[hint] |= tag == "h1"
        region = above
        if tag in ("article", "main"):
            self.elements += 1
            if not above[0]:
                region = (True, self.elements)
                if not any(hinted(x) for x in names):
                    self.articles[region] = hint
        elif block and not above[0] and tag not in ("p", "li") and tag[0] != "h":
            self.elements += 1
            region = (False, self.elements)
        mark = tag in DROPPED or (tag == "header" and not above[0])
        if not mark and attrs:
            for name, value in attrs:
                if name == "hidden" or (value and (
                    (name == "role" and value.lower() in ROLES)
                    or (name == "aria-hidden" and value == "true")
                    or (name == "style" and "display:none" in value.replace(" ", ""))
                )):
                    mark = True
        if tag in HEADINGS or tag == "p":
            names = []
        elif tag == "section" and above[0]:
            names = [x for name, x in attrs if name == "class" and x and READERS.search(x)]
        if not mark and not main and tag not in ("body", "html", "article") and any(hinted(x) for x in names):
            self.parents.append(hint)
            self.wraps.append(False)
            self.heads.append(tag == "h1")
            hint = len(self.parents) - 1
        self.open.append((tag, mark, region, hint))
        self.marked += mark
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_to(i)
                break

    def handle_data(self, data: str) -> None:
        if self.marked:
            self.noise.append(data)
        else:
            self.text.append((data, self.open[-1][3] if self.open else -1, self.links > 0))

    def void_hints(self) -> list[bool]:
        """By hint, whether its element wraps the main part of the page.

        It does if it encloses a main element; or, on a page without an article outside all
        hints, an article with as much text as lies outside; or the h1 or such an article, and
        most of the text. Where every line is under a hint, so do the outermost ones. An article
        whose own name hints (a comment, a teaser) does not count.
        """
        inside, article = [0] * len(self.parents), [0] * len(self.parents)
        wraps, heads = list(self.wraps), list(self.heads)
        plain = plain_article = whole = 0
        for pieces, _, marked, region, _ in self.lines:
            if marked:
                continue
            for text, hint, _ in pieces:
                size = len(" ".join(text.split()))
                whole += size
                of_article = self.articles.get(region) == hint
                if hint < 0:
                    plain += size
                    plain_article += size * of_article
                else:
                    inside[hint] += size
                    article[hint] += size * of_article
        for hint in range(len(self.parents) - 1, -1, -1):
            above = self.parents[hint]
            if above >= 0:
                inside[above] += inside[hint]
                article[above] += article[hint]
                wraps[above] |= wraps[hint]
                heads[above] |= heads[hint]
        only = [n > 0 and not plain_article for n in article]
        void = [
            wraps[k] or (only[k] and article[k] >= plain) or ((heads[k] or only[k]) and 2 * inside[k] > whole)
            for k in range(len(self.parents))]
        if whole and not plain and not any(void):
            void = [above < 0 for above in self.parents]
        return void

    def read(self) -> list[tuple[str, int, bool, tuple[bool, int], bool]]:
        """(text, tags, marked, region, solid) of the lines, without pieces under hints that are
        not void; a line of such pieces alone is marked."""
        active: list[bool] = []
        for void, above in zip(self.void_hints(), self.parents, strict=True):
            active.append(not void or (above >= 0 and active[above]))
        out = []
        for pieces, tags, marked, region, solid in self.lines:
            kept = [x for x in pieces if x[1] < 0 or not active[x[1]]]
            text = _joined(kept)
            linked = len(_joined([x for x in kept if x[2]]))
            out.append((text or _joined(pieces), tags, marked or not text, region, solid and 2 * linked < len(text)))
        return out


def _joined(pieces: list[tuple[str, int, bool]]) -> str:
    return " ".join("".join(x[0] for x in pieces).split())


def smoothed(values: list[float], sigma: float = SIGMA, reach: int = REACH) -> list[float]:
    """Gaussian smoothing; at the ends over the neighbours that exist."""
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[lo - i + reach:hi - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Border between two clusters of ratios: means and midpoint, until neither moves."""
    border = sum(values) / len(values)
    for _ in range(20):
        low, high = [v for v in values if v < border], [v for v in values if v >= border]
        if not low or not high:
            return border
        moved = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(moved - border) < 1e-9:
            break
        border = moved
    return border


def main_blocks(html: str) -> list[str]:
    """The blocks of main text of a page, in page order."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.read()
    if not lines:
        return []
    ratios = smoothed([len(line[0]) / max(1, line[1]) for line in lines])
    border = threshold(ratios)
    usable = [i for i, line in enumerate(lines) if not line[2]]
    articles = [i for i in usable if lines[i][3][0]]
    usable = articles or usable
    best: dict[tuple[bool, int], float] = {}
    size: dict[tuple[bool, int], int] = {}
    for i in usable:
        region = lines[i][3]
        best[region] = max(best.get(region, 0.0), ratios[i])
        size[region] = size.get(region, 0) + len(lines[i][0])
    chosen = {r for r, v in best.items() if v >= border}
    if not chosen and size:
        chosen = {max(size, key=lambda r: size[r])}
    if not articles:
        chosen |= {lines[i][3] for i in usable if lines[i][4]}
    return [lines[i][0] for i in usable if lines[i][3] in chosen]


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every page."""
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{html}`").cast("string").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, blocks = [], []
            for page in batch.column("html").to_pylist():
                found = main_blocks(page) if page else []
                texts.append("\n".join(found))
                blocks.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(blocks, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long, n_blocks long")
