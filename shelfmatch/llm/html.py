"""Main text of web pages: parser events, text-to-tag ratio, smoothing and clustering.

The standard library's parser streams events; block elements cut the page into lines. Each line has
a ratio of text to tags, which a Gaussian smooths over the neighbouring lines. What an element's
name, class or role says (navigation, notice, advert, form, comment) and a line's share of links
lower its value and decide nothing alone. Two clusters of the values give the threshold. The content
region is the container, whatever its element, that holds most text of lines above the threshold
and least of lines below it. All its lines are kept, short ones too, but for those below the
threshold that are marked or belong to a menu of links.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIGMA = 1.0  # of the Gaussian, in lines
LINK_SHARE = 0.5  # a line with more of its text in links may belong to a menu
MENU_LINES = 3  # that follow one another make a menu
MARKED = 0.2  # what is left of a line's value for each mark around it
OTHER = 1  # weight of text that is no content, in the choice of the region
WRAPPER = 0.5  # an element with more of the page's text is a wrapper, whatever it is called

# fixed values: elements and attribute words of the HTML vocabulary and of common page templates
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form header "
    "main menu nav ol section table td ul".split()
)
_MAIN = frozenset(("article", "main"))
_NEVER = frozenset(
    "audio button canvas embed head iframe input noscript object option script select style svg "
    "template textarea title video".split()
)
_MARKS = frozenset("aside dialog footer form header menu nav".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline comment "
    "commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr "
    "header login masthead menu menus meta modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags teaser toc toolbar widget widgets".split()
)
_SPACE = re.compile(r"\s+")
_CLOSES_P = _BLOCKS - {"body", "html"}
_ITEMS = frozenset("dd dt li td th tr".split())


@dataclass
class Line:
    text: str
    linked: int  # characters in links
    tags: int
    container: int
    marks: tuple[int, ...]  # marked elements around it

    def in_links(self) -> bool:
        return self.linked > LINK_SHARE * len(self.text)


@dataclass
class Open:
    tag: str
    never: bool  # its text is not shown
    container: int
    marks: tuple[int, ...]


class Lines(HTMLParser):
    """Collects lines, and the containers that they lie in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open = [Open("", False, 0, ())]
        self.around = [0]  # of each container the one around it; 0 is the page
        self.marks = 0
        self.cleared: set[int] = set()  # marks of elements around an article or main element
        self.named: set[int] = set()  # marks that an element's name makes, which is no wrapper then
        self.links = 0
        self._new()

    def _new(self) -> None:
        self.parts: list[str] = []
        self.linked = 0
        self.tags = 0

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            top = self.open[-1]
            self.lines.append(Line(text, self.linked, self.tags, top.container, top.marks))
        self._new()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES_P:
            self._end_line()
            if any(x.tag == "p" for x in self.open[-4:]):
                self._close("p")
            if tag in _ITEMS and self.open[-1].tag == tag:
                self._close(tag)
        elif tag == "body":
            self._close("head")
            self._end_line()
        if tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in _VOID:
            return
        if tag in _MAIN:
            self._begin_main()
        top = self.open[-1]
        container, marks = top.container, top.marks
        if tag in _CONTAINERS:
            container = len(self.around)
            self.around.append(top.container)
        if _is_marked(tag, attrs) and not (tag == "header" and any(x.tag in _MAIN for x in self.open)):
            self.marks += 1
            marks = (*marks, self.marks)
            if tag in _MARKS and tag != "form":
                self.named.add(self.marks)
        self.open.append(Open(tag, top.never or tag in _NEVER or _is_hidden(attrs), container, marks))
        self.links += tag == "a"

    def _begin_main(self) -> None:
        """Elements around it are wrappers, but for a menu that was never closed."""
        while self.open[-1].tag in ("a", "li", "ul") or self.open[-1].tag in _MARKS:
            self.links -= self.open.pop().tag == "a"
        self.cleared.update(self.open[-1].marks)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in _VOID or tag not in _BLOCKS:
            if tag in _BLOCKS:
                self._end_line()
            elif tag == "br":
                self.parts.append(" ")
            self.tags += 1
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._end_line()
        self.tags += 1
        self._close(tag)

    def _close(self, tag: str) -> None:
        """Close the nearest such element, but none outside the container it would have to be in."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i].tag
            if name == tag:
                self.links -= sum(x.tag == "a" for x in self.open[i:])
                del self.open[i:]
                return
            if name in _CONTAINERS and tag not in _CONTAINERS:
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1].never:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def finish(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def _is_hidden(attrs: list) -> bool:
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _is_marked(tag: str, attrs: list) -> bool:
    """Whether an element says that it is no content, by its name, role, or a whole class name or id.

    Names are looked at on containers alone: a heading may be called "notice".
    """
    if tag in _MARKS:
        return True
    if tag not in _CONTAINERS or tag == "body":
        return False
    for name, value in attrs:
        words = (value or "").lower().split()
        if (name in ("class", "id") and not _WORDS.isdisjoint(words)) or (name == "role" and not _ROLES.isdisjoint(words)):
            return True
    return False


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian over the neighbours, its weights summing to 1 at the ends as well."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Border between two clusters of one-dimensional values (Lloyd's iteration from the ends)."""
    low, high = min(values), max(values)
    while True:
        border = (low + high) / 2
        small = [v for v in values if v < border]
        large = [v for v in values if v >= border]
        new = (sum(small) / len(small) if small else low, sum(large) / len(large))
        if new == (low, high):
            return border
        low, high = new


def line_values(lines: list[Line], cleared: set[int], named: set[int]) -> tuple[list[float], list[int]]:
    """The smoothed ratio of each line as marks and links leave it, and its number of marks."""
    total, inside = sum(len(x.text) for x in lines), Counter()
    for x in lines:
        inside.update(dict.fromkeys(x.marks, len(x.text)))
    wrappers = {m for m, n in inside.items() if n > WRAPPER * total and m not in named}
    marks = [len([m for m in x.marks if m not in cleared and m not in wrappers]) for x in lines]
    # a logarithm, so that one very long line doesn't make all others small
    ratio = smoothed([math.log1p(len(x.text) / max(1, x.tags)) for x in lines])
    values = [
        r * (1 - min(1.0, x.linked / len(x.text))) * MARKED**n for x, r, n in zip(lines, ratio, marks)
    ]
    return values, marks


def content_region(lines: list[Line], content: list[bool], around: list[int]) -> set[int]:
    """The containers of the region: the one with most content, less OTHER times what else it holds,
    and all within it; of equals the outermost."""
    gain = [0] * len(around)
    for x, good in zip(lines, content):
        gain[x.container] += len(x.text) if good else -OTHER * len(x.text)
    for container in range(len(around) - 1, 0, -1):  # containers come after those around them
        gain[around[container]] += gain[container]
    best = max(range(len(around)), key=lambda c: (gain[c], -c))
    region = {best}
    for container in range(best + 1, len(around)):
        if around[container] in region:
            region.add(container)
    return region


def menu_lines(lines: list[Line]) -> list[bool]:
    """Lines of links among MENU_LINES or more that follow one another."""
    out, at = [False] * len(lines), 0
    while at < len(lines):
        end = at
        while end < len(lines) and lines[end].in_links():
            end += 1
        if end - at >= MENU_LINES:
            out[at:end] = [True] * (end - at)
        at = end + 1
    return out


def main_text(html: str | None) -> str:
    """Blocks of the content region in page order, joined by an empty line."""
    parser = Lines()
    parser.feed(html or "")
    lines = parser.finish()
    if not lines:
        return ""
    values, marks = line_values(lines, parser.cleared, parser.named)
    if all(n or x.in_links() for n, x in zip(marks, lines)):
        return ""
    border = threshold([v for v in values if v > 0])  # lines that are links alone are no content
    content = [v >= border for v in values]
    region = content_region(lines, content, parser.around)
    menu = menu_lines(lines)
    return "\n\n".join(
        x.text
        for x, good, marked, m in zip(lines, content, marks, menu)
        if x.container in region and (good or not (marked or m))
    )


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of ``pages`` without the html, and a struct ``main`` of text and n_chars.

    Null or empty html, and pages without content, have empty text. Rows are independent, so
    repeated rows give repeated results. A column named ``main`` of the input is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "main")]
    rows = pages.select(F.struct(F.lit(0).alias("_"), *kept).alias("_row"), F.col(html).alias("_html"))
    kinds = [T.StructField("_", T.IntegerType(), False)] + [f for f in pages.schema if f.name in kept]
    schema = T.StructType(
        [T.StructField("_row", T.StructType(kinds)), T.StructField("text", T.StringType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch[1]], pa.string())
            yield pa.record_batch([batch[0], texts], names=["_row", "text"])

    out = rows.mapInArrow(work, schema)
    main = F.struct("text", F.length("text").cast("long").alias("n_chars")).alias("main")
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], main)
