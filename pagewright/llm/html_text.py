r"""Main text of web pages by text-to-tag ratios.

Method: the standard library's streaming parser gives events, of which block borders make *lines*.
A line's ratio is its characters outside links over its tags. Ratios are smoothed by a Gaussian over
neighbouring lines, multiplied by the weights of the elements that the line stands in, and clustered
by a threshold, their standard deviation and half their mean at least, into content and other lines. Elements whose kind
(``KINDS``) or a word of whose class, id or role (``WORDS``) speaks of furniture weigh less than 1;
such a ``WRAPPING`` mark that may stand on a layout's wrapper counts only where the element holds less
than ``SHARE`` of the page's text outside links and other marks.

Content lines select the regions. The first is the deepest element that holds ``SHARE`` of their
characters, or the ``article`` (else ``main``) around it; every other element beside it that is not
marked as furniture and is content for half of its characters is one more. Of a region all lines are
returned, so that short paragraphs stay, but those in a marked element inside it that is not content
itself for half of its characters. So a mark only weighs: where the text stands in a marked element,
that element is the region, or content, and stays. If the region is the page's body itself, it goes
from the first content line (and the heading right before it) to the last, without lines of links.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined in page order by one space.

Defined results: null or empty html gives an empty text of 0 characters; html without any content
line gives all its lines outside marked elements; the text of ``NO_TEXT`` elements is no line at all;
unclosed and unmatched tags are taken as browsers take them in the main (a paragraph ends at the next
block, an end tag closes what is open inside, one without a start is passed over); rows with equal or
null ids each give a row; other columns are passed over. No length is limited.

Scale: no shuffle; one page is held at a time, in time linear in its events.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that begin and end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol option p pre script section select style "
    "summary table tbody td template textarea tfoot th thead title tr ul video button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
NO_TEXT = frozenset("audio button canvas head iframe noscript object script select style svg template textarea title video".split())
#: Weights of elements by their kind; a header counts outside articles only.
KINDS = {"aside": 0.05, "dialog": 0.05, "footer": 0.05, "form": 0.1, "header": 0.1, "menu": 0.05, "nav": 0.05}
#: Weights of words of class, id and role: what readers add, what is sold or asked, what frames the page, what may be either.
WORDS = (
    dict.fromkeys("comment comments disqus replies".split(), 0.02)
    | dict.fromkeys("ad ads advert advertisement adverts consent cookie cookies gdpr newsletter notice popup promo sponsor sponsored subscribe".split(), 0.1)
    | dict.fromkeys("breadcrumb breadcrumbs complementary contentinfo footer menu modal nav navbar navigation sidebar toolbar".split(), 0.1)
    | dict.fromkeys("banner masthead related search share sharing skip social widget".split(), 0.4)
)
#: Marks that may stand on what wraps the whole page or article.
WRAPPING = frozenset("form breadcrumb breadcrumbs menu modal nav navbar navigation sidebar toolbar banner masthead related search share sharing skip social widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: End tags of these do not close what is open outside the nearest of ``SCOPES``.
INNER = frozenset("a b em i li p span strong td tr".split())
SCOPES = frozenset("article body main table".split())
#: A paragraph outside of these is not ended by a block inside.
P_SCOPES = frozenset("button caption html object table td template th".split())
SAME_ENDS = frozenset("dd dt li option td th tr".split())
PAGE = frozenset(("", "html", "body"))
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z0-9]+")
SIGMA = 1.0
RADIUS = 3
#: Part of the content's characters that its region holds.
SHARE = 0.9


class Line:
    __slots__ = ("parts", "tags", "linked", "node", "border", "text")

    def __init__(self, node: int, border: bool):
        self.parts: list[str] = []
        self.tags, self.linked, self.node, self.border = 0, 0, node, border
        self.text = ""


class Lines(HTMLParser):
    """Turns events into lines, and elements into nodes ``parent, tag, weight``; node 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.wrapping: list[int] = []  # marked elements that may be wrappers
        self.parent, self.tag, self.own, self.weight, self.leaf = [0], [""], [1.0], [1.0], [True]
        # of each open element: node, tag, place of the nearest open paragraph and scope, depth of articles and of links
        self.open: list[tuple[int, str, int, int, int, int]] = [(0, "", -1, 0, 0, 0)]
        self.places: dict[str, list[int]] = {}
        self.lines = [Line(0, True)]
        self.border = True

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            if self.open[-1][2] >= 0:
                self.close_from(self.open[-1][2])
            if tag in SAME_ENDS and self.open[-1][1] == tag:
                self.close_from(len(self.open) - 1)
        node, _, paragraph, scope, articles, links = self.open[-1]
        marks = {tag: KINDS[tag]} if tag in KINDS and not (tag == "header" and articles) else {}
        if tag not in ("html", "body"):
            for name, value in attrs:
                if value and name in ("class", "id", "role"):
                    marks |= {word: WORDS[word] for word in WORD.findall(value.lower()) if word in WORDS}
        own = 0.0 if tag in NO_TEXT else min(marks.values(), default=1.0)
        if tag not in VOID:
            at = len(self.open)
            self.parent.append(node)
            self.tag.append(tag)
            self.own.append(own)
            self.weight.append(self.weight[node] * own)
            if own and marks and WRAPPING.issuperset(marks):
                self.wrapping.append(len(self.own) - 1)
            self.leaf.append(True)
            if tag in BLOCKS:
                self.leaf[node] = False
            paragraph = at if tag == "p" else -1 if tag in P_SCOPES else paragraph
            scope = at if tag in SCOPES else scope
            self.open.append((len(self.parent) - 1, tag, paragraph, scope, articles + (tag in ("article", "main")), links + (tag == "a")))
            self.places.setdefault(tag, []).append(at)
        if tag in BLOCKS or tag == "br":
            self.border = True
        self.line().tags += 1

    def handle_endtag(self, tag: str) -> None:
        places = self.places.get(tag)
        if places and not (tag in INNER and places[-1] < self.open[-1][3]):
            self.close_from(places[-1])
        if tag in BLOCKS:
            self.border = True
        self.line().tags += 1

    def close_from(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop()[1]].pop()

    def line(self) -> Line:
        """The line that goes on here; a new one after a border, and where an inline element's weight differs."""
        line, node = self.lines[-1], self.open[-1][0]
        if not line.parts:
            line.node, line.border = node, line.border or self.border
        elif self.border or self.weight[line.node] != self.weight[node]:
            line = Line(node, self.border)
            self.lines.append(line)
        self.border = False
        return line

    def handle_data(self, data: str) -> None:
        node = self.open[-1][0]
        if not self.weight[node]:
            return
        if data.isspace():  # parts words, but is no text that could begin a line
            if self.lines[-1].parts and not self.border:
                self.lines[-1].parts.append(data)
            return
        line = self.line()
        if not line.parts:
            line.node = self.block(node)
        line.parts.append(data)
        if self.open[-1][5]:
            line.linked += len(data)

    def block(self, node: int) -> int:
        """The block that an inline element stands in, as long as their weights agree."""
        while self.tag[node] not in BLOCKS and node and self.weight[self.parent[node]] == self.weight[node]:
            node = self.parent[node]
        return node


def smoothed(values: list[float]) -> list[float]:
    kernel = [math.exp(-k * k / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - RADIUS), min(len(values), i + RADIUS + 1)
        weights = kernel[low - i + RADIUS : high - i + RADIUS]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def clustered(lines: list[Line], weight: list[float]) -> list[bool]:
    """Which lines are content."""
    ratios = [max(0, len(line.text) - line.linked) / max(1, line.tags) for line in lines]
    values = [value * weight[line.node] for line, value in zip(lines, smoothed(ratios), strict=True)]
    mean = sum(values) / len(values)
    threshold = max(math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)), mean / 2)
    return [value >= threshold and ratio > 0 for value, ratio in zip(values, ratios, strict=True)]


def _summed(parent: list[int], lines: list[Line], chosen: list[bool]) -> list[int]:
    """Characters of the chosen lines inside each node."""
    held = [0] * len(parent)
    for line, wanted in zip(lines, chosen, strict=True):
        if wanted:
            held[line.node] += len(line.text)
    for node in range(len(parent) - 1, 0, -1):
        held[parent[node]] += held[node]
    return held


def unwrapped(page: Lines, lines: list[Line]) -> None:
    """Take the marks off elements that wrap the page's text."""
    if page.wrapping:
        wraps, marked = set(page.wrapping), [False] * len(page.parent)
        for node in range(1, len(marked)):
            marked[node] = marked[page.parent[node]] or page.own[node] < 1 and node not in wraps
        held = _summed(page.parent, lines, [not marked[line.node] and 2 * line.linked <= len(line.text) for line in lines])
        for node in page.wrapping:
            if held[node] >= SHARE * held[0]:
                page.own[node] = 1.0
        for node in range(1, len(page.parent)):
            page.weight[node] = page.weight[page.parent[node]] * page.own[node]


def _region(page: Lines, held: list[int]) -> int:
    """The element that holds the article."""
    parent, tag = page.parent, page.tag
    region = max(n for n in range(len(parent)) if held[n] >= SHARE * held[0])
    while region and (page.leaf[region] or tag[region] not in BLOCKS):
        region = parent[region]
    around, node = {}, region
    while node:
        if tag[node] in ("article", "main") and page.own[node] == 1.0:
            around[tag[node]] = node
        node = parent[node]
    return around.get("article", around.get("main", region))


def _selected(page: Lines, lines: list[Line], content: list[bool]) -> list[bool]:
    parent, tag, own = page.parent, page.tag, page.own
    n = len(parent)
    held, total = _summed(parent, lines, content), _summed(parent, lines, [True] * len(lines))
    region = _region(page, held)
    above, node = {0}, region
    while node:
        above.add(node)
        node = parent[node]
    # of each node: the region it stands in (-1: none), and whether it is left out there
    inside, out, marked, top = [-1] * n, [False] * n, [False] * n, [0] * n
    for node in range(n):
        up = parent[node]
        mark = own[node] < 1 and 2 * held[node] < total[node]
        if node in above:
            inside[node] = region if node == region else -1
            continue
        if inside[up] >= 0:
            inside[node], out[node] = inside[up], out[up] or mark
            continue
        top[node] = node if up in above else top[up]
        marked[node] = marked[up] or own[node] < 1
        if top[node] == node and not marked[node] and held[node] and 2 * held[node] >= total[node]:
            inside[node] = node
    keep = [inside[line.node] >= 0 and not out[line.node] for line in lines]
    if tag[region] in PAGE:
        where = [i for i, chosen in enumerate(content) if chosen and not out[lines[i].node]]
        first, last = (where[0], where[-1]) if where else (0, len(lines) - 1)
        while first and not lines[first].border:  # whole blocks
            first -= 1
        while last + 1 < len(lines) and not lines[last + 1].border:
            last += 1
        before = first - 1
        while before >= 0 and keep[before] and tag[lines[before].node] in HEADINGS:
            before -= 1
        keep = [k and before < i <= last and (content[i] or 2 * line.linked <= len(line.text)) for i, (k, line) in enumerate(zip(keep, lines, strict=True))]
    return keep


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    lines = []
    for line in page.lines:
        line.text = SPACE.sub(" ", "".join(line.parts)).strip()
        if line.text:
            lines.append(line)
    if not lines:
        return ""
    unwrapped(page, lines)
    content = clustered(lines, page.weight)
    keep = _selected(page, lines, content) if any(content) else [page.weight[line.node] == 1 for line in lines]
    parts: list[str] = []
    for line, kept in zip(lines, keep, strict=True):
        if line.border:
            parts.append(" ")
        if kept:
            parts.extend(line.parts)
    return SPACE.sub(" ", "".join(parts)).strip()


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
