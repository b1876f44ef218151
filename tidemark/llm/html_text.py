"""Main text of HTML pages by a tree-structured graphical model.

The DOM's block elements are the nodes of a tree; each is main text or not. A node's potential comes from what it is
(element, hints in class and id, words, share of linked words, punctuation), an edge's potential from the labels of
parent and child and the kind of edge. One sum-product pass upward and one downward give every node's exact marginal.
Weights are trained on labelled pages by gradient ascent on the conditional likelihood, whose gradient is observed minus
expected features under the same marginals.

Text of scripts, styles, templates and the head is never text of the page. Character references are decoded, runs of
white space inside a block become one space, blocks are trimmed and joined by one newline in page order; ``br`` is white
space. Nothing else is dropped or capped.

Defined cases: null and empty pages, and pages without main text, give the empty text; markup that is cut off, unclosed
or out of order is read as far as it goes; text outside any element is a block of its own; a page of any length and
depth is read whole, by loops and not by recursion; repeated rows are read one by one; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled_pages

# Labelled pages the default model is trained on, and passes over them.
TRAINING_PAGES = 72
PASSES = 40
PULL = 1e-3

# Elements of the HTML standard (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head script style noscript template iframe object svg math title textarea select option".split())
# Elements that may stand in the head; any other start tag ends it.
HEAD_ELEMENTS = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
FOREIGN = frozenset("svg math".split())
# Unseen elements that need an end tag of their own; without one they are read as if they were empty. What follows an
# open script or style is code all the same, and head and options end by what follows them.
NEED_END = UNSEEN - frozenset("head script style option".split())
CLOSES_P = BLOCKS - frozenset("body html tbody td tfoot th thead title tr li dd dt option caption legend summary button".split())
# An opening element ends an open one of these names, looked for no further up than the fences.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "tbody": (("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",)),
}
# Words in class, id and role that hint at what an element is for.
SIDE_HINTS = (
    "ad ads advert advertisement banner sponsor sponsored promo promotion sidebar side aside widget menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead top footer foot bottom copyright legal cookie cookies consent "
    "notice alert popup modal overlay comment comments discussion reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription login signup search form pager pagination tags meta toolbar skip "
    "complementary contentinfo"
).split()
MAIN_HINTS = "article content main post entry story body text prose page blog".split()

GROUPS = {
    "main": ("article", "main"),
    "section": ("section", "div", "figure", "details", "dl"),
    "paragraph": ("p", "blockquote", "pre", "dd", "dt", "figcaption"),
    "heading": ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"),
    "list": ("ul", "ol", "menu", "dir"),
    "item": ("li",),
    "table": ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"),
    "nav": ("nav",),
    "side": ("aside",),
    "header": ("header",),
    "footer": ("footer", "address"),
    "form": ("form", "fieldset", "button", "legend", "dialog"),
    "root": ("html", "body"),
}
GROUP_OF = {name: i for i, names in enumerate(GROUPS.values()) for name in names}
OTHER = len(GROUPS)
# Node features: bias, groups, hints, hidden, linked share, no text of its own, words, punctuation, comment.
FEATURES = 1 + (OTHER + 1) + 2 + 1 + 1 + 1 + 2 + 1
# Edge kinds: the child is a section element, a block of text, or one whose element or hints set it apart.
KINDS = 3

_SPLIT = re.compile(r"[^a-z]+")
_SPACES = re.compile(r"\s+")


@dataclass
class Node:
    name: str
    parent: int
    attributes: dict[str, str]
    words: int = 0
    linked: int = 0
    marks: int = 0
    label: int | None = None
    hints: tuple[int, int] = (0, 0)
    segments: list[int] = field(default_factory=list)


class Page(HTMLParser):
    """Block elements of a page as a tree, and its text segments in page order as (node, pieces)."""

    def __init__(self, unclosed: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        # Start tags, by number, that are known to have no end tag; those found on this pass; the numbers of open ones.
        self.known = unclosed
        self.unclosed: set[int] = set()
        self.number = 0
        self.numbers: list[int] = []
        self.nodes = [Node("html", -1, {})]
        self.segments: list[tuple[int, list[str]]] = []
        # Open elements: (name, node it opened or -1); the nodes among them; unseen and link elements open now.
        self.open: list[tuple[str, int]] = []
        # How many elements of each name are open, so that an end tag without a start costs nothing.
        self.held: Counter[str] = Counter()
        self.at = [0]
        self.unseen = 0
        self.links = 0
        self.fresh = True

    def _push(self, name: str, node: int) -> None:
        self.open.append((name, node))
        self.held[name] += 1
        self.numbers.append(self.number)
        if node >= 0:
            self.at.append(node)
            self.fresh = True
        self.unseen += name in UNSEEN
        self.links += name == "a"

    def _pop(self) -> None:
        name, node = self.open.pop()
        self.held[name] -= 1
        self.numbers.pop()
        if node >= 0:
            self.at.pop()
            self.fresh = True
        self.unseen -= name in UNSEEN
        self.links -= name == "a"

    def _end(self, names, fences) -> None:
        """Close the innermost open element of ``names``, unless a fence stands before it."""
        if not any(self.held[name] for name in names):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                while len(self.open) > i + 1:
                    self._note_unclosed()
                    self._pop()
                self._pop()
                return
            if self.open[i][0] in fences:
                return

    def _note_unclosed(self) -> None:
        if self.open[-1][0] in NEED_END:
            self.unclosed.add(self.numbers[-1])

    def _end_head(self) -> None:
        """End a head that is the innermost open element, or the next one around a noscript."""
        if self.open and self.open[-1][0] == "noscript" and len(self.open) > 1 and self.open[-2][0] == "head":
            self._pop()
        if self.open and self.open[-1][0] == "head":
            self._pop()

    def set_cdata_mode(self, elem, **more) -> None:
        if self.number not in self.known:
            super().set_cdata_mode(elem, **more)

    def close(self) -> None:
        super().close()
        while self.open:
            self._note_unclosed()
            self._pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        self.number += 1
        if tag in ("html", "body"):
            if tag == "body":
                self._end(("head",), ())
            return
        if tag not in HEAD_ELEMENTS:
            self._end_head()
        if self.number in self.known:
            return
        if tag in CLOSES_P:
            self._end(("p",), ("table", "td", "th", "button", "li", "div", "article", "section", "blockquote"))
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag == "a":
            self._end(("a",), BLOCKS)
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self._text(" ")
            if tag == "hr":
                self.fresh = True
            return
        node = -1
        if tag in BLOCKS and not self.unseen:
            node = len(self.nodes)
            self.nodes.append(Node(tag, self.at[-1], {k: v or "" for k, v in attrs}))
        self._push(tag, node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        # Only foreign elements may close themselves.
        if self.open and self.numbers[-1] == self.number and (self.unseen and any(n in FOREIGN for n, _ in self.open)):
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._text(" ")
            return
        # An end tag of a block closes what is still open inside it; one of an inline element stops at blocks.
        self._end((tag,), () if tag in BLOCKS or tag in UNSEEN else BLOCKS)

    def handle_data(self, data: str) -> None:
        self._text(data)

    def _text(self, data: str) -> None:
        if self.unseen and self.open[-1][0] == "head" and not data.isspace():
            self._end_head()
        if self.unseen or not data:
            return
        if self.fresh or self.segments[-1][0] != self.at[-1]:
            if data.isspace():
                return
            self.segments.append((self.at[-1], []))
            self.nodes[self.at[-1]].segments.append(len(self.segments) - 1)
            self.fresh = False
        self.segments[-1][1].append(data)
        node = self.nodes[self.at[-1]]
        words = len(data.split())
        node.words += words
        node.linked += words if self.links else 0
        node.marks += sum(map(data.count, ".,;:!?"))


def read(html: str) -> Page:
    """The page; read again with unseen elements that have no end tag taken for empty, so that they hide nothing."""
    known: frozenset[int] = frozenset()
    while True:
        page = Page(known)
        page.feed(html)
        page.close()
        if page.unclosed <= known:
            return page
        known |= page.unclosed


def describe(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node features (n, FEATURES), parents (n) and edge kinds (n)."""
    n = len(page.nodes)
    parents = np.array([node.parent for node in page.nodes])
    words = np.array([node.words for node in page.nodes], dtype=np.float64)
    linked = np.array([node.linked for node in page.nodes], dtype=np.float64)
    total, total_linked = words.copy(), linked.copy()
    # Children come after their parents, so one backward pass sums subtrees.
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
        total_linked[parents[i]] += total_linked[i]
    x = np.zeros((n, FEATURES))
    kinds = np.zeros(n, dtype=np.int64)
    for i, node in enumerate(page.nodes):
        group = GROUP_OF.get(node.name, OTHER)
        hints = set(_SPLIT.split(" ".join(node.attributes.get(k, "") for k in ("class", "id", "role")).lower()))
        side, main = bool(hints.intersection(SIDE_HINTS)), bool(hints.intersection(MAIN_HINTS))
        hidden = "hidden" in node.attributes or "display:none" in node.attributes.get("style", "").replace(" ", "")
        row = x[i]
        row[0] = 1.0
        row[1 + group] = 1.0
        at = 2 + OTHER
        row[at], row[at + 1], row[at + 2] = side, main and not side, hidden
        row[at + 3] = total_linked[i] / total[i] if total[i] else 0.0
        row[at + 4] = node.words == 0
        row[at + 5] = math.log1p(node.words) / 4
        row[at + 6] = math.log1p(total[i]) / 6
        row[at + 7] = min(1.0, 8 * node.marks / node.words) if node.words else 0.0
        apart = side or hidden or node.name in ("nav", "aside", "header", "footer", "form")
        kinds[i] = 2 if apart else 0 if node.name in ("div", "section", "article", "main", "figure") else 1
    return x, parents, kinds


def marginals(unary: np.ndarray, pair: np.ndarray, parents: np.ndarray, kinds: np.ndarray):
    """Exact sum-product on the tree, in logs: node marginals (n), edge marginals (n, 2, 2), log partition.

    ``unary`` is the log potential of label 1 (that of label 0 is 0), ``pair`` (kinds, 2, 2) is by parent and child.
    """
    n = len(unary)
    own = np.zeros((n, 2))
    own[:, 1] = unary
    up = own.tolist()
    edge = pair.tolist()
    message = [None] * n
    for i in range(n - 1, 0, -1):
        e, (a, b) = edge[kinds[i]], up[i]
        to = tuple(_log_add(e[p][0] + a, e[p][1] + b) for p in (0, 1))
        message[i] = to
        parent = up[parents[i]]
        parent[0] += to[0]
        parent[1] += to[1]
    belief = [None] * n
    belief[0] = up[0]
    log_z = _log_add(*up[0])
    both = np.zeros((n, 2, 2))
    for i in range(1, n):
        e, (a, b), to, above = edge[kinds[i]], up[i], message[i], belief[parents[i]]
        # What the parent believes without this child's own message.
        r0, r1 = above[0] - to[0], above[1] - to[1]
        j00, j01, j10, j11 = r0 + e[0][0] + a, r0 + e[0][1] + b, r1 + e[1][0] + a, r1 + e[1][1] + b
        belief[i] = (_log_add(j00, j10), _log_add(j01, j11))
        both[i] = ((j00, j01), (j10, j11))
    node = np.array([1 / (1 + math.exp(min(700, b[0] - b[1]))) for b in belief])
    both[1:] = np.exp(both[1:] - log_z)
    return node, both, log_z


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


@dataclass
class Model:
    weights: np.ndarray
    pair: np.ndarray

    def main(self, page: Page) -> np.ndarray:
        """Each node's chance of being main text."""
        x, parents, kinds = describe(page)
        return marginals(x @ self.weights, self.pair, parents, kinds)[0]

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = read(html)
        if not page.segments:
            return ""
        main = self.main(page)
        blocks = (_SPACES.sub(" ", "".join(pieces)).strip() for node, pieces in page.segments if main[node] >= 0.5)
        return "\n".join(b for b in blocks if b)


def labels(page: Page) -> np.ndarray:
    """Labels of a marked page: a node is what its nearest marked ancestor or itself says, 0 without a mark."""
    y = np.zeros(len(page.nodes), dtype=np.int64)
    for i, node in enumerate(page.nodes):
        mark = node.attributes.get("data-main")
        y[i] = int(mark == "1") if mark is not None else (y[node.parent] if node.parent >= 0 else 0)
    return y


def train(pages: list[str], passes: int = PASSES) -> Model:
    """Weights of the conditional likelihood's maximum (with a weak pull to zero), by adaptive gradient ascent."""
    read_pages = [read(p) for p in pages]
    data = [(*describe(p), labels(p)) for p in read_pages]
    w, pair = np.zeros(FEATURES), np.zeros((KINDS, 2, 2))
    seen_w, seen_pair = np.full(FEATURES, 1e-6), np.full((KINDS, 2, 2), 1e-6)
    for _ in range(passes):
        for x, parents, kinds, y in data:
            node, both, _ = marginals(x @ w, pair, parents, kinds)
            grad = x.T @ (y - node) - PULL * w
            grad_pair = -PULL * pair
            observed = np.zeros_like(both)
            observed[np.arange(1, len(y)), y[parents[1:]], y[1:]] = 1.0
            np.add.at(grad_pair, kinds[1:], (observed - both)[1:])
            seen_w += grad * grad
            seen_pair += grad_pair * grad_pair
            w += 0.5 * grad / np.sqrt(seen_w)
            pair += 0.5 * grad_pair / np.sqrt(seen_pair)
    return Model(w, pair)


def default_model() -> Model:
    return train(labelled_pages.pages(TRAINING_PAGES))


def extract(
    pages: DataFrame, html_column: str = "html", text_as: str = "text", labelled: list[str] | None = None
) -> DataFrame:
    """``pages`` with the main text under ``text_as``; ``labelled`` are marked pages to train on instead of the default."""
    model = train(labelled) if labelled is not None else default_model()
    at = pages.columns.index(html_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(h.as_py()) for h in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    types = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(pages.schema))
    plain = pages.withColumn(html_column, F.col(html_column).cast("string")).toDF(*[f"c{i}" for i in range(len(pages.columns))])
    return plain.mapInArrow(run, f"{types}, text string").toDF(*pages.columns, text_as)
