"""Main text of web pages by minimum cut.

A page is cut into blocks of text. A linear classifier looks at each by itself: its words
and sentences, how much of it is links, the elements it stands in and what their classes
say. Its score becomes a capacity to the source (article) or to the sink (boilerplate).
Neighbours tend to belong together: edges join blocks that follow each other, the more so
the closer they are in the element tree, and blocks of one element that something else has
come between. The minimum cut is the labelling of least total cost; max-flow finds it, and
what the source still reaches is the article.

The weights of the classifier are fitted to labelled blocks (``fit_weights``) and kept here as
numbers. A listed word in a class or id is a feature among others, and none that decides: it
counts by its share of the words of its name, the less the more of the page's words its element
holds, and long prose outbids it. Words on inline elements are a feature of their block, and
take nothing out of it.

Defined results: no html has no text; what no element encloses is judged like any block;
tags left open are closed by what follows. Scripts, styles and the head never are text;
formulas, drawings and what stands in for scripts and objects are text within an article.
Repeated rows get a result each. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import rows_in_arrow

# Elements that make blocks, that hold no text, and that have no end.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "tr ul".split()
)
SILENT = frozenset(
    "script style template title iframe textarea annotation annotation-xml".split()
)
SILENT_OUTSIDE = frozenset("noscript object svg math".split())  # of an article
UNSHOWN = SILENT | SILENT_OUTSIDE | {"head"}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Which open elements a new one ends.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPES = frozenset("ul ol menu dl table select body html article section div".split())

# What the classifier knows of elements and of words in their classes and ids.
ARTICLE = frozenset("article main".split())
ASIDE = frozenset("nav footer aside form menu dialog search select fieldset button".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs captcha comment "
    "comments consent cookie cookies copyright discussion disqus footer form gdpr header hidden "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination popup promo promoted promotion recommended related replies reply "
    "rail search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toolbar topbar widget widgets".split()
)
# Words that say nothing of what an element is for.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn center col column container content element group head "
    "inner item items layout left link links list main nr outer page panel right row section "
    "site text top unit view wrap wrapper".split()
)
GOOD_WORDS = frozenset("article body content entry main post story text".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SENTENCE = re.compile(r"[.!?](?:\s|$)")

# Weights of the classifier by feature, as ``fit_weights`` finds them on the labelled pages of
# the tests, and capacities of the edges.
WEIGHTS = {
    "any": 0.57,
    "words": 1.31,
    "sentences": -0.12,
    "links": -2.29,
    "noted inline": 0.21,
    "paragraph": -1.12,
    "heading": 1.18,
    "in article": 1.96,
    "good name": 1.91,
    "aside": -6.18,
    "header": -5.04,
    "hidden": -6.16,
    "listed name": -8.14,
    "listed name and heading": -0.98,
    "second listed name": -1.8,
    "listed name on text": 1.1,
    "listed name in article": -1.01,
    "copyright": -1.67,
}
MOST_SENTENCES = 4
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = HEADINGS | {"p"}  # a name on one of them is about itself alone
SAME_PARENT, SAME_GRANDPARENT, APART = 1.5, 0.5, 0.1
SCALE = 1000  # capacities are whole numbers

_TEXTS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
)


# -- Blocks -----------------------------------------------------------------------------


class Element:
    """An open element, and what it and those around it say of the text in them."""

    __slots__ = ("around", "aside", "good", "hidden", "in_article", "listed", "mark", "n_words",
                 "parent", "silent", "tag", "top")

    def __init__(self, tag: str, parent: Element | None, attributes: dict[str, str | None]) -> None:
        self.tag, self.parent = tag, parent
        within = bool(parent and parent.in_article)
        self.in_article = within or tag in ARTICLE
        names = _names(attributes)
        neutral = tag in ("", "body", "html")
        # The strongest name of this element, and the elements with listed names around it.
        self.listed = 0.0 if neutral else max(map(listed_share, names), default=0.0)
        self.good = bool(parent and parent.good) or (
            not neutral and any(set(_WORDS.findall(name)) & GOOD_WORDS for name in names)
        )
        self.around = (parent.around if parent else ()) + ((self,) if self.listed else ())
        self.aside = bool(parent and parent.aside) or tag in ASIDE
        self.top = bool(parent and parent.top) or (tag == "header" and not within)
        self.hidden = bool(parent and parent.hidden) or is_hidden(attributes)
        # What kind of place it is in: edges are weak between places.
        apart = self.listed and tag not in TEXT_TAGS
        apart = apart or tag in ASIDE or (tag == "header" and not within)
        self.mark = self if apart else (parent.mark if parent else None)
        known = self.in_article or self.good or bool(self.around)
        self.silent = bool(parent and parent.silent) or tag in SILENT or tag == "head"
        self.silent |= tag in SILENT_OUTSIDE and not known
        self.n_words = 0


def _names(attributes: dict[str, str | None]) -> list[str]:
    """The names in class, id and role, in lower case, with humps as hyphens."""
    joined = " ".join(attributes.get(k) or "" for k in ("class", "id", "role"))
    return _CAMEL.sub("-", joined).lower().split()


def listed_share(name: str) -> float:
    """The listed words among those of a name that say what it is for."""
    words = [w for w in _WORDS.findall(name) if w not in PLAIN_WORDS and len(w) > 1]
    return sum(w in BAD_WORDS for w in words) / len(words) if words else 0.0


def is_hidden(attributes: dict[str, str | None]) -> bool:
    style = (attributes.get("style") or "").replace(" ", "").lower()
    return (
        "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
    )


class Block:
    __slots__ = ("element", "linked", "noted", "text")

    def __init__(self, element: Element, text: str, linked: int, noted: int) -> None:
        self.element, self.text = element, text
        self.linked, self.noted = linked, noted  # characters in links, and below listed names


class BlockParser(HTMLParser):
    """Collects the blocks of a page in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[Element] = [Element("", None, {})]
        # Open inline elements of this block: tag, whether hidden, whether of a listed name.
        self.inline: list[tuple[str, bool, bool]] = []
        self.parts: list[str] = []
        self.linked = self.noted = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.open[-1], text, self.linked, self.noted))
        self.parts, self.linked, self.noted, self.inline = [], 0, 0, []

    def _close(self, tags: set[str], within: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of these, unless a scope stands between."""
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag in tags:
                del self.open[place:]
                return
            if self.open[place].tag in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag in VOID:
            if tag in ("br", "hr", "img"):
                self.parts.append(" ")
            return
        if tag in BLOCKS or tag in UNSHOWN:
            if tag in BLOCKS:
                self._flush()
                self._close({"p", "head"}, _SCOPES - {"head"})
                if tag in ENDED_BY:
                    self._close(ENDED_BY[tag], _SCOPES - ENDED_BY[tag])
                if re.fullmatch("h[1-6]", tag):
                    self._close({"h1", "h2", "h3", "h4", "h5", "h6"}, _SCOPES)
            self.open.append(Element(tag, self.open[-1], dict(attrs)))
        else:
            named = dict(attrs)
            listed = max(map(listed_share, _names(named)), default=0.0) == 1
            self.inline.append((tag, is_hidden(named), listed))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # The slash says nothing in HTML, but on drawings and formulas.
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in UNSHOWN:
            if any(e.tag == tag for e in self.open):
                if tag in BLOCKS:
                    self._flush()
                self._close({tag})
            return
        for place in range(len(self.inline) - 1, -1, -1):
            if self.inline[place][0] == tag:
                del self.inline[place]
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].silent:
            return
        if any(hidden for _, hidden, _ in self.inline):
            return
        self.parts.append(data)
        size = len(data.strip())
        if any(tag == "a" for tag, *_ in self.inline):
            self.linked += size
        if any(listed for *_, listed in self.inline):
            self.noted += size

    def finish(self) -> list[Block]:
        self.close()
        self._flush()
        return self.blocks


def page_blocks(html: str | None) -> list[Block]:
    parser = BlockParser()
    parser.feed(html or "")
    return parser.finish()


# -- Scores and edges -------------------------------------------------------------------


def features(blocks: list[Block]) -> list[list[float]]:
    """What the classifier knows of each block, in the order of ``FEATURES``."""
    sizes = [block.text.count(" ") + 1 for block in blocks]
    total = max(1, sum(sizes))
    for block, size in zip(blocks, sizes, strict=True):
        for element in block.element.around:
            element.n_words += size
    return [
        _block_features(block, size, total) for block, size in zip(blocks, sizes, strict=True)
    ]


def _block_features(block: Block, words: int, total: int) -> list[float]:
    element = block.element
    # A name counts the less, the more of the page its element holds.
    around = (e for e in element.around if e is not element or e.tag not in TEXT_TAGS)
    names = sorted((e.listed * (1 - e.n_words / total) for e in around), reverse=True)
    first, second = [*names, 0.0, 0.0][:2]
    heading = element.tag in HEADINGS
    size = len(block.text)
    return [
        1.0,
        math.log1p(words),
        float(min(MOST_SENTENCES, len(_SENTENCE.findall(block.text)))),
        min(1.0, block.linked / size),
        min(1.0, block.noted / size),
        float(element.tag == "p"),
        float(heading),
        float(element.in_article),
        float(element.good),
        float(element.aside),
        float(element.top),
        float(element.hidden),
        first,
        first * heading,
        second,
        element.listed * (element.tag in TEXT_TAGS),
        first * element.in_article,
        float("©" in block.text),
    ]


FEATURES = (
    "any", "words", "sentences", "links", "noted inline", "paragraph", "heading", "in article",
    "good name", "aside", "header", "hidden", "listed name", "listed name and heading",
    "second listed name", "listed name on text", "listed name in article", "copyright",
)


def block_score(found: list[float]) -> float:
    """Above zero for an article's text, by the features of the block alone."""
    return sum(WEIGHTS[name] * value for name, value in zip(FEATURES, found, strict=True))


def fit_weights(
    found: list[list[float]], of_article: list[bool], decay: float = 2.0
) -> dict[str, float]:
    """Weights by logistic regression, by Newton's steps; ``decay`` keeps them small."""
    x, y = np.array(found), np.array(of_article, dtype=float)
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + decay * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    return {name: round(float(w), 2) for name, w in zip(FEATURES, weights, strict=True)}


def closeness(a: Element, b: Element) -> float:
    """Of two blocks in a row: more, the nearer their elements are, and little where they stand
    in different places of the page."""
    if a.mark is not b.mark:
        return APART
    if a is b or a.parent is b.parent or a is b.parent or b is a.parent:
        return SAME_PARENT
    above_a, above_b = a.parent and a.parent.parent, b.parent and b.parent.parent
    if above_a and (above_a is above_b or a.parent is above_b or b.parent is above_a):
        return SAME_GRANDPARENT
    return APART


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    found = [
        (i, i + 1, closeness(a.element, b.element)) for i, (a, b) in enumerate(pairwise(blocks))
    ]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        parent = id(block.element.parent)
        if parent in last and last[parent] < i - 1:
            found.append((last[parent], i, SAME_PARENT))
        last[parent] = i
    return found


# -- Minimum cut ------------------------------------------------------------------------


class Network:
    """Capacities between nodes, and the largest flow through them, by blocking flows."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.left: list[int] = []

    def join(self, a: int, b: int, there: int, back: int = 0) -> None:
        for start, end, capacity in ((a, b, there), (b, a, back)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.left.append(capacity)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for edge in self.out[node]:
                if self.left[edge] and level[self.to[edge]] < 0:
                    level[self.to[edge]] = level[node] + 1
                    queue.append(self.to[edge])
        return level

    def saturate(self, source: int, sink: int) -> int:
        """Push the largest flow; returns its size."""
        total = 0
        while (level := self.levels(source))[sink] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    push = min(self.left[edge] for edge in path)
                    total += push
                    for edge in path:
                        self.left[edge] -= push
                        self.left[edge ^ 1] += push
                    # Back to before the first edge that is used up.
                    full = next(i for i, edge in enumerate(path) if not self.left[edge])
                    node = self.to[path[full] ^ 1]
                    del path[full:]
                    continue
                while tried[node] < len(self.out[node]):
                    edge = self.out[node][tried[node]]
                    if self.left[edge] and level[self.to[edge]] == level[node] + 1:
                        break
                    tried[node] += 1
                if tried[node] < len(self.out[node]):
                    path.append(edge)
                    node = self.to[edge]
                elif path:
                    node = self.to[path.pop() ^ 1]
                    tried[node] += 1
                else:
                    break
        return total


def labels(scores: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the side of the source in the minimum cut."""
    source, sink = len(scores), len(scores) + 1
    network = Network(len(scores) + 2)
    for node, score in enumerate(scores):
        capacity = round(abs(score) * SCALE)
        if score > 0:
            network.join(source, node, capacity)
        else:
            network.join(node, sink, capacity)
    for a, b, weight in joined:
        network.join(a, b, round(weight * SCALE), round(weight * SCALE))
    network.saturate(source, sink)
    return [level >= 0 for level in network.levels(source)[: len(scores)]]


def main_text(html: str | None) -> str:
    """The text of the article: its blocks in order, joined by spaces."""
    blocks = page_blocks(html)
    kept = labels([block_score(f) for f in features(blocks)], edges(blocks))
    return " ".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def texts(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            text = main_text(row["html"])
            yield row["page_id"], row["url"], text, len(text)

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return read.mapInArrow(
        rows_in_arrow(texts, _TEXTS, 500), "page_id long, url string, text string, n_chars long"
    )
