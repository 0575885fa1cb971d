"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at its block-level tags. Each block gets costs for being called content or
boilerplate, from the nearest telling ancestor, its tag, its length and the share of it that is links. Boilerplate words
in the names of an article, or of an element inside content, only lower the value of their text: a whole name lowers it
more than part of one, a class more than an id, and ids of headings and sections, mostly slugs, least. The costs are
capacities to the source and the sink of a graph; neighbouring blocks and neighbours under one parent are tied by
smoothness edges, weaker the further apart they are in the tree. The minimum cut, found by maximum flow, is the
cheapest labelling.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RESULT = "text string, content_blocks int, other_blocks int"

# Kinds of elements, and words in class, id and role attributes that tell what an element is for.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = frozenset("script style noscript template title textarea iframe object embed svg canvas math head audio video".split())
RAW_TAGS = frozenset("script style noscript template title textarea iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav aside footer form button select menu dialog fieldset search".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs complementary "
    "consent contentinfo cookie cookies copyright dialog footer gdpr legal login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related "
    "search share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
HEADING_WORDS = frozenset(["header"])
SECTION_TAGS = frozenset("section h1 h2 h3 h4 h5 h6".split())

# What content and boilerplate are worth, and what a boilerplate or comment word takes from content: as a whole name or a
# part of one, in class and role or in id.
CONTENT, OTHER, NAMED = 4.0, -9.0, 3.0
ARTICLE_COSTS = {("class", True): 6.0, ("class", False): 2.0, ("id", True): 3.0, ("id", False): 1.0}
INNER_COSTS = {("class", True): 13.0, ("class", False): 7.0, ("id", True): 6.0, ("id", False): 2.0}
SECTION_COSTS = INNER_COSTS | {("id", True): 2.0, ("id", False): 1.0}
COMMENT_COSTS = {("class", True): 13.0, ("class", False): 6.0, ("id", True): 8.0, ("id", False): 4.0}
INNER_COMMENT_COSTS = {("class", True): 13.0, ("class", False): 10.0, ("id", True): 9.0, ("id", False): 4.0}
HEADING_COMMENT_COSTS = INNER_COMMENT_COSTS | {("id", True): 3.0, ("id", False): 1.0}

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][a-zA-Z0-9:_-]*)|[!?/])")
_REST = re.compile(r"""(?:[^<>"']|"[^"<>]*"|'[^'<>]*'|["'])*>?""")
_HINTS = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SCALE = 100
NEAR, SIBLING = 60, 60


@dataclass(slots=True)
class Element:
    tag: str
    parent: Element | None
    depth: int
    kind: int  # 1 content, -1 boilerplate, -2 readers' comments, 0 untold
    value: float
    skipped: bool
    holder: Element = field(init=False, repr=False)  # the nearest block-level element, itself included

    def __post_init__(self) -> None:
        self.holder = self if self.parent is None or self.tag in BLOCK_TAGS else self.parent.holder


@dataclass(slots=True)
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0


#: A name of an element: "class" (or role) or "id", and its words.
Name = tuple[str, tuple[str, ...]]


def _cost(names: list[Name], words: frozenset[str], costs: dict[tuple[str, bool], float]) -> float:
    return max((costs[place, len(parts) == 1] for place, parts in names if not words.isdisjoint(parts)), default=0.0)


def _weighed(tag: str, names: list[Name], base: float, inside: bool) -> tuple[int, float]:
    """Kind and value of an article, or of an element that is in content or names itself so."""
    if tag in CONTENT_TAGS or not inside:
        other, comment = ARTICLE_COSTS, COMMENT_COSTS
    else:
        other = SECTION_COSTS if tag in SECTION_TAGS else INNER_COSTS
        comment = HEADING_COMMENT_COSTS if tag in SECTION_TAGS and tag != "section" else INNER_COMMENT_COSTS
    others, comments = _cost(names, OTHER_WORDS, other), _cost(names, COMMENT_WORDS, comment)
    value = base - max(others, comments)
    if any(len(parts) == 1 and parts[0] in CONTENT_WORDS for _, parts in names):
        value = min(base, value + NAMED)
    return 1 if value >= 0 else -2 if comments >= others else -1, value


def _kind(tag: str, names: list[Name], parent: Element | None) -> tuple[int, float]:
    inside = parent is not None and parent.kind == 1
    words = {w for _, parts in names for w in parts}
    told = words & (COMMENT_WORDS | OTHER_WORDS)
    if tag in OTHER_TAGS:
        return -2 if words & COMMENT_WORDS else -1, OTHER
    if tag in CONTENT_TAGS:
        return _weighed(tag, names, CONTENT, inside)
    if inside:
        return _weighed(tag, names, parent.value, True) if told else (1, parent.value)
    heading = tag == "header" or words & HEADING_WORDS
    if told or heading:
        # Its own name says content, and only parts of other classes say otherwise.
        rest = COMMENT_WORDS | OTHER_WORDS | HEADING_WORDS
        named = any(not CONTENT_WORDS.isdisjoint(parts) and rest.isdisjoint(parts) for _, parts in names)
        parts_only = all(place == "class" and len(parts) > 1 for place, parts in names if not rest.isdisjoint(parts))
        if named and parts_only and tag != "header":
            return _weighed(tag, names, CONTENT, False)
        return -2 if words & COMMENT_WORDS else -1, OTHER
    if words & CONTENT_WORDS:
        return 1, CONTENT
    return (parent.kind, parent.value) if parent is not None else (0, 0.0)


def _open(tag: str, attributes: str, parent: Element | None) -> Element:
    names: list[Name] = []
    skipped = tag in SKIPPED_TAGS or (parent is not None and parent.skipped)
    if attributes:
        for name, *values in _HINTS.findall(attributes):
            value = "".join(values)
            name = name.lower()
            if name in ("class", "id", "role"):
                place = "id" if name == "id" else "class"
                names += [(place, parts) for x in value.lower().split() if (parts := tuple(_WORD.findall(x)))]
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _GONE.search(value)):
                skipped = True
    if tag in ("html", "body"):
        names = []
    kind, value = _kind(tag, names, parent)
    if parent is not None and parent.kind < 0:
        if kind > parent.kind:
            # Only an article in a wrapper with a misleading name stands by itself.
            wrapped = tag in CONTENT_TAGS and parent.kind == -1 and parent.tag not in OTHER_TAGS and not _in_content(parent)
            if not (wrapped and kind == 1):
                kind, value = parent.kind, parent.value
        elif kind == parent.kind:
            value = min(value, parent.value)
    return Element(tag, parent, parent.depth + 1 if parent else 0, kind, value, skipped)


def _in_content(element: Element | None) -> bool:
    while element is not None and element.kind != 1:
        element = element.parent
    return element is not None


def blocks(html: str) -> list[Block]:
    """Blocks with text, in page order; markup that is cut off at the end of the page is dropped."""
    out: list[Block] = []
    current = Element("", None, 0, 0, 0.0, False)
    block: Block | None = None
    links = 0
    at = 0
    while True:
        found = _TAG.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text and not current.skipped:
            if block is None or block.element is not current.holder:
                if text.strip():
                    block = Block(current.holder)
                    out.append(block)
            if block is not None and block.element is current.holder:
                block.parts.append(text)
                if links:
                    block.linked += len(text)
        if found is None:
            return out
        if found[0] == "<!--":
            end = html.find("-->", found.end())
            at = len(html) if end < 0 else end + 3
            continue
        rest = _REST.match(html, found.end())
        at = rest.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag in BLOCK_TAGS:
            block = None
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if found[1]:
            element = current
            while element.parent is not None and element.tag != tag:
                element = element.parent
            if element.parent is not None and not _kept_open(current, element, tag):
                links -= sum(1 for x in _until(current, element) if x.tag == "a")
                current = element.parent
            continue
        while current.parent is not None and _ends(current.tag, tag):
            links -= current.tag == "a"
            current = current.parent
        closed = html[at - 2 : at - 1] == "/" and tag not in BLOCK_TAGS
        if tag in VOID_TAGS or closed:
            continue
        if tag == "p" or tag in BLOCK_TAGS:
            current = _leave_paragraph(current)
        current = _open(tag, html[rest.start() : at], current)
        links += tag == "a"
        if tag in RAW_TAGS:
            end = re.compile(f"</{tag}(?![a-z0-9])", re.I).search(html, at)
            at = end.start() if end else len(html)


def _until(element: Element, last: Element) -> Iterator[Element]:
    while True:
        yield element
        if element is last:
            return
        element = element.parent


def _kept_open(current: Element, target: Element, tag: str) -> bool:
    """A closing inline tag doesn't close block-level elements around it."""
    return tag not in BLOCK_TAGS and any(x.tag in BLOCK_TAGS for x in _until(current, target) if x is not target)


def _ends(open_tag: str, tag: str) -> bool:
    """Whether an element ends where ``tag`` opens, its closing tag left out."""
    if open_tag == "li":
        return tag == "li"
    if open_tag in ("dt", "dd"):
        return tag in ("dt", "dd")
    if open_tag in ("td", "th"):
        return tag in ("td", "th", "tr", "tbody", "tfoot")
    if open_tag == "tr":
        return tag in ("tr", "tbody", "tfoot")
    if open_tag == "option":
        return tag in ("option", "optgroup")
    return open_tag == "head" and tag in BLOCK_TAGS


def _leave_paragraph(element: Element) -> Element:
    """A block-level tag ends an open paragraph, and what is inline inside it."""
    inner = element
    while inner.parent is not None and (inner.tag not in BLOCK_TAGS or inner.tag == "p"):
        if inner.tag == "p":
            return inner.parent
        inner = inner.parent
    return element


def score(block: Block, text: str) -> int:
    """How much cheaper it is to call the block content, in hundredths; negative if boilerplate is cheaper."""
    linked = min(1.0, block.linked / max(1, sum(map(len, block.parts))))
    value = block.element.value + min(len(text), 240) / 80 - 4.0 * linked - 0.4
    tag = block.element.tag
    if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"):
        value += 1.0
    return round(SCALE * value)


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (block, block, capacity) between neighbours on the page and between neighbours under one parent."""
    edges = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            capacity = NEAR // (1 + _distance(found[i - 1].element, block.element))
            if capacity:
                edges.append((i - 1, i, capacity))
        parent = id(block.element.parent)
        if parent in last_of:
            edges.append((last_of[parent], i, SIBLING))
        last_of[parent] = i
    return edges


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source: positive scores are capacities from it, negative ones to the sink."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    arcs: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, forth: int, back: int) -> None:
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, value in enumerate(scores):
        if value > 0:
            arc(source, i, value, 0)
        elif value < 0:
            arc(i, sink, -value, 0)
    for a, b, capacity in edges:
        arc(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in arcs[x]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(i for i, e in enumerate(path) if not room[e])
                x = to[path[k] ^ 1]
                del path[k:]
                continue
            while following[x] < len(arcs[x]):
                e = arcs[x][following[x]]
                if room[e] and level[to[e]] == level[x] + 1:
                    break
                following[x] += 1
            else:
                if x == source:
                    break
                x = to[path.pop() ^ 1]
                following[x] += 1
                continue
            path.append(e)
            x = to[e]


def main_text(html: str | None) -> tuple[str, int, int]:
    """The text of the content blocks, one line each, and the number of blocks of either kind."""
    found, texts = [], []
    for block in blocks(html or ""):
        text = " ".join(unescape("".join(block.parts)).split())
        if text:
            found.append(block)
            texts.append(text)
    keep = minimum_cut([score(b, t) for b, t in zip(found, texts, strict=True)], smoothness(found))
    kept = [t for t, k in zip(texts, keep, strict=True) if k]
    return "\n".join(kept), len(kept), len(texts) - len(kept)


def extract(html: Column) -> Column:
    """A struct column: text, content_blocks, other_blocks. Null and empty pages have empty text and no blocks."""

    @F.pandas_udf(RESULT)
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([main_text(x) for x in batch.tolist()], columns=["text", "content_blocks", "other_blocks"])

    return extracted(html)
