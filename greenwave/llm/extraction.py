"""Main text of HTML pages by minimum-cut labelling of their blocks.

A page's text blocks are nodes. A linear classifier's log-odds of being content become
capacities to the source or the sink; blocks that follow each other, and blocks of one
parent element, are tied by smoothness edges that weigh more the closer they are in the
document tree. Maximum flow finds the cheapest cut; what stays with the source is content.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.DOTALL
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[a-z]+|[0-9]+")
RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.IGNORECASE)

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody tfoot thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg canvas object noframes xmp".split())
SPACES = frozenset("br td th wbr img input".split())
#: An opening tag ends the open elements named beside it, up to the nearest of the third set.
CLOSES_P = BLOCKS - {"body", "html", "head", "option", "optgroup", "legend", "caption", "tbody", "tfoot", "thead", "tr"}
#: Blocks that an inline end tag reaches beyond.
WITHIN = {("select", "option"), ("select", "optgroup")}
SAME = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "option": {"select"}}

# Weights of the classifier: words of class, id and role, elements, and shape of the text.
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored sponsors promo promotion promotions banner "
    "banners menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended "
    "recommendations share sharing social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup signin login footer header masthead copyright legal disclaimer comment comments commentlist "
    "disqus reply replies respond responses pagination pager toolbar skip complementary contentinfo search dialog form "
    "teaser teasers trending outbrain taboola paywall".split()
)
CONTENT = frozenset("article content main post entry story text body".split())
BAD_ELEMENTS = frozenset("nav footer aside form menu dialog button select label fieldset head search".split())
EXEMPT = frozenset("html body article main".split())
BASE, INSIDE, OUTSIDE, PER_LINK, PER_LENGTH, SENTENCE, OWNER = 0.3, 2.5, -8.0, -3.0, 1.5, 0.5, -3.0
#: Smoothness: between neighbours, at most, and between blocks of one parent.
NEAR, PARENT = 0.5, 0.4


@dataclass
class Element:
    tag: str
    bad: bool = False
    good: bool = False
    number: int = 0
    parent: Element | None = None
    depth: int = 0
    #: Inline, and judged bad by its own tag: its text is a block of its own.
    apart: bool = False


@dataclass
class Block:
    text: str
    element: Element
    link_share: float
    parts: list = field(default_factory=list)


def _attributes(tag: str, raw: str) -> tuple[bool, bool]:
    """Whether an element's own tag speaks for boilerplate, for content."""
    bad, good = tag in BAD_ELEMENTS, tag in ("article", "main")
    if not raw or raw == "/":
        return bad, good
    for name, a, b, c in ATTRIBUTE.findall(raw):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role", "aria-label"):
            words = set(NAME.findall(value))
            if tag not in EXEMPT:
                bad = bad or bool(words & BOILERPLATE)
            good = good or bool(words & CONTENT)
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            bad = True
        elif name == "aria-hidden" and value == "true":
            bad = True
    return bad, good and not bad


def blocks_of(html: str) -> list[Block]:
    """The page's text blocks in order; character references decoded, white space collapsed."""
    root = Element("")
    stack = [root]
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    count = 0
    anchors = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            place = next(e for e in reversed(stack) if e.tag in BLOCKS or e.apart or e is root)
            out.append(Block(text, place, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal anchors
        if any(e.apart or e.tag in BLOCKS for e in stack[upto:]):
            flush()
        for e in stack[upto:]:
            anchors -= e.tag == "a"
        del stack[upto:]

    at, size = 0, len(html)
    while at < size:
        found = TOKEN.match(html, at)
        at = found.end()
        tag = found.group(2)
        if tag is None:
            piece = found.group()
            if not piece.startswith("<") or piece == "<":
                piece = unescape(piece)
                parts.append(piece)
                linked += len(piece.strip()) if anchors else 0
            continue
        tag = tag.lower()
        if found.group(1):
            if tag in BLOCKS:
                flush()
            elif tag in SPACES:
                parts.append(" ")
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in BLOCKS and tag not in BLOCKS and (tag, stack[k].tag) not in WITHIN:
                    break  # an inline end tag does not reach beyond its block
            continue
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = ending.end() if ending else size
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        elif tag in SPACES:
            parts.append(" ")
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in SAME:
            limit = SAME.get(tag, set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" and tag in CLOSES_P or tag in SAME and (
                    stack[k].tag == tag or {stack[k].tag, tag} == {"dt", "dd"}
                ):
                    close(k)
                    break
                if stack[k].tag in limit or stack[k].tag in BLOCKS and stack[k].tag != "p":
                    break
        top = stack[-1]
        bad, good = _attributes(tag, found.group(3))
        if tag == "header" and not top.good:
            bad = True
        count += 1
        apart = bad and not top.bad and tag not in BLOCKS
        if apart:
            flush()
        stack.append(Element(tag, bad or top.bad, good or top.good, count, top, top.depth + 1, apart))
        anchors += tag == "a"
    flush()
    return out


def log_odds(block: Block) -> float:
    """The classifier: positive for content."""
    value = BASE + INSIDE * block.element.good + OUTSIDE * block.element.bad
    value += PER_LINK * block.link_share * (0.3 if block.element.good else 1.0)
    value += PER_LENGTH * min(1.0, len(block.text) / 150)
    value += OWNER * (not block.element.good and RIGHTS.match(block.text) is not None)
    return value + (SENTENCE if block.text[-1] in ".!?:\"'»”)" else 0.0)


def _closeness(a: Element, b: Element) -> float:
    """1 for one element, falling with the steps between two in the tree."""
    steps = 0
    while a is not b and steps < 12:
        if a.depth >= b.depth and a.parent is not None:
            a = a.parent
        elif b.parent is not None:
            b = b.parent
        steps += 1
    return 1 / (1 + steps / 2)


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: gains are capacities to the source (positive) or sink.

    Dinic's algorithm on whole-number capacities. Of several cheapest cuts the one with
    most nodes on the source's side is taken.
    """
    n = len(gain)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def link(a: int, b: int, one: float, other: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(round(one * 1000))
        head[b].append(len(to))
        to.append(a)
        room.append(round(other * 1000))

    for k, value in enumerate(gain):
        if value > 0:
            link(source, k, value, 0)
        elif value < 0:
            link(k, sink, -value, 0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        arc = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if room[e] == 0)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while arc[a] < len(head[a]):
                e = head[a][arc[a]]
                if room[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                arc[a] += 1
            if arc[a] < len(head[a]):
                path.append(head[a][arc[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                arc[a] += 1
            else:
                break
    lost = [False] * (n + 2)
    lost[sink] = True
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in head[b]:
            if room[e ^ 1] > 0 and not lost[to[e]]:
                lost[to[e]] = True
                queue.append(to[e])
    return [not x for x in lost[:n]]


def main_blocks(html: str | None) -> list[str]:
    """The texts of the blocks labelled content, in page order."""
    found = blocks_of(html or "")
    gain = [log_odds(b) for b in found]
    if not gain or min(gain) > 0:  # no capacity to the sink: the cheapest cut is empty
        return [b.text for b in found]
    edges = []
    last: dict[int, int] = {}
    for k, block in enumerate(found):
        if k:
            edges.append((k - 1, k, NEAR * _closeness(found[k - 1].element, block.element)))
        up = block.element.parent
        key = up.number if up is not None else -1
        if last.get(key, k - 1) != k - 1:
            edges.append((last[key], k, PARENT))
        last[key] = k
    stays = minimum_cut(gain, edges)
    return [b.text for b, kept in zip(found, stays, strict=True) if kept]


def main_text(html: str | None) -> str:
    return "\n\n".join(main_blocks(html))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text`` (empty if none), ``n_chars``.

    Null and empty pages have no text. Broken markup is read as far as it goes: what is not
    closed ends with the page. Other columns are ignored; repeated rows get equal results.
    Pages are independent: no row is moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
