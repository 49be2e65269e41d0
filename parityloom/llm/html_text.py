"""Main text of web pages by minimum cut.

A page is read once into blocks: runs of text between block-level tags, each with
its open elements. A fixed logistic classifier on the block's elements, their
class, id and role words, its links and its words gives the costs of calling it
content or boilerplate; they are the capacities from the source and to the sink.
Neighbouring blocks, and next blocks of one parent, are joined by smoothness
edges, stronger the closer they are in the tree. The minimum cut, found by
augmenting paths, separates content from boilerplate.

Nulls: null html is empty; an empty page, or one without content, has the empty
text; null ids and urls are kept. Repeated rows are read each for itself. An empty
table gives no rows. Other columns are ignored. Broken markup is read as far as
it goes: tags may be unclosed, and a tag cut off by the end is dropped.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Tags by role, and words in class, id or role by role.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul video audio button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title textarea iframe object svg math canvas head select datalist noframes".split())
RAW = frozenset("script style noscript title textarea iframe noframes template".split())
AWAY = frozenset("nav footer aside form menu dialog button fieldset".split())
TOWARDS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AWAY_WORDS = frozenset("ad ads advert advertisement advertisements adbox adsense banner billboard breadcrumb breadcrumbs comment comments cookie cookies consent copyright disclaimer discussion disqus donate feedback footer form gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popular popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar tracking trending warning widget widgets".split())
#: Of these, the words for remarks of readers and for lists of other pages.
LISTED = frozenset("comment comments discussion disqus popular promo promoted promotion recommended related replies reply respond sponsor sponsored teaser trending".split())
TOWARDS_WORDS = frozenset("article articlebody body content entry main maincontent page post posts story text".split())
CLOSES_P = BLOCK - {"caption", "legend", "button", "option", "optgroup"}
SAME = {"li": ("ul", "ol", "menu"), "option": ("select",), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}

# Weights of the classifier and of the smoothness edges.
BIAS, AWAY_WEIGHT, TOWARDS_WEIGHT, LINKS, WORDS, SENTENCE, WORDS_AWAY, WORDS_TOWARDS, HEADING = -0.6, -7.0, 3.5, -3.0, 0.45, 0.5, -6.0, 1.0, 0.4
NEXT, SIBLING, FALL = 0.15, 0.45, 0.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/!?][^>]*\Z", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PIECE = re.compile(r"[A-Za-z]+")


@dataclass(slots=True)
class Block:
    text: str
    logit: float
    parent: int  # number of the innermost open block element, 0 for the page
    depth: int  # number of open block elements


def _leaning(tag: str, attrs: str, inside: bool) -> tuple[float, bool, bool]:
    """What an element says of the blocks in it, whether it is hidden or names a role away, and whether its words are of LISTED."""
    listed = False
    score = AWAY_WEIGHT if tag in AWAY or (tag == "header" and not inside) else TOWARDS_WEIGHT if tag in TOWARDS else 0.0
    if attrs:
        if _HIDDEN.search(attrs):
            return AWAY_WEIGHT * 2, True, False
        for value in _NAMED.findall(attrs):
            named = {w.lower() for w in _PIECE.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))}
            if named & AWAY_WORDS and not (tag in TOWARDS or tag == "body"):
                score += WORDS_AWAY
                listed = listed or bool(named & LISTED)
            elif named & TOWARDS_WORDS:
                score += WORDS_TOWARDS
    return score, score <= WORDS_AWAY, listed


def blocks(page: str) -> tuple[list[Block], list[int]]:
    """The text blocks of a page in order, and for each element's number that of the block element around it.

    Unclosed and unopened tags cost no look through all open elements: their places
    are kept by tag.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, float, bool]] = []  # tag, number, leaning so far, whether an article may replace it
    around: list[int] = [0]
    # places in the stack by tag, and of all block elements
    open_: dict[str, list[int]] = {}
    boxes: list[int] = []
    parts: list[str] = []
    count = linked = at = 0
    begun = False  # an article has

    def lean() -> float:
        return stack[-1][2] if stack else 0.0

    def cut(i: int) -> None:
        """Close the element at place i and all in it."""
        for tag, *_ in reversed(stack[i:]):
            open_[tag].pop()
            if tag in BLOCK:
                boxes.pop()
        del stack[i:]

    def last(tag: str) -> int:
        return open_[tag][-1] if open_.get(tag) else -1

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            n = text.count(" ") + 1
            logit = BIAS + lean() + WORDS * math.log(n) + LINKS * min(1.0, linked / max(1, len(text)))
            logit += SENTENCE if text[-1] in ".!?…:;\"'”»" else 0.0
            logit += HEADING if any(open_.get(h) for h in HEADINGS) else 0.0
            out.append(Block(text, logit, stack[boxes[-1]][1] if boxes else 0, len(boxes)))
        parts.clear()
        linked = 0

    silent = ""
    size = len(page)
    lower = None
    ahead: dict[str, int] = {}

    def find(what: str) -> int:
        """The next place of what, from at on; the page is searched for it once in all."""
        there = ahead.get(what, 0)
        if 0 <= there < at or what not in ahead:
            there = ahead[what] = lower.find(what, at)
        return there

    while at < size:
        m = _TOKEN.search(page, at)
        start = m.start() if m else size
        if start > at:
            parts.append(page[at:start])
            if any(s[0] == "a" for s in stack[-6:]):
                linked += start - at
        if not m:
            break
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            i = last(tag)
            if tag in BLOCK:
                flush()
            # an inline end tag does not close blocks
            if i >= 0 and (tag in BLOCK or not boxes or boxes[-1] < i):
                cut(i)
            continue
        if tag in RAW or tag in SILENT:
            silent = tag
            if tag in BLOCK or tag == "head":
                flush()
            lower = lower or page.lower()
            end = find(f"</{silent}")
            if tag == "head":  # a head without its end tag is left at the body
                body = find("<body")
                end = min((x for x in (end, body) if x >= 0), default=-1)
                if end >= 0 and end == body:
                    at = body
                    continue
            if end < 0 and tag not in RAW:
                continue
            at = page.find(">", end) + 1 if end >= 0 else size
            at = at or size
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and boxes and stack[boxes[-1]][0] == "p":
                cut(boxes[-1])
            if tag in SAME:
                pair = next((x for x in (("dt", "dd"), ("td", "th")) if tag in x), (tag,))
                i = max(map(last, pair))
                if i > max(map(last, SAME[tag]), default=-1):
                    cut(i)
        if attrs.endswith("/") and tag not in BLOCK:
            continue
        count += 1
        inside = any(open_.get(t) for t in TOWARDS)
        own, away, listed = _leaning(tag, attrs, inside)
        before = lean()
        weak = bool(stack) and stack[-1][3]
        # the innermost strong statement holds: an article in a page called sidebar is one, an advert in an article too
        if away or (tag in TOWARDS and before < 0 and weak):
            total = own
        else:
            total = before + own if before >= 0 or own <= 0 else before + min(own, 1.0)
        if own < 0:
            # words and a form may stand around a page; remarks and other pages' teasers come after its article has begun
            named = own != AWAY_WEIGHT * 2 and (tag == "form" or (tag not in AWAY and tag != "header"))  # not hidden, nor by its tag
            weak = named and (before >= 0 or weak) and not (listed and begun)
        begun = begun or tag == "article"
        around.append(stack[boxes[-1]][1] if boxes else 0)
        open_.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            boxes.append(len(stack))
        stack.append((tag, count, max(-20.0, min(8.0, total)), weak))
    flush()
    return out, around


def minimum_cut(logits: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the sum of label costs and of the weights of cut edges.

    Only the difference of a node's two costs matters: it is the capacity from the
    source (content) or to the sink (boilerplate). Flow runs along shortest
    augmenting paths, all those of one length at a time; nodes that the source
    still reaches are content.
    """
    n = len(logits)
    supply = [max(0.0, x) for x in logits]
    demand = [max(0.0, -x) for x in logits]
    near: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            near[x].append(len(to))
            to.append(y)
            room.append(w)
    tiny = 1e-12
    while True:
        level, front, far = [-1] * n, [i for i in range(n) if supply[i] > tiny], 0
        for i in front:
            level[i] = 0
        sources = front
        while front and not any(demand[i] > tiny for i in front):
            far += 1
            ahead = []
            for i in front:
                for e in near[i]:
                    if room[e] > tiny and level[to[e]] < 0:
                        level[to[e]] = far
                        ahead.append(to[e])
            front = ahead
        if not front:
            return [x >= 0 for x in level]
        tried = [0] * n
        for s in sources:
            path: list[int] = []
            i = s
            while supply[s] > tiny:
                if level[i] == far and demand[i] > tiny:
                    flow = min(supply[s], demand[i], min((room[e] for e in path), default=math.inf))
                    supply[s] -= flow
                    demand[i] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, i = [], s
                    continue
                while tried[i] < len(near[i]):
                    e = near[i][tried[i]]
                    if level[i] < far and room[e] > tiny and level[to[e]] == level[i] + 1:
                        path.append(e)
                        i = to[e]
                        break
                    tried[i] += 1
                else:
                    if not path:
                        break
                    i = to[path.pop() ^ 1]
                    tried[i] += 1


def _apart(x: Block, y: Block, around: list[int]) -> int:
    """Steps up from the one and down to the other in the tree of block elements."""
    (a, m), (b, n), steps = (x.parent, x.depth), (y.parent, y.depth), 0
    while a != b:
        steps += 1
        if m >= n:
            a, m = around[a], m - 1
        else:
            b, n = around[b], n - 1
    return steps


def main_text(page: str) -> str:
    found, around = blocks(page)
    edges: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}  # last block below an element
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT * FALL ** max(0, _apart(found[i - 1], b, around) - 2)))
        # what stands directly in one parent, or directly below one
        up = around[b.parent] if b.depth > 1 else b.parent
        if up in last:
            edges.append((last[up], i, SIBLING))
        last[up] = i
    keep = minimum_cut([b.logit for b in found], edges)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    small_batches(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([main_text(p) for p in b.column(2).to_pylist()], pa.string())], ["page_id", "url", "text"])

    raw = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return raw.mapInArrow(read, "page_id long, url string, text string")
