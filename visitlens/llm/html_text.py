"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks, cut where block-level elements begin
or end.  A logistic classifier gives each block a probability of being
content; its negative logarithms are the capacities of the block's edges to
source and sink.  What the markup's names say (a story, a sidebar) adds SAID
to them, an article element ARTICLE_SAID (its linked lists and captions are
text too), and a word of an id only ID_SAID; only what is never text (a form,
a menu, hidden parts) is fixed.  Neighbours in page order and blocks that
share a DOM parent are joined by smoothness edges, by their distance in the
tree.  The maximum flow's minimum cut then parts content from boilerplate, so
a short paragraph goes with the text around it.  Blocks whose own capacity
outweighs all their edges are settled before, which leaves the cut the same
and the flow short on long pages.

Classifier and smoothness are learned on the same scale, log-odds: the one by
gradient descent, the other from how often blocks at each distance agree.
Both read whole pages, at most FIT_PAGES of them and FIT_BLOCKS blocks of
each, evenly spread; blocks are labelled by what their markup says, those
without such a mark are not learned from.

Defined cases: null and empty pages give an empty text; broken or cut
markup is read as browsers do (open elements end with their parent, a cut
tag or comment is dropped); character references are decoded; rows are
independent, so repeated rows, extra columns and empty tables change
nothing.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import sample

FIT_PAGES = 400
FIT_BLOCKS = 400
SMOOTH = 1.0  # of neighbours, without training
SMOOTH_MOST = 3.0
NEAR = 8  # distances told apart
SCORE = 12.0  # the largest score that counts
SAID = 6.0
ARTICLE_SAID = 9.0
ID_SAID = 1.0
SURE = 1e6

# HTML element names by what they mean here.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "wbr",
}
NEVER = {
    "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "template", "svg", "canvas", "head",
    "object", "audio", "video", "map", "datalist", "fieldset",
}
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main",
    "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
}
ENDS_OWN = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
TEXTUAL = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "dt", "dd", "td", "th", "figcaption", "caption"}
# Words of class, id and role that name boilerplate or content.
BOILER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar sidebars side rail footer header masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login register "
    "comment comments commentlist disqus respond reply replies discussion share sharing social related recommended "
    "recommendations teaser teasers widget widgets pagination pager search form copyright legal disclaimer skip hidden "
    "complementary contentinfo dropdown tags byline meta trending popular".split())
CONTENT_WORDS = set("article articles content main story post entry body text page maincontent articlebody".split())

_TOKEN = re.compile(
    r"<!--(.*?)(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S)
_MARKS = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Open:
    """An element and its parent."""

    __slots__ = ("depth", "hint", "parent", "state", "strong", "tag", "title")

    def __init__(self, tag: str, parent: _Open | None, state: int, hint: int, strong: bool, title: bool):
        self.tag, self.parent, self.state, self.hint, self.strong, self.title = tag, parent, state, hint, strong, title
        self.depth = parent.depth + 1 if parent else 0


@dataclass
class Block:
    """A run of text and where it stands."""

    text: str
    leaf: str  # the element around it that is not inline
    place: _Open  # the element that holds it
    linked: int  # characters inside links
    state: int  # 1 the markup says content, -1 boilerplate, -2 never content, 0 nothing
    strong: bool  # inside an article element
    hint: int = 0  # what words of an id say: 1 content, -1 boilerplate, 0 nothing


class _Stack:
    """Open elements, found by tag without a walk; an element closed out of
    turn leaves a gap."""

    def __init__(self):
        self.open = [_Open("", None, 0, 0, False, False)]
        self.at: dict[str, list[int]] = {}
        self.outer: list[int] = [0]  # elements that are not inline

    def top(self) -> _Open:
        while len(self.open) > 1 and self.open[-1].tag == "":
            self.open.pop()
        return self.open[-1]

    def push(self, element: _Open) -> None:
        self.at.setdefault(element.tag, []).append(len(self.open))
        if element.tag not in INLINE:
            self.outer.append(len(self.open))
        self.open.append(element)

    def last(self, *tags: str) -> int:
        """Place of the innermost open element with one of the tags, or 0."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def cut(self, k: int) -> None:
        """Close the k-th element and all inside it."""
        while len(self.open) > k:
            element = self.open.pop()
            if element.tag:
                self.at[element.tag].pop()
                if element.tag not in INLINE:
                    self.outer.pop()

    def drop(self, k: int) -> None:
        """Close the k-th element, an inline one, alone."""
        tag = self.open[k].tag
        self.at[tag].remove(k)
        gap = _Open("", self.open[k].parent, self.open[k].state, self.open[k].hint, self.open[k].strong, self.open[k].title)
        self.open[k] = gap


def apart(a: _Open, b: _Open) -> int:
    """Steps between two elements in the tree; 0 for siblings too."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return max(0, steps - 2)


def _said(tag: str, marks: str, outer: int, hint: int, sure: bool) -> tuple[int, int]:
    """What an element says of its text: -2 never content, -1 boilerplate
    by name, 1 content, else what its parent says; and the hint of its id,
    else its parent's."""
    if outer == -2:
        return outer, hint
    if tag in NEVER:
        return -2, hint
    words: set[str] = set()
    if marks:
        for m in _MARKS.finditer(marks):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return -2, hint
            if name == "style":
                flat = value.replace(" ", "").lower()
                if "display:none" in flat or "visibility:hidden" in flat:
                    return -2, hint
            elif name == "id":
                # Ids of headings and text are made from what they say.
                own = set() if tag in TEXTUAL or tag in INLINE else set(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
                if own & (BOILER_WORDS | CONTENT_WORDS):
                    hint = bool(own & CONTENT_WORDS) - bool(own & BOILER_WORDS)
            elif name in ("class", "role"):
                words.update(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
    if words & BOILER_WORDS and not (tag in ("article", "main", "body", "html") and words & CONTENT_WORDS):
        return -1 if outer != 1 or not words & CONTENT_WORDS else outer, hint
    if tag in ("article", "main"):
        return 1, hint
    if words & CONTENT_WORDS and outer != -1:
        return 1, hint
    if tag == "header":
        # Of an article's own head only the headings stay.
        return outer if sure else -2, hint
    return outer, hint


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in page order."""
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack.top()
                state = top.state
                if top.title and not stack.last("h1", "h2", "h3", "h4", "h5", "h6"):
                    state = -2
                out.append(Block(text, stack.open[stack.outer[-1]].tag, top, linked, state, top.strong, top.hint))
            parts.clear()
        linked = 0

    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            parts.append(text)
            if stack.last("a"):
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[3] is None:
            continue
        if not m[5]:
            break  # cut inside a tag
        tag, marks = m[3].lower(), m[4]
        if m[2]:
            k = stack.last(tag)
            if tag not in INLINE:
                flush()
                if k:
                    stack.cut(k)
            elif k:
                # An inline end inside a block leaves the block open.
                if stack.outer[-1] < k:
                    stack.cut(k)
                else:
                    stack.drop(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag in ENDS_P:
            k = stack.last("p", "button", "table", "td")
            if k and stack.open[k].tag == "p":
                stack.cut(k)
        if tag in ENDS_OWN:
            own, bound = ENDS_OWN[tag]
            while (k := stack.last(*own)) > stack.last(*bound):
                stack.cut(k)
                if tag != "tr":
                    break
        if marks.endswith("/") and tag in ("svg", "path"):
            continue
        outer = stack.top()
        inside = tag == "header" and bool(stack.last("article", "main"))
        state, hint = _said(tag, marks, outer.state, outer.hint, inside)
        strong = state == 1 and (outer.strong or tag in ("article", "main"))
        stack.push(_Open(tag, outer, state, hint, strong, outer.title or inside))
    flush()
    return out


def features(page: list[Block]) -> np.ndarray:
    """One row per block."""
    n = len(page)
    rows = np.zeros((n, 12))
    for i, b in enumerate(page):
        size = len(b.text)
        words = b.text.count(" ") + 1
        last = b.leaf
        rows[i] = (1.0, np.log1p(size) / 5, min(1.0, b.linked / size), np.log1p(words) / 4,
                   sum(b.text.count(c) for c in ".,;:!?") / words, b.text[-1] in ".!?…\"'", last == "p",
                   last in ("h1", "h2", "h3", "h4", "h5", "h6"), last == "li", last in ("td", "th"), min(b.place.depth + 1, 40) / 10,
                   abs(2 * i / max(1, n - 1) - 1))
    return rows


# Weights before training: longer, unlinked, punctuated paragraphs and
# headings are content.
START = np.array([-1.5, 1.5, -4.0, 0.5, 0.5, 0.7, 1.0, 1.5, -0.7, -0.3, 0.0, -0.3])


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression from START, drawn back to it."""
    w = START.copy()
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y <= 0).sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 2.0 * (x.T @ (weight * (p - y)) + 0.01 * (w - START))
    return w


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut; edges
    hold the same capacity both ways.  Of several cuts, the one with the
    smallest source side."""
    net = [a - b for a, b in zip(source, sink, strict=True)]
    side = settled(net, edges)
    open_ = [i for i, x in enumerate(side) if x is None]
    if open_:
        number = {i: k for k, i in enumerate(open_)}
        inner = [(number[a], number[b], c) for a, b, c in edges if a in number and b in number]
        for i, x in zip(open_, _max_flow([net[i] for i in open_], inner), strict=True):
            side[i] = x
    return side


def settled(net: list[float], edges: list[tuple[int, int, float]]) -> list[bool | None]:
    """Sides of the nodes that outweigh all their edges to open nodes; what
    these edges cost moves into the neighbours' ``net``."""
    near: list[dict[int, float]] = [{} for _ in net]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    side: list[bool | None] = [None] * len(net)
    todo = deque(range(len(net)))
    while todo:
        i = todo.popleft()
        if side[i] is not None:
            continue
        held = sum(near[i].values())
        if net[i] <= held and -net[i] < held:
            continue
        side[i] = net[i] > held
        for j, c in near[i].items():
            del near[j][i]
            net[j] += c if side[i] else -c
            todo.append(j)
    return side


def _max_flow(net: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes that the source still reaches after a maximum flow."""
    n = len(net)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, x in enumerate(net):
        # What can flow straight through a node has.
        if x > 0:
            join(s, i, x, 0.0)
        elif x < 0:
            join(i, t, -x, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        # A blocking flow along ascending levels.
        at = [0] * (n + 2)
        path: list[int] = []
        node = s
        while True:
            if node == t:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[node] < len(head[node]):
                e = head[node][at[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                at[node] += 1
            if at[node] < len(head[node]):
                path.append(head[node][at[node]])
                node = to[path[-1]]
            elif path:
                e = path.pop()
                node = to[e ^ 1]
                at[node] += 1
            else:
                break


def pairs(page: list[Block]) -> list[tuple[int, int, int]]:
    """Blocks that are joined, and their distance: neighbours in page order,
    and successive blocks of one element (-1)."""
    out, last = [], {}
    for i, b in enumerate(page):
        if i:
            out.append((i - 1, i, min(NEAR - 1, apart(page[i - 1].place, b.place))))
        if id(b.place) in last and last[id(b.place)] != i - 1:
            out.append((last[id(b.place)], i, -1))
        last[id(b.place)] = i
    return out


def label(page: list[Block], weights: np.ndarray) -> list[bool]:
    """Which blocks are content.  Behind the classifier's weights may stand
    the smoothness of each distance."""
    if not page:
        return []
    own = len(START)
    smooth = weights[own:].tolist() or [SMOOTH / (1 + k) for k in range(NEAR)]
    score = np.clip(features(page) @ weights[:own], -SCORE, SCORE)
    content = np.log1p(np.exp(-score))  # cost of calling it content
    boiler = np.log1p(np.exp(score))
    source, sink = [], []
    for b, c, d in zip(page, content.tolist(), boiler.tolist(), strict=True):
        if b.state == -2:
            c += SURE
        said = (ARTICLE_SAID if b.strong else SAID) * max(b.state, -1) + ID_SAID * b.hint
        if said > 0:
            d += said
        else:
            c -= said
        source.append(d)
        sink.append(c)
    return min_cut(source, sink, [(i, j, smooth[k] if k >= 0 else smooth[0] / 2) for i, j, k in pairs(page)])


def main_text(page: str | None, weights: np.ndarray) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, label(found, weights), strict=True) if keep)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page features and labels of marked blocks, evenly spread over
    it, and how many joined ones agree and differ at each distance."""
    for batch in batches:
        x, y, same = [], [], []
        for page in batch.column("page").to_pylist():
            found = blocks(page)
            own = [i for i, b in enumerate(found) if b.state]
            own = own[::max(1, -(-len(own) // FIT_BLOCKS))]
            count = np.zeros((2, NEAR), np.int64)
            for i, j, k in pairs(found):
                if k >= 0 and found[i].state and found[j].state:
                    count[int((found[i].state > 0) == (found[j].state > 0)), k] += 1
            x.append(features([found[i] for i in own]).ravel() if own else np.zeros(0))
            y.append([float(found[i].state > 0) for i in own])
            same.append(count.ravel().tolist())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.list_(pa.float64())),
                                          pa.array(same, pa.list_(pa.int64()))], ["x", "y", "same"])


def smoothness(differ: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Log-odds that joined blocks agree, by distance; SMOOTH where nothing
    is known."""
    prior = np.array([SMOOTH / (1 + k) for k in range(NEAR)])
    odds = np.log((agree + 4 * np.exp(prior)) / (differ + 4))
    return np.clip(odds, 0.05, SMOOTH_MOST)


def fit(pages: DataFrame, key: str = "page_id", column: str = "html", rows: int = FIT_PAGES) -> np.ndarray:
    """Classifier weights and smoothness; of ``rows`` pages the features of
    FIT_BLOCKS blocks at most reach the driver."""
    some = sample(pages.select(F.col(key), F.col(column).cast("string").alias("page")).where("page IS NOT NULL"),
                  [key, "page"], rows, pages.count())
    x, y, same = [np.zeros((0, len(START)))], [], np.zeros((2, NEAR), np.int64)
    for row in some.select("page").mapInArrow(_examples, "x array<double>, y array<double>, same array<long>").collect():
        x.append(np.array(row.x).reshape(-1, len(START)))
        y += row.y
        same += np.array(row.same).reshape(2, NEAR)
    return np.concatenate([train(np.concatenate(x), np.array(y)), smoothness(same[0], same[1])])


def extract(pages: DataFrame, weights: np.ndarray, column: str = "html", into: str = "text") -> DataFrame:
    """All columns but the page's markup, and its main text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                texts = [main_text(x, weights) for x in part.column("page").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(texts, pa.string())],
                                                 [*carried, "found"])

    names = [c for c in pages.columns if c != column]
    carried = [f"c{i}" for i in range(len(names))]
    narrow = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(names, carried, strict=True)],
                          F.col(f"`{column}`").cast("string").alias("page"))
    kinds = dict(narrow.dtypes)
    done = narrow.mapInArrow(run, ", ".join([f"{c} {kinds[c]}" for c in carried] + ["found string"]))
    return done.select(*[F.col(n).alias(c) for c, n in zip(names, carried, strict=True) if c != into],
                       F.col("found").alias(into))
