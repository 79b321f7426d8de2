"""A forgiving HTML parser that keeps block structure only, and simple tree matching over it."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from zlib import crc32

import numpy as np

# What the elements of HTML are.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "object", "canvas", "select", "button"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "figure"}
# Words of class names, ids and roles that mark what isn't main text, words for the boxes and parts of it that
# follow them in a name, and words before them that say of another box whether it has such a part.
NOISE_MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
    "sidebar", "sidebars", "aside", "widget", "widgets", "footer", "complementary", "contentinfo", "search", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "reply", "replies", "disqus", "respond", "pagination", "pager", "toolbar", "form", "hidden", "copyright", "header",
}
FRAMES = {
    "area", "articles", "author", "bar", "block", "body", "bottom", "box", "bundle", "button", "buttons", "col", "column", "container", "content", "group", "holder", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "meta", "outer", "panel", "posts", "primary",
    "region", "right", "row", "secondary", "section", "slot", "stories", "text", "thread", "title", "top", "unit", "wrap", "wrapper", "zone",
}
COMMENTS = {"comment", "comments", "reply"}
OTHERS = {"no", "not", "has", "have", "with", "without", "hide", "show", "enable", "disable"}
SCOPE = {"table", "ul", "ol", "dl", "div", "article", "section", "body", "aside", "nav", "main", "form"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?i)(?:^|[\s"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z]+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@lru_cache(100_000)
def noise_words(value: str) -> tuple[str, ...]:
    """The words by which the names in an attribute mark what isn't main text.

    A name does so by its last word (``site-footer``), or by its first one if all others are words for boxes and parts
    (``comment-list``): ``no-sidebar``, ``related-work`` and ``search-results-page`` don't.
    """
    found = []
    for name in value.split():
        words = [w for w in map(str.lower, _WORD.findall(name)) if len(w) > 1]
        if not words or words[0] in OTHERS:
            continue
        if words[-1] in NOISE_MARKS:
            found.append(words[-1])
        elif words[0] in NOISE_MARKS and all(w in FRAMES or w in NOISE_MARKS for w in words[1:]):
            found.append(words[0])
    return tuple(dict.fromkeys(found))


class Node:
    """An element with its children and blocks of own text, in page order (``parts``). ``noise``: words of its names that mark what isn't main text."""

    __slots__ = ("marks", "noise", "own", "parts", "tag")

    def __init__(self, tag: str, marks: tuple[str, ...] = (), noise: tuple[str, ...] = ()):
        self.tag, self.marks, self.noise, self.parts, self.own = tag, marks, noise, [], []

    @property
    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]

    def label(self) -> str:
        return ".".join((self.tag, *self.marks))

    def close_block(self) -> None:
        if self.own:
            text = " ".join("".join(self.own).split())
            self.own = []
            if text:
                self.parts.append(text)

    def blocks(self) -> list[str]:
        return [p for p in self.parts if isinstance(p, str)]

    def text_hash(self) -> int:
        return crc32("\n".join(self.blocks()).encode())


def _marks(attributes: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """All words of the names, and those that mark what isn't main text."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return (), ()
    found, noise = [], []
    for name, *values in _NAMES.findall(attributes):
        if name.lower() in ("hidden", "aria-hidden"):
            if "".join(values).lower() in ("", "true", "hidden"):
                found.append("hidden")
                noise.append("hidden")
        else:
            value = html.unescape("".join(values))
            found += [x for x in _SPLIT.split(value.lower()) if x]
            noise += noise_words(value)
    return tuple(dict.fromkeys(found)), tuple(dict.fromkeys(noise))


def _spare(root: Node, boxes: set[int]) -> None:
    """Boxes (by their ids) with at least half of a page's text aren't noise, whatever their names say."""
    order, above = [root], [0]
    for i, node in enumerate(order):  # grows on the way
        kids = node.children
        order += kids
        above += [i] * len(kids)
    chars = [sum(map(len, node.blocks())) for node in order]
    for i in range(len(order) - 1, 0, -1):
        chars[above[i]] += chars[i]
    for node, n in zip(order, chars, strict=True):
        if id(node) in boxes and 2 * n >= chars[0]:
            node.noise = ()


#: What ends the text of each element whose text is raw, and what each start tag closes.
_RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_SHUTS = {tag: frozenset(CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())) for tag in {*CLOSES, *ENDS_P}}


def parse(page: str) -> Node:
    """The tree of a page. Unclosed, crossed and cut-off tags are mended as browsers roughly do.

    A box that names mark isn't marked if it holds an article (not a comment), a ``main`` or an ``h1``, and most of the text.
    """
    top = root = Node("#page")
    stack = [root]
    marked: list[Node] = []  # open boxes that names mark, of which none is known to hold an article
    holding: set[int] = set()
    opened: dict[str, int] = {}  # how many elements of a name are open, so that none is sought in vain, however deep it goes
    at, size, search = 0, len(page), _TOKEN.search

    def pop_to(depth: int) -> Node:
        while len(stack) > depth:
            node = stack.pop()
            opened[node.tag] -= 1
            if marked and marked[-1] is node:
                marked.pop()
            if node.own:
                node.close_block()
        return stack[-1]

    while at < size:
        m = search(page, at)
        begin, end = m.span() if m else (size, size)
        if begin > at:
            raw = page[at:begin]
            if top.own or not raw.isspace():
                top.own.append(html.unescape(raw) if "&" in raw else raw)
        if m is None:
            break
        at = end
        closing, tag, attributes = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if tag == "br":
            top.own.append(" ")
            continue
        if closing:
            if opened.get(tag):
                top = pop_to(len(stack) - 1 if top.tag == tag else next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag))
            if top.own:
                top.close_block()
            continue
        if top.own:
            top.close_block()
        if tag in RAW:
            if not m.group().endswith("/>"):
                ended = _RAW_ENDS[tag].search(page, at)
                at = ended.end() if ended else size
            continue
        shut = _SHUTS.get(tag)
        if shut and any([opened.get(x) for x in shut]):
            depth = len(stack) - 1
            least = len(stack)
            while depth > 0:
                if stack[depth].tag in shut:
                    least = depth
                elif stack[depth].tag in SCOPE:
                    break
                depth -= 1
            top = pop_to(least)
        if tag in VOID:
            continue
        node = Node(tag, *_marks(attributes))
        if marked and (tag in ("main", "h1") or tag == "article" and not COMMENTS.intersection(node.noise)):
            holding.update(map(id, marked))
            marked.clear()
        if node.noise and tag != "article":
            marked.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        top.parts.append(node)
        stack.append(node)
        top = node
    pop_to(1)
    if root.own:
        root.close_block()
    if holding:
        _spare(root, holding)
    return root


class Flat:
    """A tree as lists by node number, in page order."""

    def __init__(self, root: Node | None = None, spec: list | None = None):
        self.labels: list[str] = []
        self.hashes: list[int] = []
        self.kids: list[list[int]] = []
        self.nodes: list[Node] = []
        if root is not None:
            stack = [(root, -1)]
            while stack:
                node, parent = stack.pop()
                k = len(self.labels)
                self.labels.append(node.label())
                self.hashes.append(node.text_hash())
                self.kids.append([])
                self.nodes.append(node)
                if parent >= 0:
                    self.kids[parent].append(k)
                stack += [(c, k) for c in reversed(node.children)]
        elif spec is not None:
            self.labels, self.hashes, self.kids = spec

    def spec(self) -> list:
        return [self.labels, self.hashes, self.kids]


#: Cells of the programme held at once, and scores; beyond it the programme is divided.
PAIRS_MOST, SCORES_MOST = 40_000, 4_000_000

Scores = Callable[[int, int], int]


def _vectors(ys: np.ndarray, score: Scores) -> tuple[np.ndarray, Callable[[int], np.ndarray]]:
    """Each one's place among the distinct ``ys``, and a function from ``x`` to its scores against those."""
    kinds, at = np.unique(ys, return_inverse=True)
    held: dict[int, np.ndarray] = {}

    def scores(x: int) -> np.ndarray:
        if x not in held:
            if len(held) * len(kinds) > SCORES_MOST:
                held.clear()
            held[x] = np.array([score(x, y) for y in kinds.tolist()])
        return held[x]

    return at, scores


def _rows(xs: list[int], at: np.ndarray, scores: Callable[[int], np.ndarray], short: bool) -> list[np.ndarray]:
    """The programme's table row by row: the most that a prefix of ``xs`` and a prefix of the others score. If ``short``, only the last row."""
    out = [np.zeros(len(at) + 1, np.int64)]
    for x in xs:
        row = np.append(0, np.maximum.accumulate(np.maximum(out[-1][1:], out[-1][:-1] + scores(x)[at])))
        if short:
            out.clear()
        out.append(row)
    return out


def _divided(xs: list[int], ys: list[int], score: Scores) -> list[tuple[int, int]]:
    """The places of ``xs`` and ``ys`` that the programme pairs, in memory that grows with their number (Hirschberg's division)."""
    at, scores = _vectors(np.array(ys), score)
    found, stack = [], [(0, len(xs), 0, len(ys))]
    while stack:
        p0, p1, q0, q1 = stack.pop()
        p, q = xs[p0:p1], at[q0:q1]
        if not len(p) or not len(q):
            continue
        if len(p) > 1 and len(p) * len(q) > PAIRS_MOST:
            mid = len(p) // 2
            cut = q0 + int(np.argmax(_rows(p[:mid], q, scores, True)[-1] + _rows(p[mid:][::-1], q[::-1], scores, True)[-1][::-1]))
            stack += [(p0, p0 + mid, q0, cut), (p0 + mid, p1, cut, q1)]
            continue
        best, i, j = _rows(p, q, scores, False), len(p), len(q)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((p0 + i, q0 + j))
    return found


def _trim(x: Sequence[int], y: Sequence[int]) -> tuple[int, int]:
    """How many shapes are alike at the start of both lists, and at the end of what remains. Pairing these loses nothing: no other partner scores more."""
    most, lo, hi = min(len(x), len(y)), 0, 0
    while lo < most and x[lo] == y[lo]:
        lo += 1
    while hi < most - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    return lo, hi


class _Shapes:
    """Labelled shapes of subtrees by number, and what pairs of them score. Subtrees of one shape score alike."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.memo: dict[tuple[int, int], int] = {}

    def of(self, tree: Flat) -> list[int]:
        """The shape of each node, from the last to the first, as children stand behind their parents."""
        out = [0] * len(tree.labels)
        for k in range(len(out) - 1, -1, -1):
            kids = tuple([out[c] for c in tree.kids[k]])
            key = (tree.labels[k], kids)
            if key not in self.known:
                self.known[key] = len(self.labels)
                self.labels.append(tree.labels[k])
                self.kids.append(kids)
                self.sizes.append(1 + sum([self.sizes[c] for c in kids]))
            out[k] = self.known[key]
        return out

    def direct(self, x: int, y: int) -> int | None:
        """The score of a pair that needs no programme."""
        if x == y:
            return self.sizes[x]
        if self.labels[x] != self.labels[y]:
            return 0
        return None if self.kids[x] and self.kids[y] else 1

    def known_score(self, x: int, y: int) -> int:
        got = self.direct(x, y)
        return self.memo[x, y] if got is None else got

    def score(self, x: int, y: int) -> int:
        got = self.direct(x, y)
        if got is not None:
            return got
        stack = [(x, y)]
        while stack:
            p, q = stack[-1]
            if (p, q) in self.memo:
                stack.pop()
                continue
            left, right = self.kids[p], self.kids[q]
            lo, hi = _trim(left, right)
            left, right = left[lo : len(left) - hi], right[lo : len(right) - hi]
            first = [(i, j) for i in set(left) for j in set(right) if (i, j) not in self.memo and self.direct(i, j) is None]
            if first:
                stack += first
                continue
            alike = sum([self.sizes[k] for k in (*self.kids[p][:lo], *self.kids[p][len(self.kids[p]) - hi :])])
            rest = 0
            if left and right:
                at, scores = _vectors(np.array(right), self.known_score)
                rest = int(_rows(list(left), at, scores, True)[-1][-1])
            self.memo[p, q] = 1 + alike + rest
            stack.pop()
        return self.memo[x, y]


def match(a: Flat, b: Flat) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the most pairs of equally labelled nodes that keep parents and order, and the pairs.

    Each pair of shapes is scored once, by the programme over their children; where a table would have over ``PAIRS_MOST``
    cells it is divided, with the same result. Nothing here recurses, so trees may be of any depth.
    """
    shapes = _Shapes()
    sa, sb = shapes.of(a), shapes.of(b)
    total = shapes.score(sa[0], sb[0])
    if not total:
        return 0, []
    pairs, stack = [], [(0, 0)]
    while stack:
        i, j = stack.pop()
        if sa[i] == sb[j]:  # alike all through, and numbered alike
            size = shapes.sizes[sa[i]]
            pairs += zip(range(i, i + size), range(j, j + size), strict=True)
            continue
        pairs.append((i, j))
        left, right = a.kids[i], b.kids[j]
        lo, hi = _trim([sa[k] for k in left], [sb[k] for k in right])
        stack += zip(left[:lo], right[:lo], strict=True)
        stack += zip(left[len(left) - hi :], right[len(right) - hi :], strict=True)
        left, right = left[lo : len(left) - hi], right[lo : len(right) - hi]
        if left and right:
            for p in {sa[k] for k in left}:
                for q in {sb[k] for k in right}:
                    shapes.score(p, q)
            stack += [(left[p], right[q]) for p, q in _divided([sa[k] for k in left], [sb[k] for k in right], shapes.known_score)]
    return total, pairs
