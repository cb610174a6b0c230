"""Main text of web pages by a graphical model on the tree of their elements.

Block elements and the text blocks between their tags are the nodes of a page's tree; each is content or not. A node has a score from its
tag, its names, its share of text and links; each parent and child have a potential that depends on what kind of node the child is.
Sum-product messages from the leaves upward and from the root downward give each node's marginal, and the text blocks whose marginal
is a half or more are the page's text. The weights maximise the likelihood of labelled pages: observed less expected counts are the gradient.

A labelled page is HTML whose elements may carry ``data-label`` 1 or 0, which holds for all text below it up to the next one.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, read_table, trim

#: Labelled pages that the default model is trained on, at most; steps and strength of the training.
PAGES, STEPS, RATE, DECAY = 400, 250, 0.1, 0.5
#: Characters of pages handled together.
BATCH_CHARS = 2_000_000

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TAGS = ("article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption",
        "p", "blockquote", "figure", "figcaption", "pre", "fieldset", "legend", "address", "details", "summary", "dialog", "menu", "center", "body", "html", "hgroup", "search", *HEADINGS)
#: Elements whose text is not part of the page's, beside those that hold no markup (RAW) and the head.
DROPPED = frozenset("svg math object select button canvas audio video datalist".split())
RAW = "script|style|textarea|title|noscript|iframe|template"
_CONTAINERS = frozenset("div section table tbody tr td th center dl fieldset body html".split())
_SEMANTIC = frozenset("article main nav header footer aside form search dialog menu".split())
_CLOSES_P = frozenset(TAGS) - {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "li", "dt", "dd", "legend", "summary", "figcaption", "body", "html"}
#: An open element of the key's kind ends where one of its own kind begins, unless an element of the second set lies between.
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
_SCOPE = {"li": {"ul", "ol", "menu"}, "p": {"td", "th", "table"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dd": {"dl"}, "dt": {"dl"}}

#: Groups of words in class, id and role. A word counts if it begins with the group's, or is it where that ends with a dot.
NAMES = {
    "content": "article content post. posts. entry story body. text. main. page. blog prose markdown",
    "nav": "nav menu breadcrumb crumb pagination pager toolbar tabs. toc skip",
    "head": "header head. masthead banner logo topbar top. branding",
    "foot": "footer foot. copyright colophon legal bottom",
    "side": "sidebar side aside rail widget complementary column. right. left. secondary",
    "related": "related recommend more. popular trending teaser tags. tag. categories archive",
    "advert": "ad. ads. adv. advert adsense adslot sponsor promo outbrain taboola affiliate commercial dfp",
    "notice": "cookie consent notice gdpr alert newsletter subscribe subscription popup modal overlay disclaimer paywall message privacy warning signup dialog",
    "comment": "comment reply respond disqus discussion feedback review. reviews. guestbook reader",
    "share": "share sharing social follow twitter facebook byline meta. author. bio. rating tools print.",
    "form": "form search login contact. poll survey input field",
    "hidden": "hidden. invisible. sr. screenreader offscreen displaynone",
}
_LENGTHS, _SHARES, _LINKS = (1, 12, 40, 90, 250, 1000), (0.02, 0.1, 0.25, 0.5, 0.8), (0.001, 0.3, 0.7, 0.95)


def _feature_ids() -> dict[str, int]:
    names = [f"tag {t}" for t in (*TAGS, "other")] + [f"name {n}" for n in NAMES]
    names += [f"{kind} {what} {i}" for kind, what, bounds in (("leaf", "links", _LINKS), ("leaf", "length", _LENGTHS), ("node", "links", _LINKS), ("node", "length", _LENGTHS), ("node", "share", _SHARES)) for i in range(len(bounds) + 1)]
    names += [f"in tag {t}" for t in sorted(_SEMANTIC)] + [f"in name {n}" for n in NAMES] + ["inner header"]
    return {n: i for i, n in enumerate([*names, "leaf", "node", "leaf sentence", "leaf comma", "leaf copyright", "leaf heading"])}


FEATURES = _feature_ids()
#: What a potential depends on: the child is a text block, a plain block, a container without telling names, or one with them.
LEAF, PLAIN, CONTAINER, NAMED = range(4)

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)|<(?:[!?]|/[^a-zA-Z])[^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[^>"'=]+|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(?:>|\Z)""",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@functools.lru_cache(maxsize=20_000)
def _names(attrs: str) -> tuple[tuple[int, ...], int | None]:
    """(features of an element's names, its label if it carries one)."""
    found, label = set(), None
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = entities.unescape(a or b or c), name.lower()
        if name == "data-label" and value in ("0", "1"):
            label = int(value)
        elif name in ("class", "id", "role"):
            for word in _WORD.findall(value):
                word = word.lower()
                found |= {g for g, keys in NAMES.items() if any(word == k[:-1] if k[-1] == "." else word.startswith(k) for k in keys.split())}
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            found.add("hidden")
    return tuple(sorted(FEATURES[f"name {g}"] for g in found)), label


@functools.lru_cache(maxsize=20_000)
def _told(tag: str, feats: tuple[int, ...]) -> tuple[int, ...]:
    first, inner = FEATURES["name content"], FEATURES["in name content"]
    at = (inner + f - first for f in feats if first <= f < first + len(NAMES))
    return (*([FEATURES[f"in tag {tag}"]] if tag in _SEMANTIC else []), *at)


class Page:
    """A page's tree as lists: of each node its parent, its features and its kind; of text blocks their text and links; labels where given."""

    def __init__(self, source: str):
        self.parent, self.tags, self.feats, self.kind = [-1], ["html"], [()], [CONTAINER]
        self.text: list[str | None] = [None]
        self.links: list[int] = [0]
        self.label: list[int | None] = [None]
        #: What text below a node is told by the nearest element with a telling tag or name.
        self.told: list[tuple[int, ...]] = [()]
        self.open = [0]
        self.parts: list[str] = []
        self.in_link = self.in_head = self.dropped = self.linked = 0
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._data(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag:
                (self._end if m["end"] else self._start)(tag.lower(), m["attrs"] or "")
        if at < len(source):
            self._data(source[at:])
        self._flush()

    def _data(self, raw: str) -> None:
        if self.dropped or self.in_head:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.in_link:
            self.linked += len("".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self._add(self.open[-1], "", self.told[self.open[-1]], LEAF, None)
            self.text[-1], self.links[-1] = text, self.linked
        self.parts, self.linked = [], 0

    def _add(self, parent: int, tag: str, feats: tuple[int, ...], kind: int, label: int | None) -> int:
        self.parent.append(parent)
        self.tags.append(tag)
        self.feats.append(feats)
        self.kind.append(kind)
        self.text.append(None)
        self.links.append(0)
        self.label.append(self.label[parent] if label is None else label)
        self.told.append(_told(tag, feats) if kind == NAMED else self.told[parent])
        return len(self.parent) - 1

    def _close(self, tags: set[str], stop: Iterable[str] = ()) -> None:
        """Ends the open elements down to the last of ``tags``, if there is one above all of ``stop``."""
        for k in range(len(self.open) - 1, 0, -1):
            t = self.tags[self.open[k]]
            if t in tags:
                del self.open[k:]
                return
            if t in stop:
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag in DROPPED:
            self.dropped += not attrs.rstrip().endswith("/")
        elif tag == "head":
            self.in_head = 1
        elif tag == "a":
            self.in_link = 1
        elif tag in ("br", "hr", "img", "input", "wbr"):
            self.parts.append(" ")
            if tag == "hr":
                self._flush()
        elif tag in _TAG_SET and not self.dropped:
            self._flush()
            self.in_head = 0
            if tag in _CLOSES_P:
                self._close({"p"}, _SCOPE["p"])
            if tag in _SIBLINGS:
                own, stop = _SIBLINGS[tag]
                while any(self.tags[i] in own for i in self.open[self._above(stop) :]):
                    self._close(own, stop)
            feats, label = _names(attrs)
            if tag == "header" and any(self.tags[i] in ("article", "main") for i in self.open):
                feats = (*feats, FEATURES["inner header"])
            telling = tag in _SEMANTIC or bool(feats)
            kind = NAMED if telling else CONTAINER if tag in _CONTAINERS else PLAIN
            self.open.append(self._add(self.open[-1], tag, feats, kind, label))

    def _above(self, stop: set[str]) -> int:
        for k in range(len(self.open) - 1, -1, -1):
            if self.tags[self.open[k]] in stop:
                return k + 1
        return 1

    def _end(self, tag: str, _: str) -> None:
        if tag in DROPPED:
            self.dropped = max(0, self.dropped - 1)
        elif tag == "head":
            self.in_head = 0
        elif tag == "a":
            self.in_link = 0
        elif tag in _TAG_SET and not self.dropped:
            self._flush()
            self._close({tag}, _SCOPE.get(tag, ()))


_TAG_SET = frozenset(TAGS)
_ENDS = frozenset(".!?…。؟।")


@dataclass
class Forest:
    """The trees of some pages in one set of arrays. Parents come before children; ``levels`` are the nodes of each depth but the roots."""

    pages: list[Page]
    start: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    node: np.ndarray
    feature: np.ndarray


def _bucket(x: np.ndarray, bounds: Sequence[float]) -> np.ndarray:
    return np.searchsorted(bounds, x, "right")


def forest(sources: Iterable[str]) -> Forest:
    pages = [Page(s) for s in sources]
    start = np.append(0, np.cumsum([len(p.parent) for p in pages])).astype(np.int64)
    flat = lambda name, kind: np.array([x for p in pages for x in getattr(p, name)], kind)
    parent, kind = flat("parent", np.int64), flat("kind", np.int64)
    root = parent < 0
    parent += np.repeat(start[:-1], np.diff(start))
    # A parent has a smaller place than its children, so its own depth is known first.
    depths, up = [0] * len(parent), parent.tolist()
    for i in np.flatnonzero(~root).tolist():
        depths[i] = depths[up[i]] + 1
    depth = np.array(depths, np.int64)
    order = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[order], np.arange(1, int(depth.max(initial=0)) + 2))
    levels = [order[a:b] for a, b in zip(bounds, bounds[1:])]
    leaf = kind == LEAF
    leaf[root] = False
    texts = [t for p in pages for t in p.text]
    chars = np.array([len(t) if t else 0 for t in texts], np.float64)
    links = np.minimum(flat("links", np.float64), chars)
    total, linked = chars.copy(), links.copy()
    for level in reversed(levels):
        np.add.at(total, parent[level], total[level])
        np.add.at(linked, parent[level], linked[level])
    whole = np.repeat(total[start[:-1]], np.diff(start)) if len(pages) else total
    node, feature = [], []

    def put(at: np.ndarray, f: np.ndarray | int) -> None:
        node.append(at)
        feature.append(np.broadcast_to(f, at.shape))

    # The size of a part of the page tells something of containers alone: the longer a page, the smaller the share of each paragraph.
    for name, which in (("leaf", leaf), ("node", ~leaf)):
        at = np.flatnonzero(which)
        put(at, FEATURES[name])
        put(at, FEATURES[f"{name} links 0"] + _bucket(linked[at] / np.maximum(total[at], 1), _LINKS))
    at = np.flatnonzero(leaf)
    put(at, FEATURES["leaf length 0"] + _bucket(total[at], _LENGTHS))
    at = np.flatnonzero(~leaf & (kind != PLAIN))
    put(at, FEATURES["node length 0"] + _bucket(total[at], _LENGTHS))
    put(at, FEATURES["node share 0"] + _bucket(total[at] / np.maximum(whole[at], 1), _SHARES))
    tags = [t for p in pages for t in p.tags]
    inner = np.flatnonzero(~leaf)
    put(inner, np.array([FEATURES.get(f"tag {tags[i]}", FEATURES["tag other"]) for i in inner.tolist()], np.int64))
    named = [(i + s, f) for p, s in zip(pages, start) for i, fs in enumerate(p.feats) for f in fs]
    put(np.array([i for i, _ in named], np.int64), np.array([f for _, f in named], np.int64))
    leaves = [(i, texts[i]) for i in np.flatnonzero(leaf).tolist()]
    signs = {
        "sentence": [i for i, t in leaves if t.rstrip("\"'”’)»]")[-1:] in _ENDS],
        "comma": [i for i, t in leaves if "," in t or "、" in t],
        "copyright": [i for i, t in leaves if "©" in t],
        "heading": [i for i, _ in leaves if tags[up[i]] in HEADINGS],
    }
    for name, at in signs.items():
        put(np.array(at, np.int64), FEATURES[f"leaf {name}"])
    return Forest(pages, start, parent, kind, levels, np.concatenate(node), np.concatenate(feature))


@dataclass(frozen=True)
class Model:
    """``weights`` of features for content; ``edges[kind of child, state of parent, state of child]``."""

    weights: np.ndarray
    edges: np.ndarray


def marginals(f: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(probability of content of each node, joint probabilities of (parent, child) states for each node but roots, whose rows are 0).

    ``up`` has for each node its own score and all that its children say; ``down`` what the rest of the tree says.
    """
    n = len(f.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.bincount(f.node, model.weights[f.feature], n)
    up, to_parent = own, np.zeros((n, 2))
    for level in reversed(f.levels):
        to_parent[level] = np.logaddexp.reduce(up[level][:, None, :] + model.edges[f.kind[level]], axis=2)
        np.add.at(up, f.parent[level], to_parent[level])
    down, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for level in f.levels:
        above = f.parent[level]
        rest = up[above] + down[above] - to_parent[level]
        both = rest[:, :, None] + model.edges[f.kind[level]] + up[level][:, None, :]
        down[level] = np.logaddexp.reduce(rest[:, :, None] + model.edges[f.kind[level]], axis=1)
        both -= np.logaddexp.reduce(both.reshape(-1, 4), axis=1)[:, None, None]
        joint[level] = np.exp(both)
    belief = up + down
    return np.exp(belief[:, 1] - np.logaddexp(belief[:, 0], belief[:, 1])), joint


def labels_of(f: Forest) -> np.ndarray:
    """States of all nodes of labelled pages: a text block's is that of the nearest label (0 without one); an element's, whether content is
    at least half of the text in it."""
    label = np.array([x or 0 for p in f.pages for x in p.label], np.float64)
    chars = np.array([len(t) if t else 0 for p in f.pages for t in p.text], np.float64)
    content, total = chars * label, chars.copy()
    for level in reversed(f.levels):
        np.add.at(content, f.parent[level], content[level])
        np.add.at(total, f.parent[level], total[level])
    return (2 * content >= np.maximum(total, 1)).astype(np.int64)


def train(labelled: Sequence[str], steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """The model of most likelihood for labelled pages, less ``decay`` times half the squared weights; gradients from exact marginals."""
    f = forest(labelled)
    y = labels_of(f)
    n, inner = len(y), np.concatenate([np.empty(0, np.int64), *f.levels])
    seen = np.bincount(f.feature, y[f.node], len(FEATURES))
    seen_edges = np.zeros((4, 2, 2))
    np.add.at(seen_edges, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    size = len(FEATURES)
    x, first, second = np.zeros(size + 16), np.zeros(size + 16), np.zeros(size + 16)
    for step in range(1, steps + 1):
        p, joint = marginals(f, Model(x[:size], x[size:].reshape(4, 2, 2)))
        expected_edges = np.zeros((4, 2, 2))
        np.add.at(expected_edges, f.kind[inner], joint[inner])
        g = np.append(seen - np.bincount(f.feature, p[f.node], size), (seen_edges - expected_edges).ravel()) - decay * x
        g /= max(n, 1)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        x = x + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(x[:size], x[size:].reshape(4, 2, 2))


def main_texts(sources: Sequence[str], model: Model) -> list[str]:
    """The text of each page: its text blocks whose marginal is a half or more, in page order, by line."""
    f = forest(sources)
    p, _ = marginals(f, model)
    return ["\n".join(t for t, q in zip(page.text, p[a:b].tolist()) if t is not None and q >= 0.5) for page, a, b in zip(f.pages, f.start, f.start[1:])]


class _Writer:
    """Writes labelled pages: an article among the other parts of a page, each in one of several common forms. All words are made up."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def pick(self, *forms: str) -> str:
        return self.r.choice(forms)

    def words(self, low: int, high: int) -> str:
        one = lambda: "".join(self.r.choice("ka lo mi ren tu sha ve on it ar est gu ño é".split()) for _ in range(self.r.randrange(1, 4)))
        return " ".join(one() + ("," if self.r.random() < 0.06 else "") for _ in range(self.r.randrange(low, high))).rstrip(",")

    def sentences(self, n: int) -> str:
        return " ".join(self.words(1, 18).capitalize() + self.pick(".", ".", ".", "?", "!") for _ in range(n))

    def maybe(self, chance: float, part: str) -> str:
        return part if self.r.random() < chance else ""

    def links(self, n: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(n)]
        form = self.r.randrange(4)
        if form < 2:
            return f"<ul{self.pick('', ' class=list', ' class=menu')}>" + "".join(f"<li>{x}{self.maybe(0.7, '</li>')}" for x in items) + "</ul>"
        return (" | " if form == 2 else " ").join(items) if self.r.random() < 0.5 else "".join(f"<div>{x}</div>" for x in items)

    def wrap(self, opens: Sequence[str], inner: str, label: int) -> str:
        tag = self.r.choice(opens)
        name = tag.split()[0]
        return f"<{tag} data-label={label}>{inner}</{name}>"

    def nav(self) -> str:
        return self.wrap(("nav", "nav", 'div class="menu"', 'div id="navigation"', 'ul class="nav-list"', 'div class="breadcrumbs"', "div", 'div role="navigation"'), self.links(self.r.randrange(2, 9)), 0)

    def head(self) -> str:
        inner = self.pick("<h1>", "<div>", "<p>", "<span>") + self.words(1, 5) + self.maybe(0.5, self.links(3)) + self.maybe(0.4, f"<p>{self.sentences(1)}</p>")
        return self.wrap(("header", 'div class="header"', 'div id="masthead"', 'div class="site-header top-bar"', 'div role="banner"'), inner, 0)

    def foot(self) -> str:
        inner = self.maybe(0.8, self.pick("&copy; ", "© 2020 ", "Copyright ")) + self.words(1, 6) + self.pick(" &middot; ", ". ", "") + self.sentences(self.r.randrange(1, 3)) + self.maybe(0.4, self.links(4))
        return self.wrap(("footer", "footer", 'div class="footer"', 'div id="colophon"', 'div class="site-footer"', 'div role="contentinfo" class="bottom"'), self.pick(inner, f"<p>{inner}</p>"), 0)

    def side(self) -> str:
        inner = f"{self.pick('<h3>', '<h2>', '<h4>', '<div>')}{self.words(1, 4)}" + self.pick("</h3>", "</h2>", "</h4>", "</div>") + self.pick(self.links(5), f"<p>{self.sentences(self.r.randrange(1, 4))}</p>", f"{self.links(4)}<p>{self.sentences(1)}</p>")
        return self.wrap(("aside", "aside", 'div class="sidebar"', 'div id="right-column"', 'div class="widget"', 'section class="related-posts"', 'div class="recommended"', 'td class="sidebar"'), inner, 0)

    def advert(self) -> str:
        return self.wrap(('div class="ad"', 'div class="ad"', 'div id="ad-7"', 'div class="advertisement"', 'section class="sponsored"', 'div class="promo-box"', 'aside class="ads"', 'p class="advert"'), self.sentences(self.r.randrange(1, 4)), 0)

    def notice(self) -> str:
        inner = self.pick("<p>", "<div>", "<span>") + self.sentences(self.r.randrange(1, 4)) + self.maybe(0.6, "<button>ok</button>") + self.maybe(0.3, '<a href="/p">more</a>')
        return self.wrap(('div class="cookie-notice"', 'div id="consent"', 'div role="alert"', 'section class="newsletter"', 'div class="popup-modal"', 'div class="notice"', "dialog", 'p class="disclaimer"'), inner, 0)

    def form(self) -> str:
        inner = self.words(1, 5) + f"<label>{self.words(1, 3)}</label><input name=q>" + self.maybe(0.5, f"<select><option>{self.words(1, 2)}</select>") + self.maybe(0.5, f"<p>{self.sentences(1)}</p>") + self.maybe(0.6, "<button>go</button>")
        return self.wrap(("form", "form", 'div class="search-box"', 'form class="contact"', 'div class="signup-form"'), inner, 0)

    def comments(self) -> str:
        one = lambda: self.pick("<div class=comment>", "<li class=comment>", "<article class=comment>", "<p>", "<div>") + self.maybe(0.6, f"<b>{self.words(1, 3)}</b> ") + self.pick("", "<p>") + self.sentences(self.r.randrange(1, 5))
        close = {"<d": "</div>", "<l": "</li>", "<a": "</article>", "<p": "</p>"}
        parts = [x + close[x[:2]] for x in (one() for _ in range(self.r.randrange(1, 7)))]
        return self.wrap(('section id="comments"', 'div class="comments"', 'ol class="comment-list"', 'div id="disqus_thread"', 'div class="responses discussion"', 'section class="reader-feedback"'), self.maybe(0.6, f"<h3>{self.words(1, 3)}</h3>") + "".join(parts), 0)

    def block(self) -> str:
        form = self.r.randrange(18)
        text = self.sentences(self.r.choice((1, 1, 2, 3, 5, 9, 25)))
        if form == 0:
            return f"<h2>{self.words(1, 9)}</h2>"
        if form == 1:
            return "<ul>" + "".join(f"<li>{self.words(1, 14)}" for _ in range(self.r.randrange(2, 6))) + "</ul>"
        if form == 2:
            return f"<blockquote>{self.pick(text, f'<p>{text}</p>')}</blockquote>"
        if form == 3:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 4)}<td>{self.r.randrange(999)}</tr>" for _ in range(3)) + "</table>"
        if form == 4:
            return f"<p>{self.words(1, 2).capitalize()}."
        if form == 5:
            return f"<p><b>{text}<br>{self.maybe(0.5, text)}"
        if form == 6:
            return f'<p>{text} <a href="/x">{self.words(1, 5)}</a> {text}</p>'
        if form == 7:
            return f"<figure><img src=x><figcaption>{self.words(2, 9)}</figcaption></figure>"
        if form == 8:
            return f"<div>{text}</div>"
        if form == 9:
            return f"<p>{self.words(1, 60)}</p>"
        if form == 10:
            return f"<p>{' | '.join(self.words(1, 3) for _ in range(9))}"
        return f"<p>{text}" + self.maybe(0.8, "</p>")

    def article(self) -> str:
        # Now and then other parts lie within the article.
        short = self.r.random() < 0.2
        parts = [f"<p>{self.words(1, 5).capitalize()}{self.pick('.', '.', '')}</p>" if short and self.r.random() < 0.8 else self.block() for _ in range(self.r.choice((1, 2, 4, 7, 12, 20, 45, 70)))]
        for part, chance in ((self.advert, 0.15), (self.share, 0.2), (self.notice, 0.1), (self.form, 0.06), (self.side, 0.08)):
            if self.r.random() < chance:
                parts.insert(self.r.randrange(len(parts) + 1), part())
        title = self.maybe(0.85, f"<{(h := self.pick('h1', 'h1', 'h2'))}>{self.words(2, 12)}</{h}>") if self.r.random() < 0.85 else f"<header><h1>{self.words(2, 12)}</h1></header>"
        inner = title + "".join(parts)
        form = self.r.randrange(12)
        if form < 3 or form > 9:
            return f"<article data-label=1>{inner}</article>"
        if form == 3:
            return f"<main><article data-label=1>{inner}</article></main>"
        if form == 4:
            return f'<div id="main"><div class="post" data-label=1>{inner}</div></div>'
        if form == 5:
            return f"<table><tr><td data-label=1>{inner}</td>{self.maybe(0.5, self.nav().replace('<nav', '<td').replace('</nav', '</td'))}</tr></table>"
        if form == 6:
            return f"<div data-label=1>{inner}</div>"
        return self.wrap(('div class="entry-content"', 'section class="article-body"', 'div class="story"', "main", 'div id="content"', 'div class="page-text"'), inner, 1)

    def share(self) -> str:
        return self.wrap(('div class="share-buttons"', 'ul class="social"', 'div class="post-tags"', 'div class="author-bio"'), self.pick(self.links(3), self.words(1, 8)), 0)

    def page(self) -> str:
        before = [x() for x, chance in ((self.notice, 0.25), (self.head, 0.5), (self.nav, 0.75), (self.form, 0.2), (self.advert, 0.4)) if self.r.random() < chance]
        self.r.shuffle(before)
        after = [x() for x, chance in ((self.advert, 0.2), (self.share, 0.2), (self.comments, 0.45), (self.side, 0.45), (self.form, 0.2), (self.notice, 0.15), (self.nav, 0.15)) if self.r.random() < chance]
        middle = "".join(before) + self.article() + "".join(after)
        if self.r.random() < 0.3:
            middle = self.pick("<div class=wrapper>", "<div id=page>", "<div>") + middle + "</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><style>p{{}}</style></head><body>{middle}{self.maybe(0.8, self.foot())}<script>x</script></body></html>"


def labelled_pages(n: int = PAGES, seed: int = 12) -> list[str]:
    """``n`` labelled pages by rule. They stand in where no pages have been labelled by hand; their layouts, not their words, are what counts."""
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]


@functools.cache
def default_model(n: int = PAGES, seed: int = 12) -> Model:
    return train(labelled_pages(n, seed))


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi:
                    texts = pa.array(main_texts(batch.column(2).slice(lo, hi - lo).to_pylist(), model), pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), texts, pc.utf8_length(texts).cast(pa.int64())], schema=_SCHEMA)
            trim()

    return run


def extract_main_text(pages: DataFrame, labelled: DataFrame | None = None, label_col: str = "html", most: int = PAGES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points of the text).

    The model is trained on the driver from at most ``most`` labelled pages, the first by their text's digest: those of ``labelled``, or
    pages written by rule. Null and empty pages have an empty text, as have pages without content. Text blocks are whole and none that
    is content is left out, however long the page; broken and missing tags are repaired as browsers do in the common cases. Repeated rows
    have equal results, other columns are not read, an empty table stays empty. No shuffle: pages are handled where they are read.
    """
    if labelled is None:
        model = default_model(most)
    else:
        col = F.col(label_col)
        model = train([r[0] for r in labelled.filter(col.isNotNull()).select(col).distinct().orderBy(F.sha2(col, 256)).limit(most).collect()])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(lean(_extracted(model)), "page_id long, url string, text string, n_chars long")


def op12_html_tree(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))
