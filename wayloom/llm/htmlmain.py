"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded by hierarchy.

A tolerant parser builds the node tree.  Each node that has text of its own, or
says something by its tag or attributes, gets features of its subtree, its
attribute tokens, its depth and its siblings.  Boosted regression trees, fitted
here to generated page skeletons, score nodes; a dynamic program then takes the
best labelling in which no kept node lies in a dropped one.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea select title head canvas video audio".split())
FOREIGN = frozenset("math svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark noscript object q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Attribute tokens by what they tell; the trees learn how much.
TOKENS = {
    "content": "article articlebody content entry story post main body text prose markdown richtext paragraph copy".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs skip topbar toolbar".split(),
    "edge": "header footer foot masthead banner head copyright legal colophon site".split(),
    "aside": "sidebar side aside rail widget related recommended popular trending recent tags tagcloud teaser more archive author bio".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion dfp adsense affiliate partner shop".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup paywall message warning disclaimer hidden".split(),
    "talk": "comment comments reply replies discussion disqus respond responses reader thread review reviews".split(),
    "social": "share social sharing follow facebook twitter login form search button meta byline".split(),
}
_CLASS = {t: k for k, ts in TOKENS.items() for t in ts}
TAGS = ("p", "div", "section", "li", "td", "blockquote", "pre", "article", "main", "nav", "header", "footer", "aside", "form", "button", "ul", "figcaption")
_GROUPS = tuple(TOKENS)
FEATURES = (
    ["own", "words", "subtree", "density", "links", "subtree_links", "depth", "index", "siblings", "like_me", "beside", "stops", "commas", "page_share", "place", "heading", "up_share", "up_kin", "up_index"]
    + [f"tag_{t}" for t in TAGS] + [f"has_{g}" for g in _GROUPS] + [f"in_{g}" for g in _GROUPS]
    + ["in_article", "in_main", "in_nav", "in_header", "in_footer", "in_aside", "in_form", "in_blockquote", "in_section", "in_ul", "page_has_article"]
)
#: Elements at which the search for an open paragraph ends.
_SCOPE = frozenset("p div td li article section blockquote".split())
_INSIDE = ("article", "main", "nav", "header", "footer", "aside", "form", "blockquote", "section", "ul")

# a quote opens a value only after "=", and only if it is closed; nothing is tried twice, so the time is linear
_TAG = re.compile(r"""<(?:!--(?:.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_TOLD = frozenset("class id role itemprop aria-label".split())
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "tokens", "dropped", "links", "own", "depth", "index", "truth", "blocks", "scope")

    def __init__(self, tag: str, parent: Node | None, tokens: tuple = (), dropped: bool = False):
        self.tag, self.parent, self.tokens, self.dropped = tag, parent, tokens, dropped
        self.children: list[Node] = []
        self.parts: list[tuple[int, str]] = []  # text of this node's own blocks: (block, text)
        self.links, self.own, self.truth, self.blocks = 0, 0, None, []
        self.depth = parent.depth + 1 if parent else 0
        self.index = 0
        self.scope = self if tag in _SCOPE else parent.scope if parent else None  # this node, or the nearest above it, of _SCOPE
        if parent:
            self.index = len(parent.children)
            parent.children.append(self)


def _tokens(attributes: str) -> tuple[tuple, bool]:
    """Classes of an element's attribute tokens, and whether it is hidden."""
    groups, hidden = [], False
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
        elif name in _TOLD:
            for t in _SPLIT.split(value):
                t = t.lower()
                if t in _CLASS:
                    groups.append(_CLASS[t])
    return tuple(dict.fromkeys(groups)), hidden


def parse(page: str) -> tuple[list[Node], int]:
    """All block nodes in page order, the root first, and the number of text blocks.

    Inline elements, and all inside formulas and drawings, add to the block they
    are in.  Scripts, styles, what stands in for unplayable media, and other
    elements without readable text are skipped whole, comments and markup too.
    The time is in proportion to the page, however its elements are nested.
    """
    root = Node("html", None)
    nodes, now, at, block, in_link, foreign = [root], root, 0, 0, 0, 0
    is_open: Counter = Counter()  # tags of the nodes from now up to the root, without it
    endless = set()  # tags without an end tag in the rest of the page

    def leave(node: Node) -> Node:
        is_open[node.tag] -= 1
        return node.parent

    def add(raw: str) -> None:
        if raw and not raw.isspace():
            now.parts.append((block, raw))
            n = len(raw.strip())
            now.own += n
            if in_link:
                now.links += n
        elif raw:
            now.parts.append((block, " "))

    while m := _TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if tag in FOREIGN:
            foreign = max(0, foreign - 1) if m[1] else foreign + (not m[3].rstrip().endswith("/"))
            continue
        if foreign and tag not in RAW and tag not in CLOSES_P:  # an element of the page ends a formula that was never ended
            continue
        foreign = foreign if tag in RAW else 0
        if m[1]:  # an end tag
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in INLINE or tag in VOID or tag in RAW:
                if tag == "br":
                    now.parts.append((block, " "))
                continue
            if is_open[tag]:
                while now.tag != tag:
                    now = leave(now)
                now, block, in_link = leave(now), block + 1, 0
            elif tag == "p":
                block += 1
            continue
        if tag in ("br", "wbr"):
            if tag == "br":
                now.parts.append((block, " "))
            continue
        if tag == "hr":
            block += 1
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            if m[3].rstrip().endswith("/") and tag != "script":
                continue
            end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end is None:
                endless.add(tag)
            if end is None and tag in ("head", "title", "select", "video", "audio", "canvas", "iframe", "template"):
                continue
            at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link += 1
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            if (up := now.scope) is not None and up.tag == "p":
                while now is not up:
                    now = leave(now)
                now = leave(now)
        while now.tag in SAME.get(tag, ()) and now.parent is not None and tag not in ("tbody", "thead"):
            now = leave(now)
            if tag in ("li", "dt", "dd") and now.tag in ("ul", "ol", "dl"):
                break
        groups, hidden = _tokens(m[3]) if m[3] else ((), False)
        now = Node(tag, now, groups, hidden or now.dropped)
        nodes.append(now)
        is_open[tag] += 1
        block, in_link = block + 1, 0
    add(page[at:])
    return nodes, block + 1


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    own = [x.own for x in nodes]
    subtree, links, tags = own[:], [x.links for x in nodes], [1] * n
    place = {id(x): i for i, x in enumerate(nodes)}
    for i in range(n - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        subtree[up] += subtree[i]
        links[up] += links[i]
        tags[up] += tags[i]
    total = max(1, subtree[0])
    out = np.zeros((n, len(FEATURES)), dtype=np.float32)
    inside: list[frozenset] = [frozenset()] * n
    alike: list[Counter | None] = [None] * n  # tags of a node's children, counted once
    has_article = any(x.tag in ("article", "main") for x in nodes)
    base = FEATURES.index(f"tag_{TAGS[0]}")
    tag_at = {t: base + i for i, t in enumerate(TAGS)}
    g_at = {g: base + len(TAGS) + i for i, g in enumerate(_GROUPS)}
    in_at = {g: base + len(TAGS) + len(_GROUPS) + i for i, g in enumerate(_GROUPS)}
    e_at = {g: base + len(TAGS) + 2 * len(_GROUPS) + i for i, g in enumerate(_INSIDE)}
    seen = 0
    for i, x in enumerate(nodes):
        up = x.parent
        if up is not None:
            above = inside[at := place[id(up)]]
            mine = above
            if x.tag in e_at:
                mine = mine | {e_at[x.tag]}
            if x.tokens:
                mine = mine | {in_at[g] for g in x.tokens}
            inside[i] = mine
            kin = up.children
            if alike[at] is None:
                alike[at] = Counter(k.tag for k in kin)
            like = alike[at][x.tag]
            beside = sum(k.own for k in kin[max(0, x.index - 1) : x.index + 2]) - x.own
        else:
            kin, like, beside = [x], 1, 0
        text = "".join(p for _, p in x.parts) if x.own else ""
        row = out[i]
        row[:base] = (
            math.log1p(x.own), math.log1p(text.count(" ")), math.log1p(subtree[i]), math.log1p(subtree[i] / tags[i]), x.links / x.own if x.own else 0.0,
            links[i] / subtree[i] if subtree[i] else 0.0, x.depth, x.index, len(kin), like, math.log1p(beside), text.count("."), text.count(","),
            subtree[i] / total, seen / total, x.tag in HEADINGS,
            subtree[at] / total if up is not None else 0, len(up.parent.children) if up is not None and up.parent is not None else 0, up.index if up is not None else 0,
        )
        seen += x.own
        if x.tag in tag_at:
            row[tag_at[x.tag]] = 1
        for g in x.tokens:
            row[g_at[g]] = 1
        for k in inside[i]:
            row[k] = 1
        row[-1] = has_article
    return out


# -- boosted trees --------------------------------------------------------------


class Trees:
    """Gradient-boosted regression trees for the logistic loss, all of one depth."""

    def __init__(self, depth: int = 5, rounds: int = 60, rate: float = 0.25, bins: int = 24):
        self.depth, self.rounds, self.rate, self.bins = depth, rounds, rate, bins
        self.split: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)  # value <= cut
        wide = self.bins + 1
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            inner = 2**self.depth - 1
            feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
            for level in range(self.depth):
                for node in range(2**level - 1, 2 ** (level + 1) - 1):
                    mine = np.flatnonzero(at == node)
                    if len(mine) < 8:
                        continue
                    c = codes[mine] + np.arange(x.shape[1]) * wide
                    gs = np.bincount(c.ravel(), np.repeat(g[mine], x.shape[1]), x.shape[1] * wide).reshape(-1, wide).cumsum(axis=1)
                    hs = np.bincount(c.ravel(), np.repeat(h[mine], x.shape[1]), x.shape[1] * wide).reshape(-1, wide).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    j, b = divmod(int(np.argmax(gain)), wide)
                    if gain[j, b] > 1e-3 and b < len(cuts[j]):
                        feature[node], cut[node] = j, cuts[j][b]
                right = x[np.arange(len(y)), feature[at]] > cut[at]
                at = 2 * at + 1 + right
            leaf = at - inner
            size = 2**self.depth
            value = self.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + 1)
            self.split.append((feature, cut, value))
            f = f + value[leaf]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.split:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            f += value[at - len(feature)]
        return f


# -- generated skeletons for training --------------------------------------------


def _skeleton(r: random.Random) -> str:
    """A page with marks: content elements carry data-t=1, others data-t=0."""

    def words(a: int, b: int) -> str:
        out = [("".join(r.choice("aeiouy") + r.choice("bcdfglmnprst") for _ in range(r.randint(1, 4)))) for _ in range(r.randint(a, b))]
        for i in range(len(out)):
            if r.random() < 0.09:
                out[i] += r.choice((".", ",", ".", ";"))
        return " ".join(out).capitalize() + r.choice((".", ".", ""))

    def unknown() -> str:
        """A class name that tells nothing."""
        return r.choice(("col-md-8", "mt-4", "row", "u-flex", "clearfix", "wp-block", "x9", "inner")) if r.random() < 0.5 else "".join(r.choice("bcdfgklmnprstvxz") + r.choice("aeiou0123456789") for _ in range(r.randint(2, 4)))

    def attr(group: str, often: float = 0.8, plain: float = 0.0) -> str:
        """Attributes of an element of a group, in one of the usual spellings; ``plain`` of them tell nothing."""
        if r.random() < plain:
            return f' class="{unknown()}"' if r.random() < 0.8 else ""
        if r.random() > often:
            return f' class="{unknown()}"' if r.random() < 0.2 else ""
        name = r.choice(TOKENS[group])
        lead = r.choice(("", "site-", "x-", "main-" if group == "content" else "c-", "js-", "my_"))
        name = r.choice((lead + name, lead + name, lead + name, (lead + name).upper(), lead + name.capitalize(), name.capitalize()))
        more = [name, *(unknown() for _ in range(r.choice((0, 0, 1, 2))))]
        r.shuffle(more)
        return f' {r.choice(("class", "id", "class"))}="{" ".join(more)}"'

    def links(k: int) -> str:
        return "".join(f'<li data-t=0><a href="/{i}">{words(1, 4)}</a></li>' for i in range(k))

    def junk() -> str:
        kind = r.choice(("advert", "notice", "social", "aside", "talk", "menu", "form"))
        if kind == "form":
            return f"<form data-t=0>{words(1, 6)}<button data-t=0>{words(1, 2)}</button></form>"
        if kind == "menu":
            return f"<nav data-t=0{attr('menu', 0.4)}><ul data-t=0>{links(r.randint(2, 9))}</ul></nav>" if r.random() < 0.6 else f"<div data-t=0{attr('menu', 1, 0.3)}><ul data-t=0>{links(r.randint(2, 9))}</ul></div>"
        if kind == "aside":
            tag = r.choice(("aside", "div"))
            inner = f"<ul data-t=0>{links(r.randint(2, 6))}</ul>" if r.random() < 0.6 else f"<p data-t=0>{words(5, 60)}</p>"
            return f"<{tag} data-t=0{attr('aside', 0.5 if tag == 'aside' else 1)}><h3 data-t=0>{words(1, 4)}</h3>{inner}</{tag}>"
        if kind == "talk":
            said = "".join(f"<{t} data-t=0{attr('talk', 0.6)}><p data-t=0>{words(3, 80)}</p></{t}>" for t in [r.choice(("li", "div", "article"))] * r.randint(1, 6))
            return f"<{'section' if r.random() < 0.5 else 'div'} data-t=0{attr('talk', 1)}><h2 data-t=0>{words(1, 3)}</h2>{said}</div>".replace("</div>", "") + "</div></section>"
        return f"<div data-t=0{attr(kind, 1)}>{words(2, 40) if r.random() < 0.6 else f'<p data-t=0>{words(2, 40)}</p>'}</div>"

    def para() -> str:
        x = r.random()
        if x < 0.72:
            return f"<p data-t=1>{words(*r.choice(((1, 6), (5, 40), (20, 160), (60, 300))))}</p>"
        if x < 0.8:
            return f"<h2 data-t=1>{words(1, 9)}</h2>"
        if x < 0.87:
            return "<ul data-t=1>" + "".join(f"<li data-t=1>{words(2, 25)}</li>" for _ in range(r.randint(1, 7))) + "</ul>"
        if x < 0.92:
            return f"<blockquote data-t=1><p data-t=1>{words(5, 60)}</p></blockquote>"
        if x < 0.96:
            return f"<pre data-t=1>{words(4, 40)}</pre>"
        return f"<div data-t=1>{words(5, 80)}</div>"

    count = r.choice((0, 1, 2, 4, 8, 14))
    body = "".join(para() + (junk() if r.random() < 0.08 else "") for _ in range(count))
    title = f"<h1 data-t=1>{words(2, 12)}</h1>"
    shape = r.random()
    if shape < 0.5:
        article = f"<article data-t=1{attr('content', 0.3)}>{title}{body}</article>"
    elif shape < 0.65:
        article = f"<main data-t=1>{title}{body}</main>"
    else:
        article = f"<div data-t=1{attr('content', 1, 0.3 if count > 2 else 0)}>{title}{body}</div>"
    head = f"<header data-t=0{attr('edge', 0.3)}><div data-t=0>{words(1, 8)}</div></header>" if r.random() < 0.5 else f"<div data-t=0{attr('edge', 1)}>{words(1, 8)}</div>" if r.random() < 0.5 else ""
    menu = f"<nav data-t=0{attr('menu', 0.3)}><ul data-t=0>{links(r.randint(3, 12))}</ul></nav>" if r.random() < 0.7 else f"<div data-t=0{attr('menu', 1, 0.2)}>{links(r.randint(3, 9))}</div>"
    foot = f"<footer data-t=0{attr('edge', 0.3)}>&copy; {words(1, 30)}</footer>" if r.random() < 0.75 else f"<div data-t=0{attr('edge', 1)}><p data-t=0>{words(2, 30)}</p></div>"
    before, after = "".join(junk() for _ in range(r.randint(0, 2))), "".join(junk() for _ in range(r.randint(0, 3)))
    inside = head + menu + before + article + after + foot
    return f'<div id="{r.choice(("wrapper", "page", "root", "container", "app", "Page"))}">{inside}</div>' if r.random() < 0.4 else inside


_MARK = re.compile(r"""<([a-z0-9]+) data-t=([01])""")


@functools.cache
def fit(pages: int = 1000, seed: int = 5) -> Trees:
    """Trees fitted to generated pages; the same for the same arguments."""
    r, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        page = _skeleton(r)
        marks = [int(m[2]) for m in _MARK.finditer(page) if m[1] not in RAW]
        nodes, _ = parse(page.replace(" data-t=0", "").replace(" data-t=1", ""))
        marked, _ = parse(page)
        kept = [i for i, x in enumerate(nodes) if i and not (x.tag == "div" and x.parent.parent is None and not x.tokens and not x.own and len(x.children) > 2)]
        if len(kept) != len(marks) or len(marked) != len(nodes):
            continue
        xs.append(features(nodes)[kept])
        ys += marks
    return Trees().fit(np.concatenate(xs), np.array(ys, dtype=np.float64))


def decode(nodes: list[Node], scores: np.ndarray) -> list[bool]:
    """The best labelling in which a kept node's ancestors are all kept."""
    place = {id(x): i for i, x in enumerate(nodes)}
    weight = [(1 + math.log1p(x.own)) if x.own else (1.0 if x.tokens or x.tag in _INSIDE else 0.0) for x in nodes]
    s = [float(a) * w for a, w in zip(scores, weight)]
    s[0] = 0.0 if not nodes[0].own else s[0]
    for i, x in enumerate(nodes):
        if x.dropped:
            s[i] = -1e6
    keep, drop = s[:], [-v for v in s]
    for i in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    out = [True] * len(nodes)  # the root of all may hold kept and dropped parts
    for i, x in enumerate(nodes[1:], 1):
        out[i] = out[place[id(x.parent)]] and keep[i] > drop[i]
    out[0] = s[0] > 0 or len(nodes) == 1  # a page of mere text has nothing to part it from
    return out


def text_of(nodes: list[Node], kept: list[bool]) -> str:
    """Blocks of kept nodes in page order, joined by two line feeds."""
    blocks: dict[int, list[str]] = {}
    for x, ok in zip(nodes, kept):
        if ok:
            for b, raw in x.parts:
                blocks.setdefault(b, []).append(raw)
    out = (" ".join(html.unescape("".join(blocks[b])).split()) for b in sorted(blocks))
    return "\n\n".join(t for t in out if t)



def main_texts(pages: list[str], model: Trees) -> list[str]:
    parsed = [parse(p)[0] for p in pages]
    if not parsed:
        return []
    scores = model.score(np.concatenate([features(n) for n in parsed]))
    out, at = [], 0
    for nodes in parsed:
        out.append(text_of(nodes, decode(nodes, scores[at : at + len(nodes)])))
        at += len(nodes)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), model: Trees | None = None) -> DataFrame:
    """One row per page: id_col, the columns in keep, text and n_chars (its code points).

    Null and empty pages, and pages with nothing kept, have an empty text; a page
    without any block element is all text, and kept.  Whole pages are read,
    each by itself; repeated rows and null ids are returned as they are; columns
    not in keep are not looked at; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    trees = model or fit()
    state = (trees.base, trees.depth, trees.split)
    names = [id_col, *keep]
    kinds = dict(pages.dtypes)

    def run(batches):
        m = Trees()
        m.base, m.depth, m.split = state
        for batch in batches:
            for start in range(0, len(batch), 64):
                some = batch.slice(start, 64)
                texts = main_texts([p or "" for p in some.column(0).to_pylist()], m)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i + 1) for i in range(len(names))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"]
                )

    return pages.select(html_col, *names).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", text string, n_chars long")
