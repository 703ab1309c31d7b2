"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded along the tree.

A node is kept if its subtree holds main text. The trees see tag, attribute tokens, depth, place
among siblings, subtree size and density, link share and what stands above. Decoding picks the
likeliest set of kept nodes in which no kept node lies under a dropped one. The trees are
trained here, on pages that `training_pages` invents from common layouts with known main text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.runtime import ship, worker

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't text of the page.
RAW = set("script style title textarea iframe template svg select option".split())
#: Of these, the ones in which tags are plain text up to their own end tag.
PLAIN = set("script style textarea iframe".split())
#: Elements that end where a block begins; in an svg only outside foreignObject.
UNBLOCKED = set("title svg option".split())
BLOCKS = set(
    "html body head address article aside blockquote dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p pre section summary table tbody thead tfoot tr td th caption ul".split()
)
#: An element that ends when one of these begins, and where the search for it stops.
ENDS_BEFORE = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_SHUT = re.compile(r"</([^\s/>]+)\s*>")
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Groups of attribute tokens; each is a feature, of the node and of its nearest ancestors.
TOKENS = {
    "main": "article body content entry main post story text",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination tabs toc",
    "head": "banner brand header logo masthead top topbar tagline",
    "foot": "bottom colophon copyright footer legal",
    "side": "aside complementary more popular recommended related sidebar trending widget",
    "advert": "ad ads advert advertisement advertising adverts promo promoted promotion sponsor sponsored",
    "notice": "alert consent cookie cookies gdpr modal notice notification overlay paywall popup privacy",
    "talk": "comment commentlist comments discussion disqus feedback replies reply respond responses thread",
    "form": "contact form login newsletter search signin signup subscribe subscription",
    "share": "author bio byline facebook follow meta share sharing social tags twitter",
}
_GROUP = {t: i for i, words in enumerate(TOKENS.values()) for t in words.split()}
TAGS = ["article", "main", "section", "div", "p", "ul", "li", "a", "nav", "header", "footer", "aside", "form", "table", "h1", "h2", "blockquote", "pre", "figure", "body", "button", "label", "span"]
_TAG = {t: i for i, t in enumerate(TAGS)}
_ABOVE = set("nav header footer aside form".split())


class Node(NamedTuple):
    tag: str
    parent: int
    depth: int
    attributes: str


class Page(NamedTuple):
    nodes: list[Node]
    pieces: list[tuple[int, int, str]]  # (node, block, text as it stands)


class Token(NamedTuple):
    start: int
    end: int
    shut: str  # "/" of an end tag
    tag: str  # empty for comments and declarations
    attributes: str


class Scanner:
    """The tags of a page from left to right. Every character is looked at a bounded number of times: where a tag has no
    end, none behind it has one either, and the rest is text; a quote without its partner is a plain character."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.dead = len(html)  # from here on nothing is a tag
        self.alone: dict[str, int] = {}  # where the last quote of a kind is known to stand

    def _end(self, at: int) -> int:
        """Behind the > that ends the tag whose attributes begin at `at`; 0 without one."""
        html = self.html
        while m := _STOP.search(html, at):
            quote, at = m[0], m.end()
            if quote == ">":
                return at
            if self.alone.get(quote) != m.start():
                partner = html.find(quote, at)
                if partner < 0:
                    self.alone[quote] = m.start()
                else:
                    at = partner + 1
        return 0

    def next(self, at: int) -> Token | None:
        """The first tag, comment or declaration that begins at `at` or later."""
        html = self.html
        while 0 <= (at := html.find("<", at)) < self.dead:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return Token(at, len(html) if end < 0 else end + 3, "", "", "")
            if html[at + 1 : at + 2] in ("!", "?"):
                end = html.find(">", at) + 1
                if end:
                    return Token(at, end, "", "", "")
                self.dead = at
                return None
            m = _NAME.match(html, at)
            if m:
                end = self._end(m.end())
                if not end:
                    self.dead = at
                    return None
                return Token(at, end, m[1], m[2].lower(), html[m.end() : end - 1])
            at += 1
        return None

    def tokens(self, at: int) -> Iterator[Token]:
        while token := self.next(at):
            yield token
            at = token.end


def _after_raw(scan: Scanner, at: int, tag: str, above: Callable[[str], bool], unclosed: set[str]) -> int:
    """Where an element of RAW that begins at `at` ends: at its own end tag, or else where an element above it ends.

    above: whether a tag is open there; unclosed: tags of PLAIN that are known to have no end tag from here on.
    """
    html = scan.html
    if tag in PLAIN:
        shut = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
        if shut:
            return shut.end()
        unclosed.add(tag)
        return next((over.start() for over in _SHUT.finditer(html, at) if above(over[1].lower())), len(html))
    inside: list[str] = []
    held: Counter[str] = Counter()
    for m in scan.tokens(at):
        name = m.tag
        if not name:
            continue
        if m.shut:
            if held[name]:
                while inside:
                    last = inside.pop()
                    held[last] -= 1
                    if last == name:
                        break
            elif name == tag:
                return m.end
            elif above(name):
                return m.start
        elif tag == "option" and name in ("option", "optgroup") or tag in UNBLOCKED and name in BLOCKS and not held["foreignobject"]:
            return m.start
        elif name not in VOID and not m.attributes.rstrip().endswith("/"):
            inside.append(name)
            held[name] += 1
    return len(html)


def parse(html: str) -> Page:
    """The elements of a page in order and its text pieces; missing and stray end tags are allowed for."""
    scan = Scanner(html)
    nodes, pieces = [Node("#root", -1, 0, "")], []
    stack, block, at, end = [0], 0, 0, len(html)
    places: defaultdict[str, list[int]] = defaultdict(list)  # where a tag stands on the stack, and where blocks do
    blocks: list[int] = []
    unclosed: set[str] = set()

    def top(tags: Iterable[str]) -> int:
        """The uppermost place of any of the tags; 0 without one."""
        return max((places[t][-1] for t in tags if t in places and places[t]), default=0)

    def close(i: int) -> None:
        for n in stack[i:]:
            places[nodes[n].tag].pop()
        del stack[i:]
        while blocks and blocks[-1] >= i:
            blocks.pop()

    while at < end:
        m = scan.next(at)
        stop = m.start if m else end
        if stop > at:
            pieces.append((stack[-1], block, html[at:stop]))
        if not m:
            break
        at, tag = m.end, m.tag
        if not tag:
            continue
        if m.shut:
            if tag in BLOCKS:
                block += 1
            i = top((tag,))  # other than a block's, an end tag doesn't reach beyond the last block
            if i and (tag in BLOCKS or not blocks or blocks[-1] < i):
                close(i)
            continue
        if tag in BLOCKS:
            block += 1
            closes, stops = ENDS_BEFORE.get(tag, ({"p"}, {"button", "td", "th", "table", "article", "section", "div", "body", "li"}))
            i = top(closes)
            if i and i >= top(stops):
                close(i)
        if tag in VOID:
            if tag == "br":
                pieces.append((stack[-1], block, " "))
            continue
        closed = m.attributes.rstrip().endswith("/")
        if tag in RAW:
            if closed and tag in PLAIN:  # `<script src=a/>` before its own end tag isn't closed
                near = re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).search(html, at)
                closed = not near or not near[1]
            if not closed:
                at = _after_raw(scan, at, tag, lambda name: bool(top((name,))), unclosed)
            continue
        nodes.append(Node(tag, stack[-1], len(stack), m.attributes))
        if not closed:
            places[tag].append(len(stack))
            if tag in BLOCKS:
                blocks.append(len(stack))
            stack.append(len(nodes) - 1)
    return Page(nodes, pieces)


def _groups(attributes: str) -> int:
    """A bit for each token group, and one more for hidden nodes."""
    bits = 0
    if attributes:
        for value in _ATTRIBUTE.findall(attributes):
            for part in _PART.findall(value):
                group = _GROUP.get(part.lower())
                if group is not None:
                    bits |= 1 << group
        if _HIDDEN.search(attributes):
            bits |= 1 << len(TOKENS)
    return bits


N_FEATURES = len(TAGS) + 2 * (len(TOKENS) + 1) + 16


def features(page: Page) -> np.ndarray:
    """A row of numbers for each node."""
    nodes, n = page.nodes, len(page.nodes)
    text, links, commas = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, _, piece in page.pieces:
        size = len(piece) - piece.count(" ") - piece.count("\n")
        if size:
            text[node] += size
            commas[node] += piece.count(",") + piece.count(".")
    own, below, bits, above, spoiled = text.copy(), np.ones(n), [0] * n, [0] * n, [0] * n
    children = [0] * n
    nth, paragraphs = np.zeros(n), np.zeros(n)
    for i, (tag, parent, _, attributes) in enumerate(nodes):
        bits[i] = _groups(attributes)
        if parent >= 0:
            nth[i] = children[parent]
            children[parent] += 1
            above[i] = above[parent] | bits[parent]
            spoiled[i] = spoiled[parent] | (nodes[parent].tag in _ABOVE) | (nodes[parent].tag in ("article", "main")) << 1
    for i in range(n - 1, 0, -1):
        tag, parent = nodes[i].tag, nodes[i].parent
        if tag == "a":
            links[i] = text[i]
        elif tag == "p":
            paragraphs[i] += 1
        text[parent] += text[i]
        links[parent] += links[i]
        commas[parent] += commas[i]
        below[parent] += below[i]
        paragraphs[parent] += paragraphs[i]
    out = np.zeros((n, N_FEATURES), np.float32)
    parent = np.maximum(0, np.array([x.parent for x in nodes]))
    for i, x in enumerate(nodes):
        t = _TAG.get(x.tag)
        if t is not None:
            out[i, t] = 1
    at, kinds = len(TAGS), np.arange(len(TOKENS) + 1)
    out[:, at : at + len(kinds)] = np.array(bits)[:, None] >> kinds & 1
    at += len(kinds)
    out[:, at : at + len(kinds)] = np.array(above)[:, None] >> kinds & 1
    at += len(kinds)
    depth = np.array([x.depth for x in nodes])
    siblings = np.array(children)[parent]
    spoiled = np.array(spoiled)
    whole = max(1.0, text[0])
    rows = [
        depth, nth, siblings - nth, siblings, np.log1p(text), np.log1p(own), links / np.maximum(1, text), text / below,
        text / whole, commas / np.maximum(1, text), below, spoiled & 1, spoiled >> 1 & 1, paragraphs, text / np.maximum(1, text[parent]), paragraphs[parent],
    ]
    out[:, at:] = np.stack(rows, 1)
    return out


# -- gradient-boosted trees -------------------------------------------------------------------


class Trees(NamedTuple):
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x leaves
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = self.leaves.shape[1].bit_length() - 1
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        return total


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 24) -> Trees:
    """Logistic boosting with second-order leaves; splits at quantiles."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    width = bins + 1
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(len(y), base)
    all_features, all_cuts, all_leaves = [], [], []
    inner = (1 << depth) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf)
            if len(rows) >= 20:
                gs, hs = g[rows].sum(), h[rows].sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    left_g = np.cumsum(np.bincount(binned[rows, j], g[rows], width))[: len(c)]
                    left_h = np.cumsum(np.bincount(binned[rows, j], h[rows], width))[: len(c)]
                    gain = left_g**2 / (left_h + 1) + (gs - left_g) ** 2 / (hs - left_h + 1) - gs**2 / (hs + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, float(c[k]))
            feature[node], cut[node] = best[1], best[2]
            at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
        leaf = at - inner
        leaves = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += leaves[leaf]
        all_features.append(feature)
        all_cuts.append(cut)
        all_leaves.append(leaves)
    return Trees(np.array(all_features), np.array(all_cuts, np.float32), np.array(all_leaves), base)


# -- training pages ----------------------------------------------------------------------------

_KEEP = "data-keep"


def training_pages(n: int, seed: int = 5) -> Iterator[str]:
    """Invented pages whose main-text elements carry the attribute data-keep."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzéüñ"))

    vocabulary = np.array(["".join(rng.choice(letters, rng.integers(1, 10))) for _ in range(3000)])
    vocabulary = np.concatenate([vocabulary] * 22 + [np.char.add(vocabulary, mark) for mark in (",", ".", ".\n")])

    def words(lo: int, hi: int) -> str:
        return " ".join(rng.choice(vocabulary, rng.integers(lo, hi + 1))).capitalize() + pick(".", "", "?")

    def links(lo: int, hi: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{i}">{words(1, 4)}</a></{tag}>' for i in range(rng.integers(lo, hi + 1)))

    def inline(text: str) -> str:
        parts = text.split(" ")
        if rng.random() < 0.25 and len(parts) > 4:
            k = rng.integers(1, len(parts))
            mark = pick("b", "i", "em", "strong", "span", 'a href="/x"')
            parts[k] = f"<{mark} {_KEEP}>{parts[k]}</{mark.split()[0]}>"
        return " ".join(parts)

    def body() -> str:
        out = [f"<h1 {_KEEP}>{words(2, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.integers(1, 12)):
            r = rng.random()
            if r < 0.72:
                shut = "</p>" if rng.random() < 0.85 else ""
                size = (1, 3) if rng.random() < 0.15 else (5, 90)
                out.append(f"<p {_KEEP}>{inline(words(*size))}{shut}")
            elif r < 0.78:
                out.append(f"<{(h := pick('h2', 'h3'))} {_KEEP}>{words(1, 6)}</{h}>")
            elif r < 0.84:
                out.append(f"<ul {_KEEP}>" + "".join(f"<li {_KEEP}>{words(2, 20)}</li>" for _ in range(rng.integers(2, 6))) + "</ul>")
            elif r < 0.88:
                out.append(f"<blockquote {_KEEP}>{words(5, 40)}</blockquote>")
            elif r < 0.91:
                out.append(f"<pre {_KEEP}>{words(5, 30)}</pre>")
            elif r < 0.94:
                cells = "".join(f"<tr {_KEEP}><td {_KEEP}>{words(1, 4)}</td><td {_KEEP}>{words(1, 4)}</td></tr>" for _ in range(rng.integers(2, 5)))
                out.append(f"<table {_KEEP}>{cells}</table>")
            elif r < 0.97:
                out.append(junk("inside"))
            else:
                out.append(f"<div {_KEEP}>{words(5, 50)}</div>")
        return "".join(out)

    def filling() -> str:
        """What stands in an element that isn't main text."""
        r = rng.random()
        if r < 0.3:
            return words(1, 6)
        if r < 0.45:
            return words(6, 60)
        if r < 0.6:
            return f"<p>{words(3, 50)}</p>" * rng.integers(1, 4)
        if r < 0.8:
            return f"<ul>{links(2, 12)}</ul>"
        if r < 0.9:
            return links(1, 8, "span")
        return f"<{(h := pick('h1', 'h2', 'h3', 'b'))}>{words(1, 6)}</{h}>{pick(f'<p>{words(3, 40)}</p>', f'<ul>{links(2, 8)}</ul>', '')}"

    def comments() -> str:
        tag, each = pick("div", "section", "ul", "aside"), pick("div", "article", "li", "p")
        inside = lambda: words(3, 60) if each == "p" or rng.random() < 0.4 else f"<p>{words(3, 60)}</p>"
        items = "".join(f'<{each} class="{pick("comment", "reply", "")}">{inside()}</{each}>' for _ in range(rng.integers(1, 6)))
        return f'<{tag} {pick("class", "id")}="{pick(*TOKENS["talk"].split())}">{pick("", f"<h3>{words(1, 3)}</h3>")}{items}</{tag}>'

    def junk(place: str) -> str:
        groups = {"top": ["menu", "head", "advert", "notice", "form"], "end": ["foot", "side", "advert", "notice", "form", "share", "menu"], "inside": ["advert", "notice", "form", "share", "side"]}[place]
        tags = {"top": ["header", "nav", "aside", "form"], "end": ["footer", "aside", "nav", "form"], "inside": ["aside", "form"]}[place]
        out = []
        for _ in range(rng.integers(0, 5 if place != "inside" else 2)):
            r = rng.random()
            if r < 0.4:
                tag = pick(*tags)
                out.append(f"<{tag}{pick('', '', ' class=' + pick(*TOKENS[pick(*groups)].split()))}>{filling()}</{tag}>")
            elif r < 0.85:
                tag, token = pick("div", "div", "section", "p", "span"), pick(*TOKENS[pick(*groups)].split())
                name = pick(token, f"{token}-{pick('box', 'wrap', 'inner', 'x1')}", f"site-{token}", f"{pick('c1', 'left')} {token}")
                out.append(f'<{tag} {pick("class", "class", "id")}="{name}">{words(2, 30) if tag in ("p", "span") else filling()}</{tag}>')
            elif r < 0.93:
                out.append(f"<ul>{links(4, 12)}</ul>")
            elif place == "end":
                out.append(comments())
        return "".join(out)

    for _ in range(n):
        tag, name = pick(("article", ""), ("article", ""), ("main", ""), ("div", "class=content"), ("div", "id=main-content"), ("div", 'class="post-body entry"'), ("section", "class=story"), ("div", ""), ("div", "class=article-text"))
        inside = body() if rng.random() < 0.97 else ""
        keep = f" {_KEEP}" if inside else ""
        inner = f"<{tag} {name}{keep}>{inside}</{tag}>"
        if rng.random() < 0.2:
            inner = f"<{tag} {name}{keep}>{inside}{junk('end')}</{tag}>"
        page = junk("top") + inner + junk("end")
        for _ in range(rng.integers(0, 3)):
            page = f'<div class="{pick("wrapper", "page", "container", "row", "")}"{keep}>{page}</div>'
        yield f"<html{keep}><body{keep}>{page}</body></html>"


_MODEL: list[Trees] = []


def trained(pages: int = 600) -> Trees:
    """The trees, trained once for each driver."""
    if not _MODEL:
        rows, labels = [], []
        for html in training_pages(pages):
            page = parse(html)
            rows.append(features(page)[1:])
            labels += [_KEEP in x.attributes for x in page.nodes[1:]]
        _MODEL.append(boost(np.concatenate(rows), np.array(labels, float)))
    return _MODEL[0]


# -- extraction ---------------------------------------------------------------------------------


def kept_nodes(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The likeliest choice of nodes in which all nodes above a kept one are kept: by dynamic programming, leaves first."""
    n = len(page.nodes)
    # what keeping a node's subtree as well as possible gains over dropping all of it
    gain = log_odds.astype(float).tolist()
    gain[0] = 0.0
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[page.nodes[i].parent] += gain[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.nodes[i].parent] and gain[i] > 0
    return kept


def text_of(page: Page, kept: np.ndarray) -> str:
    blocks: dict[int, list[str]] = {}
    for node, block, piece in page.pieces:
        if kept[node] and (node or any(c.isalnum() for c in piece) or block in blocks):
            blocks.setdefault(block, []).append(piece)
    texts = (" ".join(unescape("".join(p)).split()) for p in blocks.values())
    return "\n\n".join(t for t in texts if t)


def main_texts(htmls: list[str], trees: Trees) -> list[str]:
    pages = [parse(h) for h in htmls]
    if not pages:
        return []
    rows = [features(p) for p in pages]
    odds = trees.log_odds(np.concatenate(rows))
    parts = np.split(odds, np.cumsum([len(r) for r in rows])[:-1])
    return [text_of(p, kept_nodes(p, o)) for p, o in zip(pages, parts)]


def _extract(trees: Trees):
    @worker("html")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                texts = main_texts([h or "" for h in part["html"].to_pylist()], trees)
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Out, a row for each row of pages: page_id, url, text, n_chars (code points of text).

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by two line feeds in page order. A null or empty html, and a page without main text, give an
    empty text. Null ids and urls are passed on; equal rows each get a row. Very long pages are
    read whole. An empty table gives no rows. Other columns of pages don't matter.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(trees or trained()), "page_id long, url string, text string, n_chars long")
