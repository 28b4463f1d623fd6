"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node with two states, content or not. Its own
potential is a sum of weights of its tag, the words of its class, id and role, the
left-out parts around it, and coarse measures of its text. A potential of parent and child states joins the nodes
along the tree. Messages pass from the leaves to the root and back (sum-product),
which gives exact marginals; the text of nodes above one half is the main text.

The weights are trained by gradient ascent on the likelihood of labelled pages: the
hand-labelled ones below, and a bounded sample of the given pages that label
themselves, since they hold exactly one article (or main) element.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 300
ROUNDS = 80

# Elements by their part in the layout (HTML).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template head title iframe object svg canvas audio video map select datalist button textarea".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output picture progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SAME_LEVEL = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}
BARRIER = {"table", "td", "th", "button", "object", "body", "html", "article", "section", "div", "aside", "nav", "footer", "header", "form", "blockquote", "ul", "ol", "dl"}
PAGE = {"#page", "html", "body"}
NOT_MAIN = set("nav footer aside form header".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass
class Node:
    """A block element: its place in the tree and the text right below it."""

    tag: str
    parent: int
    names: tuple[str, ...]
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    unseen: bool = False
    left_out: bool = False  # its names announce a part that is not the article
    inside: frozenset[str] = frozenset()  # left-out parts around it


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements, parents first, and the blocks of text in page order.

    A block is the text between two borders of block elements, with character
    references decoded and white space joined; it belongs to the element around it.
    """
    nodes = [Node("#page", -1, ())]
    blocks: list[tuple[int, str]] = []
    page = page or ""
    opened: list[tuple[str, int]] = []  # open elements and the node each stands in
    here, links = 0, 0
    pieces: list[str] = []

    def end_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text and not nodes[here].unseen:
                blocks.append((here, text))
                nodes[here].pieces.append(text)

    def close_to(depth: int) -> None:
        nonlocal here, links
        if any(t not in INLINE for t, _ in opened[depth:]):
            end_block()
        for tag, _ in opened[depth:]:
            links -= tag == "a"
        del opened[depth:]
        here = opened[-1][1] if opened else 0

    def close(tags: set[str], stop: set[str]) -> None:
        for depth in range(len(opened) - 1, -1, -1):
            if opened[depth][0] in tags:
                close_to(depth)
                return
            if opened[depth][0] in stop:
                return

    at = 0
    for token in _TOKEN.finditer(page):
        start, end = token.span()
        if start > at:
            text = page[at:start]
            pieces.append(text)
            if links > 0:
                nodes[here].linked += len(text)
        at = end
        name = token["tag"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name in VOID:
                if name == "br":
                    pieces.append(" ")
                continue
            for depth in range(len(opened) - 1, -1, -1):
                if opened[depth][0] == name:
                    close_to(depth)
                    break
                if name in INLINE and opened[depth][0] not in INLINE:
                    break
            continue
        if name in CLOSES_P:
            close({"p"}, BARRIER)
        if name in SAME_LEVEL:
            close(*SAME_LEVEL[name])
        if name in VOID:
            if name in ("br", "wbr"):
                pieces.append(" " if name == "br" else "")
            elif name == "hr":
                end_block()
            continue
        attrs = token["attrs"]
        if attrs.endswith("/") and name in ("svg", "path", "use"):
            continue
        if name not in INLINE:
            end_block()
            names: tuple[str, ...] = ()
            if "=" in attrs:
                found = [(m[1].lower(), _CAMEL.sub(r"\1 \2", m[2] or m[3] or m[4] or "").lower()) for m in _NAMED.finditer(attrs)]
                words = [w for _, f in found for w in _WORD.findall(f)]
                names = tuple(dict.fromkeys(words + ["role " + w for kind, f in found if kind == "role" for w in _WORD.findall(f)]))
            nodes.append(Node(name, here, names, unseen=nodes[here].unseen or name in UNSEEN))
            here = len(nodes) - 1
        links += name == "a"
        opened.append((name, here))
    if at < len(page):
        pieces.append(page[at:])
    end_block()
    _mark_left_out(nodes)
    return nodes, blocks


def _mark_left_out(nodes: list[Node]) -> None:
    """Tell nodes what surrounds them. Names and roles announce a left-out part only
    where no article, main or h1 element lies below them, as layouts are named so too."""
    named = [any(w in LEFT_OUT or w[:5] == "role " and w[5:] in LEFT_OUT_ROLES for w in n.names) for n in nodes]
    holds = [n.tag in ("article", "main", "h1") and not of for n, of in zip(nodes, named, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    for node, of, main in zip(nodes, named, holds, strict=True):
        node.left_out = of and not main and node.tag not in PAGE
        if node.parent >= 0:
            above = nodes[node.parent]
            own = {"in left out"} if above.left_out else set()
            own |= {"in tag " + above.tag} if above.tag in NOT_MAIN else set()
            node.inside = above.inside if above.inside >= own else above.inside | own


def observations(node: Node) -> tuple[str, ...]:
    """What the node's own potential sees."""
    size = sum(map(len, node.pieces))
    length = "none" if not size else "short" if size < 40 else "line" if size < 160 else "long"
    linked = "links" if size and node.linked > 0.5 * size else "plain"
    return ("", "tag " + node.tag, f"text {length} {linked}", *("name " + w for w in node.names), *(["left out"] * node.left_out), *node.inside)


@dataclass
class Model:
    """Weights of observations, and log weights of (parent, child) states."""

    weights: dict[str, float] = field(default_factory=dict)
    joint: tuple[tuple[float, float], tuple[float, float]] = ((1.0, -1.0), (-1.0, 1.0))

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[float], list[float]]:
        """Odds of content at each node; its own message up and the odds above it."""
        (w00, w01), (w10, w11) = ((math.exp(x) for x in row) for row in self.joint)
        get = self.weights.get
        odds, up, above = [], [1.0] * len(nodes), [1.0] * len(nodes)
        for node in nodes:
            own = sum(get(o, 0.0) for o in observations(node))
            odds.append(math.exp(max(-30.0, min(30.0, own))))
        for i in range(len(nodes) - 1, 0, -1):
            r = odds[i]
            up[i] = (w10 + w11 * r) / (w00 + w01 * r)
            p = nodes[i].parent
            odds[p] = min(1e60, max(1e-60, odds[p] * up[i]))
        for i in range(1, len(nodes)):
            q = odds[nodes[i].parent] / up[i]
            above[i] = q
            odds[i] = min(1e60, max(1e-60, odds[i] * (w01 + w11 * q) / (w00 + w10 * q)))
        return odds, up, above


def label_nodes(nodes: list[Node], content: set[int]) -> list[int]:
    """1 for nodes with content text, and for those with mostly content below them; the
    page as a whole is never content."""
    inside = [0] * len(nodes)
    outside = [0] * len(nodes)
    for i, node in enumerate(nodes):
        size = sum(map(len, node.pieces))
        (inside if i in content else outside)[i] += size
    for i in range(len(nodes) - 1, 0, -1):
        inside[nodes[i].parent] += inside[i]
        outside[nodes[i].parent] += outside[i]
    return [int(i in content or (not n.pieces and inside[i] > outside[i] and n.tag not in PAGE)) for i, n in enumerate(nodes)]


def self_labelled(nodes: list[Node]) -> set[int] | None:
    """Nodes with the text of the only article (or main) element, if there is one."""
    for name in ("article", "main"):
        found = [i for i, n in enumerate(nodes) if n.tag == name]
        if len(found) == 1:
            inside = {found[0]}
            for i in range(found[0] + 1, len(nodes)):
                if nodes[i].parent in inside and nodes[i].tag not in NOT_MAIN and not nodes[i].left_out:
                    inside.add(i)
            return {i for i in inside if nodes[i].pieces}
    return None


# Words of class and id names that announce what is not the article.
LEFT_OUT = set(
    "ad ads advert advertisement sponsor sponsored promo banner sidebar aside nav navigation menu breadcrumb footer header masthead comment comments respond reply cookie consent notice newsletter subscribe signup share sharing social related recommended popup modal form search login widget tags pagination disclaimer copyright paywall teaser alert gdpr toolbar".split()
)

# Roles of elements (WAI-ARIA) that are not the article.
LEFT_OUT_ROLES = set("navigation contentinfo banner complementary search form dialog alert alertdialog status menu menubar toolbar".split())


def hand_labelled() -> Iterator[tuple[str, set[str]]]:
    """Pages written for training: markup and the blocks that are the article.

    Each has one article in one of the usual wrappings and one of each left-out part,
    named with each of the words and roles above in turn, beside or inside it.
    """
    long = "The bridge was closed for a week, and the crews measured every joint before traffic returned, as planned by the city."
    more = "Engineers compared the readings with those of last year; the difference was small, but they kept the sensors in place."
    short = "It held."
    remark = "This is another remark that is no part of the story, though it reads like one."
    wrappings = [
        "<article>{}</article>",
        "<main>{}</main>",
        '<div class="post-content">{}</div>',
        '<div id="content">{}</div>',
        '<section class="entry body">{}</section>',
        '<div class="article-body story">{}</div>',
        "<main><article>{}</article></main>",
        '<div id="main" role="main"><div class="text">{}</div></div>',
        "<div>{}</div>",
    ]
    inners = [
        f"<h1>Bridge reopens</h1><p>{long}</p><p>{short}</p><h2>Readings</h2><blockquote><p>{more}</p></blockquote><ul><li>{long[:60]}</li><li>{more}</li></ul><pre>{short}</pre>",
        f"<h1>Bridge reopens</h1><p>{long}</p><p>{short}</p>",
        f"<p>{long}</p><p>{more}</p><p>{long}</p><p>{more}</p>",
        f"<h2>Readings</h2><p>{short}</p>",
        f"<h1>Bridge reopens</h1><h3>Readings</h3><div><p>{more}</p><p>{short}</p></div><p>{short}</p><p>{long}</p>",
    ]
    text = {"Bridge reopens", "Readings", long, more, short, long[:60].strip()}
    parts = [
        "<header><a href='/'>Home</a><p>Daily Site</p></header><nav><ul><li><a href='/a'>News</a></li><li><a href='/b'>Sport</a></li></ul></nav>",
        "<aside><h3>Related</h3><ul><li><a href='/c'>Older story about the river</a></li></ul><p>Most read this week by our readers, chosen daily.</p></aside>",
        "<form action='/s'><p>Sign up for our letter today</p><label>Mail</label><input name='m'></form>",
        "<footer><p>Copyright 2024, all rights reserved, reprinted only with permission of the publisher and its partners.</p><div>Imprint</div></footer>",
    ]
    marks = [(("class", "id")[k % 2], word) for k, word in enumerate(sorted(LEFT_OUT) * 2)] + [("role", r) for r in sorted(LEFT_OUT_ROLES) * 2]
    links = "<ul><li><a href='/a'>News</a></li><li><a href='/b'>Sport</a></li></ul>"
    for k, (kind, word) in enumerate(marks):
        inner = inners[k % len(inners)]
        named = f"<div {kind}='{word}'><h3>Look here</h3><p>This is a fine remark, I think, and it goes on for quite a while, as remarks do.</p><div>Reply now</div></div>"
        tag = ("div", "section", "p", "article", "div")[k // 4 % 5]
        single = f"<{tag} {kind}='{word}'>{remark}</{tag}>" if tag == "p" else f"<{tag} {kind}='{word}'><p>{remark}</p></{tag}>"
        plain = ("aside", "header", "footer", "form", "nav")[k // 3 % 5]
        before, after = "", ["", ""]
        if k % 3 == 0:  # as readers' comments often stand, inside the article
            after[1], named = named, ""
        elif k % 3 == 1:  # an element of a kind of its own inside the article
            after[1] = f"<{plain}><p>{remark}</p></{plain}>"
        if k % 4 == 1:
            after[0] = single
        elif k % 4 == 2:
            before = single
        elif k % 4 == 3:
            named += single
        wrapped = wrappings[k % len(wrappings)].format(before + inner + "".join(after))
        if k % 7 == 2:  # a layout of table cells
            wrapped = f"<table><tr><td>{links}</td><td>{wrapped}</td></tr></table>"
        yield f"<html><body>{parts[0]}{named}{wrapped}{''.join(parts[1:])}</body></html>", text


def train(pages: list[str], rounds: int = ROUNDS, rate: float = 1.0, ridge: float = 0.0003) -> Model:
    """Weights from the hand-labelled pages and those of ``pages`` that label themselves."""
    labelled = []
    for page, text in hand_labelled():
        nodes, blocks = parse(page)
        labelled.append((nodes, label_nodes(nodes, {i for i, b in blocks if b in text})))
    hand = len(labelled)
    for page in pages:
        nodes, _ = parse(page)
        content = self_labelled(nodes)
        if content:
            labelled.append((nodes, label_nodes(nodes, content)))
    model = Model()
    seen = [[observations(n) for n in nodes] for nodes, _ in labelled]
    names = {o: i for i, o in enumerate(dict.fromkeys(o for page in seen for node in page for o in node))}
    theta, squares = np.zeros(len(names) + 4), np.full(len(names) + 4, 1e-6)
    theta[-4:] = [1.0, -1.0, -1.0, 1.0]
    for _ in range(rounds):
        slope = -ridge * theta
        model.weights = {o: float(theta[i]) for o, i in names.items()}
        model.joint = ((theta[-4], theta[-3]), (theta[-2], theta[-1]))
        (w00, w01), (w10, w11) = ((math.exp(x) for x in row) for row in model.joint)
        for k, (nodes, truth) in enumerate(labelled):
            share = 1.0 / hand if k < hand else 1.0 / max(1, len(labelled) - hand)
            odds, up, above = model.marginals(nodes)
            for i, node_names in enumerate(seen[k]):
                off = share * (truth[i] - odds[i] / (1 + odds[i]))
                for o in node_names:
                    slope[names[o]] += off
                if i:
                    q = above[i]
                    below = odds[i] / ((w01 + w11 * q) / (w00 + w10 * q))
                    both = np.array([w00, w01 * below, q * w10, q * w11 * below])
                    slope[-4:] -= share * both / both.sum()
                    slope[-4 + 2 * truth[nodes[i].parent] + truth[i]] += share
        squares += slope**2
        theta += rate * slope / np.sqrt(squares)
    model.weights = {o: float(theta[i]) for o, i in names.items()}
    model.joint = ((float(theta[-4]), float(theta[-3])), (float(theta[-2]), float(theta[-1])))
    return model


def main_text(model: Model, page: str | None) -> str:
    """Blocks of content nodes, one per line; empty if there are none."""
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    odds, _, _ = model.marginals(nodes)
    return "\n".join(text for i, text in blocks if odds[i] >= 1.0)


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points), one row per page.

    The model is trained on at most ``train_pages`` of the pages, chosen by a hash of
    the id. A null or empty page has an empty text. Markup that is cut off or badly
    nested is read as far as it goes.
    """
    order = F.xxhash64(F.lit("pages"), F.col("page_id"))
    # The ids are chosen first: only the pages that are asked for go to the driver.
    chosen = pages.filter("page_id is not null").select("page_id").orderBy(order, "page_id").limit(train_pages).distinct()
    rows = pages.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect()
    model = train([r.html for r in sorted(rows, key=lambda r: r.page_id) if r.html])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = {n: pages.schema[n].dataType.simpleString() for n in ("page_id", "url")}
    found = pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
