"""Main-text extraction: boosted trees over DOM nodes, decoded hierarchically.

A page is read into a tree of its block elements. Every node has features of
its subtree (text, links, tags and their densities), of its attribute tokens,
of its depth, siblings and place, and of its ancestors. Gradient-boosted
trees, trained on nodes of sampled pages, give each node's log-odds of being
article content. The decoder then chooses, for the whole tree at once, the
best set of nodes in which no node is kept below a dropped one: a subtree is
kept if the log-odds inside it, weighted by their text, add up to more than
nothing.

Labels come from the pages themselves: nodes inside the element a page marks
as its article, and not inside anything that names itself a menu, advert,
comment and the like, are content. So that the trees do not lean on that mark
alone, each training page also comes without its telling tags and tokens, and
twice with boilerplate and reader comments grafted into and behind its article
and paragraphs under other tags, once with the article's mark and once without.
Only pages with a mark are counted and drawn; where no page has one, fixed
rules on links and telling tags stand in for the trees.

Text: character references decoded, white space inside a block is one space,
blocks joined by a line feed in page order; nothing else is cut. A line break
element is white space.

Defined cases: null html is empty and gives empty text; a page without any
block that is kept gives empty text; unclosed or crossing tags are closed as
browsers do; null ids and repeated rows pass through. Only page_id, url and
html are read.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_fraction, sigmoid, text_slices

MAX_PAGES = 500  # marked pages that train, about
# a tag that may mark the article, seen without parsing
MARKED = r"(?i)<article[\s/>]|<[^<>]*main"
TREES, LEAF_DEPTH, RATE, BINS = 50, 4, 0.25, 32

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)",
                       re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template textarea title iframe".split())  # run to their closing tag
# hold no text of the page either; without a closing tag they end with their
# parent or before the next block element
DROPPED = set("noscript svg canvas select object button audio video".split())
ONE_AT_A_TIME = {"button", "select", "noscript"}  # a second one ends the first
HEAD_TAGS = set("meta link title style script base noscript template".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt "
             "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main "
             "menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption head "
             "legend".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"},
         "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}}

BOILER = set("""nav navbar navigation menu header masthead topbar footer sidebar aside rail ad ads
advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login form
search breadcrumb breadcrumbs pagination pager share sharing social related recommended
recommendations teaser comment comments commentlist disqus reply replies respond discussion
reactions toolbar widget copyright legal skip complementary contentinfo""".split())
CONTENT = set("article main content post entry story body text articlebody".split())
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
CONTENT_TAGS = {"article", "main"}
KINDS = ["p", "h1", "li", "div", "section", "td", "blockquote", "pre", "ul", "body"]


@dataclass
class Node:
    tag: str
    parent: "Node | None"
    tokens: frozenset = frozenset()
    parts: list = field(default_factory=list)  # text runs, child nodes and None for a block's end
    links: int = 0
    link_text: int = 0
    inline: int = 0

    def children(self):
        return [x for x in self.parts if isinstance(x, Node)]


def attribute_tokens(text: str) -> frozenset:
    out: set = set()
    for _, value in ATTRIBUTE.findall(text):
        out.update(SPLIT.split(CAMEL.sub(" ", value.strip("\"'")).lower()))
    return frozenset(out)


def dropped_ends(page: str) -> dict[int, int]:
    """Where each dropped element that has a closing tag of its own ends, by
    the end of its opening tag. A closing tag behind the parent's, or inside a
    block that is still open, belongs to another element."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []  # open blocks and dropped elements
    at, n = 0, len(page)

    def last(tag):
        return next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)

    while at < n:
        token = TOKEN.match(page, at)
        at = token.end()
        close, start = token.group(1), token.group(2)
        if start is not None:
            tag = start.lower()
            if tag in RAW and not token.group(3).endswith("/"):
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            elif tag in DROPPED and not token.group(3).endswith("/"):
                if tag in ONE_AT_A_TIME and (i := last(tag)) is not None:
                    del stack[i]
                stack.append((tag, at))
            elif tag in BLOCKS:
                stack.append((tag, -1))
        elif close is not None:
            tag = close.lower()
            i = last(tag) if tag in BLOCKS or tag in DROPPED else None
            if i is None:
                continue
            if tag in DROPPED:
                if any(t in BLOCKS and t != "p" and t not in CLOSES for t, _ in stack[i + 1:]):
                    continue
                ends[stack[i][1]] = at
            del stack[i:]
    return ends


def parse(page: str) -> Node:
    """The tree of block elements; inline elements dissolve into their block."""
    root = Node("root", None)
    stack, at, n = [root], 0, len(page)  # open blocks
    inline: list[str] = []               # open links
    ends, dropping = None, False         # inside a dropped element without a closing tag
    while at < n:
        token = TOKEN.match(page, at)
        at = token.end()
        close, start = token.group(1), token.group(2)
        if start is None and close is None:
            text = token.group()
            if not dropping and (text[0] != "<" or text == "<"):
                node = stack[-1]
                if node.tag != "head":
                    node.parts.append(text)
                    if inline:
                        node.link_text += len(text)
            continue
        if start is not None:
            tag = start.lower()
            if stack[-1].tag == "head" and tag not in HEAD_TAGS:
                stack.pop()
            if tag in RAW:
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                if not token.group(3).endswith("/"):
                    at = end.end() if end else n
                stack[-1].inline += 1
                continue
            if tag in DROPPED:
                if not token.group(3).endswith("/"):
                    ends = dropped_ends(page) if ends is None else ends
                    dropping = dropping or at not in ends
                    at = ends.get(at, at)
                stack[-1].inline += 1
                continue
            if tag == "br" or tag == "hr":
                stack[-1].parts.append(" ")
                continue
            if dropping and tag not in BLOCKS:
                continue
            dropping = False
            if tag not in BLOCKS:
                stack[-1].inline += 1
                if tag == "a":
                    stack[-1].links += 1
                    inline.append(tag)
                continue
            if tag in ("html", "body") and any(x.tag == tag for x in stack):
                continue
            inline.clear()
            if stack[-1].tag == "p" or (stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6")
                                        and tag[0] == "h" and tag[1:].isdigit()):
                stack.pop()
            if tag in CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in LISTS[tag]:
                        break
                    if stack[i].tag in CLOSES[tag]:
                        del stack[i:]
                        break
            node = Node(tag, stack[-1], attribute_tokens(token.group(3)) if token.group(3)
                        else frozenset())
            stack[-1].parts.append(node)
            if not token.group(3).endswith("/") or tag != "p":
                stack.append(node)
            continue
        tag = close.lower()
        if tag == "a" and inline:
            inline.pop()
        elif tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    inline.clear()
                    dropping = False
                    break
    return root


def blocks_of(node: Node) -> list[str]:
    """The node's own blocks, runs of text between child blocks."""
    out, run = [], []
    for part in node.parts + [None]:
        if isinstance(part, str):
            run.append(part)
        elif run:
            text = " ".join(html_lib.unescape("".join(run)).split())
            if text:
                out.append(text)
            run = []
    return out


FEATURES = 28 + len(KINDS)


def describe(root: Node):
    """(nodes in page order, features, own text lengths, blocks by node)."""
    nodes, depth, texts = [], [], []
    walk = [(root, 0)]
    while walk:
        node, d = walk.pop()
        nodes.append(node)
        depth.append(d)
        texts.append(blocks_of(node))
        walk += [(c, d + 1) for c in reversed(node.children())]
    n = len(nodes)
    index = {id(x): i for i, x in enumerate(nodes)}
    parent = np.array([index[id(x.parent)] if x.parent is not None else -1 for x in nodes])
    own = np.array([sum(map(len, t)) for t in texts], float)
    sums = np.column_stack([
        own, [x.link_text for x in nodes], [x.links for x in nodes],
        [1 + x.inline for x in nodes], [x.tag == "p" for x in nodes],
        [x.tag == "li" for x in nodes], [len(t) for t in texts],
        [sum(s.count(".") + s.count(",") for s in t) for t in texts]]).astype(float)
    for i in range(n - 1, 0, -1):  # children come after parents
        sums[parent[i]] += sums[i]
    kids = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n)
    boiler = np.array([x.tag in BOILER_TAGS or bool(x.tokens & BOILER) for x in nodes], float)
    good = np.array([x.tag in CONTENT_TAGS or bool(x.tokens & CONTENT) for x in nodes], float)
    above_b, above_g = np.zeros(n), np.zeros(n)
    order = np.zeros(n)
    same, seen = np.zeros(n), {}
    for i in range(1, n):
        p = parent[i]
        above_b[i] = max(above_b[p], boiler[p])
        above_g[i] = max(above_g[p], good[p])
        order[i] = seen.get(p, 0)
        seen[p] = seen.get(p, 0) + 1
    for i in range(1, n):
        key = (parent[i], nodes[i].tag)
        seen[key] = seen.get(key, 0) + 1
    for i in range(1, n):
        same[i] = seen[parent[i], nodes[i].tag]
    up = sums[np.maximum(parent, 0)]
    total = sums[0] + 1e-9
    before = np.cumsum(own) - own
    siblings = kids[np.maximum(parent, 0)]
    x = np.column_stack([
        np.log1p(sums[:, 0]), np.log1p(own), sums[:, 1] / (sums[:, 0] + 1), np.log1p(sums[:, 2]),
        np.log1p(sums[:, 3]), sums[:, 0] / (sums[:, 3] + kids + 1), np.log1p(sums[:, 4]),
        np.log1p(sums[:, 5]), np.log1p(sums[:, 6]), sums[:, 7] / (sums[:, 0] + 1),
        sums[:, 0] / (sums[:, 6] + 1), sums[:, 0] / total[0], sums[:, 0] / (up[:, 0] + 1),
        depth, kids, siblings, order, order / (siblings + 1e-9), same,
        before / total[0], np.log1p(up[:, 0]), up[:, 1] / (up[:, 0] + 1), np.log1p(up[:, 4]),
        boiler, good, above_b, above_g, [len(x.tokens) for x in nodes],
    ] + [[x.tag == k for x in nodes] for k in KINDS]).astype(float)
    return nodes, parent, x, own, texts


BLIND = [23, 24, 25, 26, 27] + [28 + i for i in range(len(KINDS))]  # telling tags and tokens
CONTENT_MARKS = [24, 26]
OTHER_TEXT = ["blockquote", "li", "div", "pre", "h2", "h3", "td", "section", "dd"]


def teach(root: Node) -> np.ndarray | None:
    """1 for nodes inside the page's marked article and outside boilerplate;
    None if the page marks none."""
    nodes, parent, x, _, _ = describe(root)
    marked = np.array([n.tag in CONTENT_TAGS or "main" in n.tokens for n in nodes])
    if not marked.any():
        return None
    inside, bad = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
    for i in range(len(nodes)):
        p = parent[i]
        inside[i] = marked[i] or (p >= 0 and inside[p])
        bad[i] = x[i, 23] > 0 or (p >= 0 and bad[p])
    return (inside & ~bad).astype(float)


def _copy(node: Node, parent: Node) -> Node:
    out = Node(node.tag, parent, node.tokens, [], node.links, node.link_text, node.inline)
    out.parts = [_copy(x, out) if isinstance(x, Node) else x for x in node.parts]
    return out


def graft(root: Node, rng: random.Random) -> Node:
    """A copy of the tree with boilerplate and reader comments put into and
    behind the article, and some of its paragraphs under other tags."""
    root = _copy(root, None)
    flat, todo = [], [root]
    while todo:
        node = todo.pop()
        flat.append(node)
        todo += node.children()
    homes = [x for x in flat if x.tag in CONTENT_TAGS and x.parent is not None]
    bad = [x for x in flat if x.tag in BOILER_TAGS or x.tokens & BOILER]
    if not homes:
        return root
    article = rng.choice(homes)
    paragraphs = [x for x in article.children() if x.tag == "p"]
    names = sorted(BOILER)
    for home in (article, article, article.parent):
        at = rng.choice([0, len(home.parts), rng.randint(0, len(home.parts))])
        box = Node(rng.choice(["div", "section", "aside", "ul", "div"]), home,
                   frozenset([rng.choice(names)]))
        if paragraphs and rng.random() < 0.6:  # reader comments look like text
            box.parts = [_copy(rng.choice(paragraphs), box) for _ in range(rng.randint(1, 4))]
        elif bad:
            box.parts = [_copy(rng.choice(bad), box)]
        home.parts.insert(at, box)
    for node in paragraphs:
        if rng.random() < 0.3:
            node.tag = rng.choice(OTHER_TEXT)
    return root


def training_rows(pages: list[str]):
    """(features, labels, number of the page) of the nodes of pages that mark
    their article."""
    xs, ys, of = [], [], []
    for number, page in enumerate(pages):
        root = parse(page)
        rng = random.Random(len(page))
        for tree, blind in ((root, []), (graft(root, rng), []), (graft(root, rng), CONTENT_MARKS),
                            (root, BLIND)):
            y = teach(tree)
            if y is None:
                break
            x = describe(tree)[2]
            x[:, blind] = 0
            xs.append(x)
            ys.append(y)
            of.append(np.full(len(y), number))
    if not xs:
        return np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0, int)
    return np.vstack(xs), np.concatenate(ys), np.concatenate(of)


# --- boosted trees --------------------------------------------------------------------

@dataclass
class Boosted:
    base: float
    trees: list  # (feature, threshold, value) arrays of complete binary trees

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(LEAF_DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at]
        return out


class NodeRules:
    """Stands in for the trees where no page marks an article: everything but
    boilerplate by tag or token, and nodes that are mostly links."""

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        boilerplate = (x[:, 23] > 0) | (x[:, 25] > 0) | (x[:, 2] > 0.5)
        return np.where(boilerplate, -1.0, 1.0)


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Second-order boosting of the logistic loss over binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
             for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left")
                              for f, e in enumerate(edges)])
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(rate / (1 - rate))), [])
    raw, size = np.full(len(y), model.base), 2 ** (LEAF_DEPTH + 1) - 1
    offsets = np.arange(x.shape[1]) * BINS
    flat = binned + offsets
    for _ in range(TREES):
        p = sigmoid(raw)
        grad, hess = y - p, p * (1 - p) + 1e-6
        feature, value = np.zeros(size, dtype=np.int64), np.zeros(size)
        threshold = np.full(size, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for node in range(size):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = RATE * g / (h + 1.0)
            if node >= size // 2:
                continue
            cells = flat[rows].ravel()
            width = x.shape[1]
            gs = np.bincount(cells, np.repeat(grad[rows], width), width * BINS)
            hs = np.bincount(cells, np.repeat(hess[rows], width), width * BINS)
            gl, hl = gs.reshape(-1, BINS).cumsum(1), hs.reshape(-1, BINS).cumsum(1)
            gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            gain[(hl < 1) | (h - hl < 1)] = -1
            best = int(np.argmax(gain))
            f, b = divmod(best, BINS)
            if gain.flat[best] > 1e-6 and b < len(edges[f]):
                feature[node], threshold[node] = f, edges[f][b]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            # a node without a split sends all rows to its left child
        raw += value[at]
        model.trees.append((feature, threshold, value))
    return model


def decode(parent: np.ndarray, log_odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Nodes of the best selection that keeps no node below a dropped one."""
    n = len(parent)
    worth = log_odds * (0.05 + np.sqrt(own))
    worth[0] = 0.0
    for i in range(n - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    keep = np.zeros(n, bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = keep[parent[i]] and worth[i] > 0
    return keep


# --- Spark side -------------------------------------------------------------------------

def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Boosted | NodeRules:
    """Train on the nodes of about `max_pages` pages that mark their article,
    chosen by hashed id. Where the cheap look finds marks that parsing does
    not, more pages are drawn."""
    may_mark = F.col("html").rlike(MARKED)
    total = pages.where(may_mark).count()

    def rows(frames):
        for frame in frames:
            x, y, of = training_rows(list(frame["html"]))
            first = np.diff(of, prepend=-1) != 0
            yield pd.DataFrame({"x": [v.tobytes() for v in x.astype(np.float32)], "y": y,
                                "first": first})

    drawn = max_pages
    while True:
        got = (pages.where(F.col("html").isNotNull())
               .where(hash_fraction(F.col("page_id"), drawn, total, 41)).where(may_mark)
               .select("html").mapInPandas(rows, "x binary, y double, first boolean")
               .toPandas())  # bounded by max_pages
        labelled = int(got["first"].sum())
        if drawn >= total or labelled >= max_pages / 2:
            break
        drawn *= min(16, -(-max_pages // max(labelled, 1)))
    if not len(got):
        return NodeRules()
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), FEATURES)
    y = got["y"].to_numpy()
    order = np.lexsort((y, *x.T))  # the same training order, however rows arrived
    return boost(x[order].astype(np.float64), y[order])


def main_texts(pages: list[str], model: Boosted | NodeRules) -> list[str]:
    """Main text of each page."""
    trees = [describe(parse(p)) if p else None for p in pages]
    have = [t for t in trees if t is not None]
    if not have:
        return ["" for _ in pages]
    scores = np.split(model.log_odds(np.vstack([t[2] for t in have])),
                      np.cumsum([len(t[0]) for t in have])[:-1])
    scores = iter(scores)
    out = []
    for tree in trees:
        if tree is None:
            out.append("")
            continue
        nodes, parent, _, own, _ = tree
        keep = decode(parent, next(scores), own)
        number = {id(n): i for i, n in enumerate(nodes)}
        out.append("\n".join(_kept_blocks(nodes[0], keep, number)))
    return out


def _kept_blocks(root: Node, keep: np.ndarray, number: dict) -> list[str]:
    """Blocks of the kept nodes in page order."""
    out, run, walk = [], [], [iter(root.parts)]

    def flush():
        text = " ".join(html_lib.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    while walk:
        part = next(walk[-1], None)
        if part is None:
            flush()
            walk.pop()
        elif isinstance(part, str):
            run.append(part)
        else:
            flush()
            if keep[number[id(part)]]:
                walk.append(iter(part.parts))
    return out


def extract(pages: DataFrame, model: Boosted | NodeRules | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or fit(pages)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for part, html in text_slices(batches, "html", rows=200):
            texts = main_texts(html, model)
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
