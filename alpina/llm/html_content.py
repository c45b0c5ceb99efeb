"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a node with a hidden label (content or not). Node potentials
come from hashed features (tag, classes and ids, parent's tag, text length and
link share in bins); parent-child potentials couple the labels along the tree.
Sum-product messages go from the leaves up and from the root down, all pages
of a batch level by level, and give each node's content marginal. Text of nodes
with a marginal above one half is the page's text.

The model is trained on labelled pages: a bounded sample (``MAX_PAGES`` pages
of at most ``MAX_CHARS`` characters, chosen by a hash) whose node labels come
from the page's own landmarks - inside ``article`` or ``main`` content, except
menus, asides, forms, adverts and comments in it. Pages without landmarks train
nothing. Weights follow the gradient of the likelihood of the labels, with
marginals from the same messages. Labels are used in training alone; scoring
sees the features.

Text: character references are decoded as browsers do, white space inside a
block becomes one space, blocks are joined in page order by a line feed; a
``br`` is white space. Scripts, styles, templates and comments have no text.

Defined results: a null or empty html gives the empty text; broken markup is
read as far as it goes (open elements end with their parent); pages without a
content node give the empty text; repeated rows give repeated results; without
any labelled page a fixed prior on landmark tags is used; an empty table gives
an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_groups

MAX_PAGES, MAX_CHARS = 400, 60_000
FEATURES = 1 << 14
#: fixed values of HTML: elements without content, raw-text elements, inline elements, elements that close an open paragraph
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
HIDDEN = frozenset("script style noscript template iframe head title textarea select option button svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSE_P = frozenset(("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul").split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: fixed values: landmarks that label training pages
CONTENT_TAGS = frozenset(["article", "main"])
OTHER_TAGS = frozenset("nav header footer aside form script style noscript template iframe button select head title menu dialog".split())
OTHER_NAMES = re.compile(r"(?:^|[-_ ])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar|footer|header|cookie\w*|notice\w*|consent|comments?|respond|share|social|related|newsletter|subscribe|popup|modal|breadcrumbs?|pagination)(?:$|[-_ ])", re.I)

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


@dataclass
class Tree:
    """Nodes of a page in page order: parent number, tag, names; and runs of text as (node, text, block number).

    The block number grows wherever a block element begins or ends.
    """

    parents: list[int]
    tags: list[str]
    names: list[str]
    texts: list[tuple[int, str, int]]


def parse(page: str) -> Tree:
    """Read a page into a tree in one pass over its tags."""
    t = Tree([-1], ["#root"], [""], [])
    tags, stack, opened = t.tags, [0], Counter()
    at = pos = number = 0

    def cut(i: int):
        for n in stack[i:]:
            opened[tags[n]] -= 1
        del stack[i:]

    while m := TAG.search(page, pos):
        if m.start() > at:
            t.texts.append((stack[-1], page[at:m.start()], number))
        at = pos = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        splits = tag not in INLINE and tag not in HIDDEN
        number += splits
        if m[1]:
            if opened[tag]:
                i = len(stack) - 1
                while tags[stack[i]] != tag and (splits or tags[stack[i]] in INLINE):
                    i -= 1
                if tags[stack[i]] == tag:  # an inline element is not ended across a block
                    cut(i)
            continue
        if tag in CLOSE_P and opened["p"]:
            i = len(stack) - 1
            while tags[stack[i]] in INLINE:
                i -= 1
            if tags[stack[i]] == "p":
                cut(i)
        if tag in SAME:
            i = len(stack) - 1
            while i and tags[stack[i]] not in SAME[tag] and tags[stack[i]] not in STOP[tag]:
                i -= 1
            if i and tags[stack[i]] in SAME[tag]:
                cut(i)
        names = " ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(m[3])) if m[3] else ""
        t.parents.append(stack[-1])
        tags.append(tag)
        t.names.append(names)
        own = len(tags) - 1
        if tag in VOID:
            if tag == "br":
                t.texts.append((stack[-1], " ", number))
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            t.texts.append((own, page[pos:end.start()] if end else page[pos:], number))
            at = pos = end.end() if end else len(page)
        else:
            stack.append(own)
            opened[tag] += 1
    if len(page) > at:
        t.texts.append((stack[-1], page[at:], number))
    return t


def _bin(x: float) -> int:
    """Coarse size class: a factor of eight each, so short and long blocks of one kind stay alike."""
    return int(np.log2(1 + x) / 3)


@lru_cache(1 << 16)
def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % FEATURES


def node_features(t: Tree) -> list[list[int]]:
    """Hashed features of each node; text and link lengths are of the node's whole subtree."""
    n = len(t.parents)
    length, linked = [0] * n, [0] * n
    for node, s, _ in t.texts:
        k = len(s.strip())
        length[node] += k
        if t.tags[node] == "a":
            linked[node] += k
    for i in range(n - 1, 0, -1):
        length[t.parents[i]] += length[i]
        linked[t.parents[i]] += length[i] if t.tags[i] == "a" else linked[i]
    out = []
    for i in range(n):
        p = t.parents[i]
        link = int(4 * min(linked[i], length[i]) / length[i]) if length[i] else 5
        f = [f"t={t.tags[i]}", f"tp={t.tags[i]}/{t.tags[p] if p >= 0 else ''}", f"len={_bin(length[i])}", f"link={link}", f"tl={t.tags[i]}/{link}"]
        f += [f"n={x.lower()}" for x in t.names[i].split()]
        f += [f"m={m.group(0).strip('-_ ').lower()}" for m in OTHER_NAMES.finditer(t.names[i])]
        out.append([_hash(x) for x in f])
    return out


def landmark_labels(t: Tree) -> np.ndarray | None:
    """Node labels from a page's own landmarks; none if it has no content landmark."""
    if not CONTENT_TAGS.intersection(t.tags):
        return None
    y = np.zeros(len(t.parents), bool)
    barred = np.zeros(len(t.parents), bool)
    for i in range(1, len(t.parents)):
        p = t.parents[i]
        barred[i] = barred[p] or t.tags[i] in OTHER_TAGS and not (t.tags[i] == "header" and y[p]) or bool(t.names[i] and OTHER_NAMES.search(t.names[i]))
        y[i] = not barred[i] and (y[p] or t.tags[i] in CONTENT_TAGS)
    return y


@dataclass
class Forest:
    """All trees of a batch as flat arrays: parents, levels from the roots down, features with their owners."""

    parents: np.ndarray
    levels: list[np.ndarray]
    feature: np.ndarray
    owner: np.ndarray
    starts: np.ndarray


def forest(trees: list[Tree]) -> Forest:
    sizes = np.array([len(t.parents) for t in trees], np.int64)
    starts = np.cumsum(sizes) - sizes
    parents = np.concatenate([np.array(t.parents, np.int64) + np.where(np.array(t.parents) >= 0, s, 0) for t, s in zip(trees, starts)])
    depth = np.zeros(len(parents), np.int64)
    for t, s in zip(trees, starts):
        d = [0] * len(t.parents)
        for i in range(1, len(d)):
            d[i] = d[t.parents[i]] + 1
        depth[s:s + len(d)] = d
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    features = [f for t in trees for f in node_features(t)]
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    return Forest(parents, levels, np.array([x for f in features for x in f], np.int64), owner, starts)


@dataclass(frozen=True)
class Model:
    """Feature weights, bias and the parent-child potentials ``[parent, child]``."""

    weights: np.ndarray
    bias: float
    pair: np.ndarray


def messages(scores: np.ndarray, f: Forest, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-product on every tree: ``(inward, outward, to_parent)`` log-odds.

    ``inward`` holds a node's own score and the messages of its children,
    ``to_parent`` what it tells its parent, ``outward`` what its parent tells it.
    """
    (e00, e01), (e10, e11) = np.exp(pair)
    inward, to_parent, outward = scores.copy(), np.zeros(len(scores)), np.zeros(len(scores))
    for level in reversed(f.levels[1:]):
        r = np.exp(np.clip(inward[level], -30, 30))
        to_parent[level] = np.log((e10 + r * e11) / (e00 + r * e01))
        np.add.at(inward, f.parents[level], to_parent[level])
    for level in f.levels[1:]:
        up = f.parents[level]
        r = np.exp(np.clip(inward[up] + outward[up] - to_parent[level], -30, 30))
        outward[level] = np.log((e01 + r * e11) / (e00 + r * e10))
    return inward, outward, to_parent


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(pages: list[str], rounds: int = 80, ridge: float = 1e-2) -> Model:
    """Fit node and parent-child potentials on the pages that label themselves."""
    trees = [(t, y) for t in map(parse, pages) if (y := landmark_labels(t)) is not None]
    if not trees:
        # a prior on landmark tags, for corpora without any labelled page
        weights = np.zeros(FEATURES)
        for tag in CONTENT_TAGS:
            weights[_hash(f"t={tag}")] = 6.0
        for tag in OTHER_TAGS:
            weights[_hash(f"t={tag}")] = -6.0
        for tag in ("p", "h1"):
            weights[_hash(f"t={tag}")] = 2.0
        return Model(weights, -1.0, np.array([[1.0, -1.0], [-1.0, 1.0]]))
    f = forest([t for t, _ in trees])
    y = np.concatenate([y for _, y in trees]).astype(float)
    child = np.flatnonzero(f.parents >= 0)
    up = f.parents[child]
    seen = np.array([((1 - y[up]) * (1 - y[child])).sum(), ((1 - y[up]) * y[child]).sum(), (y[up] * (1 - y[child])).sum(), (y[up] * y[child]).sum()])
    weights, bias, pair = np.zeros(FEATURES), -1.0, np.zeros((2, 2))
    g_w, g_b, g_p = np.full(FEATURES, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(rounds):
        scores = np.bincount(f.owner, weights[f.feature], len(y)) + bias
        inward, outward, to_parent = messages(scores, f, pair)
        error = y - _sigmoid(inward + outward)
        left, right = inward[up] + outward[up] - to_parent[child], inward[child]
        joint = np.stack([np.zeros_like(left) + pair[0, 0], right + pair[0, 1], left + pair[1, 0], left + right + pair[1, 1]])
        joint = np.exp(joint - np.logaddexp.reduce(joint, axis=0)).sum(axis=1)
        grad = np.bincount(f.feature, error[f.owner], FEATURES) - ridge * weights
        grad_p = (seen - joint).reshape(2, 2) - ridge * pair
        g_w += grad ** 2
        g_b += error.sum() ** 2
        g_p += grad_p ** 2
        weights += 0.3 * grad / np.sqrt(g_w)
        bias += 0.1 * error.sum() / np.sqrt(g_b)
        pair = pair + 0.2 * grad_p / np.sqrt(g_p)
    return Model(weights, bias, pair)


def block_text(t: Tree, content: np.ndarray) -> str:
    """Text of content nodes, a line for each block."""
    hidden = [False] * len(t.parents)
    for i in range(1, len(hidden)):
        hidden[i] = hidden[t.parents[i]] or t.tags[i] in HIDDEN
    lines: dict[int, list[str]] = {}
    for node, s, number in t.texts:
        if content[node] and not hidden[node]:
            lines.setdefault(number, []).append(s)
    joined = (" ".join(html_lib.unescape("".join(x)).split()) for x in lines.values())
    return "\n".join(x for x in joined if x)


class Extractor:
    def __init__(self, model: Model):
        self.model = model

    def texts(self, pages: list[str]) -> list[list[str]]:
        if not pages:
            return [[]]
        trees = [parse(p) for p in pages]
        f = forest(trees)
        m = self.model
        inward, outward, _ = messages(np.bincount(f.owner, m.weights[f.feature], len(f.parents)) + m.bias, f, m.pair)
        content = inward + outward > 0
        return [[block_text(t, content[s:s + len(t.parents)]) for t, s in zip(trees, f.starts)]]


def training_pages(pages: DataFrame, most: int = MAX_PAGES, max_chars: int = MAX_CHARS) -> list[str]:
    """The texts of at most ``most`` pages, those with the smallest hash of page number and URL, in its order.

    A page counts once, however many rows it has; of differing rows the smallest text is taken.
    """
    h = F.xxhash64("page_id", "url")
    able = pages.where(F.length("html").between(1, max_chars)).select(h.alias("h"), F.col("html").cast("string").alias("html"))
    last = [r["h"] for r in able.select("h").distinct().orderBy("h").limit(most).collect()]
    if not last:
        return []
    rows = able.where(F.col("h") <= max(last)).groupBy("h").agg(F.min("html").alias("html")).collect()
    return [r["html"] for r in sorted(rows)]


def content_model(pages: DataFrame, most: int = MAX_PAGES, max_chars: int = MAX_CHARS) -> Model:
    """Train on :func:`training_pages`."""
    return train(training_pages(pages, most, max_chars))


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    model = model or content_model(pages)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # FEATURES weights

    def run(batches):
        import pyarrow as pa
        extract = Extractor(shared.value).texts
        for batch in batches:
            pages_in = ["" if x is None else x for x in batch.column(2).to_pylist()]
            for part in text_groups(pages_in):
                got = pa.array(extract(pages_in[part])[0], pa.string())
                n = part.stop - part.start
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, n), batch.column(1).slice(part.start, n), got], names=["page_id", "url", "text"])

    page_type, url_type = pages.schema["page_id"].dataType.simpleString(), pages.schema["url"].dataType.simpleString()
    made = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(run, f"page_id {page_type}, url {url_type}, text string")
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
