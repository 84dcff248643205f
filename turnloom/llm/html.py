"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: the text between the edges of block-level elements.
A logistic classifier over shallow features (words, link share, stop words,
punctuation, tag) and what a block's ancestors say of themselves (tags, roles,
class names) give each block the cost of calling it content and of calling it
boilerplate; these are the capacities of its terminal edges.  Neighbours in page
order, and blocks with a common parent (by way of a node for that parent), pull
each other to the same label, whatever their markup says.  The minimum cut is the
cheapest labelling.  Only text that is not shown (scripts, styles, ``hidden``) is
boilerplate for certain.

The classifier is trained here, on at most ``SAMPLE_PAGES`` distinct pages (those
with the smallest hashes), with the labels that telling markup gives.  Hashes
alone are sorted to find them; a page that is repeated counts once.  Everything
else is per page and covers whole pages.

* A null or empty html, and a page without content, give an empty text.
* A cut-off page is read as far as it goes.
* Other columns and repeated rows don't matter; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.mincut import min_cut
from turnloom.llm.quality import STOP_WORDS

SAMPLE_PAGES = 1000
UNIT = 1000  # capacities are whole numbers
SURE = 1000 * UNIT
NEXT_TO = 600
SAME_PARENT = 300
CLIP = 3.0
# What markup adds to the log odds: an article around a block, an article elsewhere on the page, a telling tag, role or name.
# Neighbours and the classifier together can outvote each of them.
ARTICLE = 3.5
OUTSIDE = -2.0
MARKED = -3.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")
_RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "title"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - {"body", "head", "html", "option", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
# What an open element ends when the next of its kind begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_BAD_TAGS = set("nav footer aside form button select menu dialog search head fieldset".split())
_BAD_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_BAD_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion sidebar sidebars rail nav navbar navigation "
    "menu menus breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social related recommended recommendations widget widgets "
    "popup modal overlay banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login pagination "
    "pager comment comments disqus replies reply respond discussion skip copyright legal outbrain taboola teaser teasers".split()
)
_BAD_ARTICLES = set("comment comments reply ad ads advert promo sponsored related teaser".split())
_GOOD_NAMES = set("article content post entry story main body text".split())
_STOP = frozenset(STOP_WORDS)


@dataclass
class Node:
    tag: str
    parent: int  # place of the parent among the nodes, -1 for none
    state: int  # -2 not shown, -1 marked as boilerplate, 1 inside the article, 0 neither


@dataclass
class Block:
    parent: int
    state: int
    heading: bool
    item: bool
    text: str = ""
    link_chars: int = 0
    runs: list[tuple[str, bool]] = field(default_factory=list)


def _state(tag: str, attrs: str, above: int) -> int:
    """What an element says of the text in it."""
    if above < -1:
        return above
    words = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if attrs.strip() else {}
    if "hidden" in words or words.get("aria-hidden") == "true":
        return -2
    if above < 0:
        return above
    role = words.get("role", "").lower()
    names: list[str] = []
    for value in (words.get("class", ""), words.get("id", "")):
        parts = _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
        names += [n for i, n in enumerate(parts) if not (i and parts[i - 1] in ("no", "has", "with", "without"))]
    if tag in _BAD_TAGS or role in _BAD_ROLES:
        return -1
    if tag == "header" and not above:
        return -1
    if tag in ("html", "body"):
        return above
    if tag in ("article", "main") or role in ("article", "main"):
        return -1 if _BAD_ARTICLES & set(names) else 1
    if _BAD_NAMES & set(names) or ("header" in names and not above):
        return -1
    return above


def blocks_of(html: str) -> tuple[list[Node], list[Block]]:
    """The elements of a page and its blocks of text, in order."""
    nodes = [Node("", -1, 0)]
    blocks: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements with the node they are in
    links = 0
    block: Block | None = None

    def node() -> int:
        return stack[-1][1] if stack else 0

    def text(raw: str) -> None:
        nonlocal block
        if not raw:
            return
        if block is None:
            if raw.isspace():
                return
            own = node()
            block = Block(own, nodes[own].state, any(t in ("h1", "h2", "h3", "h4", "h5", "h6") for t, _ in stack[-3:]), nodes[own].tag in ("li", "td", "th", "dt", "dd"))
            blocks.append(block)
        block.runs.append((raw, links > 0))

    def close(at: int) -> None:
        nonlocal links, block
        for tag, _ in stack[at:]:
            links -= tag == "a"
            if tag in _BLOCK:
                block = None
        del stack[at:]

    at = 0
    while True:
        found = _TOKEN.search(html, at)
        if not found:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in _BLOCK:
                block = None
            if (k := next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)) is not None:
                close(k)
            continue
        if tag in _RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            text(" ")
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                block = None
            continue
        if tag in _ENDS_P and (k := next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), None)) is not None:
            close(k)
        if tag in _ENDS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _HOLDS[tag]:
                    break
                if stack[k][0] in _ENDS[tag]:
                    close(k)
                    break
        if tag in _BLOCK:
            block = None
        own = node()
        state = _state(tag, found[3], nodes[own].state)
        if tag in _BLOCK or state != nodes[own].state:
            if state != nodes[own].state:
                block = None
            nodes.append(Node(tag, own, state))
            own = len(nodes) - 1
        stack.append((tag, own))
        links += tag == "a"
    kept = []
    for b in blocks:
        runs = [(unescape(raw), linked) for raw, linked in b.runs]
        b.text = " ".join("".join(r for r, _ in runs).split())
        b.link_chars = sum(len("".join(r.split())) for r, linked in runs if linked)
        if b.text:
            kept.append(b)
    return nodes, kept


def features(b: Block) -> list[float]:
    words = b.text.split()
    n = len(words)
    return [
        1.0,
        np.log1p(n),
        min(1.0, b.link_chars / max(1, len(b.text) - n + 1)),
        sum(w.strip(".,;:!?").lower() in _STOP for w in words) / n,
        float(b.text[-1] in ".!?\"”»"),
        float(b.heading),
        float(b.item),
    ]


# Used where a sample gives no labels of both kinds.
DEFAULT = (-1.5, 0.8, -4.0, 2.0, 0.8, 0.5, -0.5)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES, rounds: int = 30) -> tuple[float, ...]:
    """Weights of the classifier, from blocks whose markup tells what they are."""

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # of at most ``sample`` hashes
        for batch in batches:
            rows: list[tuple] = []
            for page, html in zip(batch["page"], batch["html"]):
                if page in seen:
                    continue
                seen.add(page)
                found = Counter((*features(b), float(b.state > 0)) for b in blocks_of(html)[1] if b.state)
                rows += [(page, *row, n) for row, n in found.items()]
            yield pd.DataFrame(rows, columns=["page", *names, "n"])

    names = [f"f{i}" for i in range(len(DEFAULT))] + ["y"]
    hashed = pages.where("html IS NOT NULL").select(F.xxhash64("html").alias("page"), "html")
    last = hashed.select("page").distinct().orderBy("page").limit(sample).agg(F.max("page")).first()[0]
    if last is None:
        return DEFAULT
    rows = hashed.where(F.col("page") <= last).mapInPandas(labelled, "page long, " + ", ".join(f"{n} double" for n in names) + ", n long")
    once = rows.groupBy("page", *names).agg(F.max("n").alias("n"))  # copies of a page are in several tasks
    data = once.groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names).toPandas().to_numpy(float)
    x, y, n = data[:, :-2], data[:, -2], data[:, -1]
    if not len(data) or not 0 < y.sum() < len(y):
        return DEFAULT
    w = np.zeros(x.shape[1])
    share = np.where(y > 0, n / n[y > 0].sum(), n / n[y == 0].sum()) * n.sum() / 2  # both kinds weigh the same
    for _ in range(rounds):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(np.round(w, 6).tolist())


def label(nodes: list[Node], blocks: list[Block], weights: tuple[float, ...]) -> list[bool]:
    """Which blocks are content: the minimum cut."""
    articles = any(b.state > 0 for b in blocks)
    content, boiler = [], []
    for b in blocks:
        if b.state < -1:
            content.append(0)
            boiler.append(SURE)
            continue
        odds = max(-CLIP, min(CLIP, float(np.dot(weights, features(b)))))
        if b.state < 0:
            odds += MARKED
        elif articles:
            odds += ARTICLE if b.state > 0 else OUTSIDE
        # What it costs to call it boilerplate, and to call it content.
        content.append(round(UNIT * np.logaddexp(0, odds)))
        boiler.append(round(UNIT * np.logaddexp(0, -odds)))
    n = len(blocks)
    edges = [(i, i + 1, NEXT_TO // (1 if a.parent == b.parent else 2)) for i, (a, b) in enumerate(zip(blocks, blocks[1:]))]
    parents: dict[int, int] = {}
    for i, b in enumerate(blocks):
        for k in {b.parent, nodes[b.parent].parent} - {-1}:
            edges.append((i, parents.setdefault(k, n + len(parents)), SAME_PARENT))
    free = [0] * len(parents)
    return min_cut(content + free, boiler + free, edges)[:n]


def main_text(html: str | None, weights: tuple[float, ...] = DEFAULT) -> str:
    nodes, blocks = blocks_of(html or "")
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, keep in zip(blocks, label(nodes, blocks, weights)) if keep)


def extract(pages: DataFrame, weights: tuple[float, ...] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    weights = fit(pages) if weights is None else weights

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=[main_text(h, weights) for h in batch["html"]])

    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    out = rows.mapInPandas(extracted, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
