"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every block element and every run of text is a node with a hidden state, content or not. Node potentials are log-linear
in what is seen at the node (tag, words of class, id and role, length, links, punctuation) and at the elements around it; parent-child potentials tie
a node to its parent. Sum-product messages go up the tree and down again, one numpy step for all nodes of one depth of
all pages in a batch, and give each run's content marginal; runs with at least one half are the main text. The
potentials are trained by gradient ascent on the likelihood of hand-labelled pages, the same messages giving the gradient.

Inline elements belong to the block around them, formulas, too, and amid text also what stands in for a video and the like. A line break is white space.
Scripts, styles, comments, frames and form controls amid text have no nodes and do not end a block. Null, empty or markup-only pages give an empty text; broken markup is repaired as browsers do (open
paragraphs and items are closed by the next one, stray end tags are dropped, an unclosed comment or script ends with the page).
Repeated rows give equal results, the table may be empty, other columns stay as they are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import groups, text_batches
from latewatch.llm.labelled_pages import PAGES

INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
             "strong sub sup time tt u var wbr "
             "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mmultiscripts mpadded menclose mspace semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe xmp noembed template svg select annotation annotation-xml".split())
# what is shown if something else cannot be: part of the block where it stands amid text, else an element of its own, of this kind
FALLBACK = {"noscript": ["other", "w_notice"], "object": ["figure"], "audio": ["figure"], "video": ["figure"], "canvas": ["figure"]}
INLINE |= {f"~{t}" for t in FALLBACK}  # as they are called where they are part of a block
CONTROLS = {"button", "label"}  # amid text they are left out, the block goes on
# a start tag closes an open element of these kinds, but not beyond the given borders
BORDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": set()}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEPS_P = INLINE | VOID - {"hr"} | set(FALLBACK) | {"label", "button", "option"}

TAG_KINDS = {
    "top": "html body root", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside", "article": "article", "main": "main",
    "section": "section", "div": "div center", "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl", "item": "li dt dd",
    "table": "table thead tbody tfoot tr td th caption", "form": "form fieldset legend button option optgroup label input dialog",
    "figure": "figure figcaption picture details summary", "quote": "blockquote pre address",
}
WORD_KINDS = {
    "w_menu": "menu nav navbar navigation breadcrumb breadcrumbs pagination pager tabs toc toolbar topbar top bar skip",
    "w_header": "header masthead banner hero logo branding", "w_footer": "footer bottom copyright imprint colophon contentinfo",
    "w_side": "sidebar aside side widget related recommended popular trending complementary more",
    "w_notice": "notice cookie cookies consent gdpr disclaimer alert popup modal overlay warning",
    "w_ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "w_form": "form login signup signin register search subscribe newsletter", "w_comment": "comment comments disqus reply replies respond discussion",
    "w_social": "social share sharing follow buttons tags meta byline",
    "w_content": "article content entry post story main body text page",
}
KIND_OF_TAG = {t: k for k, ts in TAG_KINDS.items() for t in ts.split()}
KINDS_OF_WORD: dict[str, list[str]] = {}
for _k, _ws in WORD_KINDS.items():
    for _w in _ws.split():
        KINDS_OF_WORD.setdefault(_w, []).append(_k)
# what is seen at an element and holds for all that lies in it
INHERITED = ["nav", "header", "footer", "aside", "article", "main", "form", "hidden", *WORD_KINDS]
FEATURES = {f: i for i, f in enumerate([
    "element", "other", "hidden", *TAG_KINDS, *WORD_KINDS, *[f"in_{f}" for f in INHERITED], "run", "len0", "len1", "len2", "len3", "links0", "links1", "links2", "stop", "sign",
])}

_GIVES = {f: FEATURES[f"in_{f}"] for f in INHERITED}
_NOWHERE: frozenset[int] = frozenset()
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^\"'>]*")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")


class Forest:
    """The trees of many pages in flat lists."""

    def __init__(self):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.run: list[bool] = []
        self.cells: list[tuple[int, int]] = []  # (node, feature)
        self.text: dict[int, str] = {}
        self.marked: list[bool] = []
        self.page: list[int] = []
        self.inside: list[frozenset[int]] = []  # inherited features, as numbers

    def add(self, page: int, parent: int, features: list[str], run: bool, marked: bool) -> int:
        k = len(self.parent)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.run.append(run)
        self.marked.append(marked)
        self.page.append(page)
        inside = self.inside[parent] if parent >= 0 else _NOWHERE
        self.cells.extend((k, FEATURES[f]) for f in features)
        self.cells.extend((k, f) for f in inside)
        given = [_GIVES[f] for f in features if f in _GIVES]
        self.inside.append(inside | set(given) if given else inside)
        return k

    def read(self, page: int, source: str) -> None:
        root = self.add(page, -1, ["element", "top"], False, False)
        stack: list[tuple[str, int]] = [("root", root)]  # open elements; inline ones have the node of their block
        opened: Counter[str] = Counter()  # how many elements of a name are open; a search for none is not begun
        buffer: list[str] = []
        filled = False
        links, linked, at, n = 0, 0, 0, len(source)
        missing: set[str] = set()

        def flush() -> None:
            nonlocal linked, filled
            filled = False
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    block = stack[-1][1]
                    share = linked / len(text)
                    k = self.add(page, block, [
                        "run", "len0" if len(text) < 25 else "len1" if len(text) < 80 else "len2" if len(text) < 200 else "len3",
                        "links0" if not linked else "links1" if share < 0.5 else "links2",
                        *["stop"] * (text[-1] in ".!?…。:;\"”"), *["sign"] * ("©" in text),
                    ], True, self.marked[block])
                    self.text[k] = text
                buffer.clear()
            linked = 0

        def close_to(depth: int) -> None:
            nonlocal links
            if any(t not in INLINE for t, _ in stack[depth:]):
                flush()
            links -= sum(t == "a" for t, _ in stack[depth:])
            opened.subtract(t for t, _ in stack[depth:])
            del stack[depth:]

        def end_inline(tag: str) -> None:  # at most what is open inside the block
            nonlocal links
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] not in INLINE:
                    break
                if stack[d][0] == tag:
                    links -= tag == "a"
                    opened[tag] -= 1
                    del stack[d]
                    break

        def push(tag: str, node: int) -> None:
            opened[tag] += 1
            stack.append((tag, node))

        while at < n:
            lt = source.find("<", at)
            end = n if lt < 0 else lt
            if end > at:
                piece = source[at:end]
                piece = html.unescape(piece) if "&" in piece else piece
                buffer.append(piece)
                filled = filled or not piece.isspace()
                if links:
                    linked += len(piece.strip())
            if lt < 0:
                break
            after = source[lt + 1 : lt + 2]
            if after == "!" or after == "?":
                if source.startswith("<!--", lt):
                    stop = source.find("-->", lt + 4)
                    at = n if stop < 0 else stop + 3
                else:
                    stop = source.find(">", lt)
                    at = n if stop < 0 else stop + 1
                continue
            name = _NAME.match(source, lt + 1 + (after == "/"))
            if not name:
                if after == "/":
                    stop = source.find(">", lt)
                    at = n if stop < 0 else stop + 1
                else:
                    buffer.append("<")
                    filled = True
                    at = lt + 1
                continue
            tag, p = name.group().lower(), name.end()
            while True:
                p = _PLAIN.match(source, p).end()
                if p >= n or source[p] == ">":
                    break
                quote = source[p]
                stop = -1 if quote in missing else source.find(quote, p + 1)
                if stop < 0:
                    missing.add(quote)
                    p += 1
                else:
                    p = stop + 1
            attributes, at = source[name.end() : p], min(n, p + 1)
            if after == "/":
                if opened[f"~{tag}"]:
                    end_inline(f"~{tag}")
                elif not opened[tag]:
                    pass
                elif tag in INLINE:
                    end_inline(tag)
                elif tag not in VOID:
                    for d in range(len(stack) - 1, 0, -1):
                        if stack[d][0] == tag:
                            close_to(d)
                            break
                continue
            if tag in RAW:
                if not attributes.endswith("/") or tag in ("script", "style", "textarea", "title"):
                    found = _raw_end(tag).search(source, at)
                    at = n if not found else found.end()
                continue
            if tag in CONTROLS and filled:
                found = _raw_end(tag).search(source, at)
                if found:
                    at = found.end()
                    continue
            if tag == "br":
                buffer.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag not in KEEPS_P and opened["p"]:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == "p":
                        close_to(d)
                        break
                    if stack[d][0] not in INLINE:
                        break
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] in CLOSES[tag]:
                        close_to(d)
                        break
                    if stack[d][0] in BORDERS[tag]:
                        break
            if tag in INLINE and tag != "label":
                links += tag == "a"
                push(tag, stack[-1][1])
                continue
            if tag in FALLBACK and filled:
                push(f"~{tag}", stack[-1][1])
                continue
            flush()
            features, marked = ["element", *FALLBACK.get(tag, [KIND_OF_TAG.get(tag, "other")])], self.marked[stack[-1][1]]
            if attributes.strip(" /"):
                values = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(attributes)}
                marked = marked or "data-content" in values
                words = _WORDS.findall(" ".join(values.get(k, "") for k in ("class", "id", "role")).lower())
                features += sorted({k for w in words for k in KINDS_OF_WORD.get(w, ())} - set(features))
                if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
                    features.append("hidden")
            push(tag, self.add(page, stack[-1][1], features, False, marked))
        flush()

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.parent, np.int64), np.array(self.depth, np.int64), np.array(self.run, np.int64),
                np.array(self.cells, np.int64).reshape(-1, 2))


@lru_cache(maxsize=64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I)


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1)
    return top + np.log(np.exp(a - top[..., None]).sum(axis=-1))


def messages(parent, depth, run, score, ties):
    """Content marginals of all nodes, and for each node but roots the joint marginals with its parent.

    ``score``: log-odds of content by node; ``ties``: (kind of child, state of parent, state of child).
    """
    n = len(parent)
    own = np.stack([np.zeros(n), score], axis=1)  # grows to the sum of what comes from below
    up = np.zeros((n, 2))
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for level in reversed(levels[1:]):
        up[level] = _log_sum(own[level][:, None, :] + ties[run[level]])
        for s in (0, 1):
            own[:, s] += np.bincount(parent[level], weights=up[level, s], minlength=n) if len(level) * 8 > n else 0
        if len(level) * 8 <= n:
            np.add.at(own, parent[level], up[level])
    belief, joint = own.copy(), np.zeros((n, 2, 2))
    for level in levels[1:]:
        rest = belief[parent[level]] - up[level]
        both = rest[:, :, None] + ties[run[level]] + own[level][:, None, :]
        joint[level] = both
        belief[level] = _log_sum(both.transpose(0, 2, 1))
    marginal = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
    inner = np.concatenate(levels[1:]) if len(levels) > 1 else np.array([], np.int64)
    joint = np.exp(joint[inner] - _log_sum(joint[inner].reshape(-1, 4))[:, None, None])
    return marginal, inner, joint


@lru_cache(maxsize=16)
def train(pages: tuple[str, ...] = tuple(PAGES), steps: int = 400, rate: float = 0.05, decay: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Potentials from labelled pages. An element's label is the mark, or that most of its text below is marked."""
    forest = Forest()
    for k, page in enumerate(pages):
        forest.read(k, page)
    parent, depth, run, cells = forest.arrays()
    n = len(parent)
    x = np.zeros((n, len(FEATURES)))
    x[cells[:, 0], cells[:, 1]] = 1
    weight = np.array([len(forest.text.get(k, "")) for k in range(n)], float)
    marked = weight * np.array(forest.marked)
    for k in range(n - 1, 0, -1):  # parents stand before their children
        if parent[k] >= 0:
            weight[parent[k]] += weight[k]
            marked[parent[k]] += marked[k]
    y = np.array(forest.marked) | (marked > 0.5 * np.maximum(weight, 1))
    theta, ties = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    speed_t, speed_w = np.zeros_like(theta), np.zeros_like(ties)
    for _ in range(steps):
        p, inner, joint = messages(parent, depth, run, x @ theta, ties)
        seen = np.zeros_like(joint)
        seen[np.arange(len(inner)), y[parent[inner]].astype(int), y[inner].astype(int)] = 1
        grad_w = np.stack([(seen - joint)[run[inner] == k].sum(axis=0) for k in (0, 1)]) - decay * ties
        speed_t = 0.9 * speed_t + x.T @ (y - p) - decay * theta
        speed_w = 0.9 * speed_w + grad_w
        theta, ties = theta + rate * 0.2 * speed_t, ties + rate * 0.2 * speed_w
    return theta, ties


def main_texts(pages: list[str], theta: np.ndarray, ties: np.ndarray) -> list[str]:
    forest = Forest()
    for k, page in enumerate(pages):
        forest.read(k, page)
    parent, depth, run, cells = forest.arrays()
    score = np.bincount(cells[:, 0], weights=theta[cells[:, 1]], minlength=len(parent))
    marginal, _, _ = messages(parent, depth, run, score, ties)
    blocks: list[list[str]] = [[] for _ in pages]
    for k, text in forest.text.items():  # in page order
        if marginal[k] >= 0.5:
            blocks[forest.page[k]].append(text)
    return ["\n".join(b) for b in blocks]


def extract(df: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of ``column`` as ``out`` (replaced if it exists). The trained potentials, a few dozen
    numbers, travel with the function."""
    theta, ties = train()

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in parts:
            yield pd.Series([t for group in groups(pages.tolist()) for t in main_texts(group, theta, ties)], dtype=object)

    text_batches(df.sparkSession)
    return df.withColumn(out, run(F.col(column)))
