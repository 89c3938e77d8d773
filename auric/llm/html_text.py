"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into its leaf blocks: the stretches of text between block-level
tags, in page order, each with the open elements around it. A block's features are
its ancestors' tags and the words in their class and id names, its own tag, its
length, link density, end punctuation and signs, and its place in the page. The field
has two labels (article, other) with a weight for each feature and each pair of
neighbouring labels. It is trained by gradient ascent on the conditional
likelihood of labelled pages (forward-backward) and decoded by Viterbi.

Extraction is one narrow scan with a page at a time in memory. The labelled pages
are a fixed grammar in ``html_pages`` (a parameter); the trained weights are a
small table of feature names.

Defined results: a null or empty page, and a page without article blocks, gives an
empty text; an unclosed comment or raw element, and a tag without its end, run to the end
of the page; a quote in a tag that is never closed ends with the tag, at the next >. Text
in math, svg, noscript, iframe and template counts with its block; null and repeated ids
and repeated rows give a result each; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.html_pages import labelled_pages
from auric.llm.tables import table

# Element kinds of HTML.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl
    dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
    main menu nav noscript ol optgroup option p pre search section select summary table tbody td
    textarea tfoot th thead title tr ul button ins iframe""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp".split())
DROPPED = frozenset("script style title".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body table td th ul ol dl button div section article aside main nav".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?=>|\Z)|[^>]*)"
                  r"(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r"\bdata-(main|other)\b")
_TOKEN = re.compile(r"[a-z]+")


class _Open:
    __slots__ = ("tag", "feats", "label")

    def __init__(self, tag, feats, label):
        self.tag, self.feats, self.label = tag, feats, label


class Stack:
    """The open elements, with how many of each tag are open, in all and since the
    innermost element of ``SCOPE``, so that no tag searches them in vain."""

    def __init__(self):
        self.items = [_Open("", frozenset(), None)]
        self.open: Counter[str] = Counter()
        self.scopes: list[Counter[str]] = [Counter()]

    def push(self, tag, feats, label):
        self.items.append(_Open(tag, feats, label))
        self.open[tag] += 1
        if tag in SCOPE:
            self.scopes.append(Counter())
        self.scopes[-1][tag] += 1

    def pop(self):
        tag = self.items.pop().tag
        self.open[tag] -= 1
        if tag in SCOPE:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        return tag

    def close(self, tag):
        """An end tag: the innermost such element and all in it."""
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def close_before(self, shut):
        """What a start tag ends: open paragraphs, then one element of ``shut``, no
        further out than the innermost element of the scope."""
        while self.scopes[-1]["p"]:
            self.close("p")
        if any(self.scopes[-1][t] for t in shut):
            while self.pop() not in shut:
                pass


class Block:
    __slots__ = ("text", "around", "tag", "linked", "label")

    def __init__(self, text, around, tag, linked, label):
        self.text, self.around, self.tag = text, around, tag
        self.linked, self.label = linked, label


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    out: list[Block] = []
    stack = Stack()
    parts: list[str] = []
    in_link, linked, at = 0, 0, 0

    def close_block():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack.items[-1]
                out.append(Block(text, top.feats, top.tag, linked / len(text), top.label))
            parts.clear()
        linked = 0

    def add(text):
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.strip())

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            if tag in BLOCK:
                close_block()
                stack.close(tag)
            continue
        if tag == "br":
            parts.append(" ")
        if tag == "a":
            in_link = 1
        if tag in RAW and not m[0].endswith("/>"):
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            inside, at = (page[at:stop.start()], stop.end()) if stop else (page[at:], end)
            if tag in DROPPED:
                if tag in BLOCK:
                    close_block()
                continue
            close_block()
            top = stack.items[-1]
            stack.push(tag, top.feats | {"a:" + tag}, top.label)
            parts.append(inside)
            close_block()
            stack.pop()
            continue
        if tag not in BLOCK:
            continue
        close_block()
        stack.close_before(CLOSED_BY.get(tag, ()))
        if tag in VOID:
            continue
        attrs = m[3]
        feats, label = stack.items[-1].feats, stack.items[-1].label
        new = {"a:" + tag}
        if attrs:
            for n in _NAMES.findall(attrs):
                new.update("n:" + t for t in _TOKEN.findall((n[0] or n[1] or n[2]).lower()))
            marked = _LABEL.search(attrs)
            if marked:
                label = marked[1] == "main"
        stack.push(tag, feats if new <= feats else feats | new, label)
    close_block()
    return out


def features(page: list[Block]) -> list[list[str]]:
    out = []
    for k, b in enumerate(page):
        n = len(b.text)
        f = [*b.around, "t:" + b.tag, f"len:{min(9, int(math.log2(n + 1)))}",
             f"link:{min(4, int(b.linked * 4 + 0.5))}", "bias"]
        if b.text[-1] in ".!?:;\"')…":
            f.append("end")
        if "©" in b.text:
            f.append("copyright")
        if k == 0:
            f.append("first")
        if k == len(page) - 1:
            f.append("last")
        out.append(f)
    return out


class Field:
    """Labels 0 (other) and 1 (article); a feature's weight speaks for label 1."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        self.pair = np.zeros((2, 2))

    def scores(self, feats: list[list[str]]) -> list[float]:
        get = self.weight.get
        return [sum([get(x, 0.0) for x in f]) for f in feats]

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Viterbi; a tie goes to label 0."""
        (a, b), (c, d) = self.pair.tolist()
        s0 = s1 = 0.0
        back = []
        for k, s in enumerate(self.scores(feats)):
            if k:
                from0, from1 = (s0 + a, s1 + c), (s0 + b, s1 + d)
                back.append((from0[1] > from0[0], from1[1] > from1[0]))
                s0, s1 = max(from0), max(from1)
            s1 += s
        if not feats:
            return []
        y = [int(s1 > s0)]
        for step in reversed(back):
            y.append(int(step[y[-1]]))
        return y[::-1]

    def marginals(self, feats: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(probability of label 1 at each block, expected pairs), forward-backward."""
        state = np.zeros((len(feats), 2))
        state[:, 1] = self.scores(feats)
        fwd, bwd = np.zeros_like(state), np.zeros_like(state)
        fwd[0] = state[0]
        for k in range(1, len(state)):
            fwd[k] = state[k] + np.logaddexp(fwd[k - 1, 0] + self.pair[0],
                                             fwd[k - 1, 1] + self.pair[1])
        for k in range(len(state) - 2, -1, -1):
            x = bwd[k + 1] + state[k + 1]
            bwd[k] = np.logaddexp(self.pair[:, 0] + x[0], self.pair[:, 1] + x[1])
        total = np.logaddexp(*fwd[-1])
        pairs = np.exp(fwd[:-1, :, None] + self.pair + (state + bwd)[1:, None, :] - total)
        return np.exp(fwd[:, 1] + bwd[:, 1] - total), pairs.sum(axis=0)

    def train(self, pages: list[list[Block]], epochs: int = 8, rate: float = 0.3,
              shrink: float = 1e-4) -> "Field":
        """Adaptive gradient steps, one page at a time, in the given order."""
        grown: dict[str, float] = {}
        grown_pair = np.full((2, 2), 1e-6)
        data = [(features(p), [int(bool(b.label)) for b in p]) for p in pages if p]
        for _ in range(epochs):
            for feats, y in data:
                p, pairs = self.marginals(feats)
                gradient: dict[str, float] = {}
                for f, have, want in zip(feats, p.tolist(), y):
                    for x in f:
                        gradient[x] = gradient.get(x, 0.0) + want - have
                for x, g in gradient.items():
                    w = self.weight.get(x, 0.0)
                    g -= shrink * w
                    grown[x] = grown.get(x, 1e-6) + g * g
                    self.weight[x] = w + rate * g / math.sqrt(grown[x])
                seen = np.zeros((2, 2))
                for a, b in zip(y, y[1:]):
                    seen[a, b] += 1
                g = seen - pairs - shrink * self.pair
                grown_pair += g * g
                self.pair += rate * g / np.sqrt(grown_pair)
        return self


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    labels = field.decode(features(found))
    return " ".join(b.text for b, y in zip(found, labels) if y)


def train(pages: list[str] | None = None) -> Field:
    return Field().train([blocks(p) for p in (labelled_pages() if pages is None else pages)])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", field: Field | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    kind, urls = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    bc = pages.sparkSession.sparkContext.broadcast(field or train())

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                texts = [main_text(x.as_py(), bc.value) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    [id_col, url_col, "text", "n_chars"])

    return (pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_u"),
                         F.col(html_col).cast("string").alias("_h"))
            .mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` {urls}, text string, n_chars bigint"))


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op9_html_text": op9_html_text}
ORACLE: dict[str, str] = {}
