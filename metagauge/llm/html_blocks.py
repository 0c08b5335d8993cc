"""Main text of HTML pages from shallow features of flat text blocks.

A page is cut into blocks at block-level tags; inline tags don't cut. Of each
block, and of the ones before and after it, the number of words and the share
of words inside links are known, and of the block also the kind of its tag and
whether it ends as a sentence does, for these numbers alone don't tell a heading of two
words from a button. A decision tree (CART, Gini) grown on a small
labelled table of blocks says which blocks are main text. Their texts, with
character references resolved and white space collapsed, make the result, one
line each.

Comments and what stands in title, script, style, textarea, noscript, template,
svg, select and button don't count. A head has no other text, so it may be left
open. A tag ends at the first ``>``. Without an end tag, comments, script, style
and textarea run to the end of the page; a title and a button end before the
next block-level tag (or any tag, if there is none), a select before the first
tag that is no option's, and of the others the tag alone is dropped. A svg tag that
ends in ``/>`` is closed.

Defined results: a null page has null text and 0 blocks; a page without blocks
or without main text has "". page_ids are integers (ValueError otherwise), or
null. Extra columns are ignored. Repeated rows have repeated results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .html_pages import labelled_pages
from .textcore import slices

_OPEN = re.compile(r"<!--|<(title|script|style|textarea|noscript|template|svg|select|button)(?![^\s/>])[^>]*>", re.I)
_CLOSE = {n: re.compile(rf"</{n}(?![^\s/>])[^>]*>", re.I) for n in ("script", "style", "textarea")}
_EITHER = {n: re.compile(rf"<(/?){n}(?![^\s/>])[^>]*>", re.I) for n in ("noscript", "template", "svg", "select", "button")}
_NOT_OPTION = re.compile(r"<(?!/?(?:option|optgroup|hr)(?![^\s/>]))[a-zA-Z/!?]", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*)([^>]*)>|<[!?/][^>]*>")
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())

#: Of a block itself, then of the ones before and after it. kind: 3 for headings, 2 for paragraphs, 1 for items of lists and tables, 0 for others; stop: whether it ends as a sentence does.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "kind", "stop")
_KIND = dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6"), 3) | dict.fromkeys(("p", "blockquote", "pre"), 2) | dict.fromkeys(("li", "dd", "dt", "td", "th"), 1)
_STOP = (".", "!", "?", "…", "。", "！", "？", '."', ".”", ".»", "?”", "!”", ".)", ":")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    kind: int
    #: Whether its tag has the attribute data-main.
    main: bool


def features(found: list[Block], page: np.ndarray) -> np.ndarray:
    """Rows of FEATURES of blocks in order, of pages by number; outside a page there are 0 words."""
    words = np.array([b.words for b in found], float)
    own = np.stack([words, np.array([b.linked for b in found], float) / np.maximum(words, 1)])
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = page[1:] == page[:-1]
    before[:, 1:] = own[:, :-1] * same
    after[:, :-1] = own[:, 1:] * same
    form = np.array([[b.kind for b in found], [b.text.endswith(_STOP) and not b.text.endswith("...") for b in found]], float)
    return np.concatenate([own, before, after, form]).T


def labelled_table(pages: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    parsed = [parse(p) for p in pages or labelled_pages()]
    flat = [b for p in parsed for b in p]
    return features(flat, np.repeat(np.arange(len(parsed)), [len(p) for p in parsed])), np.array([b.main for b in flat], int)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> tuple:
    """A tree: (share of 1,) or (feature, cut, tree for values up to it, tree for others)."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return (float(y.mean()),)
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(y) - n >= least)
        if not ok.any():
            continue
        a, b = s[:-1], s[-1] - s[:-1]
        gini = a * (n - a) / n + b * (len(y) - n - b) / (len(y) - n)
        gini[~ok] = np.inf
        i = int(gini.argmin())
        if best is None or gini[i] < best[0] - 1e-12:
            best = gini[i], f, float(v[i] + v[i + 1]) / 2
    if best is None or best[0] >= y.sum() * (1 - y.mean()) - 1e-12:
        return (float(y.mean()),)
    _, f, cut = best
    low = x[:, f] <= cut
    return f, cut, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, predict(low, x), predict(high, x))


def _pairs(page: str, name: str) -> dict[int, int]:
    """Ends of the elements of this name, which may nest, by their beginnings."""
    ends, begun = {}, []
    for m in _EITHER[name].finditer(page):
        if m[1]:
            if begun:
                ends[begun.pop()] = m.end()
        elif name != "svg" or not m[0].endswith("/>"):
            begun.append(m.start())
    return ends


def _before_block(page: str, at: int) -> tuple[int, str]:
    """Where the next tag begins that is not an inline one, and that tag; if there is none, the next tag or the end of the page."""
    first = None
    for m in _TAG.finditer(page, at):
        if m[2] and m[2].lower() not in _INLINE:
            return m.start(), m[0]
        first = m.start() if first is None else first
    return len(page) if first is None else first, ""


def _without(page: str) -> str:
    """The page, with a space for each thing that doesn't count."""
    out, at = [], 0
    pairs: dict[str, dict[int, int]] = {}
    while m := _OPEN.search(page, at):
        out.append(page[at : m.start()])
        name, end = (m[1] or "").lower(), m.end()
        if not name:
            end = page.find("-->", m.start() + 2) + 3  # <!--> is a comment too
            end = len(page) if end == 2 else end
        elif name in _CLOSE:
            close = _CLOSE[name].search(page, end)
            end = close.end() if close else len(page)
        elif name in ("svg", "template"):
            if name not in pairs:
                pairs[name] = _pairs(page, name)
            end = pairs[name].get(m.start(), end)
        elif name == "title":
            end, tag = _before_block(page, end)
            end += len(tag) if tag[:7].lower() == "</title" else 0
        else:
            other = _EITHER[name].search(page, end)  # these don't nest
            if other and other[1]:
                end = other.end()
            elif name == "select":
                stop = _NOT_OPTION.search(page, end)
                end = stop.start() if stop else end
            elif name == "button":
                end = _before_block(page, end)[0]
        out.append(" ")
        at = end
    out.append(page[at:])
    return "".join(out)


def parse(page: str) -> list[Block]:
    """Blocks that have words."""
    parts = _TAG.split(_without(page))
    out: list[Block] = []
    texts: list[str] = []
    n = linked = kind = 0
    link = main = False

    def close() -> None:
        if n:
            own = "".join(texts).split()
            out.append(Block(" ".join(own), len(own), min(linked, len(own)), kind, main))

    for i in range(0, len(parts), 4):
        text = parts[i]
        if text:
            if "&" in text:
                text = html.unescape(text)
            k = len(text.split())
            texts.append(text)
            n += k
            linked += k * link
        if i + 3 < len(parts):
            end, tag, rest = parts[i + 1 : i + 4]
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "a":
                link = not end
            elif tag == "br":
                texts.append(" ")
            elif tag not in _INLINE:
                close()
                texts, n, linked, link = [], 0, 0, False
                kind, main = (0, False) if end else (_KIND.get(tag, 0), "data-main" in rest)
    close()
    return out


def blocks(page: str) -> list[tuple[str, int, int]]:
    """(text, words, words in links) of each block that has words."""
    return [b[:3] for b in parse(page)]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """(page_id, text, n_blocks, n_main): one row for each row of pages."""
    tree = tree or grow(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [None if p is None else parse(p) for p in part.column("html").to_pylist()]
                sizes = np.array([len(f or ()) for f in found])
                flat = [b for f in found if f for b in f]
                x = features(flat, np.repeat(np.arange(len(found)), sizes)) if flat else np.zeros((0, len(FEATURES)))
                main = predict(tree, x).astype(bool).tolist()
                texts, kept, at = [], [], 0
                for f, k in zip(found, sizes.tolist()):
                    own = [b.text for b, m in zip(f or (), main[at : at + k]) if m]
                    at += k
                    texts.append(None if f is None else "\n".join(own))
                    kept.append(len(own))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(texts, pa.string()), pa.array(sizes.astype(np.int32)), pa.array(kept, pa.int32())], ["page_id", "text", "n_blocks", "n_main"])

    rows = pages.select(integer(pages, id_col).alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string, n_blocks int, n_main int")
