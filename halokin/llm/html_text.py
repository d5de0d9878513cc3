"""Main text of HTML pages (operator 13).

A page becomes a flat list of text blocks: the text between block-level tags, with character
references decoded and white space made single. Each block is described by its words and its link
density (words inside links), those of the blocks before and behind it, whether it is a heading,
ends like a sentence, and which kind of landmark encloses it most closely (boilerplate, main
content, or none). A decision tree, grown on a small labelled table of such blocks, tells the
article's blocks from menus, headers, footers, sidebars, notices, adverts, forms and comments; the
article's blocks are joined in page order.

Tasks parse pages in Arrow batches, one page at a time, and the tree judges all blocks of a batch at
once. No shuffle: every page is judged by itself.

Defined results: null or empty html, html without a main block, or without any text, gives an empty text.
Malformed pages are read as they come: unclosed elements last to the end of what encloses them, end
tags without a start are ignored, an unclosed comment, script or style lasts to the page's end. Repeated
pages get equal texts. An empty table gives no rows. Columns of ``pages`` with the names of the added
ones are replaced. Texts of any length are taken whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textbytes as tb

# Elements that start and end a block, raw-text elements, elements and class names by what they hold.
BLOCK = set("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section select
summary svg table tbody td template tfoot th thead tr ul""".split())
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
VOID = {"hr", "br"}
BOILERPLATE = set("nav aside footer form dialog menu button select option optgroup label legend noscript template svg search".split())
MAIN = {"article", "main"}
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
BOILERPLATE_NAMES = set("""ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promoted promotion
banner breadcrumb breadcrumbs comment comments commentlist disqus replies respond responses discussion consent cookie cookies gdpr notice notices
newsletter subscribe subscription popup modal overlay paywall copyright colophon footer legal imprint nav navbar navigation navi menu menus topbar
toolbar masthead login signin signup search searchbox share sharing social related recommended recommendations trending popular sidebar
widget widgets rail pagination pager skip""".split())
MAIN_NAMES = set("article content entry main maincontent post story".split())
#: What an opening element closes if it is the innermost open one.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S | re.X)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$|/)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}

NONE, IS_MAIN, IS_BOILERPLATE = 0, 1, -1


def _landmark(name: str, attrs: str, inside: int) -> int:
    """What an element holds, by its name, role and class names; ``inside`` is what encloses it."""
    if name in MAIN:
        return IS_MAIN
    if name in BOILERPLATE or (name == "header" and inside != IS_MAIN) or (attrs and _HIDDEN.search(attrs)):
        return IS_BOILERPLATE
    if not attrs or name in ("body", "html"):
        return inside
    tokens: set[str] = set()
    for m in _NAMED.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            tokens |= {"role " + r for r in value.lower().split()}
        else:
            tokens.update(x for v in (value, _HUMP.sub("-", value)) for x in re.split(r"[^a-z0-9]+", v.lower()))
    if "role main" in tokens or "role article" in tokens:
        return IS_MAIN
    if not tokens.isdisjoint(BOILERPLATE_NAMES) or not tokens.isdisjoint("role " + r for r in BOILERPLATE_ROLES):
        return IS_BOILERPLATE
    if inside != IS_MAIN and "header" in tokens:
        return IS_BOILERPLATE
    return IS_MAIN if inside == NONE and not tokens.isdisjoint(MAIN_NAMES) else inside


class Blocks:
    """The flat text blocks of one page: (text, words, linked words, landmark, heading)."""

    def __init__(self, page: str) -> None:
        self.found: list[tuple[str, int, int, int, int]] = []
        self.open: list[tuple[str, int]] = []  # open block elements, and what they hold
        self.times: Counter[str] = Counter()  # how often each is open
        self.parts: list[tuple[str, bool]] = []
        self.link = -1  # the number of open elements when a link began
        at = 0
        while at < len(page):
            m = _TOKEN.search(page, at)
            if m is None:
                break
            self._text(page[at: m.start()])
            at = m.end()
            if m["name"]:
                name = m["name"].lower()
                if name in RAW and not m["end"]:
                    close = _RAW_END[name].search(page, at)
                    at = close.end() if close else len(page)
                elif m["end"]:
                    self._end(name)
                else:
                    self._start(name, m["attrs"])
        self._text(page[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        if raw:
            self.parts.append((raw, self.link >= 0))

    def _start(self, name: str, attrs: str) -> None:
        if name == "br":
            self.parts.append((" ", False))
        elif name == "a":
            self.link = len(self.open)
        elif name in BLOCK:
            self._flush()
            while self.open and self.open[-1][0] in CLOSES.get(name, ()):
                self._pop()
            if name not in VOID:
                self.open.append((name, _landmark(name, attrs, self.open[-1][1] if self.open else NONE)))
                self.times[name] += 1

    def _end(self, name: str) -> None:
        if name == "a":
            self.link = -1
        elif name in BLOCK:
            self._flush()
            while self.times[name] and self._pop() != name:
                pass

    def _pop(self) -> str:
        name, _ = self.open.pop()
        self.times[name] -= 1
        if self.link > len(self.open):
            self.link = -1
        return name

    def _flush(self) -> None:
        if not self.parts:
            return
        raw = "".join(p for p, _ in self.parts)
        words = (html.unescape(raw) if "&" in raw else raw).split()
        if words:
            linked = sum(len(p.split()) for p, is_link in self.parts if is_link)
            heading = any(len(o) == 2 and o[0] == "h" and o[1].isdigit() for o, _ in self.open[-2:])
            landmark = self.open[-1][1] if self.open else NONE
            self.found.append((" ".join(words), len(words), linked, landmark, int(heading)))
        self.parts = []


FEATURES = ("words", "words_before", "words_behind", "links", "links_before", "links_behind", "landmark", "page_has_main", "heading", "sentence")

#: Labelled blocks: landmark (m main, b boilerplate, - none), heading (h), sentence end (s), words, linked words, and whether
#: the block is the article's. A blank line ends a page. Fixed values, labelled by hand for typical page layouts.
LABELLED = """
b - - 4 4 0 | b - - 1 1 0 | b - - 2 2 0 | m h - 8 0 1 | m - - 5 1 1 | m - s 64 2 1 | m - s 38 0 1 | m - s 3 0 1 | m - s 90 4 1 | b - s 12 1 0 | b - s 45 0 0 | b - - 9 2 0

b - - 1 1 0 | b - - 1 1 0 | b - - 3 3 0 | b - s 24 1 0 | m h s 11 0 1 | m - s 27 0 1 | m h - 3 0 1 | m - - 6 0 1 | m - - 9 0 1 | m - s 1 0 1 | m - - 4 4 0 | b h - 3 0 0 | b - s 33 0 0 | b - s 80 3 0 | b - - 7 1 0

- - - 2 2 0 | - - - 5 5 0 | m h - 6 0 1 | m - s 41 1 1 | m - s 2 0 1 | m - s 120 0 1 | m - - 12 12 0 | b - - 5 5 0 | b - - 8 0 0 | - - - 6 1 0

- - s 14 0 0 | b - - 2 2 0 | b - s 7 0 0 | m h - 1 0 1 | m - s 15 0 1 | m - - 10 1 1 | m - s 6 3 1 | m - s 5 0 1 | b - s 18 0 0 | b - s 60 0 0 | - - s 10 0 0

- - - 1 1 0 | - - - 1 1 0 | - - - 2 2 0 | - - - 1 1 0 | - h - 7 0 1 | - - s 52 0 1 | - - s 70 3 1 | - - s 9 0 1 | - - s 44 1 1 | - - - 6 1 0 | - - - 3 3 0 | - - - 2 2 0

- - - 6 6 0 | - - - 4 4 0 | - h - 9 0 1 | - - s 31 0 1 | - - s 25 2 1 | - h - 4 0 1 | - - s 66 0 1 | - - s 12 0 1 | - - s 85 0 1 | - - - 8 2 0 | - - - 5 5 0

- - - 5 5 0 | - h - 5 0 1 | - - s 110 6 1 | - - s 17 0 1 | - - s 39 0 1 | - - - 4 0 0 | - - - 3 3 0 | - - - 5 5 0 | - - - 6 6 0

b - - 3 0 0 | b - - 6 6 0 | - h - 10 0 1 | - - s 48 0 1 | - - s 22 1 1 | - - s 8 0 1 | - - s 36 0 1 | b - s 14 0 0 | b - s 29 0 0 | b - - 11 2 0

b - - 7 7 0 | b - s 9 1 0 | - - s 95 2 1 | - - s 58 0 1 | - - s 11 0 1 | - - s 73 1 1 | b - - 4 4 0 | b - s 20 2 0

b - - 2 2 0 | - - - 3 3 0 | - - - 2 2 0 | - h - 2 2 0 | - - s 16 9 0 | - - - 4 4 0 | - h - 8 0 1 | - - s 34 0 1 | - - s 61 2 1 | - - s 47 0 1 | - - - 2 2 0 | - - - 9 9 0

- - - 5 0 0 | - - s 16 0 0 | - - s 23 1 0 | m h - 8 0 1 | m - s 49 0 1 | m - s 4 0 1 | m - s 77 3 1 | - - s 30 0 0 | - - - 6 0 0 | - - s 12 0 0

- - s 40 0 0 | - h - 3 0 0 | - - s 21 1 0 | m - s 66 1 1 | m - s 19 0 1 | m - - 2 0 1 | - h - 4 0 0 | - - s 28 2 0 | - - s 35 0 0 | - - - 7 0 0

- h - 6 0 1 | - - s 57 1 1 | - - s 4 0 1 | - - s 33 0 1 | - - s 2 0 1 | - - - 3 3 0 | - - - 2 2 0 | - - - 5 0 0 | - - - 4 4 0 | - - - 3 0 0

- - - 2 2 0 | - - - 4 0 0 | - h - 11 0 1 | - - s 18 0 1 | - - s 90 5 1 | - - s 3 0 1 | - - - 3 3 0 | - - - 4 0 0

m h - 6 0 1 | m - s 40 0 1 | m - s 3 0 1

b - - 5 5 0 | b - - 3 0 0 | m - s 30 1 1 | m - - 5 0 1

- - s 60 0 1

- h - 5 0 1 | - - s 50 1 1 | - - s 33 0 1

- - s 9 0 1

m - - 2 0 1

- - - 2 2 0 | - h - 4 0 1 | - - s 20 0 1 | - - s 7 0 1

m - - 4 0 1 | m - s 55 0 1 | m - - 2 0 1 | m - s 13 0 1 | m - - 3 3 0 | b - - 3 3 0 | b - s 70 0 0 | b - s 42 0 0 | b h - 2 0 0 | b - - 1 0 0
"""
#: Most rows of a labelled table.
LABELLED_ROWS = 10_000


def labelled_blocks(text: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a labelled table."""
    pages = [[b.split() for b in page.replace("\n", "|").split("|") if b.strip()] for page in text.strip().split("\n\n")]
    if sum(map(len, pages)) > LABELLED_ROWS:
        raise ValueError(f"over {LABELLED_ROWS} labelled blocks")
    kinds = {"m": IS_MAIN, "b": IS_BOILERPLATE, "-": NONE}
    rows = [(p, int(b[3]), int(b[4]), kinds[b[0]], int(b[1] == "h"), int(b[2] == "s"), int(b[5])) for p, page in enumerate(pages) for b in page]
    table = np.array(rows, np.int64).reshape(-1, 7)
    return features(*table[:, :6].T), table[:, 6].astype(bool)


def features(page: np.ndarray, words: np.ndarray, linked: np.ndarray, landmark: np.ndarray, heading: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """The columns of ``FEATURES`` for blocks in page order; beyond a page's ends there are 0 words and links."""
    out = np.zeros((len(page), len(FEATURES)))
    if not len(page):
        return out
    links = linked / np.maximum(words, 1)
    same = page[1:] == page[:-1]
    out[:, 0], out[:, 3] = words, links
    for k, value in ((1, words), (4, links)):
        out[1:, k], out[:-1, k + 1] = np.where(same, value[:-1], 0), np.where(same, value[1:], 0)
    first = np.concatenate(([True], ~same))
    out[:, 6] = landmark
    out[:, 7] = np.maximum.reduceat(landmark == IS_MAIN, np.flatnonzero(first))[np.cumsum(first) - 1]
    out[:, 8], out[:, 9] = heading, sentence
    return out


class DecisionTree:
    """A binary tree of thresholds grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 7, least: int = 2) -> None:
        self.nodes: list[tuple[int, float, int, int, bool]] = []  # feature (-1: a leaf), threshold, at most it, above it, verdict
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, 0, 0, bool(2 * y.sum() > len(y))))
        best = (len(y) * _gini(y.mean()) if len(y) else 0.0, -1, 0.0)
        if depth and best[0] > 0:
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, good = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(v))
                ok = (v[1:] > v[:-1]) & (n >= least) & (len(v) - n >= least)
                cost = n * _gini(good[:-1] / n) + (len(v) - n) * _gini((good[-1] - good[:-1]) / (len(v) - n))
                for k in np.flatnonzero(ok):
                    if cost[k] < best[0] - 1e-9:
                        best = (cost[k], f, (v[k] + v[k + 1]) / 2)
        if best[1] >= 0:
            low = x[:, best[1]] <= best[2]
            left, right = self._grow(x[low], y[low], depth - 1, least), self._grow(x[~low], y[~low], depth - 1, least)
            self.nodes[me] = (best[1], best[2], left, right, self.nodes[me][4])
        return me

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The verdicts on all rows."""
        node = np.zeros(len(x), np.int64)
        feature, threshold, low, high, verdict = (np.array(c) for c in zip(*self.nodes))
        while (inner := np.flatnonzero(feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(x[inner, feature[at]] <= threshold[at], low[at], high[at])
        return verdict[node].astype(bool)


def _gini(p: np.ndarray) -> np.ndarray:
    return 2 * p * (1 - p)


#: What may stand behind the mark that ends a sentence, and the marks.
_CLOSERS = "\"'»”’)]"
_MARKS = (".", "!", "?", "…", ":", ";", "。", "！", "？")

ADDED = {"text": T.StringType(), "n_chars": T.LongType()}


def main_texts(tree: DecisionTree, pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    every = [Blocks(p).found if p else [] for p in pages]
    flat = [b for found in every for b in found]
    page = np.repeat(np.arange(len(pages)), [len(found) for found in every])
    count = np.array([b[1:] for b in flat], np.int64).reshape(-1, 4)
    sentence = np.array([b[0].rstrip(_CLOSERS).endswith(_MARKS) for b in flat], np.int64)
    kept = tree(features(page, *count.T, sentence))
    out: list[list[str]] = [[] for _ in pages]
    for k in np.flatnonzero(kept):
        out[page[k]].append(flat[k][0])
    return ["\n".join(lines) for lines in out]


def extract(pages: DataFrame, *, html_col: str = "html", labelled: str = LABELLED) -> DataFrame:
    """``pages`` without the html, with text and n_chars. ``labelled`` is a table in the form of ``LABELLED``, of at most
    ``LABELLED_ROWS`` blocks, from which the driver grows the tree."""
    tree = DecisionTree(*labelled_blocks(labelled))
    kept = [f for f in pages.schema if f.name not in ADDED and f.name != html_col]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(k, t) for k, t in ADDED.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, html_col):
            text = main_texts(tree, batch.column(html_col).to_pylist())
            columns = [batch.column(c) for c in names] + [pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return pages.select(*names, html_col).mapInArrow(run, schema)
