"""Benchmark decontamination by an FM-index of every training shard (operator 9).

Tasks read documents in Arrow batches and cut them into shards. Words become numbers
of the benchmark's vocabulary; runs of known words that are too short to hold any
window are left out of the index, exactly, as no occurrence can lie in them. Over
what remains a task builds a suffix array, its Burrows-Wheeler transform and a
wavelet tree of prefix counts. All benchmark windows are searched backwards at once;
their rows are located through sampled suffix positions; overlapping occurrences
merge into removal spans. Documents are never shuffled.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` of text, read one at a time. A pass over the documents
searches one block and is written before the next one begins, so neither a task nor the driver ever holds more
than one block, however large the benchmark is.

Defined results: null or empty text has no words and is not contaminated. Items whose
text is null or has no word have no window; an item without an id is searched like others, but has
no name among the items found. Repeated documents and items are searched
alike; the same item id counts once for a document. An empty benchmark or document
table gives no hits or no rows. Columns of ``docs`` with the names of the added ones
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import textbytes as tb

WINDOW = 10
#: Bytes of benchmark text in one block, and symbols in one shard's index.
BLOCK_BYTES = 4_000_000
SHARD = 1_000_000
SAMPLE = 16

ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


class FMIndex:
    """Index of a sequence of symbols; 0 separates runs and is never searched.

    Separators sort as different symbols, by position, so that no two suffixes are
    equal beyond a run. Positions of run starts are sampled, so that locating never
    steps over a separator."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.n = n = len(seq)
        sa = self._suffixes(seq)
        self.bwt = seq[sa - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        pos_start = np.ones(n, bool)
        pos_start[1:] = seq[:-1] == 0
        sampled = pos_start[sa] | (sa % SAMPLE == 0)
        self.sample = np.where(sampled, sa, -1)
        self.levels = []
        current = self.bwt
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (current >> bit) & 1
            count = np.concatenate(([0], np.cumsum(ones)))
            self.levels.append((bit, count, n - int(count[-1])))
            current = current[np.argsort(ones, kind="stable")]

    @staticmethod
    def _suffixes(seq: np.ndarray) -> np.ndarray:
        """Suffix array by doubling; only suffixes whose order is still open are sorted again."""
        n = len(seq)
        key = seq.astype(np.int64) + n
        key[seq == 0] = np.arange(int((seq == 0).sum()))
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        step = 1
        while True:
            same = ~head
            open_ = np.flatnonzero(same | np.concatenate((same[1:], [False])))
            if not len(open_):
                return order
            rows = order[open_]
            follow = np.where(rows + step < n, rank[np.minimum(rows + step, n - 1)], -1)
            again = np.lexsort((follow, rank[rows]))
            rows, follow = rows[again], follow[again]
            order[open_] = rows
            old = rank[rows]
            differs = np.concatenate(([True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])))
            head[open_] = differs
            rank[rows] = open_[np.maximum.accumulate(np.where(differs, np.arange(len(rows)), 0))]
            step *= 2

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in the first ``i`` entries of the transform, through the wavelet tree."""
        lo = np.zeros_like(i)
        for bit, count, zeros in self.levels:
            one = ((symbol >> bit) & 1) == 1
            lo = np.where(one, zeros + count[lo], lo - count[lo])
            i = np.where(one, zeros + count[i], i - count[i])
        return i - lo

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of the patterns (one in a row, of equal length) that occur."""
        which = np.arange(len(patterns))
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[which, j]
            lo, hi = self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)
            found = lo < hi
            which, lo, hi = which[found], lo[found], hi[found]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: step back until a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            at = self.sample[rows]
            found = at >= 0
            out[todo[found]] = at[found] + steps
            todo, rows = todo[~found], rows[~found]
            c = self.bwt[rows]
            rows = self.first[c] + self.rank(c, rows)
            steps += 1
        return out


class Windows:
    """The windows of a block of items: vocabulary, patterns by length, items of each pattern."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int) -> None:
        items = list(items)
        ids = np.array([i for i, _ in items], object)
        data, off = tb.utf8(pa.array([t for _, t in items], pa.string()))
        word, _, _, row = _words(data, off)
        self.vocabulary, symbol = np.unique(word, return_inverse=True)
        symbol = symbol + 1
        known: dict[tuple[int, ...], set[str]] = {}
        for r in range(len(items)):
            a, b = np.searchsorted(row, [r, r + 1])
            size = min(window, b - a)
            for k in range(a, b - size + 1) if size else ():
                names = known.setdefault(tuple(symbol[k: k + size].tolist()), set())
                if ids[r] is not None:
                    names.add(str(ids[r]))
        self.by_length = {}
        for size in sorted({len(p) for p in known}):
            patterns = [p for p in known if len(p) == size]
            self.by_length[size] = (np.array(patterns, np.int64), [sorted(known[p]) for p in patterns])
        self.shortest = min(self.by_length, default=0)

    def symbols(self, word: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, from 1; 0 for other words."""
        if not len(self.vocabulary):
            return np.zeros(len(word), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == word, at + 1, 0)


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, row) of all words, lower-cased."""
    low = tb.LOWER[data]
    start, end, row = tb.word_spans(tb.ALNUM[low], off)
    return tb.span_hashes(low, start, end), start, end, row


def _runs(symbol: np.ndarray, row: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words of all runs (known words of one row) of at least ``shortest`` words, and whether each starts a run."""
    known = symbol > 0
    if not known.any():
        return np.zeros(0, np.int64), np.zeros(0, bool)
    fresh = known & ~(np.concatenate(([False], known[:-1])) & np.concatenate(([False], row[1:] == row[:-1])))
    at = np.flatnonzero(known)
    run = np.cumsum(fresh[at]) - 1
    long_enough = np.bincount(run)[run] >= shortest
    return at[long_enough], fresh[at][long_enough]


def _search_shard(windows: Windows, symbol: np.ndarray, starts: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which of the given words (runs of symbols) are hit, and the items of each row."""
    shift = np.cumsum(starts)  # a separator before every run
    seq = np.zeros(len(symbol) + int(starts.sum()) + 1, np.int64)
    at = np.arange(len(symbol)) + shift
    seq[at] = symbol
    owner = np.full(len(seq), -1, np.int64)
    owner[at] = np.arange(len(symbol))
    index = FMIndex(seq, len(windows.vocabulary) + 1)
    cover = np.zeros(len(symbol) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for size, (patterns, names) in windows.by_length.items():
        which, lo, hi = index.search(patterns)
        first = owner[index.locate(tb.ranges(lo, hi - lo))]
        which = np.repeat(which, hi - lo)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + size, -1)
        for r, p in set(zip(row[first].tolist(), which.tolist())):
            items.setdefault(r, set()).update(names[p])
    return np.cumsum(cover[:-1]) > 0, items


def _search_batch(windows: Windows, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
    """(words of each row, rows of the hit spans, (start, end) bytes and words of each span, items of each row)."""
    n_words = np.zeros(len(off) - 1, np.int64)
    spans: list[np.ndarray] = []
    items: dict[int, set[str]] = {}
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> None:
        if not held:
            return
        symbol, starts, row, start, end, word = (np.concatenate(x) for x in zip(*held))
        held.clear()
        hit, found = _search_shard(windows, symbol, starts, row)
        for r, names in found.items():
            items.setdefault(r, set()).update(names)
        k = np.flatnonzero(hit)
        if len(k):
            # hit words next to each other in a text make one span
            cut = np.concatenate(([True], (word[k][1:] != word[k][:-1] + 1) | (row[k][1:] != row[k][:-1])))
            last = np.concatenate((cut[1:], [True]))
            spans.append(np.stack([row[k[cut]], start[k[cut]] - off[row[k[cut]]], end[k[last]] - off[row[k[cut]]],
                                   word[k[last]] - word[k[cut]] + 1], 1))

    words_before = 0
    for i, j in tb.pieces(off):
        h, start, end, row = _words(data[off[i]: off[j]], off[i: j + 1] - off[i])
        n_words[i:j] = np.bincount(row, minlength=j - i)
        if windows.shortest:
            symbol = windows.symbols(h)
            at, starts = _runs(symbol, row, windows.shortest)
            if sum(len(x[0]) for x in held) + len(at) > SHARD:
                flush()
            if len(at):
                held.append((symbol[at], starts, row[at] + i, start[at] + off[i], end[at] + off[i], at + words_before))
        words_before += len(h)
    flush()
    return n_words, np.concatenate(spans) if spans else np.zeros((0, 4), np.int64), items


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((a, b) for a, b, *_ in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def mark_passages(docs: DataFrame, items: DataFrame, *, id_col: str = "item_id", item_text: str = "text", text_col: str = "text",
                  window: int = WINDOW, remove: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence of a window), spans (merged removal spans, byte
    offsets in the UTF-8 text) and items (ids of the items found, as sorted strings). With ``remove`` the
    text loses its spans."""
    some = items.select(F.col(id_col).cast("string").alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    names = {f.name for f in ADDED}
    out = docs.select([c for c in docs.columns if c not in names])
    for b in range(blocks):
        windows = Windows(((r.id, r.text) for r in some.where(part == b).orderBy("id", "text").collect()), window)
        out = _apply(out, windows, text_col, first=b == 0, last=b == blocks - 1, remove=remove)
        out = materialize(out, "decontamination") if b < blocks - 1 else out
    return out


def _apply(docs: DataFrame, windows: Windows, text_col: str, first: bool, last: bool, remove: bool) -> DataFrame:
    """One block of windows; what earlier blocks found is merged in."""
    kept = [f for f in docs.schema if f.name not in {a.name for a in ADDED}]
    schema = T.StructType(kept + list(ADDED))
    columns = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, text_col):
            data, off = tb.utf8(batch.column(text_col))
            n_words, found, items = _search_batch(windows, data, off)
            spans: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]
            for r, a, b, _ in found.tolist():
                spans[r].append((a, b))
            names = [sorted(items.get(r, ())) for r in range(batch.num_rows)]
            n_hit = np.bincount(found[:, 0], found[:, 3], minlength=batch.num_rows).astype(np.int64)
            if not first:
                old_spans, old_names = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                for r in range(batch.num_rows):
                    if old_spans[r]:
                        spans[r] = _merged(spans[r] + [(s["start"], s["end"]) for s in old_spans[r]])
                        n_hit[r] = sum(len(_words(x := data[off[r] + a: off[r] + b], np.array([0, len(x)]))[0]) for a, b in spans[r])
                    names[r] = sorted({*names[r], *old_names[r]})
            cols = [batch.column(c) for c in columns]
            if remove and last and any(spans):
                cols[columns.index(text_col)] = _without(batch.column(text_col), data, off, spans)
            kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            cols += [pa.array(n_words), pa.array(n_hit),
                     pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(kind)),
                     pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, columns + [a.name for a in ADDED])

    return docs.mapInArrow(run, schema)


def _without(column: pa.Array, data: np.ndarray, off: np.ndarray, spans: list[list[tuple[int, int]]]) -> pa.Array:
    """The text column without the spans."""
    fresh = []
    for r in [r for r, s in enumerate(spans) if s]:
        edges = [0, *(x for span in spans[r] for x in span), off[r + 1] - off[r]]
        fresh.append(b"".join(data[off[r] + a: off[r] + b].tobytes() for a, b in zip(edges[::2], edges[1::2])).decode(errors="replace"))
    return pc.replace_with_mask(column, pa.array([bool(s) for s in spans]), pa.array(fresh, column.type))
