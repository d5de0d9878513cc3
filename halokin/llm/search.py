"""Ranked lexical search over K2-treaps (operator 11).

The corpus is a grid of terms by documents, whose cells hold impacts: the part of a document's
score that depends on the term's occurrences and the document's length, ``(1000000000*tf) div
(1000*tf + 8*m)``. Tasks put documents together to shards; in each the documents stand by length, the terms by
falling document frequency, and the grid becomes a quadtree: a cell knows which of its four quarters hold
anything and the greatest impact in it, as a difference to its parent's; a cell with a single entry
is a leaf that names its term and document. The shards are a written table, the index, of all
terms of all documents.

A search takes the items in blocks. The index gives the document frequencies of the block's terms,
added up by Spark; then every shard is searched for all items of the block at once. An item's state is a range
of documents with, for each of its terms, the cell on the term's row path over that range; the sum of weights times
cell maxima bounds all scores in it. States are taken best first, a batch for each item, and split at the middle of
their range, until the best ones are single documents. Bounds below the item's tenth score so far in
the task are dropped. Each task returns the best of its shards; a ranked window picks among them.

Terms are compared by 64-bit hash (with V different terms in a shard and Q in the items, one of Q * V / 2**64 is
taken for another). Scores are 64-bit integers. Ids are integers.

Defined results: null or empty text, or text without a term, is no document of the statistics and never
found. Items without a term, or whose terms occur nowhere, or in so many documents that they weigh nothing, find nothing.
Repeated rows, and rows with equal ids, are documents (or items) of their own; of equal scores the smaller id comes first,
null ids last. A text longer than a shard is a shard of its own. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..session import materialize, scratch_path
from . import textbytes as tb

#: Bytes of text in a shard, bytes of items in a block.
SHARD = 12_000_000
BLOCK_BYTES = 2_000_000
#: States of an item that are split at a time, items whose states are held at a time.
BATCH = 128
GROUP = 100

_POPCOUNT = np.array([bin(m).count("1") for m in range(16)], np.int64)
_LAST = np.iinfo(np.int64).max


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of UTF-8 texts."""
    lower = tb.LOWER[data]
    start, end, row = tb.word_spans(tb.ALNUM[lower], off)
    return tb.span_hashes(lower, start, end), row


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """A zero bit between any two of the 31 bits of each number."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """A K2-treap: in breadth-first order the quarters each cell has (bits 2 * lower half of rows + right half of columns),
    its greatest value, the place of its first child, and, for the cells with a single entry, that entry's row and column."""

    def __init__(self, height: int, sizes: np.ndarray, mask: np.ndarray, best: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        self.height, self.sizes, self.mask, self.best = height, sizes, mask, best
        count = _POPCOUNT[mask]
        self.child = 1 + np.cumsum(count) - count
        leaf = np.cumsum(mask == 0) - 1
        self.row, self.col = (np.where(mask == 0, x[np.maximum(leaf, 0)] if len(x) else 0, -1) for x in (rows, cols))

    @staticmethod
    def build(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> "Treap":
        """Of a grid's entries, at most one for each place."""
        height = max(int(max(row.max(), col.max())).bit_length(), 1)
        code = ((_spread(row) << np.uint64(1)) | _spread(col)).astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, value = code[order], value[order].astype(np.int64)
        masks, bests, leaves, sizes = [], [], [], []
        alive, start = np.arange(len(code)), np.zeros(1, np.int64)  # entries of the cells of a level that are no leaves; where each cell begins
        size = np.array([len(code)])
        for level in range(height + 1):
            sizes.append(len(start))
            bests.append(np.maximum.reduceat(value[alive], start))
            single = size == 1
            leaves.append(alive[start[single]])
            mask = np.zeros(len(start), np.uint8)
            inner = np.flatnonzero(~single)
            if len(inner):
                parent = np.repeat(np.arange(len(inner)), size[inner])
                alive = alive[np.repeat(~single, size)]
                key = code[alive] >> (2 * (height - level - 1))
                fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (parent[1:] != parent[:-1])))
                start = np.flatnonzero(fresh)
                size = np.diff(np.append(start, len(alive)))
                own = parent[start]
                mask[inner] = np.bitwise_or.reduceat(np.left_shift(1, key[start] & 3), np.searchsorted(own, np.arange(len(inner))))
            masks.append(mask)
            if not len(inner):
                break
        leaf = order[np.concatenate(leaves)]
        return Treap(height, np.array(sizes), np.concatenate(masks), np.concatenate(bests), row[leaf].astype(np.int64), col[leaf].astype(np.int64))

    def _parents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.mask)), _POPCOUNT[self.mask])

    def packed(self) -> dict[str, object]:
        """Compressed columns; maxima as differences to the parent's."""
        drop = self.best.copy()
        drop[1:] = self.best[self._parents()] - self.best[1:]
        leaf = self.mask == 0
        return {"height": self.height, "sizes": self.sizes.tolist(), "mask": _pack(self.mask, 1), "drop": _pack(drop), "rows": _pack(self.row[leaf]),
                "cols": _pack(self.col[leaf])}

    @staticmethod
    def unpacked(kept: dict) -> "Treap":
        sizes, mask, drop = np.array(kept["sizes"]), _unpack(kept["mask"], 1).astype(np.uint8), _unpack(kept["drop"])
        out = Treap(kept["height"], sizes, mask, drop, _unpack(kept["rows"]), _unpack(kept["cols"]))
        parent, edge = out._parents(), np.cumsum(sizes)
        for a, b in zip(edge, edge[1:]):
            drop[a:b] = drop[parent[a - 1: b - 1]] - drop[a:b]
        return out


def _pack(x: np.ndarray, width: int = 4) -> bytes:
    """Numbers below 256**width as compressed planes of their bytes."""
    return zstandard.compress(np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def _unpack(raw: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64)


_SHARD = T.StructType([
    T.StructField("term", T.BinaryType()),  # sorted hashes
    T.StructField("df", T.BinaryType()),  # documents of each, in the same order
    T.StructField("at", T.BinaryType()),  # its row of the grid
    T.StructField("ids", T.ArrayType(T.LongType())),  # of the columns
    T.StructField("height", T.IntegerType()), T.StructField("sizes", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.BinaryType()) for c in ("mask", "drop", "rows", "cols")],
])


def _shard(ids: pa.Array, h: np.ndarray, doc: np.ndarray, n_docs: int, n_terms: int) -> dict | None:
    """The index of documents from their terms' hashes."""
    if not len(h):
        return None
    n = np.bincount(doc, minlength=len(ids))
    some = np.flatnonzero(n)
    ids = ids.take(pa.array(some))
    # documents of about the same length have about the same impacts: ranges of them have closer bounds
    by_length = np.argsort(n[some], kind="stable")
    column = np.zeros(len(n), np.int64)
    column[some[by_length]] = np.arange(len(some))
    term, which = np.unique(h, return_inverse=True)
    key, tf = np.unique(which * len(some) + column[doc], return_counts=True)
    which, col = key // len(some), key % len(some)
    df = np.bincount(which, minlength=len(term))
    at = np.empty(len(term), np.int64)
    at[np.argsort(-df, kind="stable")] = np.arange(len(term))
    treap = Treap.build(at[which], col, impact(tf, n[some[by_length]][col], n_docs, n_terms))
    return {"term": term.tobytes(), "df": _pack(df), "at": _pack(at), "ids": ids.take(pa.array(by_length)).to_pylist()} | treap.packed()


@dataclass
class Index:
    """The written shards; the documents that have terms, and all their terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> Index:
    """Two passes over the documents, without a shuffle: the statistics that impacts need, then the shards."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off):
                _, _, row = tb.word_spans(tb.ALNUM[tb.LOWER[data[off[i]: off[j]]]], off[i: j + 1] - off[i])
                n_docs, n_terms = n_docs + int((np.diff(row, prepend=-1) != 0).sum()), n_terms + len(row)
        yield pa.RecordBatch.from_pydict({"n_docs": [n_docs], "n_terms": [n_terms]})

    total = rows.select("text").mapInArrow(count, "n_docs long, n_terms long").agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
    n_docs, n_terms = total.d or 0, total.t or 0

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            first = np.cumsum([0] + [len(ids) for ids, _, _ in held])
            found = _shard(pa.concat_arrays([ids for ids, _, _ in held]), np.concatenate([h for _, h, _ in held]),
                           np.concatenate([row + f for (_, _, row), f in zip(held, first)]), n_docs, n_terms) if held else None
            if found:
                yield pa.RecordBatch.from_pylist([found], pa.schema([
                    ("term", pa.binary()), ("df", pa.binary()), ("at", pa.binary()), ("ids", pa.list_(pa.int64())), ("height", pa.int32()),
                    ("sizes", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("mask", "drop", "rows", "cols")]]))
            held.clear()

        for batch in batches:
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off):
                if held and size + off[j] - off[i] > shard_bytes:
                    yield from flush()
                    size = 0
                h, row = terms(data[off[i]: off[j]], off[i: j + 1] - off[i])
                held.append((batch.column("id").slice(i, j - i), h, row))
                size += int(off[j] - off[i])
        yield from flush()
        pa.default_memory_pool().release_unused()

    return Index(materialize(rows.mapInArrow(index, _SHARD), "search-index"), n_docs, n_terms)


class _Grown:
    """An array that grows at its end."""

    def __init__(self) -> None:
        self.kept, self.n = np.zeros(1024, np.int64), 0

    def add(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.kept):
            self.kept = np.concatenate((self.kept, np.zeros(max(len(self.kept), self.n + len(x)), np.int64)))
        self.kept[self.n: self.n + len(x)] = x
        self.n += len(x)


def best_first(treap: Treap, query: np.ndarray, row: np.ndarray, weights: np.ndarray, floor: np.ndarray, k: int,
               batch: int = BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, column, score) of the k best columns of each query, and all that score as the k-th. ``query`` is ascending and tells whose
    the terms with a ``row`` and a weight are; columns that score below ``floor`` of the query may be missing."""
    h = treap.height
    state_query, level, start, bound, first, size = (_Grown() for _ in range(6))
    term, node = _Grown(), _Grown()

    def put(of: np.ndarray, level_: np.ndarray, start_: np.ndarray, begin: np.ndarray, t: np.ndarray, at: np.ndarray) -> np.ndarray:
        """New states with their terms' cells, from place ``begin`` of t and at on; the numbers of those that are worth it."""
        upper = np.add.reduceat(weights[t] * treap.best[at], begin)
        good = (upper > 0) & (upper >= floor[of])
        n = np.diff(np.append(begin, len(t)))
        entries = np.repeat(good, n)
        n = n[good]
        number = np.arange(state_query.n, state_query.n + len(n))
        first.add(term.n + np.cumsum(n) - n)
        for kept, x in ((state_query, of[good]), (level, level_[good]), (start, start_[good]), (bound, upper[good]), (size, n), (term, t[entries]),
                        (node, at[entries])):
            kept.add(x)
        return number

    if not len(query):
        return (np.zeros(0, np.int64),) * 3
    begin = np.flatnonzero(np.diff(query, prepend=-1))
    zero = np.zeros(len(begin), np.int64)
    if treap.mask[0]:
        todo = put(query[begin], zero, zero, begin, np.arange(len(query)), np.zeros(len(query), np.int64))
    else:  # one entry in all
        own = np.flatnonzero(treap.row[0] == row)
        todo = put(query[own], np.full(len(own), h), np.full(len(own), treap.col[0]), np.arange(len(own)), own, np.zeros(len(own), np.int64)) if len(own) else zero[:0]
    while True:
        order = np.lexsort((start.kept[todo], -bound.kept[todo], state_query.kept[todo]))
        todo = todo[order]
        edge = np.flatnonzero(np.diff(state_query.kept[todo], prepend=-1))
        group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(todo))))
        whole = level.kept[todo] == h
        found = np.cumsum(whole)
        ahead = found - (found - whole)[edge][group]  # single documents up to here
        kth = np.flatnonzero(whole & (ahead == k))
        enough = np.zeros(len(edge), np.int64)
        enough[group[kth]] = bound.kept[todo[kth]]
        keep = bound.kept[todo] >= enough[group]
        rank = np.arange(len(todo)) - edge[group]
        split = keep & ~whole & (rank < batch + ahead)
        if not split.any():
            done = todo[keep & whole]
            return state_query.kept[done], start.kept[done], bound.kept[done]
        now, todo = todo[split], todo[keep & ~split]
        n = size.kept[now]
        at = tb.ranges(first.kept[now], n)
        owner = np.repeat(np.arange(len(now)), n)
        cell, t = node.kept[at], term.kept[at]
        half = np.left_shift(1, h - 1 - level.kept[now])[owner]
        middle = start.kept[now][owner] + half
        mask = treap.mask[cell]
        leaf = mask == 0
        # a state whose cells are all leaves falls into its documents at once
        only = np.bitwise_and.reduceat(leaf, np.cumsum(n) - n)[owner]
        o, tt, cc = [owner[leaf]], [t[leaf]], [cell[leaf]]
        side = [np.where(only[leaf], treap.col[cell[leaf]], treap.col[cell[leaf]] >= middle[leaf])]
        inner = np.flatnonzero(~leaf)
        lower = (row[t[inner]] & half[inner]) > 0
        for right in (0, 1):
            quarter = 2 * lower + right
            has = (mask[inner] >> quarter) & 1 == 1
            which, q = inner[has], quarter[has]
            child = treap.child[cell[which]] + _POPCOUNT[mask[which] & (np.left_shift(1, q) - 1)]
            mine = (treap.mask[child] != 0) | (treap.row[child] == row[t[which]])
            o.append(owner[which[mine]])
            tt.append(t[which[mine]])
            cc.append(child[mine])
            side.append(np.full(int(mine.sum()), right))
        o, tt, cc, side = (np.concatenate(x) for x in (o, tt, cc, side))
        if not len(o):
            continue
        order = np.lexsort((side, o))
        o, tt, cc, side = o[order], tt[order], cc[order], side[order]
        begin = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (side[1:] != side[:-1]))))
        o, side = o[begin], side[begin]
        jump = np.bitwise_and.reduceat(leaf, np.cumsum(n) - n)[o]
        parent = now[o]
        new_level = np.where(jump, h, level.kept[parent] + 1)
        new_start = np.where(jump, side, start.kept[parent] + side * np.left_shift(1, h - 1 - level.kept[parent]))
        todo = np.concatenate((todo, put(state_query.kept[parent], new_level, new_start, begin, tt, cc)))


def _ranked(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """(query, score, id, id is null) of the k best of each query."""
    query, score, doc, null = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((doc, null, -score, query))
    query = query[order]
    edge = np.flatnonzero(np.diff(query, prepend=-1))
    rank = np.arange(len(query)) - np.repeat(edge, np.diff(np.append(edge, len(query))))
    order = order[rank < k]
    return tuple(np.concatenate(x)[order] for x in zip(*found))


def _frequencies(index: Index, wanted: np.ndarray) -> np.ndarray:
    """The documents that hold each of the ``wanted`` hashes (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                term = np.frombuffer(batch.column("term")[r].as_py(), np.uint64)
                at = np.minimum(np.searchsorted(term, wanted), len(term) - 1)
                df += np.where(term[at] == wanted, _unpack(batch.column("df")[r].as_py())[at], 0)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"k": pa.array(some), "df": pa.array(df[some])})

    out = np.zeros(len(wanted), np.int64)
    for r in index.shards.select("term", "df").mapInArrow(run, "k long, df long").groupBy("k").agg(F.sum("df").alias("df")).collect():
        out[r.k] = r.df
    return out


def _search_block(index: Index, texts: list[str], block: int, k: int) -> DataFrame:
    """Rows (block, item: its place in the block, score, doc_id): the best of every task."""
    h, item = terms(*tb.utf8(pa.array(texts, pa.string())))
    pair = np.unique(np.stack([item.astype(np.int64), h.view(np.int64)], 1), axis=0) if len(h) else np.zeros((0, 2), np.int64)
    item, h = pair[:, 0], pair[:, 1].copy().view(np.uint64)
    wanted, which = np.unique(h, return_inverse=True)
    weights = np.array([weight(index.n_docs, df) if df else 0 for df in _frequencies(index, wanted).tolist()], np.int64)[which]
    item, h, weights = item[weights > 0], h[weights > 0], weights[weights > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        floor = np.zeros(len(texts), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                shard = {c: batch.column(c)[r].as_py() for c in batch.schema.names if c != "ids"}
                term = np.frombuffer(shard["term"], np.uint64)
                at = np.minimum(np.searchsorted(term, h), len(term) - 1)
                here = np.flatnonzero(term[at] == h)
                if not len(here):
                    continue
                treap, row = Treap.unpacked(shard), _unpack(shard["at"])[at[here]]
                for a, b in itertools.pairwise(np.searchsorted(item[here], [*range(0, len(texts), GROUP), len(texts)])):
                    query, col, score = best_first(treap, item[here[a:b]], row[a:b], weights[here[a:b]], floor, k)
                    doc = batch.column("ids")[r].values.take(pa.array(col))
                    null = doc.is_null().to_numpy(zero_copy_only=False)
                    best = _ranked([best, (query, score, pc.fill_null(doc, _LAST).to_numpy(), null)], k)
                count = np.bincount(best[0], minlength=len(texts))
                edge = np.cumsum(count) - 1
                floor = np.where(count >= k, best[1][np.maximum(edge, 0)], 0) if len(best[0]) else floor
        query, score, doc, null = best
        yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(query), block, np.int64)), "item": pa.array(query), "score": pa.array(score),
                                          "doc_id": pa.array(doc, pa.int64(), mask=null)})

    return index.shards.select([c for c in index.shards.columns if c != "df"]).mapInArrow(run, "block long, item long, score long, doc_id long")


def search(index: Index, items: DataFrame, *, k: int = 10, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k best documents of every item. The items are read in blocks of about
    ``block_bytes`` of text, one at a time; a block's results are written before the next one is read."""
    spark = items.sparkSession
    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = -(-total // block_bytes)
    rows = materialize(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))), "search-items")
    path = scratch_path(spark, "search-results")
    named = spark.createDataFrame([], T.StructType([T.StructField(c, T.LongType()) for c in ("block", "item", "score", "doc_id")]
                                                   + [rows.schema["item_id"]]))
    named.write.parquet(path)
    for b in range(blocks):
        block = rows.where(F.col("block") == b).orderBy("item_id", "text").collect()
        found = _search_block(index, [r.text for r in block], b, k)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)],
                                    T.StructType([T.StructField("item", T.LongType()), rows.schema["item_id"]]))
        found.join(F.broadcast(ids), "item").select(named.columns).write.mode("append").parquet(path)
    rank = F.row_number().over(W.Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = spark.read.schema(named.schema).parquet(path).withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
