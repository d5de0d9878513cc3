"""Stupid-backoff language-model scores (operator 8).

Every document is scored by the n-gram counts of all other documents: the counts over
the whole corpus less its own. For a word, the highest order whose n-gram occurs
elsewhere gives count(n-gram) / count(history), times ``BACKOFF`` for every order passed
over; a word that occurs nowhere else counts as one in N + 1.

The tables are relations of blocks instead of single rows, as a row for each n-gram of
each document would be several times the corpus:

1. Documents are put together to chunks of some MB, written to the shared folder.
2. Each chunk is exploded to its distinct n-grams, with counts, in slices by the top bits
   of their 64-bit hashes: the requests (chunk, part, hashes, counts).
3. Grouped by part, a slice of the hash space of all chunks meets. It sums to the count
   table of that part, and answers each request with the totals, in the order asked.
4. The answers are joined to their chunks, and scores summed per document.

A very frequent n-gram is one entry for a chunk, so no part is larger than others;
the number of parts grows with the text. A chunk makes ``FAN`` requests at most, so that their number doesn't grow with the
text's square: with more parts, the exchange goes in steps. The requests of ``FAN`` chunks for the same wide
part are merged to one count table, which asks for ``FAN`` narrower parts in their place, and so on; the answers come
back the same way. Every step has as many requests as there are chunks, times ``FAN``.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Defined results: null text, or
text without a word, has no words, a score of 0 and a null perplexity. Repeated rows are
documents of their own, each seen by the others. With a single document all words are
unknown. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textbytes as tb

BACKOFF = 0.4
#: Bytes of text in a chunk, and of text whose n-grams share a part.
CHUNK = 8_000_000
PART = 8_000_000
LEAST_PARTS = 64
#: Binary digits of the hash that one step of the exchange tells apart.
FAN_BITS = 8


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers compressed by byte planes, which leaves out the high bytes that are zero."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, sizes, text): compressed texts, one after the other."""
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = some.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off, CHUNK):
                ids = batch.column("id").slice(i, j - i)
                yield pa.RecordBatch.from_arrays([
                    pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), ids),
                    pa.array([np.diff(off[i: j + 1])], pa.list_(pa.int64())),
                    pa.array([pack.compress(data[off[i]: off[j]].tobytes())], pa.binary())], ["chunk", "ids", "sizes", "text"])

    return some.mapInArrow(run, f"chunk string, ids array<{id_type}>, sizes array<long>, text binary")


def _ngrams(text: bytes, sizes: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(row of each word, per order the hash of the n-gram that ends at each word, and whether it lies in the row)."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
    off = np.concatenate(([0], np.cumsum(sizes)))
    words, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in tb.pieces(off):
        low = tb.LOWER[data[off[i]: off[j]]]
        start, end, row = tb.word_spans(tb.NOT_SPACE[low], off[i: j + 1] - off[i])
        words.append(tb.span_hashes(low, start, end))
        rows.append(row + i)
    word, row = np.concatenate(words), np.concatenate(rows)
    grams, inside = [word], [np.ones(len(word), bool)]
    for _ in range(1, order):
        before = np.concatenate((np.zeros(1, np.uint64), grams[-1][:-1]))[: len(word)]
        within = np.concatenate(([False], inside[-1][:-1] & (row[1:] == row[:-1])))[: len(word)]
        grams.append(tb.mix(before * np.uint64(0x9FB21C651E98DF25) + word))
        inside.append(within)
    return row, grams, inside


_REQUEST = "chunk string, part int, hashes array<binary>, counts array<binary>"
_ANSWER = "chunk string, part int, totals array<binary>, words long"


def _sliced(chunk: str, part: int, done: int, bits: int, tables: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Requests of a node that has ``tables`` (by order: sorted hashes, counts) in ``part``, a prefix of ``done`` digits, by ``bits`` more digits."""
    first = part << bits
    slices: list[list[tuple[bytes, bytes]]] = [[] for _ in range(1 << bits)]
    for hashes, counts in tables:
        edge = np.searchsorted(hashes >> np.uint64(64 - done - bits), np.arange(first, first + (1 << bits) + 1, dtype=np.uint64)) if done + bits else [0, len(hashes)]
        for p, (a, b) in enumerate(zip(edge, edge[1:])):
            slices[p].append((_pack(np.diff(hashes[a:b], prepend=np.uint64(0))), _pack(counts[a:b])))
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(slices)), pa.array(range(first, first + len(slices)), pa.int32()),
         pa.array([[x for x, _ in s] for s in slices], pa.list_(pa.binary())), pa.array([[x for _, x in s] for s in slices], pa.list_(pa.binary()))],
        ["chunk", "part", "hashes", "counts"])


def _requests(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """(chunk, part, hashes, counts): lists with an entry for each order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sizes, text in zip(*(batch.column(c) for c in ("chunk", "sizes", "text"))):
                _, grams, inside = _ngrams(text.as_buffer(), sizes.values.to_numpy(), order)
                yield _sliced(chunk.as_py(), 0, 0, bits, [np.unique(g[w], return_counts=True) for g, w in zip(grams, inside)])
                del grams, inside
                tb.give_back()

    return chunks.mapInArrow(run, _REQUEST)


def _summed(group: pa.Table, o: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all requests for the same part: the hashes of an order, their counts added up, and where each request has its own."""
    asked = [np.cumsum(_unpack(h[o])) for h in group.column("hashes").to_pylist()]
    counts = [_unpack(c[o]) for c in group.column("counts").to_pylist()]
    known, where = np.unique(np.concatenate(asked), return_inverse=True)
    sums = np.bincount(where, np.concatenate(counts).astype(float), minlength=len(known)).astype(np.uint64)
    edge = np.concatenate(([0], np.cumsum([len(a) for a in asked])))
    return known, sums, [where[a:b] for a, b in zip(edge, edge[1:])]


def _answered(group: pa.Table, totals: list[list[bytes]]) -> pa.Table:
    words = [int(_unpack(c[0]).sum()) for c in group.column("counts").to_pylist()]
    return pa.table({"chunk": group.column("chunk"), "part": group.column("part"), "totals": pa.array(totals, pa.list_(pa.binary())),
                     "words": pa.array(words, pa.int64())})


def _answers(requests: DataFrame, order: int, done: int, left: int, nodes: int, fan_bits: int = FAN_BITS) -> DataFrame:
    """(chunk, part, totals, words): the totals of every request in its order, and its words.

    ``requests`` of about ``nodes`` chunks tell ``done`` digits apart; ``left`` more are needed for parts of the size wanted."""
    def count(group: pa.Table) -> pa.Table:
        totals: list[list[bytes]] = [[] for _ in range(group.num_rows)]
        for o in range(order):
            _, sums, where = _summed(group, o)
            for k, w in enumerate(where):
                totals[k].append(_pack(sums[w]))
            tb.give_back()
        return _answered(group, totals)

    if not left:
        return requests.groupBy("part").applyInArrow(count, _ANSWER)

    bits, groups = min(fan_bits, left), max(1, nodes >> fan_bits)
    requests = materialize(requests.withColumn("team", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("string")), "lm-requests")

    def merge(group: pa.Table) -> pa.Table:
        team, part = group.column("team")[0].as_py(), group.column("part")[0].as_py()
        return pa.Table.from_batches([_sliced(team, part, done, bits, [_summed(group, o)[:2] for o in range(order)])])

    merged = requests.groupBy("team", "part").applyInArrow(merge, _REQUEST)
    wider = _answers(merged, order, done + bits, left - bits, groups, fan_bits).select(
        F.col("chunk").alias("asker"), F.shiftright("part", bits).alias("parent"), F.col("part").alias("narrow"), "totals")

    def pass_on(group: pa.Table, answers: pa.Table) -> pa.Table:
        found = answers.sort_by("narrow").column("totals").to_pylist()
        totals: list[list[bytes]] = [[] for _ in range(group.num_rows)]
        for o in range(order):
            sums = np.concatenate([_unpack(t[o]) for t in found])
            for k, w in enumerate(_summed(group, o)[2]):
                totals[k].append(_pack(sums[w]))
        return _answered(group, totals)

    return requests.groupBy("team", "part").cogroup(wider.groupBy("asker", "parent")).applyInArrow(pass_on, _ANSWER)


def backoff_scores(row: np.ndarray, seen: list[np.ndarray], inside: list[np.ndarray], total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log score, whether a lower order was used) of every word. ``seen``: by order, how often other
    documents have the n-gram that ends at the word; ``total``: the words of other documents."""
    known = np.where(seen[0] > 0, seen[0] / np.maximum(total, 1), 1 / (total + 1))
    score, lower = np.log(known), np.zeros(len(row), bool)
    for o in range(1, len(seen)):
        history = np.concatenate(([0.0], seen[o - 1][:-1]))[: len(row)]
        use = inside[o] & (seen[o] > 0)
        score = np.where(use, np.log(np.where(use, seen[o], 1) / np.where(use, history, 1)), score + np.log(BACKOFF) * inside[o])
        lower = np.where(inside[o], ~use, lower)
    return score, lower


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = 3, part_bytes: int = PART,
              least_parts: int = LEAST_PARTS, fan_bits: int = FAN_BITS) -> DataFrame:
    """(id, n_words, n_backoff, log_score, perplexity) of every row."""
    chunks = materialize(_chunks(docs, id_col, text_col), "lm-chunks")
    stats = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("size"), F.count("chunk").alias("n")).first()
    bits = (max(least_parts, -(-(stats["size"] or 0) // part_bytes)) - 1).bit_length()
    first = min(bits, fan_bits)
    answers = materialize(_answers(_requests(chunks, order, first), order, first, bits - first, stats["n"], fan_bits), "lm-answers")
    words = answers.agg(F.sum("words")).first()[0] or 0
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        by_part = right.sort_by("part").column("totals").to_pylist()
        for ids, sizes, text in zip(*(left.column(c) for c in ("ids", "sizes", "text"))):
            sizes = sizes.values.to_numpy()
            row, grams, inside = _ngrams(text.as_buffer(), sizes, order)
            n = np.bincount(row, minlength=len(sizes))
            seen = []
            for o, (g, w) in enumerate(zip(grams, inside)):
                _, which = np.unique(g[w], return_inverse=True)
                totals = np.concatenate([_unpack(p[o]) for p in by_part]).astype(np.int64)
                _, own, times = np.unique(row[w] * (len(totals) + 1) + which, return_inverse=True, return_counts=True)
                elsewhere = np.zeros(len(row))
                elsewhere[w] = totals[which] - times[own]
                seen.append(elsewhere)
            logs, lower = backoff_scores(row, seen, inside, (words - n)[row])
            total = np.bincount(row, logs, minlength=len(n)).astype(float)
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                ppl = np.exp(-total / n)
            out.append(pa.table({id_col: ids.values, "n_words": pa.array(n.astype(np.int64)),
                                 "n_backoff": pa.array(np.bincount(row, lower, minlength=len(n)).astype(np.int64)),
                                 "log_score": pa.array(total), "perplexity": pa.array(ppl, mask=n == 0)}))
            tb.give_back()
        return pa.concat_tables(out) if out else pa.table({id_col: pa.array([]), "n_words": [], "n_backoff": [], "log_score": [], "perplexity": []})

    return chunks.groupBy("chunk").cogroup(answers.select("chunk", "part", "totals").groupBy("chunk")).applyInArrow(
        score, f"`{id_col}` {id_type}, n_words long, n_backoff long, log_score double, perplexity double")
