"""MinHash near-duplicate documents (operator 5).

1. One pass over the documents makes each text's set of word shingles (64-bit
   hashes), a fingerprint of the set, and a one-permutation MinHash: every shingle
   falls into one bin, bins keep their minimum, and empty bins borrow from the bins
   that a fixed hash sequence names (optimal densification). Bands of bins become
   bucket keys.
2. Documents with equal sets are one class. Only classes go on, so thousands of
   exact copies cost no pairs.
3. Candidates are stars: in every bucket the smallest node against each other member.
   They are confirmed on the full sets, and confirmed links give components.
4. A star can miss a link between two members that both differ from its centre. So in
   buckets that span several components, the member with the most links becomes the centre of
   another star, ``HUB_ROUNDS`` times. Then each member outside the largest component is held
   against the members of other components by a bitmap filter: a set's bitmap has the parity
   of its shingles in each of ``CELLS`` cells, and two bitmaps differ in at most as many cells as the
   sets differ in shingles. Only pairs that the filter can't rule out become rows. After that
   every pair that shares a bucket is confirmed, refuted or already connected.

Bands and rows follow from the threshold, so that a pair just at it shares no bucket
with a probability below ``MISS``; this is the only way to miss a link.

Defined results: null, empty or blank text has an empty set, no link, and its own id as
component. Texts with fewer words than a shingle are one shingle. Repeated rows and
equal ids are separate nodes that join like any copies. A null id is never the smallest;
a component of null ids has a null component id. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textbytes as tb
from .bloom import Bloom
from .components import components
from .names import BLOOM, set_aside

MISS = 1e-6
#: Further stars, which only leave less to the last step; cells of the parity bitmap.
HUB_ROUNDS = 2
CELLS = 1024
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows of a band) for a similarity of ``percent``."""
    t = percent / 100
    rows = 6 if t >= 0.85 else 5 if t >= 0.75 else 4
    return math.ceil(math.log(MISS) / math.log(1 - t**rows)), rows


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, ordered by row and hash. Letters A-Z are lower-cased."""
    low = tb.LOWER[data]
    start, end, row = tb.word_spans(tb.NOT_SPACE[low], off)
    word = tb.span_hashes(low, start, end)
    n = np.bincount(row, minlength=len(off) - 1)
    first = np.cumsum(n) - n
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = tb.ranges(first, count)
    owner = np.repeat(np.arange(len(n)), count)
    size = np.minimum(n, width)[owner]
    h = size.astype(np.uint64)
    for k in range(width):
        inside = k < size
        h = np.where(inside, tb.mix(h * np.uint64(0x9FB21C651E98DF25) + word[np.minimum(at + k, len(word) - 1)]), h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], h[fresh]


def one_permutation(owner: np.ndarray, h: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Signatures (n x bins) of rows that all have a shingle."""
    value = tb.mix(h ^ np.uint64(0xA0761D6478BD642F))
    which = ((value >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    sig = np.full(n * bins, _EMPTY)
    np.minimum.at(sig, owner * bins + which.astype(np.int64), tb.mix(value))
    sig = sig.reshape(n, bins)
    source = sig.copy()
    todo = np.flatnonzero((sig == _EMPTY).any(1))
    places = np.arange(bins, dtype=np.uint64)
    for attempt in range(1, 64 * bins):
        if not len(todo):
            return sig
        lend = (tb.mix(places * np.uint64(bins * 64) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        part = sig[todo]
        part = np.where(part == _EMPTY, source[todo][:, lend], part)
        sig[todo] = part
        todo = todo[(part == _EMPTY).any(1)]
    return np.where(sig == _EMPTY, source.min(1, keepdims=True), sig)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
    for r in range(rows):
        key = tb.mix(key * np.uint64(0x9FB21C651E98DF25) + sig[:, r::rows][:, :bands])
    return key


def parity_bitmaps(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """n x CELLS / 64 numbers: the parity of the number of each row's shingles in each cell."""
    cell = (tb.mix(h ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(CELLS)).astype(np.int64)
    odd = (np.bincount(owner * CELLS + cell, minlength=n * CELLS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(n, -1)


def _signatures(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, node, n, f1, f2, bands, bits) of every row; f1 and f2 are a 128-bit fingerprint of the set."""
    some = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("node"), F.col(text_col).alias("text"))
    id_type = some.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, "text"):
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off):
                owner, h = shingle_sets(data[off[i]: off[j]], off[i: j + 1] - off[i], width)
                n = np.bincount(owner, minlength=j - i)
                f1, f2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                np.add.at(f1, owner, tb.mix(h + np.uint64(1)))
                np.add.at(f2, owner, tb.mix(h ^ np.uint64(0xE7037ED1A0B428DB)))
                some_ = np.flatnonzero(n)
                place = np.cumsum(n > 0) - 1
                keys = band_keys(one_permutation(place[owner], h, len(some_), bands * rows), bands, rows)
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
                bits = parity_bitmaps(owner, h, j - i)
                cells = np.arange(j - i + 1, dtype=np.int32) * bits.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), batch.column("node").slice(i, j - i), pa.array(n.astype(np.int64)),
                     pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(cells), pa.array(bits.reshape(-1)))],
                    ["id", "node", "n", "f1", "f2", "bands", "bits"])

    return some.mapInArrow(run, f"id {id_type}, node long, n long, f1 long, f2 long, bands array<long>, bits array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the sorted hashes of (node, text) rows as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.slices(batches, "text"):
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off):
                owner, h = shingle_sets(data[off[i]: off[j]], off[i: j + 1] - off[i], width)
                ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=j - i)))) * 8
                raw = h.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(i, j - i), pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())],
                    ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    small = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return small.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").mapInArrow(run, "a long, b long")


def _sized(percent: int):
    """Sets whose sizes differ more than the similarity allows can't be linked."""
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id, kept (the id is its component's smallest), node (hash of id and text).

    Links join rows whose shingle sets have 100 * intersection >= percent * union."""
    return _labelled(docs, id_col, text_col, width, percent).drop("label")


def _labelled(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The columns of ``near_duplicates``, and label: a node that stands for the component; for an empty set its own."""
    bands, rows = banding(percent)
    sigs = materialize(_signatures(docs, id_col, text_col, width, bands, rows), "minhash-sigs")
    classes = materialize(sigs.where("n > 0").groupBy("f1", "f2").agg(
        F.min("id").alias("id"), F.min_by(F.struct("node", "n", "bands", "bits"), F.struct("id", "node")).alias("r")
    ).select("f1", "f2", "id", "r.*"), "minhash-classes")

    entries = classes.select(F.explode("bands").alias("key"), "node", "n")
    buckets = entries.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = materialize(entries.join(buckets, "key"), "minhash-members")
    stars = materialize(members.where("node <> hub.node").select(
        F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb")
    ).where(_sized(percent)).select("a", "b").distinct(), "minhash-stars")

    # Only members of shared buckets can have to be compared.
    needed = materialize(members.select("node").distinct(), "minhash-needed")
    texts = Bloom(needed, "node", needed.count()).keep(
        docs.select(F.xxhash64(id_col, text_col).alias("node"), F.col(text_col).alias("text")), "node")
    texts = texts.join(needed, "node", "left_semi").dropDuplicates(["node"])
    sets = materialize(_sets(texts, width), "minhash-sets")
    links = materialize(_confirm(stars, sets, percent), "minhash-links")
    labels = components(links)

    wide = members.where("size > 2")
    for _ in range(HUB_ROUNDS):
        more = materialize(_confirm(_hub_pairs(wide, labels, links, percent), sets, percent), "minhash-links")
        if not more.head(1):
            break
        links = links.union(more)
        labels = components(links)
    rest = materialize(_cross_pairs(wide, labels, classes, percent), "minhash-rest")
    more = materialize(_confirm(rest.join(stars, ["a", "b"], "left_anti"), sets, percent), "minhash-links")
    if more.head(1):
        labels = components(links.union(more))

    named = classes.join(labels, "node", "left").select("f1", "f2", "id", F.coalesce("label", "node").alias("label"))
    lowest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_class = named.join(lowest, "label").select("f1", "f2", "component_id", "label")
    empty = sigs.where("n = 0").select("id", "n", F.col("id").alias("component_id"), "node", F.col("node").alias("label"))
    out = sigs.where("n > 0").select("id", "n", "f1", "f2", "node").join(of_class, ["f1", "f2"]).select(
        "id", "n", "component_id", "node", "label").union(empty)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "node", "label")


@set_aside("__rid", "kept", *BLOOM)
def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the document of the smallest id stays, once;
    of equal ids that of the smallest hash, and one of a null id only where all are null.
    Texts are shuffled only where a row may go."""
    judged = _labelled(docs, id_col, text_col, width, percent)
    nodes = materialize(judged.groupBy("node").agg(F.min("label").alias("label"), F.min(id_col).alias("id"), F.count("*").alias("n")), "minhash-nodes")
    first = nodes.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("x")).select(
        F.col("x.node").alias("node"), F.lit(True).alias("kept"))
    nodes = nodes.join(first, "node", "left").select("node", F.coalesce("kept", F.lit(False)).alias("kept"), "n")
    change = materialize(nodes.where("NOT kept OR n > 1").select(F.col("node").alias("__rid"), "kept"), "minhash-gone")
    rows = docs.withColumn("__rid", F.xxhash64(id_col, text_col))
    maybe, rest = Bloom(change, "__rid", change.count()).split(rows, "__rid")
    stay = maybe.join(change, "__rid", "left").where("coalesce(kept, true)").dropDuplicates(["__rid"])
    return rest.unionByName(stay.select(rest.columns)).drop("__rid")


def _hub_pairs(members: DataFrame, labels: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """In every bucket of several components, its member with the most links against the members of other components."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    facts = labels.join(degree, "node", "left")
    placed = members.select("key", "node", "n").join(facts, "node", "left").select(
        "key", "node", "n", F.coalesce("label", "node").alias("label"), F.coalesce("degree", F.lit(0)).alias("degree"))
    hubs = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                     F.max(F.struct("degree", "node", "n", "label")).alias("hub")).where("lo < hi")
    pairs = placed.join(hubs.select("key", "hub"), "key").where(F.col("label") != F.col("hub.label")).select(
        F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb"))
    return pairs.where(_sized(percent)).select("a", "b").distinct()


def _cross_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) that share a bucket but no component and pass the bitmap filter, one of them outside the
    bucket's largest component."""
    placed = members.select("key", "node", "n").join(labels, "node", "left").select(
        "key", "node", "n", F.coalesce("label", "node").alias("label"))
    parts = placed.groupBy("key", "label").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("c", "label")).alias("top")).where("parts > 1")
    open_ = placed.join(mixed.select("key", F.col("top.label").alias("main")), "key").join(classes.select("node", "bits"), "node")
    open_ = materialize(open_, "minhash-open")
    outside = open_.where("label <> main").select("key", *[F.col(c).alias(c + "1") for c in ("node", "n", "label", "bits")])
    pairs = outside.join(open_.select("key", *[F.col(c).alias(c + "2") for c in ("node", "n", "label", "bits")]), "key")
    differ = sum((F.bit_count(F.get("bits1", F.lit(i)).bitwiseXOR(F.get("bits2", F.lit(i)))) for i in range(CELLS // 64)), F.lit(0))
    both = F.col("n1") + F.col("n2")
    near = (100 + percent) * differ <= (100 - percent) * both  # the symmetric difference is (1 - t) / (1 + t) of both sizes at most
    return pairs.where((F.col("label1") != F.col("label2")) & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & near).select(
        F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()
