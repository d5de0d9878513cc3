"""Token-id files (operator 10): byte-level BPE ids, Huffman-coded, in document order.

``write_tokens`` range-partitions the documents by id, encodes every text with the
``tokenizers`` library, counts ids over all documents, and writes shards: rows of
Parquet files that each hold consecutive documents as a Huffman bit stream with a
checkpoint of its bit offset every 1024 ids, beside the table of code lengths.
``read_tokens`` decodes shards by table, all blocks of a shard side by side.

The library is the slow part, and most pieces that its pattern cuts a text into occur
again and again. So tasks cut texts by the same pattern, with arrays, and ask the
library for each distinct piece once; a text with one of the library's special strings
goes to it whole, and so does every text if the tokenizer's file names another normalizer, pattern or kind of model
than byte-level BPE with the usual pattern. Tests hold the ids against the library's own for whole texts.

Defined results: null text is empty; an empty text has only the end id. Documents are in
ascending id order, null ids first; rows with equal ids are ordered by a hash of the text.
An empty table gives files without shards.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import huffman, units
from . import textbytes as tb

END_ID = 0

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
#: White space of the pattern: the code points with the Unicode property White_Space.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe as a piece of its own.
_AFTER_APOSTROPHE = ("s", "t", "re", "ve", "m", "ll", "d")


def _char_classes() -> np.ndarray:
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, what in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(what, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a: b + 1] = kind
    out[0xD800:0xE000] = _OTHER
    out[_SPACES] = _SPACE
    return out


def cut(chars: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the pieces of the byte-level pattern, over code points of texts with offsets ``off``.

    Texts fall into runs of letters, numbers, white space and others. The last space of a run
    of white space joins the run behind it; other last white space before a run stands alone;
    an apostrophe that starts a piece takes the fixed endings of ``_AFTER_APOSTROPHE`` from the letters."""
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = tb.per_process("char classes", _char_classes)[chars]
    text_edge = np.zeros(n + 1, bool)
    text_edge[off] = True
    fresh = np.zeros(n + 1, bool)
    fresh[0] = True
    fresh[1:n] = kind[1:] != kind[:-1]
    fresh |= text_edge
    run = np.flatnonzero(fresh[:n])
    end = np.concatenate((run[1:], [n]))
    starts = fresh.copy()
    inner = (kind[run] == _SPACE) & ~text_edge[end]
    last = end[inner] - 1
    starts[last] = True
    starts[last[chars[last] == 0x20] + 1] = False
    quote = run[(chars[run] == 0x27) & (end - run == 1) & starts[run] & ~text_edge[end]]
    if len(quote):
        text_end = off[np.searchsorted(off, quote, "right")]
        for tail in _AFTER_APOSTROPHE:
            fits = quote + len(tail) < text_end
            for k, c in enumerate(tail):
                fits &= chars[np.minimum(quote + 1 + k, n - 1)] == ord(c)
            starts[quote[fits] + 1] = False
            starts[quote[fits] + 1 + len(tail)] = True
    begin = np.flatnonzero(starts[:n])
    return begin, np.concatenate((begin[1:], [n]))


def _byte_letters() -> dict[int, int]:
    """The printable character by which byte-level vocabularies write each byte: itself where Latin-1 prints it, else the
    next one from 256 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + k for k, b in enumerate(others)}


def cuts_by_the_pattern(path: str) -> bool:
    """Whether a tokenizer's file says that ids are those of the pieces of the byte-level pattern, one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")))


class Pieces(units.UnitIds):
    """Ids of the pieces that the pattern cuts, by the library's model; of texts with special strings by the whole library."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.by_pieces = cuts_by_the_pattern(path)

    def encode_new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenise, letters = self.tokenizer.model.tokenize, self.letters
        found = [tokenise(s.encode(errors="replace").decode("latin-1").translate(letters)) for s in pieces]
        return np.array([t.id for tokens in found for t in tokens], np.uint32), np.array([len(tokens) for tokens in found], np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each)."""
        text, chars, at = units.decoded(data, off)
        if not self.by_pieces:
            found = [self.tokenizer.encode(text[a:b], add_special_tokens=False).ids for a, b in zip(at.tolist(), at[1:].tolist())]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        start, end = cut(chars, at)
        ids, size = self.lookup(text, chars, start, end)
        row = np.searchsorted(at, start, "right") - 1
        n = np.bincount(row, size, minlength=len(off) - 1).astype(np.int64)
        return self._whole(text, at, ids, n) if any(s in text for s in self.special) else (ids, n)

    def _whole(self, text: str, at: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with texts that hold a special string encoded whole."""
        parts, n, edge = [], n.copy(), np.concatenate(([0], np.cumsum(n)))
        for r in range(len(n)):
            part = ids[edge[r]: edge[r + 1]]
            own = text[at[r]: at[r + 1]]
            if any(s in own for s in self.special):
                part = np.array(self.tokenizer.encode(own, add_special_tokens=False).ids, np.uint32)
                n[r] = len(part)
            parts.append(part)
        return np.concatenate(parts), n


def _with_end(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.insert(ids, np.cumsum(n), np.uint32(END_ID))


def _tokenised(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Shards in document order (partition, number and first id's place within it); ids compressed, in 16 bits if they fit."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # by the text's hash too: rows with equal ids can be divided
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Pieces = tb.per_process("pieces " + tokenizer, lambda: Pieces(tokenizer))
        pack = zstandard.ZstdCompressor(3)
        part, seq, inside = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            data, off = tb.utf8(batch.column("text"))
            for i, j in tb.pieces(off):
                ids, n = known.encode(data[off[i]: off[j]], off[i: j + 1] - off[i])
                ids = _with_end(ids, n)
                narrow = ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "inside": pa.array([inside], pa.int64()),
                    "doc_ids": pa.array([batch.column("id").slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                    "sizes": pa.array([n + 1], pa.list_(pa.int64())), "n_ids": pa.array([len(ids)], pa.int64()),
                    "wide": pa.array([narrow.itemsize], pa.int32()), "ids": pa.array([pack.compress(narrow.tobytes())], pa.binary())})
                seq, inside = seq + 1, inside + len(ids)

    return rows.mapInArrow(run, "part int, seq int, inside long, doc_ids array<long>, sizes array<long>, n_ids long, wide int, ids binary")


def _unpacked(ids: pa.Scalar, wide: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids.as_buffer()), np.uint16 if wide.as_py() == 2 else np.uint32)


def id_counts(shards: DataFrame) -> np.ndarray:
    """Occurrences of each id over all shards; one row for each id of the vocabulary reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, wide in zip(batch.column("ids"), batch.column("wide")):
                more = np.bincount(_unpacked(ids, wide))
                total, more = (total, more) if len(total) >= len(more) else (more, total)
                total = total.astype(np.int64)
                total[: len(more)] += more
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    got = shards.select("ids", "wide").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(got["id"].max()) + 1 if len(got) else 1, np.int64)
    counts[got["id"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return counts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents' ids below ``path``: ``codes`` (id, bits) and ``shards``. ``tokenizer`` is the
    path of a byte-level BPE file, which all executors have."""
    spark = docs.sparkSession
    raw = materialize(_tokenised(docs, tokenizer, id_col, text_col), "token-ids")
    lengths = huffman.code_lengths(id_counts(raw))
    coded = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in coded], "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    # ids before each partition: as many rows as the write has tasks reach the driver and go back
    base, before = {}, 0
    for r in raw.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        base[r["part"]], before = before, before + r["n"]
    starts = spark.createDataFrame(list(base.items()), "part int, base long")
    placed = raw.join(F.broadcast(starts), "part").withColumn("start", F.col("base") + F.col("inside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(lengths)
        for batch in batches:
            bits, checkpoints = zip(*(huffman.encode(_unpacked(i, w), lengths, codes) for i, w in zip(batch.column("ids"), batch.column("wide"))))
            keep = ["part", "seq", "start", "n_ids", "doc_ids", "sizes"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(checkpoints, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                keep + ["checkpoints", "bits"])

    shards = placed.mapInArrow(run, "part int, seq int, start long, n_ids long, doc_ids array<long>, sizes array<long>, "
                                    "checkpoints array<long>, bits binary")
    shards.write.option("compression", "zstd").parquet(f"{path}/shards")


def _decoded(spark: SparkSession, path: str, schema: str, make) -> DataFrame:
    """``make(shard's doc ids, sizes, start, ids)`` for every shard."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 1, np.uint8)
    lengths[codes["id"].to_numpy(np.int64)] = codes["bits"].to_numpy(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = huffman.Decoder(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                ids = decoder.decode(row["bits"].as_buffer(), row["checkpoints"].values.to_numpy(), row["n_ids"].as_py())
                yield make(row["doc_ids"].values, row["sizes"].values.to_numpy(), row["start"].as_py(), ids)

    return spark.read.parquet(f"{path}/shards").mapInArrow(run, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files, the end id included."""
    def make(doc_ids, sizes, start, ids):
        off = np.concatenate(([0], np.cumsum(sizes)))
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(start + off[:-1]), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))],
            ["doc_id", "start", "ids"])

    return _decoded(spark, path, "doc_id long, start long, ids array<int>", make)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    def make(doc_ids, sizes, start, ids):
        raw, off = ids.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(sizes)))
        crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(off.tolist(), off[1:].tolist())]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(start + off[:-1]), pa.array(sizes), pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _decoded(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", make)
