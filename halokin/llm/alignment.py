"""Alignment of two tokenizers over a corpus (operator 12).

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, which encodes a space and
the text; B is a SentencePiece model, which adds that space itself. Where a token of
each ends at the same byte of a text, the two are linked, and the text is cut into groups.

Tasks work on Arrow columns, a chunk of documents at a time: the id lists are flattened, with
the index of their row as parent; byte ends are cumulative sums within each row; an
Acero hash join of A's and B's tokens on (row, end) gives the links, and
``Table.group_by`` their counts by id pair. Spark adds these partial counts up over the
corpus, joins the sums to every chunk's pairs, and brings them back to the documents of the chunk
(a cogroup of documents and answers, whose size the chunk's text bounds). A pair is one row
for a chunk, however frequent; nothing is collected or broadcast by this module.

Defined results: texts that are null or empty, or whose tokens of A or B do not join to the
space and the text (such as a text with U+2581), have no tokens: zeros and an empty
``groups_sha256``. Special tokens' strings are plain text. A repeated row is another
document, whose links count again. Of id pairs with equally many links all are best.
A text longer than a chunk is a chunk of its own. An empty table gives no
rows. Columns of ``docs`` with the names of the added ones are replaced; other names can't clash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import pieces, token_files
from . import textbytes as tb

#: Bytes of text in a chunk, whose pairs are counted together.
CHUNK = 4_000_000
#: Bytes of text that are encoded and joined at a time, which takes some 100 bytes of memory for a byte of text.
STEP = 1 << 20

_COUNTED = T.StructType([T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                        + [T.StructField("groups_sha256", T.StringType())])
ADDED = [*_COUNTED.names[:4], "n_best", "count_sum", "groups_sha256"]
_PAIR = T.StructType([T.StructField(c, T.IntegerType()) for c in ("i", "a", "b")] + [T.StructField("n", T.LongType())])


def _lists(n: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    """Consecutive lists of ``n`` values each."""
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int64)), values)


def _joined(lists: pa.LargeListArray, between: str = "") -> pa.Array:
    kind = lists.type.value_type
    return pc.binary_join(lists, pa.scalar(between.encode() if pa.types.is_large_binary(kind) else between, kind))


def _encoded_lists(encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], texts: pa.Array) -> pa.LargeListArray:
    """The id list of every text. Encoding takes some 100 bytes of memory for a byte of text, so it goes by pieces."""
    data, off = tb.utf8(texts)
    found = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
    for i, j in tb.pieces(off):
        ids, n = encode(data[off[i]: off[j]], off[i: j + 1] - off[i])
        found.append((ids.astype(np.int32), n))
    return _lists(np.concatenate([n for _, n in found]), pa.array(np.concatenate([ids for ids, _ in found])))


class Aligner:
    def __init__(self, a_path: str, b_path: str) -> None:
        self.a = token_files.Pieces(a_path)
        self.a.special, self.a.tokenizer.encode_special_tokens = [], True  # their strings are plain text here
        byte = {chr(c): b for b, c in self.a.letters.items()}
        vocabulary = self.a.tokenizer.get_vocab()
        raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            raw[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = pieces.PieceModel(b_path)
        self.bytes = [pa.array(r, pa.large_binary()) for r in (raw, self.b.raw)]
        self.length = [pc.binary_length(r) for r in self.bytes]
        self.decimal = [pa.array(map(str, range(len(r))), pa.large_string()) for r in self.bytes]

    def _tokens(self, text: pa.Array) -> tuple[list[pa.LargeListArray], np.ndarray]:
        """The id lists of A and B, and which rows have tokens at all; lists of the others are empty."""
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string()))
        lists = [_encoded_lists(self.a.encode, spaced), _encoded_lists(self.b.encode, text)]
        good = pc.not_equal(text, "")
        for ids, raw in zip(lists, self.bytes):
            whole = _joined(pa.LargeListArray.from_arrays(ids.offsets, raw.take(ids.values)))
            good = pc.and_(good, pc.equal(whole, spaced.cast(pa.large_binary())))
        return [pc.if_else(good, x, pa.scalar([], x.type)) for x in lists], good.to_numpy(zero_copy_only=False)

    def _ends(self, ids: pa.LargeListArray, which: int) -> pa.Table:
        """(key, row, at) of every token: its row with the byte at which it ends there in one number, and its place in the batch."""
        row = pc.list_parent_indices(ids)
        total = pc.cumulative_sum(self.length[which].take(pc.list_flatten(ids)).cast(pa.int64()))
        before = np.concatenate(([0], total.to_numpy()))[np.concatenate(([0], np.cumsum(pc.list_value_length(ids).to_numpy())))][:-1]
        key = pc.add(pc.shift_left(row, 40), pc.subtract(total, pa.array(before).take(row)))
        return pa.table({"key": key, f"row_{which}": row, f"at_{which}": pa.array(np.arange(len(row)))})

    def align(self, text: pa.Array) -> tuple[dict[str, pa.Array], pa.Table, np.ndarray, np.ndarray]:
        """(the counted columns, the id pairs of all links with their number, each link's pair, links of each row)."""
        text = pc.fill_null(text.cast(pa.large_string()), "")
        lists, good = self._tokens(text)
        ids = [pc.list_flatten(x) for x in lists]
        links = self._ends(lists[0], 0).join(self._ends(lists[1], 1), "key", join_type="inner", use_threads=False).sort_by("at_0").combine_chunks()
        at = [links.column(f"at_{k}").to_numpy() for k in (0, 1)]
        groups = [_joined(pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], at[k] + 1))), self.decimal[k].take(ids[k])), ",") for k in (0, 1)]
        n_links = np.bincount(links.column("row_0").to_numpy(), minlength=len(text)).astype(np.int64)
        written = _joined(_lists(n_links, pc.binary_join_element_wise(*groups, pa.scalar("|", pa.large_string()))), ";")
        sha = [hashlib.sha256(w.as_buffer()).hexdigest() if ok else "" for w, ok in zip(written, good)]
        linked = pa.table({c: ids[k].take(pa.array(at[k])) for k, c in enumerate("ab")})
        pairs = linked.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        key = [t.column("a").to_numpy().astype(np.int64) << 32 | t.column("b").to_numpy() for t in (pairs, linked)]
        own = pc.index_in(pa.array(key[1]), value_set=pa.array(key[0])).to_numpy(zero_copy_only=False).astype(np.int32)
        n = [pc.list_value_length(x).cast(pa.int64()) for x in lists]
        columns = {"n_a": n[0], "n_b": n[1], "n_groups": pa.array(n_links), "n_links": pa.array(n_links), "groups_sha256": pa.array(sha, pa.string())}
        return columns, pairs, own, n_links


def _chunk(aligner: Aligner, text: pa.Array) -> tuple[dict[str, pa.Array], pa.Table, np.ndarray, np.ndarray]:
    """``Aligner.align`` of a chunk, step by step; the pairs of its steps are added up."""
    _, off = tb.utf8(text)
    steps = []
    for i, j in tb.pieces(off, STEP):
        steps.append(aligner.align(text.slice(i, j - i)))
        tb.give_back()
    if len(steps) == 1:
        return steps[0]
    found = pa.concat_tables([pairs for _, pairs, _, _ in steps]).combine_chunks()
    key, place = np.unique(found.column("a").to_numpy().astype(np.int64) << 32 | found.column("b").to_numpy(), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, place, found.column("count_all").to_numpy())
    before = np.cumsum([0, *[len(pairs) for _, pairs, _, _ in steps]])
    own = np.concatenate([place[first + links] for first, (_, _, links, _) in zip(before, steps)]).astype(np.int32)
    pairs = pa.table({"a": pa.array((key >> 32).astype(np.int32)), "b": pa.array((key & 0xFFFFFFFF).astype(np.int32)), "count_all": pa.array(n)})
    columns = {c: pa.concat_arrays([x[c].combine_chunks() if isinstance(x[c], pa.ChunkedArray) else x[c] for x, _, _, _ in steps])
               for c in _COUNTED.names}
    return columns, pairs, own, np.concatenate([n_links for _, _, _, n_links in steps])


def _encoded(docs: DataFrame, a_path: str, b_path: str, text_col: str) -> DataFrame:
    """Rows (row, counted columns, chunk, links: the pair of each link within its chunk, pairs: those of the chunk, in its
    first row)."""
    schema = T.StructType([docs.schema["row"], *_COUNTED, T.StructField("chunk", T.StringType()),
                           T.StructField("links", T.ArrayType(T.IntegerType())), T.StructField("pairs", T.ArrayType(_PAIR))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner: Aligner = tb.per_process(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))
        for batch in tb.slices(batches, text_col, CHUNK):
            columns, pairs, own, n_links = _chunk(aligner, batch.column(text_col))
            found = pa.StructArray.from_arrays([pa.array(np.arange(len(pairs), dtype=np.int32)), *(pairs.column(c).combine_chunks() for c in "ab"),
                                                pairs.column("count_all").combine_chunks().cast(pa.int64())], names=_PAIR.names)
            first = np.full(batch.num_rows + 1, len(pairs), np.int32)
            first[0] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(columns[c] for c in _COUNTED.names), pa.array([uuid.uuid4().hex] * batch.num_rows),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_links))).astype(np.int32)), pa.array(own)),
                 pa.ListArray.from_arrays(pa.array(first), found)], schema.names)

    return docs.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. The files at
    ``a_path`` (byte-level BPE) and ``b_path`` (SentencePiece) are on all executors."""
    kept = [c for c in docs.columns if c not in ADDED and c != text_col]
    row = F.struct(*kept) if kept else F.struct(F.lit(None).cast("int").alias("none"))
    encoded = materialize(_encoded(docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text")), a_path, b_path, "text"), "alignment")
    pairs = encoded.where(F.size("pairs") > 0).select("chunk", F.explode("pairs").alias("p")).select("chunk", "p.*")
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    scored = counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = pairs.join(scored, ["a", "b"]).select(F.col("chunk").alias("of"), "i", "count", "best")
    schema = T.StructType([encoded.schema["row"], *_COUNTED, *(T.StructField(c, T.LongType()) for c in ("n_best", "count_sum"))])

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("i").to_numpy(), kind="stable")
        links = docs.column("links").combine_chunks()
        own = links.flatten().to_numpy()
        row = pc.list_parent_indices(links).to_numpy()
        sums = []
        for name in ("best", "count"):
            value = answers.column(name).cast(pa.int64()).to_numpy()[order]
            total = np.zeros(docs.num_rows, np.int64)
            np.add.at(total, row, value[own] if len(own) else own)
            sums.append(pa.array(total))
        return pa.Table.from_arrays([docs.column(c) for c in schema.names[:-2]] + sums, schema.names)

    grouped = encoded.drop("pairs").groupBy("chunk").cogroup(answers.groupBy("of"))
    out = grouped.applyInArrow(finish, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *ADDED)
