"""SentencePiece encoding and decoding by suffix-array matching (operator 6).

For BPE models with byte fallback. A task collects the new units of a batch (a run of
spaces with the characters behind it; no piece reaches over a unit's end), concatenates
them, and sorts all suffixes. Every piece of the vocabulary is found in the sorted suffixes by binary
search, as a range; the ranges give the edges (start, end, piece), which are sorted by
their end and relaxed from left to right.

Relaxing uses that a sequence of pieces is the BPE encoding of its text just if each two
neighbours are the encoding of theirs, and that every prefix of a text has one encoding.
So the last piece of each prefix is the one edge that ends there and whose piece is
stable next to the last piece of the prefix before it. Tests hold the ids against the
library's own.

Spaces become U+2581, and a text gets one in front. Characters without a piece become
their UTF-8 bytes' pieces. Decoding puts the bytes of the pieces together again.

Defined results: null text stays null with null ids; an empty text has no ids. U+2581 in a
text decodes as a space. Rows are independent, so repeats get equal results. Columns with
the names of the added ones are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textbytes as tb
from . import units

_BAR = "▁"
#: Characters that one suffix array indexes (a longer unit goes alone), and pairs of pieces that a worker remembers.
INDEXED = 100_000
REMEMBERED_PAIRS = 2_000_000
#: Bytes of text that are encoded at a time (a longer text goes alone); the arrays of a step take some 100 times that.
STEP = 256 << 10


class PieceModel(units.UnitIds):
    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(_BAR in self.pieces[i].lstrip(_BAR) for i in plain):
            raise ValueError("a piece reaches over a space")
        self.n = n
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.byte_ids = np.zeros(256, np.int64)
        self.raw = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
                self.raw[i] = bytes([int(self.pieces[i][1:-1], 16)])
            elif sp.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.raw[i] = self.pieces[i].replace(_BAR, " ").encode()
        # pieces that encode as themselves, longer than one character or not
        reached = [i for i in plain if self._merged(self.pieces[i], 0)]
        self.match_ids = np.array(reached, np.int64)
        self.longest = max((len(self.pieces[i]) for i in reached), default=1)
        self.match = np.array([self.pieces[i] for i in reached], f"U{self.longest}")
        # what sorts behind every text that starts with the piece: the piece and a number beyond all characters
        end = self.match.astype(f"U{self.longest + 1}").view(np.uint32).reshape(len(reached), -1).copy()
        end[np.arange(len(reached)), np.char.str_len(self.match)] = 0x110000
        self.match_end = end.view(f"U{self.longest + 1}").reshape(-1)
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.single = np.array(sorted(ord(p) for p in self.score if len(p) == 1), np.uint32)
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.pair_keys, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)

    def _merged(self, text: str, cut: int) -> bool:
        """Merge by the highest score, the leftmost first: whether it ends in one piece, or, with a ``cut``,
        in the two pieces on its sides without a merge over it."""
        parts, score = list(text), self.score
        while len(parts) > 1 + (cut > 0):
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return False
            if cut:
                begin = sum(map(len, parts[:at]))
                if begin + len(parts[at]) == cut:
                    return False
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        # two pieces are left: do they merge?
        return not cut or score.get(parts[0] + parts[1]) is None

    def _stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces of each pair stay apart. Numbers from n on are characters without a piece; -1 is a unit's start."""
        ok = np.ones(len(left), bool)
        ask = np.flatnonzero((left >= 0) & (left < self.n) & (right < self.n))
        keys, where = np.unique(left[ask] * self.n + right[ask], return_inverse=True)
        k = np.minimum(np.searchsorted(self.pair_keys, keys), max(0, len(self.pair_keys) - 1))
        new = self.pair_keys[k] != keys if len(self.pair_keys) else np.ones(len(keys), bool)
        if new.any():
            if len(self.pair_keys) + int(new.sum()) > REMEMBERED_PAIRS:
                self.pair_keys, self.pair_ok, new = np.zeros(0, np.int64), np.zeros(0, bool), np.ones(len(keys), bool)
            fresh, pieces, length = keys[new], self.pieces, self.length
            said = np.array([self._merged(pieces[a] + pieces[b], length[a]) for a, b in zip((fresh // self.n).tolist(), (fresh % self.n).tolist())], bool)
            every = np.concatenate((self.pair_keys, fresh))
            order = np.argsort(every, kind="stable")
            self.pair_keys, self.pair_ok = every[order], np.concatenate((self.pair_ok, said))[order]
        ok[ask] = self.pair_ok[np.searchsorted(self.pair_keys, keys)][where]
        return ok

    def _edges(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of all occurrences of pieces in ``chars``, where 0 separates units."""
        n, width = len(chars), self.longest
        padded = np.concatenate((chars, np.zeros(width, np.uint32)))
        window = np.lib.stride_tricks.sliding_window_view(padded, width)[:n].copy()
        np.multiply(window, np.cumprod(window != 0, axis=1, dtype=np.uint32), out=window)  # nothing beyond a separator
        text = window.view(f"U{width}").reshape(-1)
        suffixes = np.argsort(text, kind="stable")
        ordered = text[suffixes]
        lo = np.searchsorted(ordered, self.match, "left")
        hi = np.searchsorted(ordered, self.match_end, "left")
        count = hi - lo
        return suffixes[tb.ranges(lo, count)], np.repeat(self.match_ids, count)

    def encode_new(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        edge = np.cumsum([len(u) + 1 for u in new])
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(edge, (edge[at - 1] if at else 0) + INDEXED, "right")))
            part = self._encode_block(new[at:to])
            ids.append(part[0])
            sizes.append(part[1])
            at = to
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_block(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\0".join(block) + "\0"
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = np.array([len(u) for u in block], np.int64)
        first = np.cumsum(size + 1) - size - 1
        start, piece = self._edges(chars)
        # a character without a piece is an edge of its own
        unit = np.repeat(np.arange(len(block)), size)
        body = tb.ranges(first, size)
        alone = body[~np.isin(chars[body], self.single)]
        start = np.concatenate((start, alone))
        piece = np.concatenate((piece, self.n + chars[alone].astype(np.int64)))
        length = np.where(piece < self.n, self.length[np.minimum(piece, self.n - 1)], 1)
        owner = np.zeros(len(chars), np.int64)
        owner[body] = unit
        reach = start + length - first[owner[start]]  # the place in its unit where an edge ends
        order = np.argsort(reach.astype(np.uint16) if reach.max(initial=0) < 1 << 16 else reach, kind="stable")
        start, piece, length, reach = start[order], piece[order], length[order], reach[order]
        last = np.full(len(chars) + 1, -2, np.int64)
        last[first] = -1
        bounds = np.searchsorted(reach, np.arange(1, int(size.max(initial=0)) + 2))
        for a, b in zip(bounds, bounds[1:]):
            s, p = start[a:b], piece[a:b]
            good = self._stable(last[s], p) & (last[s] != -2)
            last[s[good] + length[a:b][good]] = p[good]
        # back from the end of each unit
        who, at, step = np.arange(len(block)), first + size, 0
        steps = []
        while True:
            more = at > first[who]
            who, at = who[more], at[more]
            if not len(who):
                break
            p = last[at]
            steps.append((who, np.full(len(who), -step), p))
            at = at - np.where(p < self.n, self.length[np.minimum(p, self.n - 1)], 1)
            step += 1
        if not steps:
            return np.zeros(0, np.int64), np.zeros(len(block), np.int64)
        who, step_, ids = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((step_, who))
        who, ids = who[order], ids[order]
        unknown = np.flatnonzero(ids >= self.n)
        if len(unknown):
            as_bytes = [self.byte_ids[list(chr(c).encode(errors="replace"))] for c in (ids[unknown] - self.n).tolist()]
            extra = np.ones(len(ids), np.int64)
            extra[unknown] = [len(b) for b in as_bytes]
            place = np.cumsum(extra) - extra
            ids, who = np.repeat(ids, extra), np.repeat(who, extra)
            ids[tb.ranges(place[unknown], extra[unknown])] = np.concatenate(as_bytes)
        return ids, np.bincount(who, minlength=len(block))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each)."""
        text, chars, at = units.decoded(data, off)
        # a space in front of every text that has any character
        size = np.diff(at)
        front = at[:-1][size > 0]
        chars = np.insert(chars, front, 0x20)
        at = at + np.concatenate(([0], np.cumsum(size > 0)))
        chars = np.where(chars == 0x20, np.uint32(0x2581), chars)
        text = chars.tobytes().decode("utf-32-le")
        bar = chars == 0x2581
        starts = bar.copy()
        starts[1:] &= ~bar[:-1]
        starts[at[:-1][size > 0]] = True
        start = np.flatnonzero(starts)
        end = np.concatenate((start[1:], [len(chars)])) if len(start) else start
        ids, n = self.lookup(text, chars, start, end)
        row = np.searchsorted(at, start, "right") - 1
        return ids, np.bincount(row, n, minlength=len(off) - 1).astype(np.int64)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, offsets) of the texts with ``n`` ids each."""
        size = self.raw_size[ids]
        data = self.raw_bytes[tb.ranges(self.raw_first[ids], size)]
        edge = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n)))]
        some = edge[:-1] < edge[1:]
        first = edge[:-1][some]
        drop = first[data[first] == 0x20]  # the space in front
        keep = np.ones(len(data), bool)
        keep[drop] = False
        return data[keep], np.concatenate(([0], np.cumsum(keep)))[edge]


ADDED = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType(), "ids_crc32": T.LongType(), "roundtrip": T.BooleanType()}


def encode(docs: DataFrame, model: str, *, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` without the text, with ids, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) and
    roundtrip (whether decoding the ids gives the text). ``model`` is the path of the model, which all executors have."""
    kept = [f for f in docs.schema if f.name not in ADDED and f.name != text_col]
    names = [f.name for f in kept]
    added = [T.StructField(k, t) for k, t in ADDED.items() if with_ids or k != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: PieceModel = tb.per_process("sentencepiece " + model, lambda: PieceModel(model))
        for batch in tb.slices(batches, text_col):
            data, off = tb.utf8(batch.column(text_col))
            null = batch.column(text_col).is_null().to_numpy(zero_copy_only=False)
            for i, j in tb.pieces(off, STEP):
                own, at = data[off[i]: off[j]], off[i: j + 1] - off[i]
                ids, n = pieces.encode(own, at)
                back, back_at = pieces.decode(ids, n)
                same = np.ones(j - i, bool)
                if not (np.array_equal(back_at, at) and np.array_equal(back, own)):
                    same = np.array([own[a:b].tobytes() == back[c:d].tobytes() for a, b, c, d in zip(at, at[1:], back_at, back_at[1:])], bool)
                edge = np.concatenate(([0], np.cumsum(n)))
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(edge.tolist(), edge[1:].tolist())]
                mask = null[i:j]
                cols = {"n_tokens": pa.array(n, pa.int64(), mask=mask), "ids_crc32": pa.array(crc, pa.int64(), mask=mask),
                        "roundtrip": pa.array(same, pa.bool_(), mask=mask)}
                if with_ids:
                    lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    cols["ids"] = lists if not mask.any() else pa.array([None if m else x for m, x in zip(mask, lists.to_pylist())], lists.type)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i) for c in names] + [cols[f.name] for f in added],
                                                 names + [f.name for f in added])
            del batch, data, off, own  # before the next one is read

    return docs.select(*names, text_col).mapInArrow(run, T.StructType(kept + added))


def decode(rows: DataFrame, model: str, *, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` without the ids, with their text; null ids give null text."""
    kept = [f for f in rows.schema if f.name not in (ids_col, text_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: PieceModel = tb.per_process("sentencepiece " + model, lambda: PieceModel(model))
        for batch in batches:
            lists = batch.column(ids_col)
            n = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            data, off = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), n)
            text = [None if not ok else data[a:b].tobytes().decode(errors="replace")
                    for ok, a, b in zip(lists.is_valid().to_pylist(), off.tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(text, pa.string())], names + [text_col])

    return rows.select(*names, ids_col).mapInArrow(run, T.StructType(kept + [T.StructField(text_col, T.StringType())]))
