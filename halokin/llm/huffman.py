"""Canonical length-limited Huffman codes over numpy arrays, with block checkpoints."""

from __future__ import annotations

import numpy as np

MAX_LENGTH = 16
#: Ids between two bit-offset checkpoints.
BLOCK = 1024


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal lengths of at most ``limit`` bits for symbols with a count (0 for others), by package-merge.

    Items of a level are the sorted counts merged with the pairs of the level below. The first 2n - 2 items
    of the top level are bought; as counts are sorted, buying k single items of a level means the k rarest
    symbols, and every pair bought buys two items one level down."""
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) == 1:
        lengths[symbols] = 1
    if len(symbols) < 2:
        return lengths
    while 1 << limit < len(symbols):
        limit += 1
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weight = counts[symbols].astype(np.float64)
    singles = []  # per level, from the deepest: whether each item is a single symbol
    level, single = weight, np.ones(len(weight), bool)
    for _ in range(limit):
        singles.append(np.cumsum(single))
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((weight, pairs))
        order = np.argsort(both, kind="stable")
        level, single = both[order], order < len(weight)
    bought = 2 * len(symbols) - 2
    for count in reversed(singles):
        k = int(count[bought - 1]) if bought else 0
        lengths[symbols[:k]] += 1
        bought = 2 * (bought - k)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    code = 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        code <<= 1
        of_size = np.flatnonzero(lengths == size)
        codes[of_size] = code + np.arange(len(of_size), dtype=np.uint64)
        code += len(of_size)
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits, bit offset of every BLOCK-th id). Bits fill big-endian 32-bit words from the top."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    words = np.zeros((int(end[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
    value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(ids) else np.zeros(0, np.int64)
    for k, part in enumerate((value >> np.uint64(32), value & np.uint64(0xFFFFFFFF))):
        if len(first):
            words[word[first] + k] += np.add.reduceat(part, first)  # bits of different ids never overlap
    return words.astype(">u4").tobytes(), at[::BLOCK]


class Decoder:
    """Decodes blocks side by side through one table over the next ``width`` bits."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.width = max(1, int(lengths.max(initial=1)))
        coded = np.flatnonzero(lengths)
        coded = coded[np.lexsort((coded, lengths[coded]))]  # canonical order is the order of the codes
        span = np.int64(1) << (self.width - lengths[coded].astype(np.int64))
        fill = (1 << self.width) - int(span.sum())
        self.symbol = np.concatenate((np.repeat(coded, span), np.zeros(fill, np.int64))).astype(np.int64)
        self.length = np.concatenate((np.repeat(lengths[coded], span), np.ones(fill, np.uint8))).astype(np.int64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.int64)
        words = np.concatenate((np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64)))
        pair = (words[:-1] << np.uint64(32)) | words[1:]
        at = checkpoints.astype(np.int64).copy()
        out = np.empty((min(BLOCK, n), len(at)), np.int64)
        left = n - np.arange(len(at)) * BLOCK
        mask = np.uint64((1 << self.width) - 1)
        for k in range(len(out)):
            if left[-1] == k:  # the last block is done
                at = at[:-1]
            peek = (pair[at >> 5] >> (64 - self.width - (at & 31)).astype(np.uint64)) & mask
            out[k, : len(at)] = self.symbol[peek]
            at += self.length[peek]
        return out.T.reshape(-1)[:n]
