"""Words of Arrow text columns as numpy arrays over their UTF-8 bytes.

Shared by the operators that work on Arrow batches. Both word patterns in use are
sets of single bytes in UTF-8 (every byte of a non-ASCII character belongs to a
word), so words can be found without decoding.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into number arrays at a time (a longer text goes alone).
PIECE = 1 << 20
#: Bytes of text in a slice of an Arrow batch that is worked on and passed on at a time.
SLICE = 8 << 20

#: [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and everything beyond ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """A value made once in a Python worker, for all tasks that it runs (task code travels by value, so
    module variables don't last)."""
    kept = sys.modules.setdefault("halokin_worker_values", types.ModuleType("halokin_worker_values")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0 to n, at least, of the hash base and of its inverse mod 2**64."""
    tables = per_process("powers", lambda: [np.ones(1, np.uint64)] * 2)
    if len(tables[0]) <= n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, PIECE) + 1, b, np.uint64)
            p[0] = 1
            tables[k] = np.cumprod(p)
    return tables


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def pieces(off: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def _libc_trim() -> Callable[[int], Any]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: None


def give_back() -> None:
    """Return freed memory, which Arrow's pool and the C library hold for later, to the system."""
    pa.default_memory_pool().release_unused()
    per_process("malloc_trim", _libc_trim)(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text, or one row; unused memory is given back after each."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        off = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))  # and no copy of the texts
        edges = list(pieces(off, limit))
        for k, (i, j) in enumerate(edges):
            own = batch.slice(i, j - i)
            if k == len(edges) - 1:
                del batch  # a slice keeps the texts of all its batch: hold none while the next one is read
            yield own
            del own
            give_back()


def word_spans(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; ``is_word`` tells of each byte whether a word has it."""
    n = len(is_word)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    start = np.flatnonzero(is_word & (~before | edge[:-1]))
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of ``codes``: a polynomial from prefix sums, then mixed."""
    n = len(codes)
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    return first + np.arange(total)
