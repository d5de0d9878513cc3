"""Ids of text units, remembered by hash: the units of a text are looked up at once, and only new ones are encoded."""

from __future__ import annotations

import numpy as np

from . import textbytes as tb

#: Distinct units that a worker remembers; beyond it starts anew.
REMEMBERED = 1_000_000


def decoded(data: np.ndarray, off: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """(text, code points, offsets in code points) of UTF-8 texts; invalid bytes become U+FFFD."""
    raw = data.tobytes()
    try:
        text = raw.decode()
        at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
    except UnicodeDecodeError:
        parts = [raw[a:b].decode(errors="replace") for a, b in zip(off, off[1:])]
        text, at = "".join(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return text, np.frombuffer(text.encode("utf-32-le"), np.uint32), at


class UnitIds:
    """Sorted hashes of the units seen so far, with a run of ids each. Subclasses say how new units are encoded."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.hash, self.first, self.size, self.ids = (np.zeros(0, t) for t in (np.uint64, np.int64, np.uint32, np.uint32))

    def encode_new(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, ids of each)."""
        raise NotImplementedError

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        ids, size = self.encode_new(units)
        first = len(self.ids) + np.cumsum(size) - size
        # one array after the other, so that no two are held twice
        self.ids = np.concatenate((self.ids, ids.astype(np.uint32)))
        self.hash = np.concatenate((self.hash, hashes))
        order = np.argsort(self.hash, kind="stable").astype(np.uint32)
        self.hash = self.hash[order]
        self.first = np.concatenate((self.first, first))[order]
        self.size = np.concatenate((self.size, size.astype(np.uint32)))[order]

    def lookup(self, text: str, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, ids of each) for the units [start, end) of ``text``."""
        distinct, example, inverse = np.unique(tb.span_hashes(chars, start, end), return_index=True, return_inverse=True)
        missing = np.ones(len(distinct), bool)
        if len(self.hash):
            missing = self.hash[np.minimum(np.searchsorted(self.hash, distinct), len(self.hash) - 1)] != distinct
        if len(self.hash) + int(missing.sum()) > REMEMBERED:
            self.forget()
            missing[:] = True
        if missing.any():
            new = example[missing]
            self._learn(distinct[missing], [text[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
        k = np.searchsorted(self.hash, distinct)[inverse]
        size = self.size[k].astype(np.int64)
        return self.ids[tb.ranges(self.first[k], size)], size
