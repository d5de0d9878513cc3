"""A blocked Bloom filter as a broadcast table, in SQL functions.

Rows (block, w0..w3): a key sets two bits in each of the four 64-bit words of one
256-bit block. There are at most ``MAX_BLOCKS`` blocks (40 MB of rows), so the filter
can be broadcast whatever the number of keys. With more keys than it is sized for,
more keys pass that are not in it; a key that is in it always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 16
WORDS = ("__w0", "__w1", "__w2", "__w3")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, word: int) -> Column:
    """Two bits of a 64-bit word, from 12 bits of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    bits = [F.shiftrightunsigned(h, word * 12 + 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in (0, 1)]
    return F.call_function("shiftleft", one, bits[0]).bitwiseOR(F.call_function("shiftleft", one, bits[1]))


class Bloom:
    """A filter of the values of ``key`` in ``rows``; ``n`` is about how many there are."""

    def __init__(self, rows: DataFrame, key: str, n: int, max_blocks: int = MAX_BLOCKS) -> None:
        self.blocks = max(1, min(max_blocks, -(-n // KEYS_PER_BLOCK)))
        k = F.col(key)
        masks = rows.select(_block(k, self.blocks).alias("__block"), *[_mask(k, i).alias(w) for i, w in enumerate(WORDS)])
        self.table = masks.groupBy("__block").agg(*[F.bit_or(w).alias(w) for w in WORDS])

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with a boolean column: false only if ``key`` is not in the filter."""
        k = F.col(key)
        hit = F.col(WORDS[0]).isNotNull() & k.isNotNull()
        for i, w in enumerate(WORDS):
            hit = hit & (F.col(w).bitwiseAND(_mask(k, i)) == _mask(k, i))
        joined = rows.withColumn("__block", _block(k, self.blocks)).join(F.broadcast(self.table), "__block", "left")
        return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__block", *WORDS)

    def keep(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be in the filter."""
        return self.mark(rows, key, "__maybe").where("__maybe").drop("__maybe")

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(rows whose key may be in the filter, the others)."""
        marked = self.mark(rows, key, "__maybe")
        return marked.where("__maybe").drop("__maybe"), marked.where("NOT __maybe").drop("__maybe")


def drop_keys(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key isn't in the written table ``gone`` (one column, named ``key``). Only rows that the
    filter lets through are shuffled."""
    maybe, rest = Bloom(gone, key, gone.count()).split(rows, key)
    return rest.unionByName(maybe.join(gone, key, "left_anti").select(rest.columns))
