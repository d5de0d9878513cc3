"""Attach per-group statistics back onto the rows of the group.

This is the skew-safe form of a whole-partition window (``sum(x).over(
partitionBy(key))``): the statistics are computed with a partial (map-side)
aggregation, written to the shared folder, and joined back.

* If the statistics table is small — its exact row count is read from the
  written Parquet — it is broadcast: the large side is streamed, never shuffled,
  and a group holding a third of all rows costs nothing extra.
* If it is larger, but splits into at most ``max_chunks`` ranges of
  ``chunk_col`` (subhalo id) that each fit the bound, every range is broadcast
  to the rows of that range only. No lazy table has more such broadcasts than the driver can make at a time
  (``QUERY_BYTES``): ``attach_in_waves`` gives the ranges in several tables, for callers that work them off one by one. The range filter reaches the scan of the
  large side (pair tables are written sorted by subhalo id within each file,
  so Parquet skips the row groups of other ranges): still no shuffle of the
  large side. Range boundaries come from approximate quantiles of the small
  table; one subhalo has only a handful of statistics rows, so no range can
  be dominated by one key.
* Otherwise both sides are shuffled on the key. Groups of more rows than a
  ``PIECES``-th of a partition's share, by their counts, are cut in pieces of that size: a row
  gets a deterministic salt below the number of its group's pieces, from a hash of its own values, and
  the group's statistics row is there once for each piece. A group of a third of all rows falls into as many
  pieces as that is, spread over all tasks; small groups are neither salted nor repeated.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Rows of a table that may be broadcast, and its bytes in memory, whichever is less.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 2**20
#: The same for all broadcasts of one lazy table: Spark makes them side by side, and the driver holds the rows, the hash table and the blocks of each.
QUERY_BYTES = 128 * 2**20
DEFAULT_MAX_CHUNKS = 64
#: Pieces that a shuffle partition's share of the rows is cut into; larger groups are salted.
PIECES = 16


def broadcastable_rows(table: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    """How many rows of ``table`` fit both bounds: 8 bytes a column and 24 a row, 32 more for text and other long types."""
    wide = sum(not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for f in table.schema.fields)
    return min(max_rows, max_bytes // (24 + 8 * len(table.columns) + 32 * wide))


def key_ranges(stats: DataFrame, col: str, n: int, limit: int, max_chunks: int) -> list[tuple] | None:
    """Ranges ``[lo, hi)`` of ``col`` (None = open end) holding about
    ``0.8 * limit`` statistics rows each, or None if more than ``max_chunks``."""
    k = math.ceil(n / (0.8 * limit))
    if k > max_chunks:
        return None
    probs = [i / k for i in range(1, k)]
    # a table: a job that is started again goes on with the same ranges
    found = materialize(stats.agg(F.percentile_approx(col, probs, 1000).alias("cuts")), "ranges").first()["cuts"] if probs else None
    cuts = sorted({math.ceil(b) for b in found or ()})
    edges = [None, *cuts, None]
    return list(zip(edges[:-1], edges[1:]))


def _in_range(col: str, lo, hi) -> Column:
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= lo)
    if hi is not None:
        cond = cond & (c < hi)
    return cond


def hot_groups(sizes: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """(keys, _salts): the groups of ``sizes`` (keys, n) with more than ``rows_per_task`` rows, and their pieces.

    By default that is a ``PIECES``-th of a shuffle partition's share, so there are fewer such groups than ``PIECES``
    times the partitions: a table that can be broadcast."""
    if rows_per_task is None:
        partitions = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows_per_task = max(1, (sizes.agg(F.sum("n")).first()[0] or 0) // (PIECES * partitions))
    return sizes.where(F.col("n") > rows_per_task).select(*keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_salts"))


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str], **opts) -> DataFrame:
    """Inner-join ``stats`` (one row per key) onto ``rows`` by ``keys``, as one lazy table; the options are those of ``attach_in_waves``."""
    return attach_in_waves(rows, stats, keys, one_query=True, **opts)[0]


def attach_in_waves(rows: DataFrame, stats: DataFrame, keys: Sequence[str], *,
                    salt_cols: Sequence[str] | None = None,
                    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                    salt_buckets: int | None = None,
                    rows_per_task: int | None = None,
                    n_stats: int | None = None,
                    count_col: str | None = None,
                    chunk_col: str | None = "subhalo_id",
                    max_chunks: int = DEFAULT_MAX_CHUNKS,
                    one_query: bool = False) -> list[DataFrame]:
    """Lazy tables of the inner join of ``stats`` (one row per key) onto ``rows`` by ``keys``, all rows of a key in one of them.

    ``n_stats`` is the known row count of ``stats``; when omitted it is counted
    (cheap on a materialized table). ``count_col`` names a column of ``stats`` with the rows of each
    group, which is not attached; without it the shuffle tier counts them. ``chunk_col`` (present on both sides, a
    key or a per-group constant) defines the ranges of the middle tier. ``salt_buckets`` salts
    every group that often instead of by its size. There is more than one table if ``stats`` has more than
    ``BROADCAST_MAX_BYTES``; with ``one_query`` there is always one, and what has more than ``QUERY_BYTES`` is left to the shuffle tier.
    """
    keys = list(keys)
    n = stats.count() if n_stats is None else n_stats
    sizes = stats.select(*keys, F.col(count_col).alias("n")) if count_col else None
    stats = stats.drop(count_col) if count_col else stats
    in_query = broadcastable_rows(stats, n, QUERY_BYTES if one_query else BROADCAST_MAX_BYTES)
    broadcast_max_rows = broadcastable_rows(stats, broadcast_max_rows, BROADCAST_MAX_BYTES)
    shared = bool(chunk_col) and chunk_col in rows.columns and chunk_col in stats.columns
    # a range column that is a per-group constant, not a key, is taken from the rows only
    extra = [chunk_col] if shared and chunk_col not in keys else []
    if n <= broadcast_max_rows:
        return [rows.join(F.broadcast(stats.drop(*extra)), keys, "inner")]
    ranges = key_ranges(stats, chunk_col, n, broadcast_max_rows, max_chunks) \
        if shared and broadcast_max_rows > 0 and not (one_query and in_query < n) else None
    if ranges:
        pieces = [rows.filter(_in_range(chunk_col, lo, hi)).join(
                      F.broadcast(stats.filter(_in_range(chunk_col, lo, hi)).drop(*extra)), keys, "inner")
                  for lo, hi in ranges]
        most = len(pieces) if in_query == n else max(1, in_query // broadcast_max_rows)
        return [reduce(DataFrame.unionByName, pieces[k: k + most]) for k in range(0, len(pieces), most)]
    src = list(salt_cols) if salt_cols else [c for c in rows.columns if c not in keys]
    stats = stats.drop(*extra)
    if salt_buckets:
        salts = F.lit(int(salt_buckets))
    else:
        if sizes is None:
            sizes = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "group-sizes")
        hot = F.broadcast(hot_groups(sizes, keys, rows_per_task))
        rows, stats = rows.join(hot, keys, "left"), stats.join(hot, keys, "left")
        salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*src), salts).cast("int")).drop("_salts")
    spread = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return [salted.join(spread, keys + ["_salt"], "inner").drop("_salt")]


def group_totals(rows: DataFrame, keys: Sequence[str], totals: dict, *,
                 salt_cols: Sequence[str] | None = None,
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 salt_buckets: int | None = None,
                 tag: str = "group-totals") -> DataFrame:
    """Every row of ``rows`` with per-group aggregates ``totals`` (name -> Column).

    Equivalent to ``agg.over(Window.partitionBy(*keys))`` for an unbounded
    frame, but with partial aggregation and a size-checked join back. Rows with
    a NULL key are dropped (they match no group), as an inner join would.
    """
    stats = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()], F.count(F.lit(1)).alias("_n"))
    stats = materialize(stats, tag)
    return attach(rows, stats, keys, salt_cols=salt_cols, count_col="_n",
                  broadcast_max_rows=broadcast_max_rows, salt_buckets=salt_buckets)
