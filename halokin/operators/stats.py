"""Inspection aggregates: distinct groups, row counts, column summary,
fixed-bin histograms and ordered heads. All are single distributed
aggregations; nothing is collected to the driver."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import HIST_BINS, HIST_RANGE


def distinct_count(df: DataFrame, column: str = "subhalo_id", alias: str = "n_distinct") -> DataFrame:
    """Number of distinct values including NULL (``distinct().count()`` semantics)."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(alias))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table: ``(table, n_rows)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed long-form summary: ``(column, count, mean, stddev, min, max)``.

    One pass with all statistics of all columns in a single aggregate, then an
    unpivot of that single row.
    """
    cols = list(columns or [f.name for f in df.schema.fields
                            if f.dataType.typeName() in ("float", "double", "integer", "long", "short")])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              F.col(f"`{c}__count`").alias("count"), F.col(f"`{c}__mean`").alias("mean"),
                              F.col(f"`{c}__stddev`").alias("stddev"), F.col(f"`{c}__min`").alias("min"),
                              F.col(f"`{c}__max`").alias("max")) for c in cols])
    return wide.select(F.explode(rows).alias("s")).select("s.*")


def bin_index(value: Column, bins: int = HIST_BINS, lo: float = HIST_RANGE[0],
              hi: float = HIST_RANGE[1]) -> Column:
    """Bin of ``value`` for equal bins on [lo, hi]: left-closed, the last bin closed.

    The guess ``floor((v-lo)/step)`` is corrected against the exact edges, so
    values on an edge land where an edge comparison puts them.
    """
    step = (hi - lo) / bins
    v = value.cast("double")
    guess = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(step)), F.lit(0)), F.lit(bins - 1))

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.lit(hi)).otherwise(F.lit(lo) + i * F.lit(step))

    below = v < edge(guess)
    above = (v >= edge(guess + 1)) & (guess < bins - 1)
    return (F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = HIST_BINS, lo: float = HIST_RANGE[0],
              hi: float = HIST_RANGE[1]) -> DataFrame:
    """Counts of the non-empty bins: ``(bin, bin_lo, bin_hi, n)``; out-of-range values dropped."""
    v = F.col(column).cast("double")
    step = (hi - lo) / bins
    counted = (df.select(v.alias("_v")).filter((F.col("_v") >= lo) & (F.col("_v") <= hi))
               .select(bin_index(F.col("_v"), bins, lo, hi).alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    edge_lo = F.lit(lo) + F.col("bin") * F.lit(step)
    edge_hi = F.when(F.col("bin") + 1 >= bins, F.lit(hi)).otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(step))
    return counted.select("bin", edge_lo.alias("bin_lo"), edge_hi.alias("bin_hi"), "n")


def head(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (all columns break ties): a top-n report."""
    keys = list(order_by or []) + [c for c in df.columns if c not in (order_by or [])]
    return df.orderBy(*keys).limit(n)
