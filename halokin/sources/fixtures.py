"""Particle snapshot and subhalo catalogue derived from the driver tables.

The driver ships TPC-H-like tables, not simulation output. These builders turn
``supplier`` into a subhalo catalogue and ``lineitem`` into star / dark-matter
particles clustered around their supplier's subhalo, with integer and dyadic
arithmetic only so that every engine produces bit-identical floats. The work
grows with the tables (one particle per lineitem row).

The formulas are in Spark SQL expression text; ``halokin.plans.oracle`` holds
the same formulas for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import BOX_SIZE

# FIXED VALUES of the fixture generator (multipliers of the pseudo-random offsets).
STAR_MULTIPLIERS = (48271, 69621, 39373)
DM_MULTIPLIERS = (40692, 62089, 30323)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subhalo_catalog(spark: SparkSession, sf_dir: str, with_half_mass: bool = False) -> DataFrame:
    """Subhalo catalogue in the typed Parquet schema (px..vz, sub_id, StarHalfRad).

    Every tenth subhalo sits on the box edge (periodic wrap); every subhalo with
    ``s % 10 = 1`` sits 20 kpc/h from its predecessor (particles near both).
    """
    base = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS s",
        "CASE WHEN s_suppkey % 10 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS b",
        "CASE WHEN s_suppkey % 10 = 1 THEN 20 ELSE 0 END AS shift",
    )
    cols = [
        "CAST(CASE WHEN b % 10 = 0 THEN (b div 10) % 20 ELSE (b * 7919 + 13) % 205000 END + shift AS FLOAT) AS px",
        "CAST((b * 104729 + 101) % 205000 AS FLOAT) AS py",
        "CAST((b * 1299709 + 7) % 205000 AS FLOAT) AS pz",
        "CAST((s * 37) % 401 - 200 AS FLOAT) AS vx",
        "CAST((s * 53) % 401 - 200 AS FLOAT) AS vy",
        "CAST((s * 71) % 401 - 200 AS FLOAT) AS vz",
        "CAST(s AS INT) AS sub_id",
        "CAST(2 + s % 9 AS FLOAT) AS StarHalfRad",
    ]
    if with_half_mass:
        cols.append("CAST(s % 5 AS DOUBLE) / 64 AS StarHalfMass")
    return base.selectExpr(*cols)


def _offset(mult: int, add: int) -> str:
    return (f"CASE WHEN k % 997 = 0 THEN CAST(0 AS DOUBLE) "
            f"ELSE CAST((k * {mult} + {add}) % 641 - 320 AS DOUBLE) / q END")


def particles(spark: SparkSession, sf_dir: str, species: str) -> DataFrame:
    """Star (``species='star'``) or dark-matter particles, one per lineitem row."""
    mults = STAR_MULTIPLIERS if species == "star" else DM_MULTIPLIERS
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    h = subhalo_catalog(spark, sf_dir).selectExpr(
        "sub_id", "px AS hpx", "py AS hpy", "pz AS hpz", "vx AS hvx", "vy AS hvy", "vz AS hvz")
    j = li.join(h, li.l_suppkey == h.sub_id).selectExpr(
        "*", "l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3 AS k")
    j = j.selectExpr(
        "*",
        "CASE k % 4 WHEN 0 THEN CAST(8 AS DOUBLE) WHEN 1 THEN CAST(16 AS DOUBLE) "
        "WHEN 2 THEN CAST(32 AS DOUBLE) ELSE CAST(64 AS DOUBLE) END AS q")
    j = j.selectExpr(
        "*", f"{_offset(mults[0], 11)} AS dx", f"{_offset(mults[1], 17)} AS dy",
        f"{_offset(mults[2], 23)} AS dz")
    box = int(BOX_SIZE)
    cols = [
        f"CAST((CAST(hpx AS DOUBLE) + dx + {box}) % {box} AS FLOAT) AS px",
        f"CAST((CAST(hpy AS DOUBLE) + dy + {box}) % {box} AS FLOAT) AS py",
        f"CAST((CAST(hpz AS DOUBLE) + dz + {box}) % {box} AS FLOAT) AS pz",
        "CAST(hvx - 4 * dy + ((k * 31) % 61 - 30) AS FLOAT) AS vx",
        "CAST(hvy + 4 * dx + ((k * 37) % 61 - 30) AS FLOAT) AS vy",
        "CAST(hvz + ((k * 41) % 61 - 30) AS FLOAT) AS vz",
    ]
    if species == "star":
        cols += ["CAST(l_quantity / 64 AS FLOAT) AS mass", "CAST(k AS BIGINT) AS id",
                 "CAST(CAST(k % 1024 AS DOUBLE) / 1024 AS FLOAT) AS formation_time"]
    else:
        cols += ["CAST(k AS BIGINT) AS id"]
    return j.selectExpr(*cols)


def star_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return particles(spark, sf_dir, "star")


def dm_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return particles(spark, sf_dir, "dm")


def radius_side_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subhalo_id, StarHalfRad) side table used to enrich pair tables."""
    return subhalo_catalog(spark, sf_dir).selectExpr("sub_id AS subhalo_id", "StarHalfRad")
