"""Registered queries (Spark) and their SQL oracles (DuckDB).

Every query reads the driver tables under ``sf_dir`` (or Parquet that Spark
derived from them), so its work grows with the tables. Kinematic measures are
rounded to ``MEASURE_DECIMALS`` (unit vectors to ``UNIT_DECIMALS``) on both
sides: parallel sums add in a different order than DuckDB, which changes the
last bits but not these digits.
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FIXED_APERTURES, HALF_RADIUS_SCALES, H_CATALOG, H_JOIN, NOTEBOOK_APERTURES, join_radius
from ..operators import apertures as ap
from ..operators.catalog import catalog_2d, catalog_3d
from ..operators.neighbors import neighbour_join, subhalo_registrations
from ..schemas import CATALOG_2D, CATALOG_3D, MEASURES, UNIT_J
from ..sources import fixtures as fx
from . import jobs
from . import oracle as O

#: Two engines agree on no axis for a J of rounding noise: the compared queries take such groups as without one.
NOISE = {"j_tolerance": 1e-8}

QueryFn = Callable[[SparkSession, str], DataFrame]

_ROUND_MEASURES = set(MEASURES) | {dst for _, dst in CATALOG_3D + CATALOG_2D if not dst.startswith("unitJ")}


def quantize(c, decimals: int):
    """Round to ``decimals`` with the rounding threshold moved off the half-way
    point (see ``oracle.quantize_shift``); identical arithmetic in both engines."""
    return F.round(c + F.lit(O.quantize_shift(decimals)), decimals)


def rounded(df: DataFrame) -> DataFrame:
    """Quantize kinematic measures (3 decimals) and unit vectors (6) for comparison."""
    out = []
    for c in df.columns:
        if c in UNIT_J:
            out.append(quantize(F.col(c), O.UNIT_DECIMALS).alias(c))
        elif c in _ROUND_MEASURES:
            out.append(quantize(F.col(c), O.MEASURE_DECIMALS).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


_QUERIES: Dict[str, QueryFn] = {}
_SQL: Dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ fixtures / scans

register("fixture_subhalos", O.subhalos_sql())(lambda spark, d: fx.subhalo_catalog(spark, d))
register("fixture_star", O.particles_sql("star"))(lambda spark, d: fx.star_particles(spark, d))
register("fixture_dm", O.particles_sql("dm"))(lambda spark, d: fx.dm_particles(spark, d))

# ------------------------------------------------------------------ neighbour join


@register("neighbor_star", O.pairs_sql("star"))
def neighbor_star(spark: SparkSession, d: str) -> DataFrame:
    """Star particles (the stored snapshot) paired with every subhalo within the join radius."""
    return neighbour_join(jobs.snapshot_particles(spark, d, "star"), fx.subhalo_catalog(spark, d))


@register("neighbor_dm", O.pairs_sql("dm"))
def neighbor_dm(spark: SparkSession, d: str) -> DataFrame:
    return neighbour_join(jobs.snapshot_particles(spark, d, "dm"), fx.subhalo_catalog(spark, d))


@register("neighbor_star_chunked", O.pairs_sql("star"))
def neighbor_star_chunked(spark: SparkSession, d: str) -> DataFrame:
    """The same join in slab chunks, by a bound on the broadcast rows below their number."""
    subhalos = fx.subhalo_catalog(spark, d)
    bound = max(200, subhalo_registrations(subhalos, join_radius(H_JOIN)).count() // 6)
    return neighbour_join(jobs.snapshot_particles(spark, d, "star"), subhalos, strategy="chunked", broadcast_max_rows=bound)


# ------------------------------------------------------------------ kinematics per aperture

def _kin_fixed(species: str, aperture: float, h: float) -> QueryFn:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return rounded(ap.aperture_kinematics(jobs.pair_table(spark, d, species), aperture, species, h=h, **NOISE))
    return q


def _kin_scaled(species: str, scale: float) -> QueryFn:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return rounded(ap.column_kinematics(jobs.pair_table(spark, d, species), "StarHalfRad", species,
                                            scale=scale, h=H_CATALOG, **NOISE))
    return q


for _sp in ("star", "dm"):
    for _r in FIXED_APERTURES:
        register(f"kin_{_sp}_r{_r}", O.kin_fixed_sql(_sp, _r, H_CATALOG))(_kin_fixed(_sp, _r, H_CATALOG))
    for _s in HALF_RADIUS_SCALES:
        register(f"kin_{_sp}_rh{_s}", O.kin_scaled_sql(_sp, _s, H_CATALOG))(_kin_scaled(_sp, _s))
# the notebook's 50 kpc aperture (h = 0.6774): the whole join sphere
register("kin_star_r50", O.kin_fixed_sql("star", NOTEBOOK_APERTURES[0], H_JOIN))(
    _kin_fixed("star", NOTEBOOK_APERTURES[0], H_JOIN))


# ------------------------------------------------------------------ sweeps and catalogues

@register("sweep_fixed", O.sweep_sql(("star", "dm"), FIXED_APERTURES, ()))
def sweep_fixed(spark: SparkSession, d: str) -> DataFrame:
    return rounded(jobs.full_sweep(jobs.pair_tables(spark, d), FIXED_APERTURES, (), **NOISE))


@register("sweep_scaled", O.sweep_sql(("star", "dm"), (), HALF_RADIUS_SCALES))
def sweep_scaled(spark: SparkSession, d: str) -> DataFrame:
    return rounded(jobs.full_sweep(jobs.pair_tables(spark, d), (), HALF_RADIUS_SCALES, **NOISE))


@register("sweep_notebook", O.sweep_sql(("star",), NOTEBOOK_APERTURES, (1,), h=H_JOIN))
def sweep_notebook(spark: SparkSession, d: str) -> DataFrame:
    """The notebook's export: star particles, 50/30/20/10/5/3 kpc and one
    StarHalfRad, h = 0.6774, in one job."""
    return rounded(jobs.full_sweep({"star": jobs.pair_table(spark, d, "star")}, NOTEBOOK_APERTURES, (1,),
                                   h=H_JOIN, **NOISE))


@register("catalog_3d", O.catalog_sql("3d"))
def q_catalog_3d(spark: SparkSession, d: str) -> DataFrame:
    return rounded(catalog_3d(jobs.full_sweep(jobs.pair_tables(spark, d), **NOISE)))


@register("catalog_2d", O.catalog_sql("2d"))
def q_catalog_2d(spark: SparkSession, d: str) -> DataFrame:
    return rounded(catalog_2d(jobs.full_sweep(jobs.pair_tables(spark, d), **NOISE)))


from . import more_queries  # noqa: E402,F401  (registers the remaining queries)


def queries() -> Dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> Dict[str, str]:
    return dict(_SQL)
