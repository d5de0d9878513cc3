"""Aperture selection, constant species mass, and the per-aperture kinematics
entry points (fixed radius, or a multiple of a per-subhalo radius column)."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import H_CATALOG, dm_particle_mass
from ..schemas import MEASURES, UNIT_J
from .kinematics import D2, kinematics


def fixed_limit2(aperture: float, h: float = H_CATALOG) -> float:
    """Squared fixed aperture ``(aperture*h)^2`` as a correctly rounded product."""
    r = aperture * h
    return r * r


def fixed_aperture(pairs: DataFrame, aperture: Optional[float], h: float = H_CATALOG) -> DataFrame:
    """Rows with ``sq_dist <= (aperture*h)^2`` (inclusive); a falsy aperture keeps all."""
    if not aperture:
        return pairs
    return pairs.filter(F.col(D2) <= F.lit(fixed_limit2(aperture, h)))


def scaled_radius(column: str = "StarHalfRad", scale: float = 1, h: float = H_CATALOG) -> Column:
    """Per-row aperture radius ``scale * column * h`` (the column is the subhalo's own).

    An integral scale multiplies in the column's own precision (a float column
    gives a float product, as without ANSI type widening); then times h in double.
    """
    s = float(scale)
    factor = F.lit(s).cast("float") if s.is_integer() else F.lit(s)
    return (F.col(column) * factor).cast("double") * F.lit(h)



def scaled_aperture(pairs: DataFrame, column: str = "StarHalfRad", scale: float = 1,
                    h: float = H_CATALOG) -> DataFrame:
    """Rows with ``sq_dist <= (scale*column*h)^2`` (inclusive)."""
    r = scaled_radius(column, scale, h)
    return pairs.filter(F.col(D2) <= r * r)


def with_constant_mass(df: DataFrame, mass: float) -> DataFrame:
    """All particles of a species have the same mass (dark matter)."""
    return df.withColumn("mass", F.lit(float(mass)))


def species_mass(df: DataFrame, species: str, h: float = H_CATALOG) -> DataFrame:
    """Dark-matter rows get the constant particle mass; star rows keep theirs."""
    return with_constant_mass(df, dm_particle_mass(h)) if species == "dm" else df


def suffixed_name(name: str, suffix: str) -> str:
    """Notebook naming: ``<measure>_<suffix>``, with an axis/variant tail of a
    dispersion after the suffix (``..._dispersion_30_x``)."""
    base, _, tail = name.partition("_dispersion_")
    if name.startswith("mass_weighted_velocity_dispersion_") and tail:
        return f"{base}_dispersion_{suffix}_{tail}"
    return f"{name}_{suffix}"


def suffix_measures(df: DataFrame, suffix: Optional[str]) -> DataFrame:
    """The measure columns renamed with the aperture."""
    if suffix is None:
        return df
    return df.withColumnsRenamed({n: suffixed_name(n, suffix) for n in (*MEASURES, *UNIT_J) if n in df.columns})


def aperture_kinematics(pairs: DataFrame, aperture: Optional[float] = None, species: str = "star", *,
                        h: float = H_CATALOG, suffix: Optional[str] = None, **opts) -> DataFrame:
    """Kinematics of every subhalo inside a fixed aperture (kpc)."""
    rows = species_mass(fixed_aperture(pairs, aperture, h), species, h)
    return suffix_measures(kinematics(rows, ("subhalo_id",), **opts), suffix)


def column_kinematics(pairs: DataFrame, column: str = "StarHalfRad", species: str = "star", *,
                      scale: float = 1, h: float = H_CATALOG, suffix: Optional[str] = None,
                      **opts) -> DataFrame:
    """Kinematics inside ``scale`` times a per-subhalo radius column."""
    rows = scaled_aperture(species_mass(pairs, species, h), column, scale, h)
    return suffix_measures(kinematics(rows, ("subhalo_id",), **opts), suffix)
