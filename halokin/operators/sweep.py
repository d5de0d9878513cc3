"""Aperture sweeps: many apertures and both species in one distributed job.

Instead of one job per (aperture, species) — 20 jobs that each rescan the pair
tables — every pair row is tagged with the apertures that contain it
(``explode(filter(array_of_apertures, contains))``), the species tables are
unioned, and the kinematics group by ``(species, aperture, subhalo_id)``.
Apertures are nested, so a pair emits at most one row per aperture, and mass, mean
velocity and angular momentum need no such rows: see ``shell_axis``. Only the last pass, whose
terms depend on the aperture's own axis, has them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FIXED_APERTURES, H_CATALOG, HALF_RADIUS_SCALES, H_JOIN, dm_particle_mass, join_radius
from ..functions.twofloat import at_place, halves, project, two_difference, two_product, two_sum
from .apertures import scaled_radius, species_mass
from .kinematics import D2, V, X, _axis, kinematics

KEYS = ("species_id", "aperture_id", "subhalo_id")


@dataclass(frozen=True)
class Aperture:
    """A labelled aperture: fixed radius (kpc) or ``scale`` x a radius column."""
    label: str
    radius_kpc: float | None = None
    scale: float | None = None
    column: str = "StarHalfRad"

    def radius(self, h: float) -> Column:
        """Aperture radius in pair units (kpc/h), as double."""
        if self.radius_kpc is not None:
            return F.lit(float(self.radius_kpc * h))
        return scaled_radius(self.column, self.scale, h)


def fixed_apertures(radii: Sequence[float] = FIXED_APERTURES) -> list[Aperture]:
    return [Aperture(label=f"{r:g}", radius_kpc=float(r)) for r in radii]


def scaled_apertures(scales: Sequence[float] = HALF_RADIUS_SCALES, column: str = "StarHalfRad") -> list[Aperture]:
    # integral scales stay integers: int * float column is a float product, as in
    # the original per-radius jobs
    return [Aperture(label=f"{s:g}Rh", scale=int(s) if float(s).is_integer() else float(s), column=column)
            for s in scales]


def aperture_rows(pairs: DataFrame, species_id: int, apertures: Sequence[Aperture], species: str,
                  h: float = H_CATALOG) -> DataFrame:
    """One row per (pair, aperture containing it), with species and mass set.

    Every pair row is exploded over the aperture list and filtered by the
    aperture's radius: both steps stay in one whole-stage-codegen span
    (a higher-order ``filter`` on the array would be interpreted per row).
    Species and apertures are small integer ids until the final projection.
    """
    extra = sorted({a.column for a in apertures if a.radius_kpc is None})
    base = species_mass(pairs, species, h).select("subhalo_id", *X, D2, *V, "mass", *extra)
    tagged = F.array(*[F.struct(F.lit(i).alias("aid"), a.radius(h).alias("radius"))
                       for i, a in enumerate(apertures)])
    rows = base.select("subhalo_id", *X, D2, *V, "mass", F.explode(tagged).alias("_ap"))
    rows = rows.filter(F.col(D2) <= F.col("_ap.radius") * F.col("_ap.radius"))
    return rows.select(F.lit(species_id).alias("species_id"), F.col("_ap.aid").alias("aperture_id"),
                       "subhalo_id", F.col("_ap.radius").alias("aperture_radius"), *X, D2, *V, "mass")


#: Scales of the terms of a sum, in km/s and kpc/h: the parts of a term below 2**-22 of these are summed on their own.
_SPEED, _LENGTH = "4096D", "64D"
_PLAIN = ("_n", "_M", "_mr", "_xx", "_vv", "_P0", "_P1", "_P2")
_TURN = [f"_A{i}" for i in range(3)]
_ARM = [f"_B{i}{side}" for i in range(3) for side in range(2)]
_SHELL_SUMS = (*_PLAIN, *[name + part for name in _TURN for part in "hlt"], *[name + part for name in _ARM for part in "hl"])


def _shell_terms(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The terms of M, sum m|x|, sum m x.x, sum m v.v, P = sum m v, and, in parts, of A = sum m (x cross v) and B = sum m x.

    B has the two components that a component of A goes with. Rows where that one is NULL have no part in them, nor in the plain
    sums that are NULL there. A and B have the mass ``_own``: 1 for a species whose particles all have the same, by
    which their sums are multiplied. The parts are exact for x, v and masses of 24 bits."""
    given = {"_m": "coalesce(double(mass), 0D)", "_u": "coalesce(double(_own), 0D)"}
    given |= {f"_x{i}": f"coalesce(double({c}), 0D)" for i, c in enumerate(X)} | {f"_v{i}": f"coalesce(double({c}), 0D)" for i, c in enumerate(V)}
    both = [((i + 1) % 3, (i + 2) % 3) for i in range(3)]
    given |= {f"_k{i}": f"CASE WHEN {V[j]} IS NULL OR {V[k]} IS NULL OR mass IS NULL THEN 0D ELSE 1D END" for i, (j, k) in enumerate(both)}
    given["_k"] = f"CASE WHEN {' OR '.join(f'{c} IS NULL' for c in V)} THEN 0D ELSE 1D END"
    r = project(rows, given, keys)
    square = lambda c: f"({c}0 * {c}0 + {c}1 * {c}1 + {c}2 * {c}2)"
    plain = {"_n": "1L", "_M": "_m", "_mr": f"_m * sqrt{square('_x')}", "_xx": f"_m * {square('_x')}", "_vv": f"_k * _m * {square('_v')}",
             **{f"_P{i}": f"_m * _v{i}" for i in range(3)}}
    products = {f"_a{i}": f"_x{j} * _v{k}" for i, (j, k) in enumerate(both)} | {f"_b{i}": f"_x{k} * _v{j}" for i, (j, k) in enumerate(both)}
    r = project(r, {**plain, **products, **{f"_w{i}": f"_k{i} * _u" for i in range(3)}}, [*keys, "_u", "_x0", "_x1", "_x2"])
    turn = {}
    for i in range(3):
        turn[f"_c{i}"], turn[f"_e{i}"] = two_difference(f"_a{i}", f"_b{i}")
    arms = {f"_B{i}{side}p": f"_w{i} * _x{j}" for i in range(3) for side, j in enumerate(both[i])}
    r = project(r, {**turn, **arms}, [*keys, *plain, "_u", "_w0", "_w1", "_w2"])
    upper = {f"_s{i}": halves(f"_c{i}")[0] for i in range(3)}
    r = project(r, upper, [*keys, *plain, "_u", "_w0", "_w1", "_w2", *turn, *arms])
    parts = {f"_A{i}p": f"_w{i} * _s{i}" for i in range(3)} | {f"_A{i}t": f"_w{i} * (_c{i} - _s{i}) + _w{i} * _e{i}" for i in range(3)}
    r = project(r, parts, [*keys, *plain, "_u", *arms])
    cut = {}
    for names, scale in ((_TURN, f"_u * {_SPEED} * {_LENGTH}"), (_ARM, f"_u * {_LENGTH}")):
        for name in names:
            cut[name + "h"], cut[name + "l"] = at_place(name + "p", f"({scale})")
    return project(r, cut, [*keys, *plain, "_A0t", "_A1t", "_A2t"])


def _axis_of_sums(sums: DataFrame, keep: Sequence[str], j_tolerance: float) -> DataFrame:
    """Mean velocity and J = A - B x vbar of every group, in two-float arithmetic, from its sums; ``_unit`` is what A and B are times.

    vbar is the rounded mean, as row by row: of a lone particle J is what its rounding leaves. With ``j_tolerance`` a J of at most
    that times sqrt(sum m x.x * sum m u.u) is noise (and zero), as in ``kinematics``. A J below the error of the sums is zero."""
    result = [*keep, "_n", "_M", "_vb0", "_vb1", "_vb2"]
    keep = [*keep, *_PLAIN, "_unit"]
    two = {f"_vb{i}": f"try_divide(_P{i}, _M)" for i in range(3)}
    for name in (*_TURN, *_ARM):
        two[name], e = two_sum(name + "h", name + "l")
        two[name + "r"] = f"{e} + {name}t" if name in _TURN else e
    r = project(sums, two, keep)
    turned = {}
    for i in range(3):
        for side, k in ((0, (i + 2) % 3), (1, (i + 1) % 3)):  # x_j vbar_k, and x_k vbar_j
            p, e = two_product(f"_B{i}{side}", f"_vb{k}")
            turned[f"_t{i}{side}"], turned[f"_u{i}{side}"] = p, f"{e} + _B{i}{side}r * _vb{k}"
    r = project(r, turned, [*keep, *two])
    first = {}
    for i in range(3):
        first[f"_f{i}"], first[f"_g{i}"] = two_difference(f"_A{i}", f"_t{i}0")
    r = project(r, first, [*keep, *two, *turned])
    J = {}
    for i in range(3):
        s, e = two_sum(f"_f{i}", f"_t{i}1")
        J[f"_K{i}"] = f"{s} + ((({e} + _g{i}) + _A{i}r) + (_u{i}1 - _u{i}0))"
    length = lambda parts: "sqrt(" + " + ".join(f"{p} * {p}" for p in parts) + ")"
    J["_size"] = length([f"(abs(_A{i}) + abs(_t{i}0) + abs(_t{i}1))" for i in range(3)])
    J["_uu"] = "_vv - (_P0 * _vb0 + _P1 * _vb1 + _P2 * _vb2)"
    r = project(r, J, [*keep, *two])
    small = f"{length(['_K0', '_K1', '_K2'])} > _size * {2.0 ** -72!r}D"
    r = project(r, {**{f"_J{i}": f"CASE WHEN {small} THEN _unit * _K{i} ELSE 0D END" for i in range(3)},
                    "_JS": f"sqrt(CASE WHEN _uu > _vv * {2.0 ** -40!r}D THEN _uu ELSE 0D END * _xx)"},  # below: rounding of the two sums
                [*keep, "_vb0", "_vb1", "_vb2"])
    return r.select(*result, *_axis((F.col("_J0"), F.col("_J1"), F.col("_J2")), F.col("_JS"), j_tolerance))


def shell_axis(pairs_by_species: Mapping[str, DataFrame], apertures: Sequence[Aperture], h: float, j_tolerance: float = 0.0) -> DataFrame:
    """The sweep's mean velocities and angular momenta without exploding pair rows, in one scan for each species.

    Fixed apertures nest, and so do the multiples of one column: a family. In every family a row gets
    the number of the smallest aperture that holds it (its shell); the sums are grouped by subhalo and the shells of all
    families, and only this small table is spread over the apertures and added up. J about the mean velocity of
    an aperture comes from sums that don't know it: what cancels there is kept by two-float sums."""
    families: dict[str | None, list[int]] = {}
    for i, a in enumerate(apertures):
        families.setdefault(a.column if a.radius_kpc is None else None, []).append(i)
    ordered = [sorted(ids, key=lambda i: apertures[i].scale if column else apertures[i].radius_kpc) for column, ids in families.items()]
    columns = [c for c in families if c]
    shells, inside = [], {}
    for f, ids in enumerate(ordered):
        shell = F.lit(len(ids))
        for k, i in reversed(list(enumerate(ids))):
            radius = apertures[i].radius(h)
            shell = F.when(F.col(D2) <= radius * radius, F.lit(k)).otherwise(shell)
            inside[i] = F.col(f"_shell{f}") <= F.lit(k)
        shells.append(shell.alias(f"_shell{f}"))
    keys = ["species_id", "_unit", "subhalo_id", *columns, *[f"_shell{f}" for f in range(len(ordered))]]
    out_of_all = " AND ".join(f"_shell{f} = {len(ids)}" for f, ids in enumerate(ordered))
    rows = None
    for number, (sp, pairs) in enumerate(pairs_by_species.items()):
        unit = dm_particle_mass(h) if sp == "dm" else 1.0
        own = F.lit(1.0) if sp == "dm" else F.col("mass").cast("double")
        part = species_mass(pairs, sp, h).select(F.lit(number).alias("species_id"), F.lit(unit).alias("_unit"), *keys[2:-len(ordered)], *shells, *X, *V,
                                                 F.col("mass").cast("double").alias("mass"), own.alias("_own")).where(f"NOT ({out_of_all})")
        rows = part if rows is None else rows.unionByName(part)
    total = _shell_terms(rows, keys).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in _SHELL_SUMS])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("aperture_id"), a.radius(h).alias("radius"), inside[i].alias("inside"))
                               for i, a in enumerate(apertures)])).alias("a")
    held = total.select("species_id", "subhalo_id", "_unit", *_SHELL_SUMS, each).where("a.inside")
    sums = held.groupBy("species_id", F.col("a.aperture_id").alias("aperture_id"), "subhalo_id").agg(
        F.max("a.radius").alias("aperture_radius"), F.max("_unit").alias("_unit"), *[F.sum(n).alias(n) for n in _SHELL_SUMS])
    return _axis_of_sums(sums, [*KEYS, "aperture_radius"], j_tolerance)


def sweep(pairs_by_species: Mapping[str, DataFrame], apertures: Sequence[Aperture], *,
          h: float = H_CATALOG, join_h: float = H_JOIN, **opts) -> DataFrame:
    """Kinematics for every (species, aperture, subhalo) in one job.

    ``aperture_truncated`` flags apertures larger than the neighbour-join
    radius: the pair table holds no particle beyond it, so such an aperture
    silently sees only the join sphere.
    """
    species = list(pairs_by_species)
    parts = [aperture_rows(df, i, apertures, sp, h) for i, (sp, df) in enumerate(pairs_by_species.items())]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if opts.get("method", "three_pass") == "three_pass":
        opts["axis"] = shell_axis(pairs_by_species, apertures, h, opts.get("j_tolerance", 0.0))
    res = kinematics(rows, KEYS, carry=("aperture_radius",), with_unit_j=True, **opts)
    species_label = F.element_at(F.array(*[F.lit(sp) for sp in species]), F.col("species_id") + 1)
    aperture_label = F.element_at(F.array(*[F.lit(a.label) for a in apertures]), F.col("aperture_id") + 1)
    out = [species_label.alias("species"), aperture_label.alias("aperture"), "subhalo_id", "aperture_radius",
           *[c for c in res.columns if c not in (*KEYS, "aperture_radius")],
           (F.col("aperture_radius") > F.lit(join_radius(join_h))).alias("aperture_truncated")]
    return res.select(*out)
