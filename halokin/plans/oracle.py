"""DuckDB SQL for every registered query (the correctness oracle).

The SQL follows the original formulation directly — theta join on the
periodic cell-adjacency predicate, then per-row ``u = v - vbar``, J, validity,
and the no-rotation terms with V joined back — so it checks the Spark plans
(grid equi-join, conditional sums, expanded no-rotation terms) rather than
repeating them. Floats are compared after the same rounding on both sides.

DuckDB notes: literals with an exponent are DOUBLE (plain ``8.0`` is DECIMAL),
FLOAT - FLOAT stays FLOAT, ``x / 0.0`` is inf (hence NULLIF), ``//`` is integer
division, and ``%`` keeps the sign of the dividend.
"""

from __future__ import annotations

from typing import Sequence

from ..constants import (BOX_SIZE, FIXED_APERTURES, GRID_CELLS, H_CATALOG, H_JOIN, HALF_RADIUS_SCALES,
                         HIST_BINS, HIST_RANGE, JOIN_RADIUS_KPC, MASS_CUT, SIZE_CUT, dm_particle_mass,
                         join_radius)
from ..schemas import CATALOG_2D, CATALOG_3D, MEASURES, UNIT_J
from ..sources.fixtures import DM_MULTIPLIERS, STAR_MULTIPLIERS

MEASURE_DECIMALS = 3
UNIT_DECIMALS = 6
#: A group whose |J| is at most this part of sum m|x||u| has no axis that two engines agree on: its rotation
#: measures are compared as NULL.
J_NOISE = 1e-8


def quantize_shift(decimals: int) -> float:
    """Offset added before rounding to ``decimals``.

    Plain rounding has its threshold half-way between grid points; exact
    rationals with small denominators (common in the fixture, e.g. 214.6875 or
    k/240) can sit exactly there, and the order of a parallel sum then decides
    the last digit. Shifting by (1/sqrt(2) - 1/2) units moves the threshold to
    the irrational fraction 1 - 1/sqrt(2) of a unit, which no such value is
    near; both engines add the same double and round.
    """
    return (0.5 ** 0.5 - 0.5) * 10.0 ** -decimals


def qround(expr: str, decimals: int) -> str:
    return f"round(({expr}) + {dbl(quantize_shift(decimals))}, {decimals})"


def dbl(x: float) -> str:
    """A DOUBLE literal that round-trips exactly."""
    s = repr(float(x))
    return s if ("e" in s or "inf" in s or "nan" in s) else s + "e0"


def pmod(expr: str, n: float) -> str:
    """Spark's pmod for doubles: r = a % n; r < 0 ? (r + n) % n : r."""
    n_ = dbl(n)
    return f"(CASE WHEN ({expr}) % {n_} < 0 THEN (({expr}) % {n_} + {n_}) % {n_} ELSE ({expr}) % {n_} END)"


# ---------------------------------------------------------------- fixtures

def subhalos_sql(with_half_mass: bool = False) -> str:
    extra = ", CAST(s % 5 AS DOUBLE) / 64 AS StarHalfMass" if with_half_mass else ""
    return f"""
SELECT
  CAST(CASE WHEN b % 10 = 0 THEN (b // 10) % 20 ELSE (b * 7919 + 13) % 205000 END + shift AS FLOAT) AS px,
  CAST((b * 104729 + 101) % 205000 AS FLOAT) AS py,
  CAST((b * 1299709 + 7) % 205000 AS FLOAT) AS pz,
  CAST((s * 37) % 401 - 200 AS FLOAT) AS vx,
  CAST((s * 53) % 401 - 200 AS FLOAT) AS vy,
  CAST((s * 71) % 401 - 200 AS FLOAT) AS vz,
  CAST(s AS INTEGER) AS sub_id,
  CAST(2 + s % 9 AS FLOAT) AS StarHalfRad{extra}
FROM (SELECT s_suppkey AS s,
             CASE WHEN s_suppkey % 10 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS b,
             CASE WHEN s_suppkey % 10 = 1 THEN 20 ELSE 0 END AS shift
      FROM supplier) t"""


def particles_sql(species: str) -> str:
    a, b, c = STAR_MULTIPLIERS if species == "star" else DM_MULTIPLIERS

    def off(m: int, add: int) -> str:
        return f"CASE WHEN k % 997 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST((k * {m} + {add}) % 641 - 320 AS DOUBLE) / q END"

    tail = ("CAST(l_quantity / 64 AS FLOAT) AS mass, CAST(k AS BIGINT) AS id, "
            "CAST(CAST(k % 1024 AS DOUBLE) / 1024 AS FLOAT) AS formation_time"
            if species == "star" else "CAST(k AS BIGINT) AS id")
    box = int(BOX_SIZE)
    return f"""
SELECT
  CAST((CAST(hpx AS DOUBLE) + dx + {box}) % {box} AS FLOAT) AS px,
  CAST((CAST(hpy AS DOUBLE) + dy + {box}) % {box} AS FLOAT) AS py,
  CAST((CAST(hpz AS DOUBLE) + dz + {box}) % {box} AS FLOAT) AS pz,
  CAST(hvx - 4 * dy + ((k * 31) % 61 - 30) AS FLOAT) AS vx,
  CAST(hvy + 4 * dx + ((k * 37) % 61 - 30) AS FLOAT) AS vy,
  CAST(hvz + ((k * 41) % 61 - 30) AS FLOAT) AS vz,
  {tail}
FROM (
  SELECT *, {off(a, 11)} AS dx, {off(b, 17)} AS dy, {off(c, 23)} AS dz
  FROM (
    SELECT *, CASE k % 4 WHEN 0 THEN CAST(8 AS DOUBLE) WHEN 1 THEN CAST(16 AS DOUBLE)
                         WHEN 2 THEN CAST(32 AS DOUBLE) ELSE CAST(64 AS DOUBLE) END AS q
    FROM (
      SELECT l.l_quantity, h.px AS hpx, h.py AS hpy, h.pz AS hpz, h.vx AS hvx, h.vy AS hvy, h.vz AS hvz,
             l.l_orderkey * 7 + l.l_linenumber * 13 + l.l_partkey * 3 AS k
      FROM lineitem l JOIN ({subhalos_sql()}) h ON l.l_suppkey = h.sub_id
    ) t1
  ) t2
) t3"""


PARTICLE_COLUMNS = {
    "star": ["px", "py", "pz", "vx", "vy", "vz", "mass", "id", "formation_time"],
    "dm": ["px", "py", "pz", "vx", "vy", "vz", "id"],
}


def pairs_sql(species: str, h: float = H_JOIN, box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> str:
    """Neighbour pairs: the original theta join on cell adjacency + exact filter."""
    cell = dbl(box / n_cells)
    half = dbl(box / 2.0)
    r = JOIN_RADIUS_KPC * h
    pcols = ", ".join(f"p.{c}" for c in PARTICLE_COLUMNS[species])

    def adj(a: str, b: str) -> str:
        return f"least(abs({a} - {b}), {n_cells} - abs({a} - {b})) <= 1"

    def rel(a: str) -> str:
        return f"{pmod(f'CAST(p.p{a} - h.subhalo_p{a} AS DOUBLE) + {half}', box)} - {half}"

    return f"""
SELECT *, rel_px * rel_px + rel_py * rel_py + rel_pz * rel_pz AS sq_dist_subhalo2ptl
FROM (
  SELECT {pcols}, p.ix, p.iy, p.iz,
         h.subhalo_px, h.subhalo_py, h.subhalo_pz, h.subhalo_vx, h.subhalo_vy, h.subhalo_vz,
         h.subhalo_id, h.StarHalfRad, h.subhalo_ix, h.subhalo_iy, h.subhalo_iz,
         {rel('x')} AS rel_px, {rel('y')} AS rel_py, {rel('z')} AS rel_pz
  FROM (SELECT *, CAST(floor(CAST(px AS DOUBLE) / {cell}) AS INTEGER) AS ix,
                  CAST(floor(CAST(py AS DOUBLE) / {cell}) AS INTEGER) AS iy,
                  CAST(floor(CAST(pz AS DOUBLE) / {cell}) AS INTEGER) AS iz
        FROM ({particles_sql(species)}) pp) p
  JOIN (SELECT px AS subhalo_px, py AS subhalo_py, pz AS subhalo_pz,
               vx AS subhalo_vx, vy AS subhalo_vy, vz AS subhalo_vz,
               sub_id AS subhalo_id, StarHalfRad,
               CAST(floor(CAST(px AS DOUBLE) / {cell}) AS INTEGER) AS subhalo_ix,
               CAST(floor(CAST(py AS DOUBLE) / {cell}) AS INTEGER) AS subhalo_iy,
               CAST(floor(CAST(pz AS DOUBLE) / {cell}) AS INTEGER) AS subhalo_iz
        FROM ({subhalos_sql()}) hh) h
    ON {adj('p.ix', 'h.subhalo_ix')} AND {adj('p.iy', 'h.subhalo_iy')} AND {adj('p.iz', 'h.subhalo_iz')}
) c
WHERE rel_px * rel_px + rel_py * rel_py + rel_pz * rel_pz < {dbl(r * r)}"""


# ---------------------------------------------------------------- kinematics

def _k(keys: Sequence[str], alias: str | None = None) -> str:
    return ", ".join(f"{alias}.{k}" if alias else k for k in keys)


def kinematics_sql(rows_sql: str, keys: Sequence[str], with_unit_j: bool = False,
                   decimals: int | None = MEASURE_DECIMALS, j_noise: float | None = J_NOISE) -> str:
    """Direct evaluation of the kinematics equations over ``rows_sql``. Groups with a zero J have no result;
    by ``j_noise``, those with a J of rounding noise have NULL rotation measures.

    ``rows_sql`` yields the keys, rel_px..pz, sq_dist_subhalo2ptl, vx..vz, mass.
    """
    K = _k(keys)
    using = f"USING ({K})"
    unit = ""
    if with_unit_j:
        unit = ", " + ", ".join(
            f"{qround(f'val.J{ax} / NULLIF(Jn, 0)', UNIT_DECIMALS)} AS unitJ_{ax}" for ax in "xyz")
    if decimals is None:
        R = lambda e, name: f"{e} AS {name}"
    else:
        R = lambda e, name: f"{qround(e, decimals)} AS {name}"
    m = MEASURES
    size = "sqrt(Jrx * Jrx + Jry * Jry + Jrz * Jrz)"
    noise = f"(JS > 0 AND {size} <= {dbl(j_noise)} * JS)" if j_noise else "FALSE"
    return f"""
WITH f AS (
  SELECT {K}, CAST(rel_px AS DOUBLE) AS x, CAST(rel_py AS DOUBLE) AS y, CAST(rel_pz AS DOUBLE) AS z,
         CAST(sq_dist_subhalo2ptl AS DOUBLE) AS d2,
         CAST(vx AS DOUBLE) AS vx, CAST(vy AS DOUBLE) AS vy, CAST(vz AS DOUBLE) AS vz,
         CAST(mass AS DOUBLE) AS m
  FROM ({rows_sql}) src
),
a AS (SELECT {K}, SUM(m) AS mtot, SUM(m * vx) AS Mvx, SUM(m * vy) AS Mvy, SUM(m * vz) AS Mvz FROM f GROUP BY {K}),
u AS (
  SELECT f.*, a.mtot, f.vx - a.Mvx / NULLIF(a.mtot, 0) AS ux, f.vy - a.Mvy / NULLIF(a.mtot, 0) AS uy,
         f.vz - a.Mvz / NULLIF(a.mtot, 0) AS uz
  FROM f JOIN a {using}
),
tot AS (
  SELECT {K}, SUM(m * (ux * ux + uy * uy + uz * uz)) * 0.5e0 AS Ktot,
         SUM((ux * ux) * m) AS Sx, SUM((uy * uy) * m) AS Sy, SUM((uz * uz) * m) AS Sz, MAX(mtot) AS mtot
  FROM u GROUP BY {K}
),
jraw AS (
  SELECT {K}, SUM((y * uz - z * uy) * m) AS Jrx, SUM((z * ux - x * uz) * m) AS Jry,
         SUM((x * uy - y * ux) * m) AS Jrz,
         SUM(m * sqrt(x * x + y * y + z * z) * sqrt(ux * ux + uy * uy + uz * uz)) AS JS
  FROM u GROUP BY {K}
),
jj AS (
  SELECT {K}, {noise} AS noise, CASE WHEN {noise} THEN 0e0 ELSE Jrx END AS Jx, CASE WHEN {noise} THEN 0e0 ELSE Jry END AS Jy,
         CASE WHEN {noise} THEN 0e0 ELSE Jrz END AS Jz
  FROM jraw
),
g AS (SELECT u.*, Jx, Jy, Jz, sqrt(Jx * Jx + Jy * Jy + Jz * Jz) AS Jn FROM u JOIN jj {using}),
r AS (
  SELECT g.*,
    (((y * uz - z * uy) * m) * Jx + ((z * ux - x * uz) * m) * Jy + ((x * uy - y * ux) * m) * Jz)
      / NULLIF(Jn, 0) AS jrot,
    (x * Jx + y * Jy + z * Jz) / NULLIF(Jn, 0) AS Rtot,
    Jx / NULLIF(Jn, 0) AS jhx, Jy / NULLIF(Jn, 0) AS jhy, Jz / NULLIF(Jn, 0) AS jhz,
    sqrt(x * x + y * y + z * z) AS rr
  FROM g
),
s AS (SELECT r.*, d2 - Rtot * Rtot AS q FROM r),
v1 AS (
  SELECT s.*, jrot / NULLIF(sqrt(q), 0) AS mV,
    x / NULLIF(rr, 0) AS rhx, y / NULLIF(rr, 0) AS rhy, z / NULLIF(rr, 0) AS rhz,
    jhy * z - jhz * y AS cx, jhz * x - jhx * z AS cy, jhx * y - jhy * x AS cz
  FROM s WHERE q > 0
),
v2 AS (
  SELECT v1.*, cx / NULLIF(sqrt(cx * cx + cy * cy + cz * cz), 0) AS phx,
               cy / NULLIF(sqrt(cx * cx + cy * cy + cz * cz), 0) AS phy,
               cz / NULLIF(sqrt(cx * cx + cy * cy + cz * cz), 0) AS phz
  FROM v1
),
v3 AS (
  SELECT v2.*, phy * rhz - phz * rhy AS thx, phz * rhx - phx * rhz AS thy, phx * rhy - phy * rhx AS thz
  FROM v2
),
v4 AS (
  SELECT v3.*, ux * rhx + uy * rhy + uz * rhz AS ur, ux * phx + uy * phy + uz * phz AS uphi,
         ux * thx + uy * thy + uz * thz AS utheta
  FROM v3
),
val AS (
  SELECT {K}, SUM(0.5e0 * (mV * mV) / NULLIF(m, 0)) AS Krot, SUM(mV) / NULLIF(MAX(mtot), 0) AS V,
         SUM(m) AS W, SUM((ur * ur) * m) AS Sr, SUM((utheta * utheta) * m) AS St,
         SUM((uphi * uphi) * m) AS Sp, MAX(Jx) AS Jx, MAX(Jy) AS Jy, MAX(Jz) AS Jz, MAX(Jn) AS Jn
  FROM v4 GROUP BY {K}
),
nr AS (
  SELECT {_k(keys, 'v4')},
         SUM(((v4.uphi - val.V) * (v4.uphi - val.V)) * v4.m) AS Np,
         SUM(((v4.ux - val.V * v4.phx) * (v4.ux - val.V * v4.phx)) * v4.m) AS Nx,
         SUM(((v4.uy - val.V * v4.phy) * (v4.uy - val.V * v4.phy)) * v4.m) AS Ny,
         SUM(((v4.uz - val.V * v4.phz) * (v4.uz - val.V * v4.phz)) * v4.m) AS Nz
  FROM v4 JOIN val {using} GROUP BY {_k(keys, 'v4')}
)
SELECT {K},
  {R('Ktot', m[0])},
  {R('Sx / NULLIF(mtot, 0)', m[1])}, {R('Sy / NULLIF(mtot, 0)', m[2])}, {R('Sz / NULLIF(mtot, 0)', m[3])},
  {R('Sx / NULLIF(mtot, 0) + Sy / NULLIF(mtot, 0) + Sz / NULLIF(mtot, 0)', m[4])},
  {R('Krot', m[5])}, {R('V', m[6])},
  {R('Sr / NULLIF(W, 0)', m[7])}, {R('St / NULLIF(W, 0)', m[8])}, {R('Sp / NULLIF(W, 0)', m[9])},
  {R('Np / NULLIF(W, 0)', m[10])},
  {R('Sr / NULLIF(W, 0) + Np / NULLIF(W, 0) + St / NULLIF(W, 0)', m[11])},
  {R('Nx / NULLIF(W, 0)', m[12])}, {R('Ny / NULLIF(W, 0)', m[13])}, {R('Nz / NULLIF(W, 0)', m[14])}
  {unit}
FROM tot JOIN jj {using} LEFT JOIN val {using} LEFT JOIN nr {using}
WHERE W IS NOT NULL OR noise"""


def mass_expr(species: str, h: float = H_CATALOG) -> str:
    return dbl(dm_particle_mass(h)) if species == "dm" else "mass"


def fixed_rows_sql(species: str, aperture: float | None, h: float = H_CATALOG) -> str:
    where = ""
    if aperture:
        r = aperture * h
        where = f"WHERE sq_dist_subhalo2ptl <= {dbl(r * r)}"
    return (f"SELECT subhalo_id, rel_px, rel_py, rel_pz, sq_dist_subhalo2ptl, vx, vy, vz, "
            f"{mass_expr(species, h)} AS mass FROM ({pairs_sql(species)}) p {where}")


def scaled_radius_sql(scale: float, column: str = "StarHalfRad", h: float = H_CATALOG) -> str:
    s = str(int(scale)) if float(scale).is_integer() else dbl(scale)
    return f"CAST({s} * {column} AS DOUBLE) * {dbl(h)}" if s.isdigit() else f"{s} * {column} * {dbl(h)}"


def scaled_rows_sql(species: str, scale: float, column: str = "StarHalfRad", h: float = H_CATALOG) -> str:
    rad = scaled_radius_sql(scale, column, h)
    return (f"SELECT subhalo_id, rel_px, rel_py, rel_pz, sq_dist_subhalo2ptl, vx, vy, vz, "
            f"{mass_expr(species, h)} AS mass FROM ({pairs_sql(species)}) p "
            f"WHERE sq_dist_subhalo2ptl <= ({rad}) * ({rad})")


def kin_fixed_sql(species: str, aperture: float | None, h: float = H_CATALOG) -> str:
    return kinematics_sql(fixed_rows_sql(species, aperture, h), ["subhalo_id"])


def kin_scaled_sql(species: str, scale: float, h: float = H_CATALOG) -> str:
    return kinematics_sql(scaled_rows_sql(species, scale, h=h), ["subhalo_id"])


SWEEP_KEYS = ["species", "aperture", "subhalo_id", "aperture_radius"]


def sweep_rows_sql(species_list: Sequence[str], fixed: Sequence[float] = (),
                   scales: Sequence[float] = (), h: float = H_CATALOG) -> str:
    """One SELECT per (species, aperture), concatenated with UNION ALL."""
    apertures = [(f"{r:g}", dbl(r * h)) for r in fixed]
    apertures += [(f"{s:g}Rh", f"({scaled_radius_sql(s, h=h)})") for s in scales]
    parts = [
        f"SELECT '{sp}' AS species, '{label}' AS aperture, subhalo_id, {rad} AS aperture_radius, "
        f"rel_px, rel_py, rel_pz, sq_dist_subhalo2ptl, vx, vy, vz, {mass_expr(sp, h)} AS mass "
        f"FROM pairs_{sp} WHERE sq_dist_subhalo2ptl <= {rad} * {rad}"
        for sp in species_list for label, rad in apertures
    ]
    return " UNION ALL ".join(parts)


def sweep_sql(species_list: Sequence[str] = ("star", "dm"), fixed: Sequence[float] = (),
              scales: Sequence[float] = (), h: float = H_CATALOG, subhalo_id: str = "subhalo_id") -> str:
    ctes = ", ".join(f"pairs_{sp} AS (SELECT * REPLACE ({subhalo_id} AS subhalo_id) FROM ({pairs_sql(sp)}) p0)" for sp in species_list)
    rows = sweep_rows_sql(species_list, fixed, scales, h)
    body = kinematics_sql(rows, SWEEP_KEYS, with_unit_j=True)
    jr = dbl(join_radius(H_JOIN))
    return (f"WITH {ctes} SELECT k.*, aperture_radius > {jr} AS aperture_truncated "
            f"FROM ({body}) k")


def catalog_sql(which: str, fixed: Sequence[float] = FIXED_APERTURES,
                scales: Sequence[float] = HALF_RADIUS_SCALES) -> str:
    mapping = CATALOG_3D if which == "3d" else CATALOG_2D
    cols = ", ".join(f"{src} AS {dst}" for src, dst in mapping)
    return f"SELECT species, aperture, subhalo_id, {cols} FROM ({sweep_sql(('star', 'dm'), fixed, scales)}) s"


# ---------------------------------------------------------------- misc

def hist_sql(value_sql: str, source_sql: str, bins: int = HIST_BINS,
             lo: float = HIST_RANGE[0], hi: float = HIST_RANGE[1]) -> str:
    step = (hi - lo) / bins
    st, lo_, hi_ = dbl(step), dbl(lo), dbl(hi)

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= {bins} THEN {hi_} ELSE {lo_} + ({i}) * {st} END)"

    guess = f"least(greatest(floor((v - {lo_}) / {st}), 0), {bins - 1})"
    return f"""
SELECT bin, {lo_} + bin * {st} AS bin_lo, {edge('bin + 1')} AS bin_hi, COUNT(*) AS n
FROM (
  SELECT CAST(CASE WHEN v < {edge('g')} THEN g - 1
                   WHEN v >= {edge('g + 1')} AND g < {bins - 1} THEN g + 1 ELSE g END AS INTEGER) AS bin
  FROM (SELECT v, {guess} AS g
        FROM (SELECT CAST({value_sql} AS DOUBLE) AS v FROM ({source_sql}) src) a
        WHERE v >= {lo_} AND v <= {hi_}) b
) c GROUP BY bin"""


__all__ = [
    "dbl", "pmod", "subhalos_sql", "particles_sql", "pairs_sql", "kinematics_sql", "kin_fixed_sql",
    "kin_scaled_sql", "sweep_sql", "catalog_sql", "hist_sql", "fixed_rows_sql", "scaled_rows_sql",
    "SIZE_CUT", "MASS_CUT", "UNIT_J",
]
