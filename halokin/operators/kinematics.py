"""Mass-weighted kinematics per group (subhalo, or subhalo x aperture x species).

Input rows: group keys, ``rel_px..pz`` (x, displacement from the centre),
``sq_dist_subhalo2ptl`` (d^2), ``vx..vz`` (v) and ``mass`` (m). Per group:

  M = sum m, vbar = sum(m v)/M, u = v - vbar                       (all rows)
  Ktot = 1/2 sum m u.u ; sigma2_k = sum m u_k^2 / M                 (all rows)
  J = sum m (x cross u) ; J-hat = J/|J|
  per row: j_rot = m (x cross u).J/|J|, R_tot = x.J/|J|,
           valid <=> d^2 - R_tot^2 > 0, R_rot = sqrt(d^2 - R_tot^2),
           mV_rot = j_rot/R_rot, phi-hat = (J-hat cross x)/|J-hat cross x|,
           theta-hat = phi-hat cross r-hat, u_r/u_phi/u_theta = projections of u
  Krot = sum 1/2 mV_rot^2/m ; V = sum mV_rot / M                    (valid rows)
  sigma2_{r,theta,phi} = sum m u_c^2 / W, W = sum m                 (valid rows)
  sigma2_phi_noRot = sum m (u_phi - V)^2 / W
  sigma2_k_noRot   = sum m (u_k - V phi-hat_k)^2 / W
  sigma2_noRot = sigma2_r + sigma2_phi_noRot + sigma2_theta

Only groups with at least one valid row are returned (a group whose J is zero
has none). Divisions by zero give NULL (``try_divide``), never an error.

``j_tolerance`` (default 0: off): a group with 0 < |J| <= j_tolerance * sum m|x||u|
has a J that is only the rounding residue of cancelling terms, and its axis is
arbitrary. With a tolerance such a group stays, with its energies and Cartesian
variances, and its rotation measures are NULL.

Execution: no windows. Each pass is a grouped aggregation with partial
(map-side) aggregation, so a group holding a third of all rows is reduced
locally in every task before the shuffle. The small per-group tables are
written to the shared folder and joined back (broadcast when their exact row
count allows, range by range or a shuffle with large groups salted otherwise; see ``joinback``).
Where the ranges are more than the driver can broadcast at a time, the sums of each are written before the next.

* ``method="three_pass"`` (default): pass 1 -> M, vbar; pass 2 -> J from
  u = v - vbar on every row (the same arithmetic as the original formulation);
  pass 3 -> all sums.
* ``method="two_pass"``: J from the identity
  J = sum m (x cross v) - (sum m x) cross vbar in pass 1, saving one scan.

V is only known at the end of the last pass, so the two no-rotation variances
are expanded about an estimate V0 = |J| / sum m|x| from the pass before:
sum m (a - V b)^2 = sum m c^2 - 2 (V - V0) sum m c b + (V - V0)^2 sum m b^2 with
c = a - V0 b, each sum over the rows where the original term is defined. For a
cold disc V0 is V up to rounding, so nothing cancels; a sum of squares that
rounding leaves below zero is zero.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cross, divide, dot, norm, norm2, safe_div, scale, sq, sub
from ..schemas import MEASURES, UNIT_J
from ..session import materialize
from .joinback import DEFAULT_BROADCAST_MAX_ROWS, attach, attach_in_waves

X = ("rel_px", "rel_py", "rel_pz")
V = ("vx", "vy", "vz")
D2 = "sq_dist_subhalo2ptl"
_SALT_COLS = list(X) + list(V)


def _vec(names: Sequence[str]) -> tuple[Column, Column, Column]:
    return F.col(names[0]), F.col(names[1]), F.col(names[2])


def kinematic_input(rows: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Project the needed columns, velocities and mass cast to double."""
    return rows.select(
        *keys, *carry, *[F.col(c).cast("double").alias(c) for c in X], F.col(D2).cast("double").alias(D2),
        *[F.col(c).cast("double").alias(c) for c in V], F.col("mass").cast("double").alias("mass"))


def _mean_velocity(base: DataFrame, keys: Sequence[str], two_pass: bool,
                   carry: Sequence[str] = (), j_tolerance: float = 0.0) -> DataFrame:
    m = F.col("mass")
    x, v = _vec(X), _vec(V)
    aggs = [F.max(c).alias(c) for c in carry]
    aggs += [F.count(F.lit(1)).alias("_n"), F.sum(m).alias("_M")] + [F.sum(m * c).alias(f"_mv{i}") for i, c in enumerate(v)]
    if two_pass:
        aggs += [F.sum(m * c).alias(f"_mx{i}") for i, c in enumerate(x)]
        aggs += [F.sum(m * c).alias(f"_mxv{i}") for i, c in enumerate(cross(x, v))]
        aggs += [F.sum(m * norm(x) * norm(v)).alias("_JS"), F.sum(m * norm(x)).alias("_mr")]
    s = base.groupBy(*keys).agg(*aggs)
    vbar = [safe_div(F.col(f"_mv{i}"), F.col("_M")).alias(f"_vb{i}") for i in range(3)]
    cols = [*keys, *carry, "_n", "_M", *vbar]
    if two_pass:
        mx = _vec(["_mx0", "_mx1", "_mx2"])
        vb = tuple(safe_div(F.col(f"_mv{i}"), F.col("_M")) for i in range(3))
        jv = sub(_vec(["_mxv0", "_mxv1", "_mxv2"]), cross(mx, vb))
        scale_ = F.col("_JS") + norm(mx) * norm(vb)
        cols += _axis(jv, scale_, j_tolerance)
    return s.select(*cols)


def _axis(J, scale_: Column, j_tolerance: float) -> list[Column]:
    """J (zero where it is noise by ``j_tolerance``), whether it is noise, and the estimate V0."""
    noise = F.coalesce((norm(J) <= F.lit(float(j_tolerance)) * scale_) & (scale_ > 0), F.lit(False)) if j_tolerance else F.lit(False)
    kept = tuple(F.when(noise, F.lit(0.0)).otherwise(c) for c in J)
    v0 = F.coalesce(safe_div(norm(J), F.col("_mr")), F.lit(0.0))
    return [*[c.alias(f"_J{i}") for i, c in enumerate(kept)], noise.alias("_noise"), v0.alias("_V0")]


def _in_waves(base: DataFrame, stats: DataFrame, keys: Sequence[str], sums: Callable[[DataFrame], DataFrame], tag: str, **opts) -> DataFrame:
    """``sums`` (grouped by ``keys``) of the rows with their ``stats``; of several waves each is written before the next."""
    waves = [sums(rows) for rows in attach_in_waves(base, stats, keys, **opts)]
    return waves[0] if len(waves) == 1 else reduce(DataFrame.unionByName, [materialize(w, tag) for w in waves])


def _angular_momentum(rows1: DataFrame, keys: Sequence[str], j_tolerance: float) -> DataFrame:
    """J per group, grouped by the keys alone; the pass-1 values are joined on
    afterwards (a join of two per-group tables)."""
    m = F.col("mass")
    u = sub(_vec(V), _vec(["_vb0", "_vb1", "_vb2"]))
    j = scale(cross(_vec(X), u), m)
    jsum = rows1.groupBy(*keys).agg(*[F.sum(c).alias(f"_Jraw{i}") for i, c in enumerate(j)],
                                    F.sum(m * norm(_vec(X)) * norm(u)).alias("_JS"),
                                    F.sum(m * norm(_vec(X))).alias("_mr"))
    return jsum.select(*keys, *_axis(_vec(["_Jraw0", "_Jraw1", "_Jraw2"]), F.col("_JS"), j_tolerance))


def _final_sums(rows2: DataFrame, keys: Sequence[str]) -> DataFrame:
    m = F.col("mass")
    d2 = F.col(D2)
    x = _vec(X)
    u = sub(_vec(V), _vec(["_vb0", "_vb1", "_vb2"]))
    J = _vec(["_J0", "_J1", "_J2"])
    jn = norm(J)
    jhat = divide(J, jn)

    # per-row quantities, evaluated once in a projection
    j = scale(cross(x, u), m)
    j_rot = safe_div(dot(j, J), jn)
    r_tot = safe_div(dot(x, J), jn)
    q = d2 - r_tot * r_tot
    r_hat = divide(x, F.sqrt(norm2(x)))
    jx = cross(jhat, x)
    phi = divide(jx, norm(jx))
    cols = {
        "_valid": F.coalesce(q > 0, F.lit(False)),
        "_q": q, "_jrot": j_rot,
        "_ux": u[0], "_uy": u[1], "_uz": u[2],
        "_px": phi[0], "_py": phi[1], "_pz": phi[2],
        "_rx": r_hat[0], "_ry": r_hat[1], "_rz": r_hat[2],
    }
    r = rows2.select(*keys, "mass", "_V0", *[c.alias(n) for n, c in cols.items()])

    valid = F.col("_valid")
    uu = _vec(["_ux", "_uy", "_uz"])
    ph = _vec(["_px", "_py", "_pz"])
    rh = _vec(["_rx", "_ry", "_rz"])
    th = cross(ph, rh)
    mv_rot = F.when(valid, safe_div(F.col("_jrot"), F.sqrt(F.col("_q"))))
    u_r, u_phi, u_theta = dot(uu, rh), dot(uu, ph), dot(uu, th)

    def when_ok(expr: Column, cond: Column = valid) -> Column:
        return F.when(cond, expr)

    # every per-row term in one projection (common subexpressions evaluated
    # once), so that the aggregation below is a list of plain column sums
    phi_ok = valid & u_phi.isNotNull() & m.isNotNull()
    terms = {
        "_Ktot": m * dot(uu, uu),
        **{f"_S{i}": sq(c) * m for i, c in enumerate(uu)},
        "_Krot": when_ok(safe_div(F.lit(0.5) * (mv_rot * mv_rot), m)),
        "_SmV": mv_rot,
        "_W": when_ok(m),
        "_Sr": when_ok(sq(u_r) * m),
        "_St": when_ok(sq(u_theta) * m),
        "_Sp": when_ok(sq(u_phi) * m),
        "_Np": when_ok(m * sq(u_phi - F.col("_V0")), phi_ok),
        "_Ap": when_ok(m * (u_phi - F.col("_V0")), phi_ok),
        "_Bp": when_ok(m, phi_ok),
    }
    for i, (uk, pk) in enumerate(zip(uu, ph)):
        ok = valid & uk.isNotNull() & pk.isNotNull() & m.isNotNull()
        ck = uk - F.col("_V0") * pk
        terms.update({f"_E{i}": when_ok(m * sq(ck), ok), f"_C{i}": when_ok(m * ck * pk, ok),
                      f"_D{i}": when_ok(m * sq(pk), ok)})
    t = r.select(*keys, "_valid", *[c.alias(n) for n, c in terms.items()])
    aggs = [F.count_if(F.col("_valid")).alias("_nvalid")]
    aggs += [(F.sum(n) * F.lit(0.5)).alias(n) if n == "_Ktot" else F.sum(n).alias(n) for n in terms]
    return t.groupBy(*keys).agg(*aggs)


def _measures(s: DataFrame, keys: Sequence[str], with_unit_j: bool, carry: Sequence[str] = ()) -> DataFrame:
    M, W = F.col("_M"), F.col("_W")
    vrot = safe_div(F.col("_SmV"), M)
    sx, sy, sz = (safe_div(F.col(f"_S{i}"), M) for i in range(3))
    sr, st, sp = (safe_div(F.col(n), W) for n in ("_Sr", "_St", "_Sp"))
    dv = vrot - F.col("_V0")

    def squares(cc: str, cb: str, bb: str) -> Column:
        total = F.col(cc) - F.lit(2.0) * dv * F.col(cb) + dv * dv * F.col(bb)
        return F.when(total < 0, F.lit(0.0)).otherwise(total)

    sp_nr = safe_div(squares("_Np", "_Ap", "_Bp"), W)
    sk_nr = [safe_div(squares(f"_E{i}", f"_C{i}", f"_D{i}"), W) for i in range(3)]
    values = [F.col("_Ktot"), sx, sy, sz, sx + sy + sz, F.col("_Krot"), vrot, sr, st, sp,
              sp_nr, sr + sp_nr + st, *sk_nr]
    out = [*keys, *carry, *[c.alias(n) for n, c in zip(MEASURES, values)]]
    if with_unit_j:
        J = _vec(["_J0", "_J1", "_J2"])
        out += [c.alias(n) for n, c in zip(UNIT_J, divide(J, norm(J)))]
    return s.filter((F.col("_nvalid") > 0) | F.col("_noise")).select(*out)


def kinematics(rows: DataFrame, keys: Sequence[str] = ("subhalo_id",), *,
               method: str = "three_pass", with_unit_j: bool = False,
               carry: Sequence[str] = (), j_tolerance: float = 0.0, axis: DataFrame | None = None,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               salt_buckets: int | None = None) -> DataFrame:
    """Per-group kinematics; one output row per group with a valid row.

    ``rows`` are already restricted to the aperture and carry ``mass``.
    ``carry`` names columns that are constant within a group (returned with the
    result, never used as grouping keys). ``axis`` may give the result of the first two
    passes: keys, carry, ``_n`` (rows), ``_M``, ``_vb0`` to ``_vb2``, ``_J0`` to ``_J2``, ``_noise`` and ``_V0``.
    """
    keys = list(keys)
    carry = list(carry)
    base = kinematic_input(rows, keys, carry)
    join_opts = dict(salt_cols=_SALT_COLS, broadcast_max_rows=broadcast_max_rows,
                     salt_buckets=salt_buckets, count_col="_n")
    # a carried subhalo id stays on the rows: it is the range column of the
    # chunked join-back tier (pair tables are sorted by it)
    keep = [c for c in carry if c == "subhalo_id"]  # if it is no key itself
    drop = [c for c in carry if c not in keep]
    if axis is not None:
        stats = materialize(axis, "kin-J")
        n_groups = stats.count()
    elif method == "three_pass":
        s1 = materialize(_mean_velocity(base, keys, False, carry), "kin-vbar")
        n_groups = s1.count()  # exact size of every per-group table below
        jsum = _in_waves(base.drop(*drop), s1.drop(*drop), keys, lambda rows1: _angular_momentum(rows1, keys, j_tolerance), "kin-Jsum",
                         n_stats=n_groups, **join_opts)
        stats = materialize(s1.join(jsum, keys, "inner"), "kin-J")
    elif method == "two_pass":
        stats = materialize(_mean_velocity(base, keys, True, carry, j_tolerance), "kin-J")
        n_groups = stats.count()
    else:
        raise ValueError(f"unknown method {method!r}")
    slim = stats.select(*keys, *keep, "_n", "_M", "_vb0", "_vb1", "_vb2", "_J0", "_J1", "_J2", "_V0")
    sums = _in_waves(base.drop(*drop), slim, keys, lambda rows2: _final_sums(rows2, keys), "kin-sums", n_stats=n_groups, **join_opts)
    per_group = stats.select(*keys, *carry, "_M", "_J0", "_J1", "_J2", "_noise", "_V0")
    return _measures(sums.join(per_group, keys, "inner"), keys, with_unit_j, carry)


def velocity_moments(rows: DataFrame, keys: Sequence[str] = ("subhalo_id",), *,
                     broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                     salt_buckets: int | None = None) -> DataFrame:
    """Per group, over all rows: total kinetic energy 1/2 sum m u.u and the
    mass-weighted variances sum m u_k^2 / M (k = x, y, z) and their sum.

    Unlike ``kinematics`` every group is returned, including groups whose
    angular momentum is zero.
    """
    keys = list(keys)
    base = kinematic_input(rows, keys)
    s1 = materialize(_mean_velocity(base, keys, two_pass=False), "moments-vbar")
    r = attach(base, s1, keys, salt_cols=_SALT_COLS, broadcast_max_rows=broadcast_max_rows,
               salt_buckets=salt_buckets, count_col="_n")
    m = F.col("mass")
    u = sub(_vec(V), _vec(["_vb0", "_vb1", "_vb2"]))
    s = r.groupBy(*keys, "_M").agg(
        (F.sum(m * dot(u, u)) * F.lit(0.5)).alias(MEASURES[0]),
        *[F.sum(sq(c) * m).alias(f"_S{i}") for i, c in enumerate(u)])
    sx, sy, sz = (safe_div(F.col(f"_S{i}"), F.col("_M")) for i in range(3))
    return s.select(*keys, MEASURES[0], sx.alias(MEASURES[1]), sy.alias(MEASURES[2]),
                    sz.alias(MEASURES[3]), (sx + sy + sz).alias(MEASURES[4]))
