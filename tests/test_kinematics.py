"""Kinematics: window-form cross-check, invariants, degenerate groups, plan shape."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from halokin.operators.apertures import aperture_kinematics, fixed_aperture
from halokin.operators.kinematics import kinematics, velocity_moments
from halokin.schemas import MEASURES

H = 0.7


def window_reference(rows):
    """The equation chain written with whole-group windows, as originally
    formulated (test-only cross-check; not a scalable plan). Column names are
    case-insensitive, so the group totals must not be called Jx next to jx."""
    w = Window.partitionBy("subhalo_id")
    m = F.col("mass").cast("double")
    df = rows.select("subhalo_id", "rel_px", "rel_py", "rel_pz", "sq_dist_subhalo2ptl",
                     *[F.col(c).cast("double").alias(c) for c in ("vx", "vy", "vz")], m.alias("mass"))
    df = df.withColumn("M", F.sum("mass").over(w))
    for a in "xyz":
        df = df.withColumn(f"u{a}", F.col(f"v{a}") - F.sum(F.col("mass") * F.col(f"v{a}")).over(w) / F.col("M"))
    x, y, z = F.col("rel_px"), F.col("rel_py"), F.col("rel_pz")
    ux, uy, uz = F.col("ux"), F.col("uy"), F.col("uz")
    df = df.withColumn("jx", F.col("mass") * (y * uz - z * uy)).withColumn(
        "jy", F.col("mass") * (z * ux - x * uz)).withColumn("jz", F.col("mass") * (x * uy - y * ux))
    for a in "xyz":
        df = df.withColumn(f"Jtot_{a}", F.sum(f"j{a}").over(w))
    Jn = F.sqrt(F.col("Jtot_x") ** 2 + F.col("Jtot_y") ** 2 + F.col("Jtot_z") ** 2)
    df = df.withColumn("Jn", Jn)
    df = df.withColumn("jrot", F.try_divide(F.col("jx") * F.col("Jtot_x") + F.col("jy") * F.col("Jtot_y")
                                            + F.col("jz") * F.col("Jtot_z"), F.col("Jn")))
    df = df.withColumn("Rtot", F.try_divide(x * F.col("Jtot_x") + y * F.col("Jtot_y") + z * F.col("Jtot_z"), F.col("Jn")))
    df = df.withColumn("q", F.col("sq_dist_subhalo2ptl") - F.col("Rtot") * F.col("Rtot"))
    allrows = df.groupBy("subhalo_id").agg(
        (F.sum(F.col("mass") * (ux * ux + uy * uy + uz * uz)) * 0.5).alias(MEASURES[0]),
        *[(F.sum(F.col(f"u{a}") ** 2 * F.col("mass")) / F.sum("mass")).alias(MEASURES[1 + i])
          for i, a in enumerate("xyz")])
    v = df.filter(F.col("q") > 0).withColumn("mV", F.col("jrot") / F.sqrt("q"))
    v = v.withColumn("V", F.sum("mV").over(w) / F.col("M"))
    for a in "xyz":
        v = v.withColumn(f"jh{a}", F.col(f"Jtot_{a}") / F.col("Jn"))
    cx = F.col("jhy") * z - F.col("jhz") * y
    cy = F.col("jhz") * x - F.col("jhx") * z
    cz = F.col("jhx") * y - F.col("jhy") * x
    cn = F.sqrt(cx * cx + cy * cy + cz * cz)
    r = F.sqrt(x * x + y * y + z * z)
    v = v.select("*", (cx / cn).alias("phx"), (cy / cn).alias("phy"), (cz / cn).alias("phz"),
                 (x / r).alias("rhx"), (y / r).alias("rhy"), (z / r).alias("rhz"))
    thx = F.col("phy") * F.col("rhz") - F.col("phz") * F.col("rhy")
    thy = F.col("phz") * F.col("rhx") - F.col("phx") * F.col("rhz")
    thz = F.col("phx") * F.col("rhy") - F.col("phy") * F.col("rhx")
    ur = ux * F.col("rhx") + uy * F.col("rhy") + uz * F.col("rhz")
    uphi = ux * F.col("phx") + uy * F.col("phy") + uz * F.col("phz")
    uth = ux * thx + uy * thy + uz * thz
    V = F.col("V")
    mass = F.col("mass")
    val = v.groupBy("subhalo_id").agg(
        F.sum(0.5 * F.col("mV") ** 2 / mass).alias(MEASURES[5]), F.max("V").alias(MEASURES[6]),
        (F.sum(ur ** 2 * mass) / F.sum(mass)).alias(MEASURES[7]),
        (F.sum(uth ** 2 * mass) / F.sum(mass)).alias(MEASURES[8]),
        (F.sum(uphi ** 2 * mass) / F.sum(mass)).alias(MEASURES[9]),
        (F.sum((uphi - V) ** 2 * mass) / F.sum(mass)).alias(MEASURES[10]),
        *[(F.sum((u - V * F.col(f"ph{a}")) ** 2 * mass) / F.sum(mass)).alias(MEASURES[12 + i])
          for i, (a, u) in enumerate(zip("xyz", (ux, uy, uz)))])
    out = allrows.join(val, "subhalo_id")
    out = out.withColumn(MEASURES[4], F.col(MEASURES[1]) + F.col(MEASURES[2]) + F.col(MEASURES[3]))
    out = out.withColumn(MEASURES[11], F.col(MEASURES[7]) + F.col(MEASURES[10]) + F.col(MEASURES[8]))
    return out.select("subhalo_id", *MEASURES)


def _by_id(df):
    return {r["subhalo_id"]: r.asDict() for r in df.collect()}


def _close(a, b, rel=1e-9, abs_=1e-9):
    return math.isclose(a, b, rel_tol=rel, abs_tol=abs_)


@pytest.mark.parametrize("aperture", [5, 30])
def test_matches_window_formulation(small_pairs, aperture):
    rows = fixed_aperture(small_pairs["star"], aperture, H)
    ours, ref = _by_id(kinematics(rows)), _by_id(window_reference(rows))
    assert set(ours) == set(ref) and ours
    for sid, r in ref.items():
        for m in MEASURES:
            assert _close(ours[sid][m], r[m], rel=1e-8, abs_=1e-7), (sid, m, ours[sid][m], r[m])


def test_two_pass_equals_three_pass(small_pairs):
    rows = fixed_aperture(small_pairs["star"], 20, H)
    a = _by_id(kinematics(rows, method="three_pass"))
    b = _by_id(kinematics(rows, method="two_pass"))
    assert set(a) == set(b)
    for sid in a:
        for m in MEASURES:
            assert _close(a[sid][m], b[sid][m], rel=1e-8, abs_=1e-7)


def test_invariants(small_pairs):
    res = _by_id(aperture_kinematics(small_pairs["star"], 30, "star", with_unit_j=True))
    M = _by_id(small_pairs["star"].filter(F.col("sq_dist_subhalo2ptl") <= (30 * H) ** 2)
               .groupBy("subhalo_id").agg(F.sum(F.col("mass").cast("double")).alias("M")))
    for sid, r in res.items():
        # K_tot = 1/2 M sigma^2
        assert _close(r[MEASURES[0]], 0.5 * M[sid]["M"] * r[MEASURES[4]], rel=1e-9)
        # |u - V phi|^2 = u_r^2 + (u_phi - V)^2 + u_theta^2 on every valid row
        assert _close(r[MEASURES[11]], r[MEASURES[12]] + r[MEASURES[13]] + r[MEASURES[14]], rel=1e-7, abs_=1e-6)
        assert _close(r["unitJ_x"] ** 2 + r["unitJ_y"] ** 2 + r["unitJ_z"] ** 2, 1.0, rel=1e-12)


def test_degenerate_groups(spark):
    # group 1: a single particle (J = 0 -> dropped); group 2: centre particle plus two
    # orbiting ones (r = 0 must not raise under ANSI); group 3: NULL mass row ignored
    cols = "subhalo_id int, rel_px double, rel_py double, rel_pz double, sq_dist_subhalo2ptl double, " \
           "vx float, vy float, vz float, mass float"
    rows = spark.createDataFrame([
        (1, 1.0, 0.0, 0.0, 1.0, 10.0, 0.0, 0.0, 1.0),
        (2, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0),
        (2, 1.0, 0.0, 0.0, 1.0, 0.0, 5.0, 0.0, 1.0),
        (2, -1.0, 0.0, 0.0, 1.0, 0.0, -5.0, 0.0, 1.0),
        (3, 1.0, 0.0, 0.0, 1.0, 0.0, 5.0, 0.0, 1.0),
        (3, -1.0, 0.0, 0.0, 1.0, 0.0, -5.0, 0.0, 1.0),
        (3, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, None),
    ], cols)
    res = _by_id(kinematics(rows))
    assert set(res) == {2, 3}
    # pure rotation at speed 5 about z; V = sum(mV_rot) / M with M over all rows
    # (group 2 includes the centre particle, group 3 skips the NULL mass)
    assert _close(res[2][MEASURES[6]], 10.0 / 3.0, rel=1e-12)
    assert _close(res[3][MEASURES[6]], 5.0, rel=1e-12)
    assert _close(res[2][MEASURES[9]], 25.0, rel=1e-12)
    assert _close(res[2][MEASURES[10]], 25.0 / 9.0, rel=1e-12)
    assert _close(res[3][MEASURES[10]], 0.0, abs_=1e-12)
    for sid in (2, 3):
        assert _close(res[sid][MEASURES[7]], 0.0, abs_=1e-12)  # no radial motion


def test_velocity_moments_keep_all_groups(spark):
    cols = "subhalo_id int, rel_px double, rel_py double, rel_pz double, sq_dist_subhalo2ptl double, " \
           "vx float, vy float, vz float, mass float"
    rows = spark.createDataFrame([(1, 1.0, 0.0, 0.0, 1.0, 10.0, 0.0, 0.0, 1.0),
                                  (2, 1.0, 0.0, 0.0, 1.0, 2.0, 0.0, 0.0, 1.0),
                                  (2, 2.0, 0.0, 0.0, 4.0, 4.0, 0.0, 0.0, 3.0)], cols)
    res = _by_id(velocity_moments(rows))
    assert set(res) == {1, 2}
    assert res[1][MEASURES[0]] == 0.0
    # vbar = 3.5; K = 1/2 (1*2.25 + 3*0.25) = 1.5; sigma2_x = 3/4
    assert _close(res[2][MEASURES[0]], 1.5) and _close(res[2][MEASURES[1]], 0.75)


def test_plan_has_no_window(small_pairs):
    res = aperture_kinematics(small_pairs["star"], 10, "star")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan


def test_salted_shuffle_path_with_hot_group(spark, small_pairs):
    # make one subhalo hold about a third of all rows, then force the
    # statistics join-back beyond the broadcast bound (salted shuffle)
    base = fixed_aperture(small_pairs["star"], 30, H)
    n = base.count()
    hot = base.filter(F.col("subhalo_id") != 0).limit(n // 2).withColumn("subhalo_id", F.lit(0))
    rows = base.unionByName(hot)
    assert rows.filter("subhalo_id = 0").count() * 3 >= rows.count() * 0.9
    a = _by_id(kinematics(rows))
    b = _by_id(kinematics(rows, broadcast_max_rows=0, salt_buckets=7))
    plan = kinematics(rows, broadcast_max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert set(a) == set(b)
    for sid in a:
        for m in MEASURES:
            assert _close(a[sid][m], b[sid][m], rel=1e-9, abs_=1e-9)


def test_range_chunked_join_back(small_pairs):
    # statistics beyond a (forced) tiny broadcast bound: joined back per subhalo-id range
    rows = fixed_aperture(small_pairs["star"], 30, H)
    a = _by_id(kinematics(rows))
    res = kinematics(rows, broadcast_max_rows=3)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "_salt" not in plan
    b = _by_id(res)
    assert set(a) == set(b)
    for sid in a:
        for m in MEASURES:
            assert _close(a[sid][m], b[sid][m], rel=1e-9, abs_=1e-9)


def test_noise_angular_momentum(spark):
    # group 1: two particles at one position -> J = x cross (sum m u) = 0, computed
    # only as rounding noise. By default only J = 0 or NULL drops a group; with a tolerance
    # the group stays too, and its rotation measures are NULL. Both methods agree.
    cols = "subhalo_id int, rel_px double, rel_py double, rel_pz double, sq_dist_subhalo2ptl double, " \
           "vx float, vy float, vz float, mass float"
    x = (0.37, -1.3, 0.71)
    d2 = sum(c * c for c in x)
    rows = spark.createDataFrame([
        (1, *x, d2, 1.7, 0.3, 2.9, 0.1),
        (1, *x, d2, -0.7, 1.1, 0.13, 0.3),
        (2, 1.0, 0.0, 0.0, 1.0, 0.0, 5.0, 0.0, 1.0),
        (2, -1.0, 0.0, 0.0, 1.0, 0.0, -5.0, 0.0, 1.0),
    ], cols)
    for method in ("three_pass", "two_pass"):
        assert 2 in _by_id(kinematics(rows, method=method))
        got = _by_id(kinematics(rows, method=method, j_tolerance=1e-8))
        assert set(got) == {1, 2}
        assert got[1][MEASURES[0]] > 0 and got[1][MEASURES[4]] > 0
        assert all(got[1][m] is None for m in MEASURES[5:]) and all(got[2][m] is not None for m in MEASURES)


def test_no_variance_is_negative(spark):
    """Cold discs: all of the motion is rotation, and what is left is rounding."""
    import math
    import random

    rng = random.Random(7)
    rows = []
    for g in range(40):
        n = [rng.gauss(0, 1) for _ in range(3)]
        size = math.sqrt(sum(c * c for c in n))
        n = [c / size for c in n]
        a = [n[1], -n[0], 0.0]
        size = math.sqrt(sum(c * c for c in a))
        a = [c / size for c in a]
        b = [n[1] * a[2] - n[2] * a[1], n[2] * a[0] - n[0] * a[2], n[0] * a[1] - n[1] * a[0]]
        for k in range(60):
            t, r = 2 * math.pi * k / 60, rng.choice([1.0, 3.0, 7.5])
            c, s = math.cos(t), math.sin(t)
            x = [r * (c * a[i] + s * b[i]) for i in range(3)]
            v = [300 * (-s * a[i] + c * b[i]) for i in range(3)]
            rows.append((g, *x, sum(q * q for q in x), *v, 1.0))
    df = spark.createDataFrame(rows, "subhalo_id int, rel_px double, rel_py double, rel_pz double, sq_dist_subhalo2ptl double, "
                                     "vx double, vy double, vz double, mass double")
    for method in ("three_pass", "two_pass"):
        got = _by_id(kinematics(df, method=method))
        assert len(got) == 40
        for r in got.values():
            assert all(0 <= r[m] < 1e-6 for m in MEASURES[10:15]), [r[m] for m in MEASURES[10:15]]


def test_scan_prunes_columns_and_pushes_aperture(small_pairs):
    res = aperture_kinematics(small_pairs["star"], 10, "star")
    plan = res._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "rel_px" in line]
    assert scans
    for line in scans:
        schema = line.split("ReadSchema: struct<")[1].split(">")[0]
        fields = {f.split(":")[0] for f in schema.split(",")}
        # only the columns the measures need: no positions, cells, ids or catalogue columns
        assert fields <= {"subhalo_id", "rel_px", "rel_py", "rel_pz", "sq_dist_subhalo2ptl",
                          "vx", "vy", "vz", "mass"}, fields
        assert "LessThanOrEqual(sq_dist_subhalo2ptl" in line
