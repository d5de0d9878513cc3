"""Neighbour join: specification example, brute force, periodic wrap, strategies, plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from halokin.constants import BOX_SIZE, GRID_CELLS
from halokin.functions import grid
from halokin.functions.vectors import min_image
from halokin.operators.neighbors import neighbour_join, rename_subhalos
from halokin.schemas import STAR_PARTICLES, SUBHALOS
from halokin.sources import fixtures as fx

R2 = (50 * 0.6774) ** 2


def _keyset(df):
    return sorted((r["id"], r["subhalo_id"]) for r in df.select("id", "subhalo_id").collect())


def theta_join(particles, subhalos):
    """The original formulation: adjacency predicate on unwrapped cells (nested loop)."""
    size = BOX_SIZE / GRID_CELLS
    p = particles.select("*", *[F.floor(F.col(f"p{a}") / size).cast("int").alias(f"i{a}") for a in "xyz"])
    s = rename_subhalos(subhalos)
    s = s.select("*", *[F.floor(F.col(f"subhalo_p{a}") / size).cast("int").alias(f"subhalo_i{a}") for a in "xyz"])
    cond = None
    for a in "xyz":
        c = grid.periodic_adjacent(F.col(f"i{a}"), F.col(f"subhalo_i{a}"))
        cond = c if cond is None else cond & c
    j = p.join(F.broadcast(s), cond)
    rel = [min_image(F.col(f"p{a}"), F.col(f"subhalo_p{a}"), BOX_SIZE).alias(f"rel_p{a}") for a in "xyz"]
    j = j.select("*", *rel)
    d2 = F.col("rel_px") * F.col("rel_px") + F.col("rel_py") * F.col("rel_py") + F.col("rel_pz") * F.col("rel_pz")
    return j.filter(d2 < R2)


def brute_force(particles, subhalos):
    """Every pair, exact periodic distance (small inputs only)."""
    s = rename_subhalos(subhalos)
    j = particles.crossJoin(s)
    rel = [min_image(F.col(f"p{a}"), F.col(f"subhalo_p{a}"), BOX_SIZE) for a in "xyz"]
    return j.filter(rel[0] * rel[0] + rel[1] * rel[1] + rel[2] * rel[2] < R2)


def test_specification_example(spark):
    # ptl1, ptl2 near sub1; ptl3 near sub2; ptl4 near both; result has 5 rows
    subs = spark.createDataFrame([(1000.0, 1000.0, 1000.0, 0.0, 0.0, 0.0, 1, 2.0),
                                  (1040.0, 1000.0, 1000.0, 0.0, 0.0, 0.0, 2, 3.0)], SUBHALOS)
    parts = spark.createDataFrame([
        (1000.0, 1010.0, 1000.0, 1.0, 0.0, 0.0, 1.0, 1, 0.5),
        (990.0, 1000.0, 1005.0, 0.0, 1.0, 0.0, 1.0, 2, 0.5),
        (1065.0, 1000.0, 1000.0, 0.0, 0.0, 1.0, 1.0, 3, 0.5),
        (1020.0, 1000.0, 1000.0, 1.0, 1.0, 0.0, 1.0, 4, 0.5),
    ], STAR_PARTICLES)
    got = _keyset(neighbour_join(parts, subs))
    assert got == [(1, 1), (2, 1), (3, 2), (4, 1), (4, 2)]


def test_equals_theta_and_brute_force(spark):
    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    ours = neighbour_join(parts, subs)
    assert ours.count() == 5864
    expect = _keyset(brute_force(parts, subs))
    assert _keyset(ours) == expect
    assert _keyset(theta_join(parts, subs)) == expect


def test_periodic_wrap_and_box_edge(spark):
    # a subhalo at x = 5 sees a particle at x = 204990 (distance 15 across the edge),
    # and a particle exactly at x = L (cell n, wraps to 0)
    subs = spark.createDataFrame([(5.0, 100.0, 100.0, 0.0, 0.0, 0.0, 7, 2.0)], SUBHALOS)
    parts = spark.createDataFrame([
        (204990.0, 100.0, 100.0, 0.0, 0.0, 0.0, 1.0, 1, 0.0),
        (205000.0, 100.0, 100.0, 0.0, 0.0, 0.0, 1.0, 2, 0.0),
        (102500.0, 100.0, 100.0, 0.0, 0.0, 0.0, 1.0, 3, 0.0),
    ], STAR_PARTICLES)
    rows = {r["id"]: r for r in neighbour_join(parts, subs).collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["rel_px"] == -15.0 and rows[2]["rel_px"] == -5.0
    assert rows[2]["ix"] == GRID_CELLS  # unwrapped cell kept as a data column


def test_strategies_agree(spark):
    parts, subs = fx.dm_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    b = neighbour_join(parts, subs, strategy="broadcast")
    s = neighbour_join(parts, subs, strategy="shuffle", salt_buckets=5)
    assert b.count() == s.count() == 5837
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0


def test_chunked_strategy_equals_broadcast(spark):
    # registrations split into x-slab chunks of at most 60 rows (forced small bound)
    from halokin.operators.neighbors import slab_chunks, subhalo_registrations

    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    regs = subhalo_registrations(subs, 50 * 0.6774)
    chunks = slab_chunks(regs, 60, 64)
    assert chunks is not None and len(chunks) > 2
    c = neighbour_join(parts, subs, broadcast_max_rows=60)
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert _keyset(c) == _keyset(neighbour_join(parts, subs, strategy="broadcast"))
    # a bound below the largest slab falls back to the salted shuffle, same result
    s = neighbour_join(parts, subs, broadcast_max_rows=1)
    assert _keyset(s) == _keyset(c)


def test_coarse_grid_is_still_exact(spark):
    # fewer, larger cells: the registration covers every overlapped cell, results unchanged
    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    coarse = neighbour_join(parts, subs, n_cells=1500)
    assert _keyset(coarse) == _keyset(neighbour_join(parts, subs))


def test_plan_is_broadcast_hash_join(spark):
    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    plan = neighbour_join(parts, subs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_translation_invariance(spark):
    # shifting particles and subhalos by the same vector modulo L (exact in float32
    # for these positions) moves pairs across the box edge but changes no pair
    from halokin.operators.apertures import aperture_kinematics

    shift = {"px": BOX_SIZE / 2, "py": BOX_SIZE / 4, "pz": 0.0}

    def moved(df):
        return df.withColumns({c: ((F.col(c).cast("double") + F.lit(s)) % F.lit(BOX_SIZE)).cast("float")
                               for c, s in shift.items()})

    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    a = neighbour_join(parts, subs)
    b = neighbour_join(moved(parts), moved(subs))
    assert _keyset(a) == _keyset(b)
    ka = {r["subhalo_id"]: r for r in aperture_kinematics(a, 20, "star").collect()}
    kb = {r["subhalo_id"]: r for r in aperture_kinematics(b, 20, "star").collect()}
    assert set(ka) == set(kb)
    for sid in ka:
        for m in ("total_kinetic_energy", "mass_weighted_rotation_velocity",
                  "mass_weighted_velocity_dispersion_phi_no_rotation"):
            assert abs(ka[sid][m] - kb[sid][m]) <= 1e-9 * max(1.0, abs(ka[sid][m]))
