"""What the driver holds at a time: broadcasts of one query, and the folders of one table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from halokin.operators import joinback, kinematics, neighbors
from halokin.operators.sweep import fixed_apertures, sweep
from halokin.plans import jobs
from halokin.schemas import MEASURES
from halokin.session import materialize, resumable, scratch_path, tables_of
from halokin.sources import fixtures as fx
from halokin.sources import sinks

from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pairs_are_written_by_the_registrations_a_query_may_broadcast(spark, monkeypatch):
    snap, subs = jobs.snapshot_particles(spark, SF_SMALL, "star", 8), fx.subhalo_catalog(spark, SF_SMALL)
    whole = neighbors.neighbour_join(snap, subs)
    monkeypatch.setattr(neighbors, "REGISTRATION_BYTES", 10_000)
    monkeypatch.setattr(neighbors, "QUERY_BYTES", 10_000)
    waves = neighbors.neighbour_waves(snap, subs)
    assert len(waves) > 2 and all(plan_of(w).count("Join Inner") == 1 for w in waves)
    assert same(neighbors.neighbour_join(snap, subs), whole)
    assert same(spark.read.parquet(jobs.write_pair_table(waves, scratch_path(spark, "t-waves"))), whole)


def test_full_slabs_are_a_wave_of_their_own(spark, monkeypatch):
    """No slab fits the bound of a single row, so there are no chunks and one shuffled wave; a null position has no pairs."""
    stars, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    none = subs.limit(1).withColumn("px", F.lit(None).cast("float"))
    whole = neighbors.neighbour_join(stars, subs)
    monkeypatch.setattr(neighbors, "QUERY_BYTES", 1)
    assert len(neighbors.neighbour_waves(stars, subs.unionByName(none), broadcast_max_rows=1)) >= 1
    assert same(neighbors.neighbour_join(stars, subs.unionByName(none), broadcast_max_rows=1), whole)
    assert same(neighbors.neighbour_join(stars, subs.unionByName(none), broadcast_max_rows=60), whole)


def test_sweep_joins_few_statistics_back_at_a_time(spark, small_pairs, monkeypatch):
    aps = fixed_apertures((5, 20))
    rows = lambda df: {(r["species"], r["aperture"], r["subhalo_id"]): r for r in df.collect()}
    a = rows(sweep(small_pairs, aps))
    monkeypatch.setattr(joinback, "BROADCAST_MAX_BYTES", 1200)
    made = []
    monkeypatch.setattr(kinematics, "materialize", lambda df, tag: made.append((tag, plan_of(df).count("Join Inner"))) or materialize(df, tag))
    b = rows(sweep(small_pairs, aps))
    sums = [joins for tag, joins in made if tag == "kin-sums"]
    assert len(sums) > 2 and max(sums) <= 2  # one for each species
    assert set(a) == set(b)
    for k in a:
        for m in MEASURES:
            assert b[k][m] == pytest.approx(a[k][m], rel=1e-9, abs=1e-9)


def test_waves_of_a_sweep_that_is_started_again_are_there(spark, small_pairs, monkeypatch):
    monkeypatch.setattr(joinback, "BROADCAST_MAX_BYTES", 1200)
    root = scratch_path(spark, "t-resume")
    with resumable(root):
        sweep(small_pairs, fixed_apertures((5, 20)))
        first = tables_of(spark, root)
        sweep(small_pairs, fixed_apertures((5, 20)))
    assert len([t for t in first if t.startswith("kin-sums")]) > 2 and tables_of(spark, root) == first


def test_one_table_has_no_more_broadcasts_than_the_driver_can_make(spark, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 100).cast("int").alias("subhalo_id"), "id")
    stats = materialize(rows.groupBy("subhalo_id").agg(F.sum("id").alias("total")), "t-stats")
    want = rows.join(stats, "subhalo_id")
    monkeypatch.setattr(joinback, "BROADCAST_MAX_BYTES", 20 * 40)
    few = joinback.attach(rows, stats, ["subhalo_id"])
    assert "Union" in plan_of(few) and same(few, want)
    monkeypatch.setattr(joinback, "QUERY_BYTES", 40 * 40)
    none = joinback.attach(rows, stats, ["subhalo_id"])
    assert "_salt" in plan_of(none) and same(none, want)
    waves = joinback.attach_in_waves(rows, stats, ["subhalo_id"])
    assert len(waves) > 4 and sum(w.count() for w in waves) == 3000


@pytest.mark.parametrize("ids", [range(-5, 60), [None, *range(40), 2**40]])
def test_many_folders_are_read_some_at_a_time(spark, monkeypatch, ids):
    rows = spark.createDataFrame([(i, float(k), "x") for i in ids for k in range(3)], "subhalo_id bigint, x double, s string")
    path = sinks.write_partitioned(rows, scratch_path(spark, "t-folders"))
    want = sinks.read_partitioned(spark, path)
    monkeypatch.setattr(sinks, "FOLDERS_AT_ONCE", 16)
    got = sinks.read_partitioned(spark, path)
    assert got.schema == want.schema and same(got, want) and got.count() == 3 * len(list(ids))
    assert len(got.inputFiles()) < len(want.inputFiles())


def test_folders_of_text_are_one_table(spark, monkeypatch):
    rows = spark.range(40).select(F.concat(F.lit("a"), F.col("id")).alias("subhalo_id"), F.col("id").alias("x"))
    path = sinks.write_partitioned(rows, scratch_path(spark, "t-text"))
    monkeypatch.setattr(sinks, "FOLDERS_AT_ONCE", 16)
    assert same(sinks.read_partitioned(spark, path).select(rows.columns), rows)
