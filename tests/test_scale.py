"""What bounds a task and a batch: files by bytes, the broadcast of the join, the manifest of the batches."""

from __future__ import annotations

import os

from halokin.operators import neighbors
from halokin.plans import jobs
from halokin.session import scratch_path
from halokin.sources import fixtures as fx
from halokin.streaming import batched_ingest as B

from conftest import SF_SMALL


def test_snapshot_and_pair_files_follow_the_bytes(spark, monkeypatch):
    jobs.forget_tables()
    monkeypatch.setattr(jobs, "JOIN_FILE_BYTES", 10_000)
    snap = jobs.snapshot_particles(spark, SF_SMALL, "star")
    n = jobs.files_for(snap, 10_000)
    assert n > spark.sparkContext.defaultParallelism
    assert len(snap.inputFiles()) == n
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    path = jobs.write_pair_table(neighbors.neighbour_join(snap, fx.subhalo_catalog(spark, SF_SMALL)), scratch_path(spark, "t-pairs"))
    assert len(spark.read.parquet(path).inputFiles()) == n  # each sorted by a task of its own
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    jobs.forget_tables()


def test_registrations_of_many_bytes_go_in_chunks(spark, monkeypatch):
    stars, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    whole = neighbors.neighbour_join(stars, subs)
    monkeypatch.setattr(neighbors, "REGISTRATION_BYTES", 10_000)
    cut = neighbors.neighbour_join(stars, subs)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") > whole._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")
    assert cut.count() == whole.count() and cut.exceptAll(whole.select(cut.columns)).count() == 0


def test_manifest_rows_are_one_folder_and_need_no_python(spark, tmp_path):
    out = str(tmp_path)
    schema = B.T.StructType(B.STATUS_SCHEMA.fields[:-1])
    assert B._local(spark, [], schema).count() == 0
    for k in range(3):
        row = (k, "ok", 5, 0, f"claim{k}", [f"file:/x/{k}.csv"], None)
        assert "RDD" not in B._local(spark, [row], schema)._jdf.queryExecution().optimizedPlan().toString()
        B._append(spark, out, "commits", [row], schema)
    assert not [x for x in os.listdir(f"{out}/_manifest/commits") if os.path.isdir(f"{out}/_manifest/commits/{x}")]
    # a commit of an older job has a folder of its own
    old = B._local(spark, [(9, "failed", None, None, None, ["file:/x/9.csv"], "bad")], schema).withColumn("at", B.F.current_timestamp())
    old.write.parquet(f"{out}/_manifest/commits/older")
    assert sorted(r["file"] for r in B.committed_files(spark, out).collect()) == [f"file:/x/{k}.csv" for k in range(3)]
    assert [r["file"] for r in B.failed_files(spark, out).collect()] == ["file:/x/9.csv"]


def test_pair_sort_of_a_snapshot_file_is_bounded():
    """Particles of 32 bytes, two pairs for each of 450 bytes in the sorter: a few pages of a task's memory."""
    assert jobs.JOIN_FILE_BYTES // 32 * 2 * 450 < 200 * 2**20


def test_a_chunk_opens_its_own_files_only(spark):
    subs = fx.subhalo_catalog(spark, SF_SMALL)
    path = jobs.write_snapshot(fx.star_particles(spark, SF_SMALL), scratch_path(spark, "t-snap"), 16)
    snap = spark.read.parquet(path)
    files = neighbors.file_ranges(snap)
    assert len(files) == 16 and all(lo <= hi for _, lo, hi in files)
    whole = neighbors.neighbour_join(snap, subs)
    with jobs._a_task_for_each_file(spark):
        chunked = neighbors.neighbour_join(snap, subs, strategy="chunked", broadcast_max_rows=40)
        regs = neighbors.subhalo_registrations(subs, 50 * 0.6774)
        n_chunks = len(neighbors.plan_chunks(regs, 40)[0])
        assert n_chunks > 4
        assert chunked.rdd.getNumPartitions() < 16 * n_chunks / 2
    assert chunked.count() == whole.count() and chunked.exceptAll(whole.select(chunked.columns)).count() == 0


def test_files_with_odd_positions_are_read_by_every_chunk(spark):
    subs = fx.subhalo_catalog(spark, SF_SMALL)
    stars = fx.star_particles(spark, SF_SMALL)
    away = stars.limit(50).withColumn("px", (neighbors.F.col("px") + 205000).cast("float"))
    none = stars.limit(5).withColumn("px", neighbors.F.lit(None).cast("float"))
    nan = stars.limit(5).withColumn("px", neighbors.F.lit(float("nan")).cast("float"))
    path = scratch_path(spark, "t-odd")
    for part in (stars.where("px < 100000"), stars.where("px >= 100000"), away, none, nan):
        part.coalesce(1).write.mode("append").parquet(path)
    odd = spark.read.parquet(path)
    whole = neighbors.neighbour_join(odd, subs)
    chunked = neighbors.neighbour_join(odd, subs, strategy="chunked", broadcast_max_rows=40)
    assert chunked.count() == whole.count() and chunked.exceptAll(whole.select(chunked.columns)).count() == 0


def test_particles_that_are_no_table_have_no_files(spark):
    assert neighbors.file_ranges(spark.range(3).selectExpr("CAST(id AS float) px")) is None
