"""Ingest by header, recovery of failed files, scratch folders, stored tables, sinks and the remaining jobs."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from halokin import session
from halokin.__main__ import run
from halokin.constants import H_JOIN, join_radius
from halokin.operators.joinback import broadcastable_rows
from halokin.operators.neighbors import _hot_cells, neighbour_join, particle_cells, rename_subhalos, subhalo_registrations
from halokin.operators.sweep import fixed_apertures, shell_axis, sweep
from halokin.plans import jobs
from halokin.schemas import DM_PARTICLES
from halokin.session import scratch_path
from halokin.sources import fixtures as fx
from halokin.sources import ingest, sinks
from halokin.streaming.batched_ingest import batch_status, failed_files, ingest_in_batches, read_batches

HEADER = "px,py,pz,vx,vy,vz,ID"


def local(path: str) -> str:
    return path.replace("file:", "")


def write(folder: str, **files: str) -> str:
    os.makedirs(local(folder), exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(local(folder), name + ".csv"), "w") as f:
            f.write(text)
    return folder


def ids(df):
    return sorted((r["id"], r["px"], r["vz"]) for r in df.collect())


def test_each_file_maps_by_its_own_header(spark, tmp_path):
    raw = write(str(tmp_path / "raw"), a=f"{HEADER}\n1,2,3,4,5,6,7\n", b="ID,vz,vy,vx,pz,py,px\n10,6,5,4,3,2,1\n", c="px,note,py,pz,vx,vy,vz,ID\n9,x,2,3,4,5,6,8\n", d="")
    want = [(7, 1.0, 6.0), (8, 9.0, 6.0), (10, 1.0, 6.0)]
    for mode in ("PERMISSIVE", "FAILFAST"):
        assert ids(ingest.read_particle_csv(spark, raw, "dm", mode=mode)) == want
    out = str(tmp_path / "out")
    ingest_in_batches(spark, raw, out, "dm", files_per_batch=10)
    assert ids(read_batches(spark, out, "dm")) == want


def test_rejected_values_are_counted_and_listed(spark, tmp_path):
    raw = write(str(tmp_path / "raw"), a=f"{HEADER}\n1,2,3,4,5,6,7\nx,2,3,4,5,6,8\n,2,3,4,5,6,9\n")
    seen = Observation()
    assert ingest.read_particle_csv(spark, raw, "dm", observation=seen).count() == 3
    assert seen.get == {"rows": 3, "rejected": 1}
    bad = ingest.read_rejects(spark, raw, "dm").collect()
    assert [(r["ID"], r["px"], r["file"].endswith("a.csv")) for r in bad] == [("8", "x", True)]


def test_failfast_does_not_skip_lost_files(spark, tmp_path):
    for mode in ("PERMISSIVE", "FAILFAST"):
        raw = write(str(tmp_path / mode), a=f"{HEADER}\n1,2,3,4,5,6,7\n", b=f"{HEADER}\n1,2,3,4,5,6,8\n")
        df = ingest.read_particle_csv(spark, raw, "dm", mode=mode)
        os.remove(os.path.join(raw, "b.csv"))
        if mode == "PERMISSIVE":
            assert df.count() == 1
        else:
            with pytest.raises(Exception):
                df.collect()


def test_failed_files_are_recovered_by_the_next_run(spark, tmp_path):
    good = {f"f{k}": f"{HEADER}\n{k},2,3,4,5,6,{k}\n" for k in range(5)}
    raw = write(str(tmp_path / "raw"), **good, bad="px,py\n1,2\n")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    go = lambda: run(["ingest", "--species", "dm", "--csv", raw, "--out", out, "--files-per-batch", "100"], spark)
    assert read_batches(spark, out, "dm").schema == DM_PARTICLES and read_batches(spark, out, "dm").count() == 0
    first = ingest_in_batches(spark, raw, out, "dm", files_per_batch=100, checkpoint=ckpt).collect()
    assert sum(len(r["files"]) for r in first if r["status"] == "ok") == 5
    assert [os.path.basename(f) for r in first if r["status"] == "failed" for f in r["files"]] == ["bad.csv"]
    assert len(ids(read_batches(spark, out, "dm"))) == 5 and failed_files(spark, out).count() == 1
    again = ingest_in_batches(spark, raw, out, "dm", files_per_batch=100, checkpoint=ckpt).collect()
    assert [r["status"] for r in again] == ["failed"]
    write(raw, bad=f"{HEADER}\n9,2,3,4,5,6,9\n")
    third = ingest_in_batches(spark, raw, out, "dm", files_per_batch=100, checkpoint=ckpt).collect()
    assert [r["status"] for r in third] == ["ok"] and failed_files(spark, out).count() == 0
    assert [i for i, _, _ in ids(read_batches(spark, out, "dm"))] == [0, 1, 2, 3, 4, 9]
    assert batch_status(spark, out).count() > 3
    assert ingest_in_batches(spark, raw, out, "dm", files_per_batch=100, checkpoint=ckpt).count() == 0
    write(raw, bad="px,py\n1,2\n")
    out = str(tmp_path / "cli")
    result = go()
    assert result["failed"] == 1 and result["failed_files"][0].endswith("bad.csv")


def test_cluster_sessions_need_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_scratch_tables_can_be_removed():
    """In a session of its own, as the tables of this one are in use."""
    code = ("from halokin import session; s = session.local_session(1, 1, '1g'); t = session.materialize(s.range(3), 'x'); import os;"
            "p = t.inputFiles()[0].replace('file://', ''); assert os.path.exists(p); assert session.remove_scratch(s); assert not os.path.exists(p)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=200, capture_output=True)


def test_stored_tables_follow_their_source(spark, tmp_path):
    for t in ("supplier", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    before = jobs.snapshot_particles(spark, str(tmp_path), "star").count()
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(100).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert jobs.snapshot_particles(spark, str(tmp_path), "star").count() == before + 100


def test_a_chunk_reads_its_own_files_only(spark):
    """The stored snapshot is clustered by x: files hold disjoint px ranges, and chunks scan few of them."""
    snap = jobs.snapshot_particles(spark, SF_SMALL, "star", 8)
    spans = sorted((r.lo, r.hi) for r in snap.groupBy(F.input_file_name()).agg(F.min("px").alias("lo"), F.max("px").alias("hi")).collect())
    assert len(spans) > 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    lo, hi = spans[2]
    assert snap.where((F.col("px") >= lo) & (F.col("px") < hi)).select(F.input_file_name()).distinct().count() == 1
    subs = fx.subhalo_catalog(spark, SF_SMALL)
    n = subhalo_registrations(subs, join_radius(H_JOIN)).count()
    a = neighbour_join(snap, subs, strategy="chunked", broadcast_max_rows=n // 4)
    b = neighbour_join(snap, subs, strategy="broadcast")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert neighbour_join(snap, subs.limit(0), strategy="chunked").count() == 0


def test_only_hot_cells_are_salted(spark):
    parts, subs = fx.star_particles(spark, SF_SMALL), fx.subhalo_catalog(spark, SF_SMALL)
    want = neighbour_join(parts, subs, strategy="broadcast")
    for rows in (None, 3, 10**9):
        got = neighbour_join(parts, subs, strategy="shuffle", rows_per_task=rows)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    cells = particle_cells(parts)
    hot = _hot_cells(cells, ["cx", "cy", "cz"], 40).collect()
    sizes = [r["count"] for r in cells.groupBy("cx", "cy", "cz").count().collect()]
    assert sorted(r["_salts"] for r in hot) == sorted(-(-n // 40) for n in sizes if n > 40) and hot


def test_broadcast_is_bounded_by_bytes(spark):
    narrow, wide = spark.range(1), spark.range(1).select(*[F.lit("x").alias(f"c{k}") for k in range(50)])
    assert broadcastable_rows(narrow, 10) == 10
    assert broadcastable_rows(wide, 10**9) * 50 * 40 <= 256 * 2**20


def test_partitioned_sink_splits_a_hot_key(spark):
    """A third of all rows has one key: the rebalance writes it by more than four tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    rows = spark.range(0, 60000, 1, 12).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40 + 100).alias("subhalo_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    try:
        path = sinks.write_partitioned(rows, scratch_path(spark, "t-hot"))
        assert len(glob.glob(local(path) + "/subhalo_id=7/part-*")) > 4
        assert spark.read.parquet(path).count() == 60000
        path = sinks.write_partitioned(rows, scratch_path(spark, "t-buckets"), buckets=5)
        assert len(glob.glob(local(path) + "/bucket=*")) == 5 and spark.read.parquet(path).count() == 60000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sweep_first_pass_has_no_generate(spark, small_pairs):
    plan = shell_axis(small_pairs, fixed_apertures((3, 10)), 0.7)._jdf.queryExecution().optimizedPlan().toString()
    # the one explode works on the shells: below it is the aggregate over the rows, which are scanned once for each species
    below = plan.split("Generate")[1:]
    assert len(below) == 1 and below[0].count("Aggregate") == 1 and below[0].count("Relation") == len(small_pairs)


def test_sweep_takes_long_ids_and_many_apertures(small_pairs):
    pairs = {"star": small_pairs["star"].withColumn("subhalo_id", F.col("subhalo_id").cast("long") * 2**33 - 7)}
    res = sweep(pairs, fixed_apertures([1 + k / 2 for k in range(70)]))
    assert res.select("aperture").distinct().count() > 64
    assert {r[0] % 2**33 for r in res.select("subhalo_id").distinct().collect()} == {2**33 - 7}


def test_text_exports_are_sorted(spark, small_pairs):
    paths = jobs.notebook_exports(small_pairs["star"], scratch_path(spark, "t-notebook"))
    assert list(paths) == ["50", "30", "20", "10", "5", "3", "StarHalfRad"]
    for label, path in paths.items():
        got = []
        for f in sorted(glob.glob(local(path) + "/part-*")):
            head, *lines = open(f).read().splitlines()
            assert head.split(" ")[:2] == ["subhalo_id", f"total_kinetic_energy_{label}"]
            got += [int(x.split(" ")[0]) for x in lines]
        assert got == sorted(got) and got


def test_older_pipeline_by_command_line(spark):
    out = {k: scratch_path(spark, f"t-cli-{k}") for k in ("star", "subs", "radii", "pairs")}
    fx.star_particles(spark, SF_SMALL).write.parquet(out["star"])
    fx.subhalo_catalog(spark, SF_SMALL, with_half_mass=True).write.parquet(out["subs"])
    fx.radius_side_table(spark, SF_SMALL).withColumn("StarHalfRad", F.col("StarHalfRad") + 1).write.parquet(out["radii"])
    n = run(["pairs", "--particles", out["star"], "--subhalos", out["subs"], "--radii", out["radii"], "--out", out["pairs"], "--buckets", "3"], spark)["pairs"]
    back = spark.read.parquet(out["pairs"])
    heavy = rename_subhalos(fx.subhalo_catalog(spark, SF_SMALL, with_half_mass=True)).where(F.col("subhalo_StarHalfMass") / H_JOIN > 0.01)
    assert n == back.count() > 0 and back.select("subhalo_id").distinct().count() <= heavy.count()
    # the joined radius wins over the catalogue's
    assert back.join(fx.radius_side_table(spark, SF_SMALL).withColumnRenamed("StarHalfRad", "r"), "subhalo_id").where("StarHalfRad <> r + 1").count() == 0


def test_many_folders_are_listed_by_few_tasks(spark):
    rows = spark.range(90).select(F.col("id").cast("int").alias("subhalo_id"), F.lit(1.0).alias("x"))
    path = sinks.write_partitioned(rows, scratch_path(spark, "t-many"))
    sc, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    sc.setJobGroup("t-listing", "")
    try:
        back = sinks.read_partitioned(spark, path)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("t-listing") for s in tracker.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 4 * sc.defaultParallelism < 90
    assert spark.conf.get(key) == before
    assert sorted(r["subhalo_id"] for r in back.collect()) == list(range(90))
