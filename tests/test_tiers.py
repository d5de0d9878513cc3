"""Batches committed by a manifest, header discovery, join tiers by size, and the sweep's shell sums."""

from __future__ import annotations

import io
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from halokin.functions.twofloat import at_place, halves, project, two_difference, two_product, two_sum
from halokin.operators.joinback import attach, group_totals, hot_groups
from halokin.operators.kinematics import D2, kinematics
from halokin.operators.neighbors import neighbour_join, plan_chunks, subhalo_registrations
from halokin.operators.sweep import fixed_apertures, scaled_apertures, shell_axis, sweep
from halokin.plans import jobs
from halokin.schemas import MEASURES
from halokin.session import materialize, scratch_path
from halokin.sources import fixtures as fx
from halokin.sources import ingest
from halokin.streaming import batched_ingest as B
from test_jobs import HEADER, ids, local, write


# ------------------------------------------------------------------ manifest

class Lost(RuntimeError):
    pass


def test_a_lost_job_leaves_no_rows_behind(spark, tmp_path):
    """20 rows in 5 files. Lost before the commit: of a whole batch, of a split batch, of the retry, and after a commit."""
    lines = lambda k: HEADER + "\n" + "".join(f"{k},{n},3,4,5,6,{10 * k + n}\n" for n in range(4))
    raw = write(str(tmp_path / "raw"), **{f"f{k}": lines(k) for k in range(4)}, f4="px,py\n1,2\n")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run(lose=lambda batch_id: None):
        return B.ingest_in_batches(spark, raw, out, "dm", files_per_batch=100, checkpoint=ckpt, before_commit=lose)

    def lose(batch_id):
        raise Lost(f"batch {batch_id}")

    for _ in range(2):  # all folders of the split batch are written, and then the driver goes
        with pytest.raises(Exception, match="batch 0"):
            run(lose)
        assert B.read_batches(spark, out).count() == 0 and B.batch_status(spark, out).count() == 0
    first = run().collect()
    assert sum(len(r["files"]) for r in first if r["status"] == "ok") == 4 and B.read_batches(spark, out).count() == 16
    write(raw, f4=lines(4))
    with pytest.raises(Lost):  # the retry
        run(lose)
    assert B.read_batches(spark, out).count() == 16 and B.failed_files(spark, out).count() == 1
    assert [r["status"] for r in run().collect()] == ["ok"]
    want = sorted(10 * k + n for k in range(5) for n in range(4))
    assert [i for i, _, _ in ids(B.read_batches(spark, out))] == want
    # the stream's own checkpoint is lost: everything is offered again, and nothing is written twice
    again = B.ingest_in_batches(spark, raw, out, "dm", files_per_batch=2, checkpoint=str(tmp_path / "other"))
    assert again.count() == 0 and B.read_batches(spark, out).count() == 20
    # what the lost runs left is there, pruned by the readers, and can be removed
    folders = lambda: {f for f in os.listdir(out) if f.startswith("batch=")}
    held = {f"batch={r['claim']}" for r in B.batch_status(spark, out).where("status = 'ok'").collect()}
    assert spark.read.parquet(out).count() > 20 and held < folders()
    plan = B.read_batches(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert set(B.remove_orphans(spark, out)) and folders() == held and B.remove_orphans(spark, out) == []
    assert B.read_snapshot(spark, out).count() == 20 and B.read_batches(spark, out).count() == 20


def test_snapshots_without_a_manifest_are_read_whole(spark, tmp_path):
    fx.dm_particles(spark, SF_SMALL).write.parquet(str(tmp_path / "a/b"))
    assert B.read_snapshot(spark, str(tmp_path)).count() == fx.dm_particles(spark, SF_SMALL).count()


# ------------------------------------------------------------------ headers

def _bytes_read(spark) -> int:
    every = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(every.get(i).getBytesRead() for i in range(every.size()))


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_first_lines_take_one_block():
    for text, want, most in ((f"{HEADER}\n" + "1,2\n" * 10**6, HEADER, ingest.HEADER_BYTES), ("a,b\r\n1", "a,b", 10), ("", None, 0), ("x", "x", 1), ("\n1", "", 2),
                             ("é" * 10**5 + "\n" + "1" * 10**6, "é" * 10**5, 7 * ingest.HEADER_BYTES)):
        stream = Counting(text.encode())
        assert ingest.first_line(stream) == want and stream.taken <= most


def test_files_are_read_once(spark, tmp_path):
    """Spark reads no byte for the headers, and each file once for the rows; tasks read a block of each for its header."""
    rows = "".join(f"{k % 977}.5,{k % 89},3,4,5,6,{k}\n" for k in range(100_000))
    raw = write(str(tmp_path / "raw"), **{f"f {k}": f"{HEADER}\n{rows}" for k in range(6)})
    size = sum(os.path.getsize(os.path.join(raw, f)) for f in os.listdir(raw))
    before = _bytes_read(spark)
    assert [tuple(r) for r in ingest.file_headers(spark, raw).groupBy("header").count().collect()] == [(HEADER, 6)]
    assert _bytes_read(spark) - before < 100_000  # the written table
    before = _bytes_read(spark)
    df = ingest.read_particle_csv(spark, raw, "dm")
    df.write.format("noop").mode("overwrite").save()
    assert size <= _bytes_read(spark) - before <= 1.05 * size
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_headers_in_a_store_that_only_spark_reads(spark, tmp_path):
    raw = write(str(tmp_path / "raw"), a=f"{HEADER}\n1,2,3,4,5,6,7\n", b="ID,vz,vy,vx,pz,py,px\n10,6,5,4,3,2,1\n")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.own.link./in", f"file://{raw}")
    for mode in ("PERMISSIVE", "FAILFAST"):
        assert ids(ingest.read_particle_csv(spark, "viewfs://own/in", "dm", mode=mode)) == [(7, 1.0, 6.0), (10, 1.0, 6.0)]


def test_several_layouts_are_one_scan_in_both_modes(spark, tmp_path):
    raw = write(str(tmp_path / "raw"), a=f"{HEADER}\n1,2,3,4,5,6,7\n\n1,2,3,4,5,6,9\n", b=f"note,{HEADER}\n\"x,y\",1,2,3,4,5,6,8\n", c="", d=f"{HEADER}\n")
    for mode in ("PERMISSIVE", "FAILFAST"):
        df = ingest.read_particle_csv(spark, raw, "dm", mode=mode)
        assert ids(df) == [(7, 1.0, 6.0), (8, 1.0, 6.0), (9, 1.0, 6.0)]
        assert df._jdf.queryExecution().optimizedPlan().toString().count("] text") == 1
    write(raw, e=f"{HEADER}\n1,2,3,4,5,6,z\n", f=f"{HEADER},more\n1,2,3\n")
    assert sorted(r["ID"] or "" for r in ingest.read_rejects(spark, raw, "dm").collect()) == ["z"]
    assert ingest.read_particle_csv(spark, raw, "dm").count() == 5
    with pytest.raises(Exception):
        ingest.read_particle_csv(spark, raw, "dm", mode="FAILFAST").collect()
    write(raw, g="px,py\n1,2\n")
    with pytest.raises(ValueError, match="no column .* in the header of 1 files, the first is .*g.csv"):
        ingest.read_particle_csv(spark, raw, "dm")
    assert ingest.read_particle_csv(spark, write(str(tmp_path / "none"), a=""), "dm").count() == 0


# ------------------------------------------------------------------ tiers

def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_any_number_of_chunks_without_a_particle_shuffle(spark):
    snap, subs = jobs.snapshot_particles(spark, SF_SMALL, "star", 8), fx.subhalo_catalog(spark, SF_SMALL)
    want = neighbour_join(snap, subs, strategy="broadcast")
    regs = subhalo_registrations(subs, 50 * 0.6774)
    limit = max(r["count"] for r in regs.groupBy("cx").count().collect())
    chunks, full = plan_chunks(regs, limit)
    assert len(chunks) > 10 and not full
    got = neighbour_join(snap, subs, broadcast_max_rows=limit, max_chunks=5)
    assert got.columns == want.columns and same(got, want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # the waves are written
    lazy = neighbour_join(snap, subs, broadcast_max_rows=limit, max_chunks=1000)
    assert "Exchange hashpartitioning" not in lazy._jdf.queryExecution().executedPlan().toString()
    assert same(neighbour_join(snap, subs, broadcast_max_rows=limit, max_chunks=5, clustered=False), want)


def test_full_slabs_are_cut_or_shuffled(spark):
    """All subhalos in two x-slabs: the slabs are cut into parts; at a still lower limit only their particles are shuffled."""
    subs = fx.subhalo_catalog(spark, SF_SMALL)
    near = subs.withColumn("px", (F.col("px") * F.lit(0.0) + F.when(F.col("sub_id") % 3 == 0, 1000.0).otherwise(5000.0)).cast("float"))
    parts = fx.star_particles(spark, SF_SMALL).withColumn("px", (F.col("px") % 20.0 + F.when(F.col("id") % 2 == 0, 990.0).otherwise(4990.0)).cast("float"))
    want = neighbour_join(parts, near, strategy="broadcast")
    assert want.count() > 0
    regs = subhalo_registrations(near, 50 * 0.6774)
    n = max(r["count"] for r in regs.groupBy("cx").count().collect())
    cut, full = plan_chunks(regs, n // 2 + 5)
    assert any(c.parts > 1 for c in cut) and not full
    assert same(neighbour_join(parts, near, strategy="chunked", broadcast_max_rows=n // 2 + 5), want)
    chunks, full = plan_chunks(regs, n // 6)
    assert full
    assert same(neighbour_join(parts, near, strategy="chunked", broadcast_max_rows=n // 6), want)


def test_only_large_groups_are_salted_by_their_size(spark):
    """A group with a third of all rows: no partition of the join has over twice the median's rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(240_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2003).cast("int").alias("subhalo_id"), F.col("id").alias("x"))
        stats = rows.groupBy("subhalo_id").agg(F.sum("x").alias("total"), F.count("x").alias("_n"))
        stats = materialize(stats, "t-stats")
        hot = hot_groups(stats.select("subhalo_id", F.col("_n").alias("n")), ["subhalo_id"]).collect()
        assert {r["subhalo_id"] for r in hot} == {0} and hot[0]["_salts"] >= 16 * 8 // 3
        for count in ("_n", None):
            out = attach(rows, stats if count else stats.drop("_n"), ["subhalo_id"], broadcast_max_rows=0, count_col=count)
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
            assert sum(sizes) == 240_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
        totals = group_totals(rows, ["subhalo_id"], {"total": F.sum("x")}, broadcast_max_rows=0)
        assert totals.columns == ["subhalo_id", "x", "total"]
        assert same(totals, rows.join(stats.drop("_n"), "subhalo_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ shells

def test_two_float_columns_are_exact(spark):
    from fractions import Fraction as Q

    rng = random.Random(1)
    rows = [(rng.uniform(-1, 1) * 2.0 ** rng.randint(-40, 40), rng.uniform(-1, 1) * 2.0 ** rng.randint(-40, 40)) for _ in range(200)] + [(0.0, 1.0), (3.0, -3.0)]
    names = dict(zip("stdepquwl", (*two_sum("a", "b"), *two_difference("a", "b"), *two_product("a", "b"), *at_place("a", "(abs(b) + 1D)"), halves("a")[0])))
    df = project(spark.createDataFrame(rows, "a double, b double"), names, ["a", "b"])
    for r in df.collect():
        x, y = Q(r["a"]), Q(r["b"])
        assert Q(r["s"]) + Q(r["t"]) == x + y and Q(r["d"]) + Q(r["e"]) == x - y and Q(r["p"]) + Q(r["q"]) == x * y and Q(r["u"]) + Q(r["w"]) == x
        assert int(math.frexp(r["l"])[0] * 2**53) % 2**26 == 0  # 26 bits and a sign


def test_shell_sums_need_no_generate_and_one_scan_for_each_species(spark, small_pairs):
    aps = fixed_apertures((5, 20)) + scaled_apertures((1, 2))
    plan = shell_axis(small_pairs, aps, 0.7)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Generate")
    assert len(below) == 2 and "Aggregate" in below[1] and below[1].count("Relation") == len(small_pairs) and "Relation" not in below[0]


def test_angular_momentum_of_shells_keeps_what_cancels(spark):
    """J is 1e-9 of the terms that cancel in its sums: particles far from rest, nearly in pairs; against exact fractions."""
    from fractions import Fraction as Q

    rng, rows = random.Random(5), []
    for _ in range(400):
        x, v = [rng.randint(-2**20, 2**20) / 2**16 for _ in range(3)], [rng.randint(-2**20, 2**20) / 2**20 for _ in range(3)]
        m = rng.randint(1, 2**10) / 2**12
        for s in (1, -1):
            rows.append((7, 20.0, *[s * c for c in x], sum(c * c for c in x), *[3000.0 + c for c in v], m))
    rows.append((7, 20.0, 1.0, 2.0, 3.0, 14.0, 3000.0, 3000.0, 3000.5, 0.25))
    schema = f"subhalo_id int, StarHalfRad float, rel_px double, rel_py double, rel_pz double, {D2} double, vx double, vy double, vz double, mass double"
    pairs = spark.createDataFrame(rows, schema).repartition(4)
    near = [r for r in rows if math.sqrt(r[5]) <= 10]
    total = sum(Q(r[9]) for r in near)
    vbar = [Q(float(sum(Q(r[9]) * Q(r[6 + k]) for r in near) / total)) for k in range(3)]
    J = [0, 0, 0]
    for r in near:
        u = [Q(r[6 + k]) - vbar[k] for k in range(3)]
        for k in range(3):
            i, j = (k + 1) % 3, (k + 2) % 3
            J[k] += Q(r[9]) * (Q(r[2 + i]) * u[j] - Q(r[2 + j]) * u[i])
    got = shell_axis({"star": pairs}, fixed_apertures((10, 40)), 1.0).where("aperture_id = 0").first()
    assert got["_n"] == len(near) and float(total) == got["_M"]
    size = sum(abs(float(c)) for c in J)
    for k in range(3):
        assert got[f"_J{k}"] == pytest.approx(float(J[k]), rel=1e-7, abs=1e-9 * size)


def test_shells_treat_missing_velocities_as_the_single_runs_do(spark, small_pairs):
    """A NULL velocity component leaves out the terms that need it, and no others."""
    rows = small_pairs["star"].withColumn("vy", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("vy")))
    rows = rows.withColumn("mass", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("mass")))
    single = {r["subhalo_id"]: r for r in kinematics(rows.where(F.col(D2) <= 14.0 * 14.0)).collect()}
    many = {r["subhalo_id"]: r for r in sweep({"star": rows}, fixed_apertures((20,))).collect()}
    assert single and set(single) == set(many)
    for k, r in single.items():
        for m in MEASURES:
            assert many[k][m] == pytest.approx(r[m], rel=1e-8, abs=1e-9), (k, m)


# ------------------------------------------------------------------ resumed jobs, layout, sinks

def test_a_killed_catalog_job_goes_on_from_its_finished_passes(spark, tmp_path, monkeypatch):
    from halokin.operators import kinematics as K
    from halokin.session import tables_of

    resume, out = str(tmp_path / "resume"), str(tmp_path / "out")
    source = {sp: str(tmp_path / sp) for sp in ("star", "dm")}
    for sp, path in source.items():
        jobs.pair_table(spark, SF_SMALL, sp).write.parquet(path)
    pairs = lambda: {sp: spark.read.parquet(path) for sp, path in source.items()}
    opts = dict(fixed=(5, 20), scales=(1,))
    with monkeypatch.context() as m:
        m.setattr(K, "_final_sums", lambda *a: (_ for _ in ()).throw(Lost("killed")))
        with pytest.raises(Lost):
            jobs.catalog_job(pairs(), out, resume=resume, **opts)
    made = {t: os.path.getmtime(os.path.join(resume, t, "_SUCCESS")) for t in tables_of(spark, resume)}
    assert [t.split("-")[0] for t in made] == ["kin"]
    paths = jobs.catalog_job(pairs(), out, resume=resume, **opts)
    assert tables_of(spark, resume) > set(made) and all(os.path.getmtime(os.path.join(resume, t, "_SUCCESS")) == at for t, at in made.items())
    want = jobs.catalog_job(pairs(), str(tmp_path / "plain"), **opts)
    assert same(spark.read.parquet(paths["kinematics"]).select("species", "aperture", "subhalo_id"),
                spark.read.parquet(want["kinematics"]).select("species", "aperture", "subhalo_id"))
    # other apertures, or a source that has changed, have tables of their own
    before = tables_of(spark, resume)
    jobs.catalog_job(pairs(), out, resume=resume, fixed=(5, 10), scales=(1,))
    assert len(tables_of(spark, resume) - before) == 2
    before = tables_of(spark, resume)
    spark.read.parquet(source["star"]).limit(10).write.mode("append").parquet(source["star"])
    jobs.catalog_job(pairs(), out, resume=resume, **opts)
    assert len(tables_of(spark, resume) - before) == 2
    # a table whose write was not finished is made again
    os.remove(os.path.join(resume, next(iter(made)), "_SUCCESS"))
    before = tables_of(spark, resume)
    assert next(iter(made)) not in before


def test_a_region_reads_its_share_of_a_snapshot_along_a_curve(spark):
    from halokin.functions.grid import morton_key

    keys = spark.createDataFrame([(0.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (3.0, 5.0, 6.0), (-1.0, 8.0, 0.0)], "x double, y double, z double")
    got = [r[0] for r in keys.select(morton_key("x", "y", "z", 8.0, 3)).collect()]
    assert got == [0, 1, 2, 4, morton_of(3, 5, 6), morton_of(7, 0, 0)]
    p = spark.range(200_000).select(*[(F.rand(k) * 205000).cast("float").alias(c) for k, c in enumerate(("px", "py", "pz"))], F.col("id"))
    path = jobs.write_snapshot(p, scratch_path(spark, "t-morton"), layout="morton", file_bytes=6_000)
    stored = spark.read.parquet(path)
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(*[F.struct(F.min(c).alias("a"), F.max(c).alias("b")).alias(c) for c in ("px", "py", "pz")]).collect()
    assert len(spans) >= 512 and stored.count() == 200_000
    region = {"px": (30e3, 90e3), "py": (60e3, 120e3), "pz": (20e3, 100e3)}
    share = math.prod((b - a) / 205e3 for a, b in region.values())
    read = sum(all(s[c]["a"] <= b and s[c]["b"] >= a for c, (a, b) in region.items()) for s in spans)
    by_x = sum(s["px"]["a"] <= region["px"][1] and s["px"]["b"] >= region["px"][0] for s in spans)
    assert read <= 3 * share * len(spans) and 3 * read < by_x
    with pytest.raises(ValueError):
        jobs.write_snapshot(p, path, layout="other")


def morton_of(x, y, z, bits=3):
    return sum(((x >> k & 1) << 3 * k + 2) | ((y >> k & 1) << 3 * k + 1) | ((z >> k & 1) << 3 * k) for k in range(bits))


def test_the_number_of_files_follows_the_bytes(spark):
    p = fx.star_particles(spark, SF_SMALL)
    n = p.count()
    assert jobs.files_for(p, 10**9) == 1 and jobs.files_for(p, 1000) == math.ceil(n * 40 / 1000)


def test_enrichment_takes_the_side_tables_columns(spark):
    from halokin.operators.catalog import enrich

    pairs = spark.createDataFrame([(1, 5.0, "a"), (1, 5.0, "b"), (2, 6.0, "c"), (3, 7.0, "d")], "subhalo_id int, StarHalfRad double, x string")
    side = spark.createDataFrame([(1, 50.0, "q"), (2, None, "r")], "subhalo_id int, StarHalfRad double, note string")
    out = enrich(pairs, side)
    assert sorted(out.columns) == ["StarHalfRad", "note", "subhalo_id", "x"]
    assert sorted((r["x"], r["StarHalfRad"], r["note"]) for r in out.collect()) == [("a", 50.0, "q"), ("b", 50.0, "q"), ("c", None, "r")]
