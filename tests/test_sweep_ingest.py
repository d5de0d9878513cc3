"""Aperture sweep vs single runs; ingest, batched ingest and sinks."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from halokin.operators.apertures import aperture_kinematics, column_kinematics
from halokin.operators.catalog import catalog_2d, catalog_3d
from halokin.operators.sweep import fixed_apertures, scaled_apertures, sweep
from halokin.schemas import MEASURES
from halokin.session import scratch_path
from halokin.sources import fixtures as fx
from halokin.sources import ingest, sinks
from halokin.streaming.batched_ingest import ingest_in_batches, read_batches


def _rows(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_sweep_equals_single_runs(small_pairs):
    res = sweep(small_pairs, fixed_apertures((3, 10)) + scaled_apertures((2,)))
    got = _rows(res, ["species", "aperture", "subhalo_id"])
    for sp in ("star", "dm"):
        singles = {"3": aperture_kinematics(small_pairs[sp], 3, sp),
                   "10": aperture_kinematics(small_pairs[sp], 10, sp),
                   "2Rh": column_kinematics(small_pairs[sp], "StarHalfRad", sp, scale=2)}
        for label, df in singles.items():
            ref = {k[0]: v for k, v in _rows(df, ["subhalo_id"]).items()}
            mine = {k[2]: v for k, v in got.items() if k[0] == sp and k[1] == label}
            assert set(mine) == set(ref), (sp, label)
            for sid, r in ref.items():
                for m in MEASURES:
                    assert mine[sid][m] == pytest.approx(r[m], rel=1e-9, abs=1e-9)
    assert res.filter("aperture_truncated").count() == 0  # all radii here < join radius


def test_catalog_columns(small_pairs):
    res = sweep(small_pairs, fixed_apertures((10,)))
    c3, c2 = catalog_3d(res), catalog_2d(res)
    assert c3.columns[:3] == ["species", "aperture", "subhalo_id"]
    assert {"sigma2", "Vrot", "Ktot", "Krot", "sigma2_noRot", "unitJ_x"} <= set(c3.columns)
    assert {"sigma2_r_noRot", "sigma2_phi_noRot", "sigma2_theta"} <= set(c2.columns)
    row = c2.first()
    assert row["sigma2_r_noRot"] == row["sigma2_r"]


def test_csv_roundtrip_by_name(spark):
    p = fx.star_particles(spark, SF_SMALL)
    path = scratch_path(spark, "t-csv")
    ingest.write_pandas_style_csv(p, path, "star", cell_key=F.pmod(F.col("id"), F.lit(4)))
    # reorder columns in a copy: the reader maps by header name, not position
    shuffled = scratch_path(spark, "t-csv-shuffled")
    spark.read.option("header", True).csv(path + "/*/*.csv").select(
        "ID", "mass", "vz", "vy", "vx", "pz", "py", "px", "Formation_time", F.lit("x").alias("extra")
    ).write.option("header", True).csv(shuffled)
    for src in (path + "/*/*.csv", shuffled):
        back = ingest.read_particle_csv(spark, src, "star")
        assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0


def test_csv_modes(spark):
    path = scratch_path(spark, "t-bad-csv")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "a.csv"), "w") as f:
        f.write("px,py,pz,vx,vy,vz,ID\n1,2,3,4,5,6,7\nx,2,3,4,5,6,8\n")
    ok = ingest.read_particle_csv(spark, path, "dm", mode="PERMISSIVE").orderBy("id").collect()
    assert ok[0]["px"] == 1.0 and ok[1]["px"] is None
    with pytest.raises(Exception):
        ingest.read_particle_csv(spark, path, "dm", mode="FAILFAST").collect()


def test_batched_ingest_keeps_remainder(spark):
    p = fx.dm_particles(spark, SF_SMALL)
    raw = scratch_path(spark, "t-raw")
    ingest.write_pandas_style_csv(p, raw, "dm", cell_key=F.pmod(F.col("id"), F.lit(7)))
    n_files = len(glob.glob(raw.replace("file:", "") + "/*/*.csv"))
    out = scratch_path(spark, "t-batches")
    status = ingest_in_batches(spark, raw, out, "dm", files_per_batch=3).collect()
    assert len(status) == -(-n_files // 3)  # ceil: the last, smaller batch is kept
    assert all(s["status"] == "ok" for s in status)
    back = read_batches(spark, out, "dm")
    assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0
    # a second run over the same checkpoint finds nothing new (resumable)
    ckpt = scratch_path(spark, "t-ckpt")
    out2 = scratch_path(spark, "t-batches2")
    ingest_in_batches(spark, raw, out2, "dm", files_per_batch=3, checkpoint=ckpt)
    again = ingest_in_batches(spark, raw, out2, "dm", files_per_batch=3, checkpoint=ckpt)
    assert again.count() == 0


def test_partitioned_sink(spark, small_pairs):
    path = sinks.write_partitioned(small_pairs["star"], scratch_path(spark, "t-part"), files_per_key=2)
    back = spark.read.parquet(path)
    assert back.count() == small_pairs["star"].count()
    one = back.filter(F.col("subhalo_id") == 3)
    assert "PartitionFilters: [isnotnull(subhalo_id" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == small_pairs["star"].filter("subhalo_id = 3").count()
    dirs = glob.glob(path.replace("file:", "") + "/subhalo_id=*")
    assert len(dirs) == small_pairs["star"].select("subhalo_id").distinct().count()


def test_sweep_join_back_in_subhalo_ranges(small_pairs):
    # per-group statistics beyond a forced tiny bound: the sweep (packed group key)
    # joins them back per subhalo-id range, with the range pushed into the pair scan
    aps = fixed_apertures((5, 20))
    a = _rows(sweep(small_pairs, aps), ["species", "aperture", "subhalo_id"])
    res = sweep(small_pairs, aps, broadcast_max_rows=12)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "_salt" not in plan
    b = _rows(res, ["species", "aperture", "subhalo_id"])
    assert set(a) == set(b)
    for k in a:
        for m in MEASURES:
            assert b[k][m] == pytest.approx(a[k][m], rel=1e-9, abs=1e-9)
