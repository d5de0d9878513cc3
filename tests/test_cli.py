"""The command-line jobs end to end on raw files derived from the driver tables."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from halokin.__main__ import run
from halokin.plans import jobs
from halokin.session import scratch_path
from halokin.sources import fixtures as fx
from halokin.sources import ingest


def test_ingest_join_kinematics_pipeline(spark):
    raw = {sp: scratch_path(spark, f"cli-raw-{sp}") for sp in ("star", "dm")}
    slab = F.pmod(F.floor(F.col("px") / F.lit(20500.0)), F.lit(10)).cast("int")
    for sp, path in raw.items():
        ingest.write_pandas_style_csv(fx.particles(spark, SF_SMALL, sp), path, sp, cell_key=slab)
    txt = ingest.write_subhalo_text(fx.subhalo_catalog(spark, SF_SMALL), scratch_path(spark, "cli-txt"))
    out = {k: scratch_path(spark, f"cli-{k}") for k in ("star", "dm", "subs", "pstar", "pdm", "res")}

    assert run(["ingest", "--species", "star", "--csv", raw["star"] + "/*/*.csv", "--out", out["star"]],
               spark)["rows"] == 6000
    batched = run(["ingest", "--species", "dm", "--csv", raw["dm"], "--out", out["dm"],
                   "--files-per-batch", "4"], spark)
    assert batched["failed"] == 0 and batched["batches"] >= 2
    assert run(["catalog", "--txt", txt, "--out", out["subs"], "--cut"], spark)["subhalos"] == 10
    assert run(["join", "--particles", out["star"], "--subhalos", out["subs"], "--out", out["pstar"]],
               spark)["pairs"] == 5864
    assert run(["join", "--particles", out["dm"], "--subhalos", out["subs"], "--out", out["pdm"]],
               spark)["pairs"] == 5837
    res = run(["kinematics", "--star", out["pstar"], "--dm", out["pdm"], "--out", out["res"],
               "--fixed", "5,30", "--scales", "2"], spark)
    tidy = spark.read.parquet(res["kinematics"])
    expect = jobs.full_sweep(jobs.pair_tables(spark, SF_SMALL), (5, 30), (2,))
    assert res["groups"] == expect.count() > 0
    keys = ["species", "aperture", "subhalo_id"]
    diff = tidy.select(*keys, "total_kinetic_energy").join(
        expect.select(*keys, F.col("total_kinetic_energy").alias("ref")), keys)
    assert diff.filter(F.abs(F.col("total_kinetic_energy") - F.col("ref")) > 1e-9 * F.abs(F.col("ref"))).count() == 0
    assert diff.count() == res["groups"]
    assert glob.glob(res["3d"].replace("file:", "") + "/species=star/aperture=30/*.csv")
