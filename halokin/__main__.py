"""Command-line jobs over real snapshot files (run with spark-submit or python -m).

    python -m halokin ingest     --species dm --csv 'raw/dm_*.csv' --out snap/dm [--files-per-batch 1000]
    python -m halokin catalog    --txt catalogue.txt --out snap/subhalos [--cut]
    python -m halokin join       --particles snap/star --subhalos snap/subhalos --out pairs/star
    python -m halokin kinematics --star pairs/star --dm pairs/dm --out result [--fixed 1,3,5] [--scales 1,2]
    python -m halokin pairs      --particles snap/star --subhalos snap/subhalos --radii radii --out by_subhalo
    python -m halokin notebook   --star pairs/star --out result

``ingest --files-per-batch`` exits with 1 while files are failed; run it again once they are mended.

The session comes from the environment (``spark-submit`` settings, or a local
session when run directly); scratch tables go to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Observation, SparkSession

from .constants import FIXED_APERTURES, H_CATALOG, H_JOIN, HALF_RADIUS_SCALES, JOIN_RADIUS_KPC


def _floats(text: str) -> tuple[float, ...]:
    return tuple(float(t) for t in text.split(",") if t.strip()) if text else ()


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="halokin")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("ingest", help="particle CSV files -> typed Parquet")
    p.add_argument("--species", choices=("star", "dm"), required=True)
    p.add_argument("--csv", required=True, help="file, directory or glob")
    p.add_argument("--out", required=True)
    p.add_argument("--files-per-batch", type=int, default=0, help="resumable batches of N files")
    p.add_argument("--n-files", type=int, default=0, help="output files (one-shot ingest)")
    p.add_argument("--mode", default="PERMISSIVE", choices=("PERMISSIVE", "FAILFAST"))
    p = sub.add_parser("catalog", help="subhalo catalogue text -> typed Parquet")
    p.add_argument("--txt", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--cut", action="store_true", help="StarHalfRad * 2 * h > 0.1")
    p.add_argument("--h", type=float, default=H_CATALOG)
    p = sub.add_parser("join", help="periodic neighbour join -> pair table")
    p.add_argument("--particles", required=True)
    p.add_argument("--subhalos", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--radius", type=float, default=JOIN_RADIUS_KPC, help="kpc")
    p.add_argument("--h", type=float, default=H_JOIN)
    p = sub.add_parser("kinematics", help="aperture sweep -> tidy table + 3D/2D catalogues")
    p.add_argument("--star", default="")
    p.add_argument("--dm", default="")
    p.add_argument("--out", required=True)
    p.add_argument("--fixed", default=",".join(str(r) for r in FIXED_APERTURES))
    p.add_argument("--scales", default=",".join(str(s) for s in HALF_RADIUS_SCALES))
    p.add_argument("--resume", default="", help="shared folder for finished passes, read again by a job that is started again")
    p.add_argument("--h", type=float, default=H_CATALOG)
    p = sub.add_parser("pairs", help="the older pipeline: mass cut, join, radii, pairs partitioned by subhalo")
    p.add_argument("--particles", required=True)
    p.add_argument("--subhalos", required=True, help="catalogue with StarHalfMass")
    p.add_argument("--radii", required=True, help="Parquet of (subhalo_id, StarHalfRad)")
    p.add_argument("--out", required=True)
    p.add_argument("--h", type=float, default=H_JOIN)
    p.add_argument("--buckets", type=int, default=0, help="hash buckets instead of a directory per subhalo")
    p = sub.add_parser("notebook", help="the seven text exports of star kinematics")
    p.add_argument("--star", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--h", type=float, default=H_JOIN)
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"halokin-{args.job}").getOrCreate()
    from .operators.catalog import size_cut
    from .operators.neighbors import neighbour_join
    from .plans import jobs
    from .sources import ingest, sinks
    from .streaming.batched_ingest import ingest_in_batches, read_snapshot

    if args.job == "ingest":
        if args.files_per_batch:
            status = ingest_in_batches(spark, args.csv, args.out, args.species,
                                       files_per_batch=args.files_per_batch, mode=args.mode)
            rows = [r.asDict() for r in status.select("status", "rejected", "files").collect()]
            return {"batches": len(rows), "failed": sum(r["status"] != "ok" for r in rows),
                    "rejected": sum(r["rejected"] or 0 for r in rows),
                    "failed_files": [f for r in rows if r["status"] != "ok" for f in r["files"]]}
        seen = Observation()
        df = ingest.ingest_csv(spark, args.csv, args.out, args.species, mode=args.mode,
                               n_files=args.n_files or None, observation=seen)
        return {"rows": df.count(), "rejected": seen.get["rejected"], "out": args.out}
    if args.job == "catalog":
        cat = ingest.read_subhalo_text(spark, args.txt)
        if args.cut:
            cat = size_cut(cat, h=args.h)
        sinks.write_parquet(cat, args.out)
        return {"subhalos": spark.read.parquet(args.out).count(), "out": args.out}
    if args.job == "join":
        particles = read_snapshot(spark, args.particles)
        pairs = neighbour_join(particles, spark.read.parquet(args.subhalos), h=args.h, radius_kpc=args.radius)
        jobs.write_pair_table(pairs, args.out)
        return {"pairs": spark.read.parquet(args.out).count(), "out": args.out}
    if args.job == "pairs":
        particles = read_snapshot(spark, args.particles)
        jobs.partitioned_pairs_job(particles, spark.read.parquet(args.subhalos), spark.read.parquet(args.radii), args.out,
                                   h=args.h, buckets=args.buckets or None)
        return {"pairs": spark.read.parquet(args.out).count(), "out": args.out}
    if args.job == "notebook":
        return jobs.notebook_exports(spark.read.parquet(args.star), args.out, h=args.h)
    pairs = {sp: spark.read.parquet(path) for sp, path in (("star", args.star), ("dm", args.dm)) if path}
    if not pairs:
        ap.error("kinematics needs --star and/or --dm")
    paths = jobs.catalog_job(pairs, args.out, resume=args.resume or None, fixed=_floats(args.fixed), scales=_floats(args.scales),
                             h=args.h)
    return {"groups": spark.read.parquet(paths["kinematics"]).count(), **paths}


def main() -> None:
    result = run(sys.argv[1:])
    print(json.dumps(result))
    sys.exit(1 if result.get("failed") else 0)


if __name__ == "__main__":
    main()
