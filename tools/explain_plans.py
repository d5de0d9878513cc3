"""Print the executed (AQE-final) physical plans of the headline jobs.

    python tools/explain_plans.py [--sf /root/testdata/sf0.01] [--mode formatted|simple]

Used to check that the neighbour join is a BroadcastHashJoin on the cell key
with the distance test in the join condition, that scans read only the needed
columns with pushed filters, and that the kinematics have no Window operator.
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="final", help="final (AQE executed plan), simple, formatted")
    args = ap.parse_args()

    from halokin.operators.apertures import aperture_kinematics
    from halokin.operators.neighbors import neighbour_join
    from halokin.plans import jobs
    from halokin.session import local_session
    from halokin.sources import fixtures as fx

    spark = local_session()
    snap = jobs.snapshot_particles(spark, args.sf, "star")
    pairs = jobs.pair_tables(spark, args.sf)
    subs = fx.subhalo_catalog(spark, args.sf)
    plans = {
        "neighbour join (star), broadcast tier": neighbour_join(snap, subs),
        "neighbour join (star), slab-chunked tier (bound forced to 1000 registrations)":
            neighbour_join(snap, subs, broadcast_max_rows=1000),
        "kinematics, 30 kpc (star), final pass": aperture_kinematics(pairs["star"], 30, "star"),
        "kinematics, 30 kpc, join-back by subhalo-id ranges (bound forced to 40 groups)":
            aperture_kinematics(pairs["star"], 30, "star", broadcast_max_rows=40),
        "catalogue sweep, final pass": jobs.full_sweep(pairs),
    }
    for name, df in plans.items():
        df.write.format("noop").mode("overwrite").save()  # run, so AQE has its final plan
        print(f"\n===== {name} =====")
        if args.mode == "final":
            print(df._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain(args.mode)


if __name__ == "__main__":
    main()
