"""Measure task balance under a hot key, from Spark's event log.

    python tools/skew_probe.py [--sf /root/testdata/sf0.01]

Moves every third particle of the stored snapshot next to subhalo 0, so one
grid cell (and one subhalo) holds about a third of all rows, then reports for
each job the largest and the median task by records read:

* neighbour join, salted shuffle tier (salt 16) versus unsalted (salt 1);
* neighbour join, broadcast tier (no shuffle of particles at all);
* kinematics of the hot subhalo table (partial aggregation before the shuffle).

The event log goes to a fresh scratch folder; the Spark UI stays off.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def task_records(log_dir: str, group: str) -> list[dict]:
    """Per-stage records-read stats of the jobs tagged with ``group``."""
    jobs, stages, out = set(), {}, []
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == group:
                        jobs.add(ev["Job ID"])
                        for sid in ev.get("Stage IDs", []):
                            stages[sid] = []
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                            + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                    stages[ev["Stage ID"]].append(recs)
    for sid, recs in sorted(stages.items()):
        if len(recs) > 1 and max(recs) > 0:
            out.append({"stage": sid, "tasks": len(recs), "max": max(recs),
                        "median": statistics.median(recs), "total": sum(recs)})
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="halokin-eventlog-")

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")  # show the raw partitioning
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")  # only explicit broadcasts
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from halokin.operators.apertures import fixed_aperture
    from halokin.operators.kinematics import kinematics
    from halokin.operators.neighbors import neighbour_join
    from halokin.plans import jobs
    from halokin.sources import fixtures as fx

    subs = fx.subhalo_catalog(spark, args.sf)
    s0 = subs.filter("sub_id = 0").first()
    snap = jobs.snapshot_particles(spark, args.sf, "star", n_files=8)
    hot = snap.withColumns({
        c: F.when(F.col("id") % 3 == 0, F.lit(float(getattr(s0, c))) + (F.col("id") % 17) * 0.25 - 2.0)
            .otherwise(F.col(c)).cast("float") for c in ("px", "py", "pz")})
    sc = spark.sparkContext
    runs = {
        "join, salted shuffle (16)": lambda: neighbour_join(hot, subs, strategy="shuffle", salt_buckets=16),
        "join, unsalted shuffle (1)": lambda: neighbour_join(hot, subs, strategy="shuffle", salt_buckets=1),
        "join, broadcast": lambda: neighbour_join(hot, subs, strategy="broadcast"),
    }
    report = {}
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        n = build().count()
        report[name] = {"pairs": n}
    pairs = neighbour_join(hot, subs)
    rows = fixed_aperture(pairs, 30)
    sc.setJobGroup("kinematics, hot subhalo", "kinematics, hot subhalo")
    n_hot = rows.filter("subhalo_id = 0").count()
    n_all = rows.count()
    kinematics(rows).write.format("noop").mode("overwrite").save()
    report["kinematics, hot subhalo"] = {"rows": n_all, "rows_of_subhalo_0": n_hot}
    spark.stop()  # flush the event log
    for name in report:
        report[name]["stages"] = task_records(log_dir, name)
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
