"""Stage and task times of a registered query, from Spark's event log.

usage: python tools/stage_times.py [sf_dir] name

Runs the query once to warm up and once measured, with the event log written
to a fresh scratch folder, then prints per stage: tasks, median and max task
time, and max/median (a skew indicator).  No UI or server is used.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(folder: str):
    for f in sorted(glob.glob(os.path.join(folder, "**", "events*"), recursive=True) +
                    glob.glob(os.path.join(folder, "*"))):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb")).read()
        for line in raw.decode(errors="replace").splitlines():
            if line.startswith("{"):
                yield json.loads(line)


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    name = args[0]
    run_dir = tempfile.mkdtemp(prefix="run-")
    ev_dir = os.path.join(run_dir, "events")
    os.makedirs(ev_dir)
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").appName("proficio-profile")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from proficio.plans.registry import queries
    q = queries()[name]
    q(spark, sf).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("measured", "measured")
    t0 = time.perf_counter()
    q(spark, sf).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()

    measured_stages, names, tasks = set(), {}, {}
    for e in _events(ev_dir):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            if (e.get("Properties") or {}).get("spark.jobGroup.id") == "measured":
                measured_stages.update(e["Stage IDs"])
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            names[si["Stage ID"]] = si["Stage Name"].split(" at ")[0]
        elif ev == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    print(f"{name}: {wall:.2f} s wall, {len(measured_stages)} stages (log: {ev_dir})")
    print(f"{'stage':>6} {'tasks':>6} {'median ms':>10} {'max ms':>8} {'max/med':>8}  name")
    for sid in sorted(s for s in measured_stages if s in tasks):
        d = tasks[sid]
        med = statistics.median(d)
        print(f"{sid:>6} {len(d):>6} {med:>10.0f} {max(d):>8} {max(d) / max(med, 1):>8.1f}  "
              f"{names.get(sid, '')[:40]}")


if __name__ == "__main__":
    main()
