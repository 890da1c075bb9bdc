"""Stage and job times of catalog queries from Spark's event log (no UI, no server).

    python tools/stage_times.py /root/testdata/sf0.1 strike_counts zonal_mean

The event log goes to a fresh scratch folder; each query runs through the
``noop`` sink under its own job group, and the log is summarised per query:
jobs, stages, tasks, summed stage time and shuffle bytes.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    from pyspark.sql import SparkSession

    from sunset_engine.plans import catalog

    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or ["top_airports"]
    log_dir = tempfile.mkdtemp(prefix="sunset-events-")
    spark = (SparkSession.builder.master("local[8]").appName("stage_times")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    walls = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
    spark.stop()

    jobs, stage_group, stages = {}, {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                    jobs[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if "Completion Time" not in info:
                        continue
                    shuffle = sum(a.get("Value", 0) for a in info.get("Accumulables", [])
                                  if a.get("Name") == "internal.metrics.shuffle.write.bytesWritten")
                    stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                                info["Number of Tasks"], shuffle)
    for name in names:
        mine = [stages[s] for s, g in stage_group.items() if g == name and s in stages]
        print(f"{name:26s} wall {walls[name]:6.2f}s  jobs {sum(1 for g in jobs.values() if g == name):3d}  "
              f"stages {len(mine):3d}  tasks {sum(t for _, t, _ in mine):4d}  "
              f"stage time {sum(d for d, _, _ in mine) / 1000:6.2f}s  shuffle {sum(b for *_, b in mine) / 1e6:8.2f} MB")
    print("event log:", log_dir)
    return 0


if __name__ == "__main__":
    sys.exit(main())
