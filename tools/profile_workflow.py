"""Stage-time profile of one workflow from Spark's event log.

Usage: python tools/profile_workflow.py <linear_cv|linear_tvs|tree_cv|gbt_tvs> [sf_dir]

Writes the event log to a fresh scratch folder (no UI, no server), runs the
workflow once after a warm-up, then prints jobs and the slowest stages with
their wall time, task count and summed task time.
"""
import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lumenreg.plans import workflows as W  # noqa: E402
from lumenreg.session import get_session  # noqa: E402
from lumenreg.sources.fixture import tpch_sales  # noqa: E402


def main():
    name = sys.argv[1] if len(sys.argv) > 1 else "tree_cv"
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="lumenreg-eventlog-")
    spark = get_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    fn = getattr(W, name)
    fn(spark, tpch_sales(spark, "/root/testdata/sf0.001"))  # warm-up
    spark.sparkContext.setJobGroup("measured", name)
    t0 = time.perf_counter()
    fn(spark, tpch_sales(spark, sf_dir))
    wall = time.perf_counter() - t0
    spark.stop()

    stages, task_time, measured_jobs = {}, defaultdict(float), set()
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not p.endswith(".inprogress")]
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == "measured":
                        measured_jobs.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if "Submission Time" in info and "Completion Time" in info:
                        stages[info["Stage ID"]] = (
                            (info["Completion Time"] - info["Submission Time"]) / 1000.0,
                            info["Number of Tasks"], info["Stage Name"])
                elif kind == "SparkListenerTaskEnd":
                    ti = ev.get("Task Info", {})
                    task_time[ev["Stage ID"]] += (ti.get("Finish Time", 0) - ti.get("Launch Time", 0)) / 1000.0
    rows = [(sid, *stages[sid], task_time[sid]) for sid in measured_jobs if sid in stages]
    rows.sort(key=lambda r: -r[1])
    print(f"{name} on {sf_dir}: wall {wall:.2f}s, {len(rows)} stages, "
          f"sum of stage wall {sum(r[1] for r in rows):.2f}s, task time {sum(r[4] for r in rows):.2f}s")
    for sid, dur, ntasks, sname, tt in rows[:15]:
        print(f"  stage {sid:4d}  {dur:6.2f}s  tasks {ntasks:4d}  task-time {tt:6.2f}s  {sname[:70]}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
