"""Task-level skew report from Spark's event log (no UI, no server).

Runs hot-key scenarios built from a test table - one key holding a third of
the rows - in a session that writes its event log to a fresh scratch folder,
then reads the log and prints, per stage, the number of tasks and the largest
task's share of the records the stage read. A share near 1/3 or more means one
task got the hot key; small shares mean the work was split.

Usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _event_lines(log_path: str):
    """Lines of an event log: a single file, or a rolling log folder (``eventlog_v2_*``)."""
    files = [log_path]
    if os.path.isdir(log_path):
        def part(p):
            base = os.path.basename(p)
            return int(base.split("_")[1]) if base.startswith("events_") else -1
        files = sorted((p for p in glob.glob(os.path.join(log_path, "*")) if part(p) >= 0), key=part)
    for path in files:
        with open(path) as f:
            yield from f


def stage_stats(log_path: str) -> dict[int, dict]:
    stages: dict[int, dict] = {}
    for line in _event_lines(log_path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                    + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            st = stages.setdefault(ev["Stage ID"], {"records": [], "ms": []})
            st["records"].append(recs)
            st["ms"].append(m.get("Executor Run Time", 0))
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            stages.setdefault(info["Stage ID"], {"records": [], "ms": []})["name"] = info["Stage Name"]
        elif kind == "SparkListenerJobStart":
            for sid in ev.get("Stage IDs", []):
                stages.setdefault(sid, {"records": [], "ms": []})["job"] = ev["Job ID"]
    return stages


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="skew-eventlog-")
    from pyspark.sql import functions as F

    from martsmith.operators.dedup import first_wins
    from martsmith.operators.joins import skew_safe_left_join
    from martsmith.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{logdir}",
        "spark.eventLog.compress": "false",
        # thresholds scaled down to the test size (defaults: 256 MB, factor 5)
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(16)
    hot = li.withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(16).select(
        F.col("o_orderkey").alias("ok"), "o_custkey")

    scenarios = {}

    def run(name, df):
        spark.sparkContext.setJobGroup(name, name)
        jobs_before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        df.write.format("noop").mode("overwrite").save()
        scenarios[name] = set(spark.sparkContext.statusTracker().getJobIdsForGroup(name)) - jobs_before

    run("first_wins on a key holding 1/3 of rows",
        first_wins(hot, ["hot"], ["l_shipdate"]))
    # unique keys on the preserved side; a third of the other side's rows share key 0
    fact = orders
    other = hot.select(F.col("hot").alias("k"), "l_linenumber", "l_quantity")
    run("plain left join, hot key on the other side", fact.join(other, F.col("ok") == F.col("k"), "left"))
    run("skew_safe_left_join, hot key on the other side",
        skew_safe_left_join(fact, other, "ok", "k", max_broadcast_bytes=0))
    spark.stop()

    logs = [p for p in glob.glob(os.path.join(logdir, "*")) if not p.endswith(".inprogress")]
    stats = stage_stats(logs[0])
    by_job: dict[int, list[int]] = {}
    for sid, st in stats.items():
        by_job.setdefault(st.get("job", -1), []).append(sid)
    for name, jobs in scenarios.items():
        print(f"\n{name}")
        for job in sorted(jobs):
            for sid in sorted(by_job.get(job, [])):
                st = stats[sid]
                recs = st["records"]
                if not recs or sum(recs) == 0:
                    continue
                share = max(recs) / sum(recs)
                print(f"  stage {sid:3d} tasks={len(recs):3d} records={sum(recs):8d} "
                      f"max_task_share={share:.2f} median_task_ms={statistics.median(st['ms']):.0f} "
                      f"max_task_ms={max(st['ms'])}")


if __name__ == "__main__":
    main(sys.argv)
