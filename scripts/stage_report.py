"""Run queries with Spark's event log on and summarize stages from it.

Usage: python scripts/stage_report.py [sf_dir] query [query ...]

The event log is written to a fresh folder under /tmp; per query it prints the
number of stages and tasks, wall time of the stages, rows read, and shuffle
bytes written, which is what grows with the data at scale.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from cafetal.plans import catalog  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="cafetal-eventlog-")
    spark = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    catalog.bronze_layer(spark, sf_dir)
    qs = catalog.queries()
    for name in args:
        spark.sparkContext.setJobGroup(name, name)
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stages = defaultdict(lambda: {"stages": 0, "tasks": 0, "ms": 0, "rows_in": 0, "shuffle_w": 0})
    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    paths = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = job_group.get(stage_job.get(info["Stage ID"]))
                    if group is None:
                        continue
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    s = stages[group]
                    s["stages"] += 1
                    s["tasks"] += info.get("Number of Tasks", 0)
                    s["ms"] += (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                    s["rows_in"] += int(acc.get("internal.metrics.input.recordsRead", 0) or 0)
                    s["shuffle_w"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
    print("| query | stages | tasks | stage ms | rows read | shuffle bytes written |")
    print("|---|---|---|---|---|---|")
    for name in args:
        s = stages[name]
        print(f"| {name} | {s['stages']} | {s['tasks']} | {s['ms']} | {s['rows_in']} | {s['shuffle_w']} |")


if __name__ == "__main__":
    main()
