"""Execute every registered query and tabulate what it ran, from Spark's event log (markdown).

All SQL executions of a query count, also writes and what stands behind a
written table or a checkpoint, each by its final adaptive plan; rows read and
shuffle bytes are the tasks' own metrics.  The bronze and silver layers are
written beforehand, once.

Usage: python scripts/plan_audit.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cafetal.plans import catalog  # noqa: E402
from cafetal.session import build_session  # noqa: E402

COLUMNS = {
    "scans": ("Scan parquet", "Scan csv", "Scan text"), "shuffles": ("Exchange",),
    "broadcasts": ("BroadcastExchange",), "hash joins": ("BroadcastHashJoin", "ShuffledHashJoin"),
    "merge joins": ("SortMergeJoin",), "nested loops": ("BroadcastNestedLoopJoin", "CartesianProduct"),
    "windows": ("Window",), "Python": ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"),
}
HEAD = """# PLANS

Everything that each registered climate query ran at {sf}, by `scripts/plan_audit.py` from Spark's event
log: all its SQL executions with their final adaptive plans, writes and checkpointed work included, and
the rows and shuffle bytes that its tasks read and wrote.  Bronze and silver are written beforehand.
Reused exchanges count once.  Windows are only over partitions bounded by the calendar (at most 13
months per point, one row per year per point-month) or over one row per range partition.

"""


def nodes(plan: dict) -> Counter:
    """Operators of a plan tree; the reader behind a reused exchange isn't counted again."""
    name = plan["nodeName"]
    out = Counter([name.rsplit(" ", 1)[0] if name.startswith("Scan ") and name.count(" ") > 1 else name])
    if not name.startswith("ReusedExchange"):
        for child in plan["children"]:
            out += nodes(child)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="cafetal-eventlog-")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("plan-audit", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{log_dir}",
                          spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false")
    catalog.silver_layer(spark, sf_dir)
    names = list(catalog.queries())
    for name, query in catalog.queries().items():
        spark.sparkContext.setJobGroup(name, name)
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    plans: dict[int, dict] = {}
    group_of: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    moved: dict[str, Counter] = defaultdict(Counter)
    for path in glob.glob(f"{log_dir}/*"):
        with open(path, encoding="utf-8") as log:
            for line in log:
                e = json.loads(line)
                kind = e["Event"].rpartition(".")[2]
                if "sparkPlanInfo" in e:
                    plans[e["executionId"]] = e["sparkPlanInfo"]  # the last one is the final plan
                elif kind == "SparkListenerJobStart":
                    given = e.get("Properties") or {}
                    group = given.get("spark.jobGroup.id")
                    for k in e["Stage IDs"]:
                        stage_group[k] = group
                    if given.get("spark.sql.execution.id"):
                        group_of[int(given["spark.sql.execution.id"])] = group
                elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    m, c = e["Task Metrics"], moved[stage_group.get(e["Stage ID"])]
                    c["rows"] += m["Input Metrics"]["Records Read"]
                    c["bytes"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    totals: dict[str, Counter] = defaultdict(Counter)
    for execution, plan in plans.items():
        totals[group_of.get(execution)] += nodes(plan)
    print(HEAD.format(sf=os.path.basename(sf_dir.rstrip("/"))), end="")
    print("| query | " + " | ".join(COLUMNS) + " | rows read | shuffle kB |")
    print("|---" * (len(COLUMNS) + 3) + "|")
    for name in names:
        counts = [sum(n for node, n in totals[name].items() if node.strip() in kinds) for kinds in COLUMNS.values()]
        print(f"| {name} | " + " | ".join(map(str, counts))
              + f" | {moved[name]['rows']:,} | {moved[name]['bytes'] / 1000:,.0f} |")


if __name__ == "__main__":
    main()
