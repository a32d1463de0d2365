"""Plan display for the key silver and gold queries (the pipeline's explain option).

``explain_layer`` returns Spark's formatted physical plan for each key query of
a layer, as ``df.explain("formatted")`` prints it (scan filters, pruned read
schema, exchanges and join strategies).  ``scripts/plan_audit.py`` executes
every query and tabulates the final adaptive plans.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame, SparkSession

from cafetal.plans import catalog

LAYER_QUERIES = {
    "silver": ["silver_preview", "silver"],
    "gold": ["ranking_counts", "point_seasonality", "point_month_join", "top20_point_month",
             "executive_summary"],
}


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


# metrics shown by an analysed plan, in this order
SHOWN = ("numOutputRows", "shuffleRecordsWritten", "dataSize", "spillSize", "scanTime", "aggTime", "sortTime", "pipelineTime")


def analyzed_plan(df: DataFrame) -> str:
    """Run ``df`` and return its final adaptive plan, each operator with what it did: rows, bytes, spill, milliseconds.

    The whole plan runs on the executors, and only its row count comes back.
    """
    plan = df._jdf.queryExecution().executedPlan()
    rows = df._jdf.queryExecution().toRdd().count()
    lines: list[str] = []

    def show(node, depth: int) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return show(node.executedPlan(), depth)
        values = node.metrics()
        known = []
        for metric in SHOWN:
            found = values.get(metric)
            if found.isDefined() and found.get().value() > 0:
                known.append(f"{metric}={found.get().value()}")
        lines.append("  " * depth + name + (f"  [{', '.join(known)}]" if known else ""))
        children = node.children()
        below = [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in name:
            below = [node.plan()]
        for child in below:
            show(child, depth + 1)

    show(plan, 0)
    return "\n".join([f"rows returned: {rows}", *lines])


def explain_layer(spark: SparkSession, sf_dir: str, layer: str, analyze: bool = False) -> dict[str, str]:
    """Plans of a layer's key queries; with ``analyze`` they are run, and the plans say what each operator did."""
    if layer not in LAYER_QUERIES:
        raise ValueError(f"unknown layer {layer!r}; use one of {sorted(LAYER_QUERIES)}")
    qs = catalog.queries()
    return {name: (analyzed_plan if analyze else plan_text)(qs[name](spark, sf_dir)) for name in LAYER_QUERIES[layer]}


def plan_facts(plan: str) -> dict[str, int]:
    """Counts of the operators that matter at scale, read from the plan tree.

    For an executed adaptive plan only the ``== Final Plan ==`` part of the
    tree is counted.
    """
    tree = plan.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Initial Plan ==")[0]

    def n(pattern: str) -> int:
        return len(re.findall(pattern, tree))
    def details(node_id: str) -> str:
        m = re.search(rf"^\({node_id}\) Exchange\n((?:.+\n?)*)", plan, re.M)
        return m.group(1) if m else ""
    single = sum(1 for m in re.finditer(r"\bExchange \((\d+)\)", tree)
                 if "SinglePartition" in details(m.group(1)))
    return {
        "scans": n(r"Scan parquet"),
        "shuffles": n(r"\bExchange \(\d+\)"),
        "single_partition_shuffles": single,
        "broadcasts": n(r"BroadcastExchange \(\d+\)"),
        "broadcast_hash_joins": n(r"BroadcastHashJoin"),
        "sort_merge_joins": n(r"SortMergeJoin"),
        "nested_loop_joins": n(r"BroadcastNestedLoopJoin") + n(r"CartesianProduct"),
        "windows": n(r"\bWindow \(\d+\)"),
        "python_udfs": n(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
    }
