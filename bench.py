"""Benchmark the headline queries.

Runs each query in ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Every query is fully executed with the ``noop`` sink (the whole plan runs, no
rows are collected to the driver).  A warm-up on the smallest scale runs first
so JVM start and code loading are not charged to the first timed query.  The first timed entries,
``bronze_layer`` and ``silver_layer``, are the ingestion (projected from the
supplied tables) and the silver layer, each written once; the queries after
them scan those tables, as in a pipeline run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cafetal.plans import catalog  # noqa: E402
from cafetal.session import local_session  # noqa: E402

HEADLINE = [
    "silver",
    "ranking",
    "seasonality",
    "executive_summary",
    "point_month_join",
    "top20_point_month",
    "monthly_anomaly",
    "icc_ranking",
    "grid_match",
    "map_feed",
    "thermal_amplitude",
    "date_gaps",
    "validation_report",
    "contract_silver",
    "csv_union_by_name",
    "run_layers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    only = sys.argv[1:]
    names = only or HEADLINE
    spark = local_session()
    qs = catalog.queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and warm.rstrip("/") != sf_dir:
        catalog.q_ranking(spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    catalog.bronze_layer(spark, sf_dir)
    times["bronze_layer"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    catalog.silver_layer(spark, sf_dir)
    times["silver_layer"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
