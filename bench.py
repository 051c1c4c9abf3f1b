"""Headline benchmark: runs the main workloads on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]`` and prints one JSON line.

Each query is executed ``$BENCH_RUNS`` times (three), to completion, with the
``noop`` sink (every row is produced, nothing is collected to the driver); the
median counts. Before the first query a
tiny job starts the session's executors and JVM so that start-up is not
billed to whichever query happens to run first.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ingest_batch",          # pages -> records -> hash -> merge (bronze)
    "q_records_per_state",   # README query over silver
    "q_top_crops",
    "dq_all",                # all quality rules, one scan
    "validation_run_summary",
    "wide_to_tidy",          # reshape, shuffle-free
    "pivot_metrics",         # reshape through melt + pivot
    "lineage_edges",         # events -> edges
    "reference_validate",    # directory match (deletion keys)
    "graph_cycles",          # transitions -> circuits
    "html_table_rows",       # mapInPandas table parse
    "job_ledger",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from granary.plans import registry
    from granary.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus))
    registry.load_all()
    spark.range(0, 100_000, 1, cpus).selectExpr("sum(id)").collect()  # session warm-up
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            t0 = time.time()
            df = registry.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
