"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR  tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to 1 for every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from runlens import plans  # noqa: E402
from runlens.session import local_session  # noqa: E402

HEADLINE = [
    "flatten_calls", "workflow_root", "troubleshoot_report", "failure_class", "lcp",
    "monitor_stats", "monitor_last", "monitor_median", "monitor_scan", "input_sizes", "ragged_tsv",
    "ols_sum", "ols_multi",
    "list_workflows", "find_wildcard", "find_ids", "find_union", "labels_build", "labels_update", "subworkflow_closure",
    "log_events", "status_transitions", "current_status", "task_events", "shortid_resolve",
    "flatten_doc", "leaf_values", "unflatten_doc", "merge_docs", "split_doc",
    "bind_dirs", "localize_plan", "cleanup_plan", "import_closure", "default_images", "conf_includes",
    "heartbeat_alive", "stream_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cores})
    queries = plans.all_queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE

    def run(name: str, place: str) -> float:
        start = time.perf_counter()
        queries[name](spark, place).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("flatten_calls", sf_dir)  # warm the JVM
    seconds = {}
    for name in names:
        seconds[name] = round(run(name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total" if names is HEADLINE else "all_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
