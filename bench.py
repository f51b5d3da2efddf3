"""Time the headline queries and print one JSON line.

Each query runs once to warm the JVM and is then timed ``BENCH_RUNS`` times; the best run counts. Results go to Spark's
no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from layerlint.plans import QUERIES
from layerlint.testing import local_session

HEADLINES = [
    "feature_verdicts", "metadata_issues", "map_part_properties", "all_errors", "errors_by_feature", "verdict", "running_summary",
    "assign_chunks", "chunk_stats", "roi_candidates", "apply_roi_resolution", "task_counters", "duration_histogram", "duration_quantile",
    "active_tasks", "pod_rates", "triage_failures",
]


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session()
    seconds = {}
    for name in names:
        first = timed(lambda: QUERIES[name](spark, sf_dir))
        seconds[name] = round(min(timed(lambda: QUERIES[name](spark, sf_dir)) for _ in range(runs)), 3)
        print(f"{name}: first {first:.2f}s, best {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
