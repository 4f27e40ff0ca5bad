"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is evaluated in full through the ``noop`` sink (no collect to
the driver).  One warm-up pass, then the median of ``$BENCH_REPEAT`` runs
per query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

HEADLINE = [
    "frontier_timeline",
    "frontier_snapshot",
    "blocked_by_gap",
    "tracker_snapshot",
    "completion_class",
    "failed_attempt_counter",
    "replay_set",
    "no_loss",
    "commit_outcome",
    "catch_up",
    "active_jobs",
    "log_parse",
    "log_out_of_order",
    "scenario_checks",
    "lineitem_pending",
]


def _sf_of(path: str) -> float | str:
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=max(cpus, 4))

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up: JIT, file listing, python workers
        once(name)
    per = {}
    for name in names:
        per[name] = round(statistics.median(once(name) for _ in range(repeat)), 3)
    spark.stop()
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(per.values()), 3),
                      "unit": "sec", "queries": per, "sf": _sf_of(sf_dir), "cpus": cpus,
                      "repeat": repeat}))


if __name__ == "__main__":
    main()
