"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (default 3).
Each query runs once to warm up; its time is the median of the runs after that. The whole result is computed
and dropped, without moving it to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from landcarbon.session import local_session
from standins.queries import REGISTRY

HEADLINE = [
    "pivoted_categories",
    "report_classes",
    "savings_by_grant",
    "savings_by_year",
    "condition_share_int",
    "priority_sources",
    "append_missing",
    "enrich_by_id_list",
    "technique_list",
    "changes_since_snapshot",
    "box_clip_area",
    "points_in_boxes",
    "overlap_flag",
    "covered_boxes",
    "dissolve_boxes",
    "dissolve_by_year",
    "priority_subtract",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], f"first {times[0]:.1f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
