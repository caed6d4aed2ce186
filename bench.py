"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES a subset of the queries.
Every query is run to the end over its whole tables; results go to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.registry import QUERIES
from tracewright.session import local_session

HEADLINE = [
    "objects_inside_polygon",
    "nearby_objects",
    "objects_crossing_line",
    "vehicle_trajectory",
    "resolve_reference",
    "gold_trace_steps",
    "negative_cases",
    "assembled_samples",
    "text_keys",
    "static_check",
    "execution_check",
    "final_highlights",
    "dedup_kept",
    "split_assignment",
    "review_sample",
    "first_parsed_answers",
    "gate_cascade",
    "funnel_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start-up is not measured
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
