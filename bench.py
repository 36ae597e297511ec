"""Headline queries, timed end to end; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the repetitions (best counts).
"""

from __future__ import annotations

import json
import os
import time

from cadencia.session import build_session
from checks.queries import QUERIES

HEADLINE = (
    "scheduled_gap_by_hour",
    "trips_typed",
    "headway_punctuality",
    "headway_inliers",
    "multiset_audit_summary",
    "multiset_audit_dump",
    "can_fields",
    "can_wide_clean",
    "can_brand_counts",
    "service_week_totals",
    "range_replace_result",
    "range_replace_stored",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One warm-up of the JVM and the Python workers; then every query runs equally often.
    for name in HEADLINE[:1]:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
