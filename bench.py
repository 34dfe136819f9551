"""Benchmark: run the headline queries over $BENCH_SF_DIR and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is computed,
nothing is collected to the driver). One warm-up pass, then ``BENCH_REPEAT``
timed passes; the fastest pass per query is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillflow.plans.queries import QUERIES  # noqa: E402
from tillflow.runtime import build_session  # noqa: E402

HEADLINE = [
    "weekly_sales",
    "weekly_sales_union",
    "weekly_sales_orders",
    "valid_events",
    "quarantined_events",
    "user_sessions",
    "user_sessions_24h",
    "hot_user_sessions",
    "session_events",
    "hot_user_session_events",
    "session_panes",
    "streamed_sessions",
    "streamed_panes",
]


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(f"local[{cpus}]", partitions=cpus)
    for name in HEADLINE:  # warm-up: JIT, Python workers, file listing
        _run(spark, name, sf_dir)
    best = {name: min(_run(spark, name, sf_dir) for _ in range(repeat)) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
