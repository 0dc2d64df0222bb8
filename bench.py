"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the `noop` sink (every row computed,
nothing collected to the driver). A small warm-up query runs first so JVM
start-up and code generation are not charged to the first query. Prints ONE
JSON line: {"metric", "value", "unit", "queries", "sf"}. Set
ZONECAST_EVENT_LOG to a scratch folder to keep Spark's event log.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_pickups",          # G1: trips -> zone-hour
    "clean_trips",             # F10: nine rules + semi joins
    "attrition_funnel",        # F15: one-pass funnel
    "rule_rejections",         # F16
    "point_in_zone",           # J4: tile join + exact test
    "combined_demand",         # J3: flagship zone-hour table
    "borough_totals",          # G7
    "weekday_hour_profile",    # G8
    "null_profile",            # G11
    "ridge_grid_search",       # M4: 8 alphas x 5 folds from one pass
    "scan_multi_month",        # A3: per-month read + conform + union
]


COPIES = 30


def throughput(spark, sf_dir: str, once: float) -> dict:
    """`curate` over the events `COPIES` times over: what a further row costs,
    """
    from tools.throughput import copies
    from zonecast.plans.curate import curate

    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    path = copies(spark, sf_dir, COPIES)
    t0 = time.perf_counter()
    curate(spark, path)
    took = time.perf_counter() - t0
    return {"curate_rows": n * COPIES, "curate_sec": round(took, 3),
            "marginal_us_per_row": round((took - once) * 1e6 / (n * (COPIES - 1)), 3)}


def main() -> None:
    from zonecast.plans.registry import all_queries
    from zonecast.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    # optional: Spark's event log in a scratch folder (stage / task times)
    spark = local_session(cpus, app="zonecast-bench",
                          event_log_dir=os.environ.get("ZONECAST_EVENT_LOG"))
    qs = all_queries()

    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        qs["combined_demand"](spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not sys.argv[1:]:
        # the end-to-end curation (all curated outputs written), the
        # counterpart of the published preprocessing time
        from zonecast.plans.curate import curate

        t0 = time.perf_counter()
        curate(spark, sf_dir)
        times["curate_end_to_end"] = round(time.perf_counter() - t0, 3)
    extra = {} if sys.argv[1:] else {"throughput": throughput(spark, sf_dir, times["curate_end_to_end"])}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
