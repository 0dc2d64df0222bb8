"""Marginal cost of a row of `curate`: the input's events written `times`
over into scratch, `curate` run on one and on all copies.

    python tools/throughput.py <sf_dir> [times] [cpus]

Prints one JSON line: seconds at both sizes, rows (trips and ridership) and
microseconds per further row. Copies differ in their event ids only, so the
work per row stays that of the input.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def copies(spark, sf_dir: str, times: int) -> str:
    from pyspark.sql import functions as F

    from zonecast.session import scratch_path

    out = scratch_path(spark, f"copies-{times}")
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    top = events.agg(F.max("event_id")).first()[0] + 1
    more = events.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    # ids keep their remainders of the fixtures' rules: a multiple of all of them
    step = 60 * 25 * 7 * 101 * (1 + top // (60 * 25 * 7 * 101))
    more.withColumn("event_id", F.col("event_id") + F.col("_k") * step).drop("_k").repartition(
        max(8, times)).write.parquet(f"{out}/events.parquet")
    return out


def main(argv: list[str]) -> None:
    from zonecast.plans.curate import curate
    from zonecast.session import local_session

    if not argv:
        raise SystemExit(__doc__)
    times = int(argv[1]) if len(argv) > 1 else 30
    spark = local_session(argv[2] if len(argv) > 2 else "8", app="zonecast-throughput")
    seconds, rows = {}, {}
    curate(spark, os.path.join(os.path.dirname(argv[0].rstrip("/")), "sf0.001"))        # warm-up
    for k in (1, times):
        path = copies(spark, argv[0], k)
        rows[k] = spark.read.parquet(f"{path}/events.parquet").count()
        t0 = time.perf_counter()
        curate(spark, path)
        seconds[k] = round(time.perf_counter() - t0, 2)
    print(json.dumps({"metric": "curate_marginal_us_per_row", "unit": "us",
                      "value": round((seconds[times] - seconds[1]) * 1e6 / (rows[times] - rows[1]), 3),
                      "seconds": seconds, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
