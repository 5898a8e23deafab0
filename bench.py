"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, executing the full plan into the ``noop`` sink.
median of the next ``$BENCH_REPEATS`` runs (default 3) is reported (plan
building, including any broadcast size check, is inside the timing).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill import registry  # noqa: E402
from ordermill.session import build_session  # noqa: E402

# The queries timed, in order.
HEADLINE = (
    "p4_daily_revenue", "p5_product_performance", "p6_inventory_alerts",
    "a1_daily_category_revenue", "t1_top_products", "j1_enrich_left",
    "v2_orders_good", "v6_bad_union", "p3_backfill", "p7_profile",
)


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.queries()[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = build_session(f"local[{cpus}]", max(8, cpus), app_name="ordermill-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    timings = {}
    for name in only:
        _run(spark, name, sf_dir)  # first run dropped
        runs = [_run(spark, name, sf_dir) for _ in range(repeats)]
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
