"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every query is warmed up
once, then run three times into the noop sink; the median counts. ``incremental_load`` is the time
of one load on a target that was seeded beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from changefold import PRODUCTS, TargetStore, build_session, scratch_dir
from checks import feeds, queries

QUERIES = [
    "latest_by_key",
    "latest_tiebreak",
    "source_conflicts",
    "dedup_exact",
    "classify_outcomes",
    "run_metrics",
    "window_filter",
    "late_arrivals",
    "contract_gate",
    "constraint_audit",
    "state_diff",
    "state_checksum",
    "bucket_checksum",
]
REPEATS = 3


def time_query(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def time_load(spark, sf_dir: str) -> float:
    """Second load of the orders: 30 days of overlap re-read, the target rewritten and published."""
    store, history = queries.seeded_store(spark, sf_dir)
    started = time.perf_counter()
    queries.fixed_load(store, history, "load")
    return time.perf_counter() - started


def time_first_load(spark, sf_dir: str) -> float:
    """The whole order history into an empty store."""
    store = TargetStore(spark, scratch_dir(spark, "store"), PRODUCTS, n_buckets=8)
    history = feeds.order_products(spark, sf_dir)
    started = time.perf_counter()
    queries.fixed_load(store, history, "seed")
    return time.perf_counter() - started


def median(run) -> float:
    run()
    return round(statistics.median(run() for _ in range(REPEATS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: median(lambda: time_query(spark, sf_dir, name)) for name in QUERIES}
    seconds["incremental_load"] = median(lambda: time_load(spark, sf_dir))
    seconds["first_load"] = median(lambda: time_first_load(spark, sf_dir))
    spark.stop()
    report = {
        "metric": "total of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    sys.exit(main())
