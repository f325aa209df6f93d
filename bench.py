"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs, forced by a no-op write."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sellerbooks import queries  # noqa: E402
from sellerbooks.session import local_session, remove_stages  # noqa: E402

HEADLINE = (
    "fifo_assign",
    "ledger_rolling",
    "combined_order_fees",
    "open_finance_upload",
    "final_assigned_orders",
    "return_expand",
    "latest_listing",
    "sync_diff",
    "global_sequence",
    "schema_profile",
)


def timed(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    queries.run(spark, folder, name).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    remove_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
