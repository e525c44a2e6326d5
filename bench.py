"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: the median of three warm runs each, as one JSON line.

Each query's figure goes to the error stream as it ends.  A run is cancelled after
BENCH_LIMIT seconds (120), and its query then has no figure.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("a2_roll_up", "w1_best_hit_declared", "j11_interval_join", "k1_wide_matrix", "f15_quantile_cascade", "w5_run_lengths", "m12_percent_identity", "a21_kmer_profile")


def main() -> None:
    from lamina.plans import QUERIES
    from lamina.session import get_spark

    folder, cpus, limit = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8"), float(os.environ.get("BENCH_LIMIT", "120"))
    spark = get_spark("bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__sql__files__maxPartitionBytes="4m", spark__sql__files__openCostInBytes="256k")
    sc = spark.sparkContext
    sc.setLogLevel("OFF")

    def run(name: str) -> float:
        timer = threading.Timer(limit, sc.cancelAllJobs)
        timer.start()
        try:
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began
        finally:
            timer.cancel()

    times: dict[str, float | None] = {}
    for name in HEADLINE:
        try:
            run(name)
            times[name] = round(statistics.median(run(name) for _ in range(3)), 3)
        except Exception as e:  # one query without a figure leaves the others theirs
            times[name] = None
            print(f"{name}: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr, flush=True)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, sum of warm medians of 3", "value": round(sum(t for t in times.values() if t is not None), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
