"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up run, then ``$BENCH_RUNS`` (default 3)
timed runs; the median is reported.  Every run executes the whole plan with
all output columns through the ``noop`` sink (no collect, no count-only
pruning).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.checks import spark_queries as Q  # noqa: E402
from barloom.session import get_session  # noqa: E402

HEADLINE = {
    "bars": Q.q_bars,
    "silver": Q.q_silver,
    "gold": Q.q_gold,
    "supplier_gold": Q.q_supplier_gold,
    "features": Q.q_scaled_features,
    "ema": Q.q_ema,
    "macd": Q.q_macd,
    "correlation": Q.q_correlation,
    "bronze_upsert_keep_first": Q.q_bronze_upsert_keep_first,
    "pages_dedupe": Q.q_pages_dedupe,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:] if a in HEADLINE]
    spark = get_session(f"local[{cpus}]", app_name="barloom-bench",
                        shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    for name, q in HEADLINE.items():
        if only and name not in only:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
