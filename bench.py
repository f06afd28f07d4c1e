"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is built and fully materialised with the ``noop`` sink (every
row and column is computed, nothing is collected to the driver). The feeds
that are landed as files (tracking documents, export windows as Parquet and
CSV, routing pages)
are landed once first, cold, and reported under ``landing`` (fixture setup;
``value_with_landing`` adds it to ``value``); one untimed warm-up pass over all queries then
compiles the generated code, and each query is timed ``$BENCH_REPEAT`` times
(default 3), reporting the median. ``value`` is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from courierlake.registry import QUERIES, landed  # noqa: E402
from courierlake.session import build_session  # noqa: E402


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="courierlake-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    landing, times = {}, {}
    for feed in ("documents", "exports", "exports_csv", "routing"):
        t0 = time.perf_counter()
        landed(spark, sf_dir, feed)
        landing[feed] = round(time.perf_counter() - t0, 3)
    selected = {n: fn for n, fn in QUERIES.items() if not only or n in only}
    for fn in selected.values():
        materialise(fn(spark, sf_dir))
    for name, fn in selected.items():
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            materialise(fn(spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "landing": landing,
        "value_with_landing": round(sum(times.values()) + sum(landing.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
