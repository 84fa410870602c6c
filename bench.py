"""Time every query of the catalogue; prints one JSON line.

Each query runs once to warm up and is then timed ``BENCH_REPEATS`` times (the
median counts). Results go to Spark's no-op sink, so all columns are computed
but nothing is sent to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from proseframe.plans.catalogue import QUERIES  # noqa: E402
from proseframe.session import local_session  # noqa: E402


def seconds(query, spark, sf: str) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in wanted:
        seconds(QUERIES[name], spark, sf)
        runs = [seconds(QUERIES[name], spark, sf) for _ in range(repeats)]
        times[name] = round(statistics.median(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
