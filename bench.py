"""Times every registered query and prints one JSON line.

Each query is warmed up once and then run BENCH_RUNS times into the no-op sink, which
evaluates every row and column without collecting them; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stallbook.catalog import QUERIES  # noqa: E402
from stallbook.session import clear_scratch, local_session  # noqa: E402


def run_once(spark, build, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.mode("overwrite").format("noop").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    spark = local_session(cores, "bench")
    timings = {}
    for name in wanted:
        run_once(spark, QUERIES[name], folder)
        timings[name] = round(statistics.median(run_once(spark, QUERIES[name], folder) for _ in range(runs)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_all_queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
