"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_RUNS     warm runs per batch query, the median counts (default 3)
BENCH_QUERIES  comma-separated names (default: all)

Every query is run once to warm up. A stream query is then timed once: it starts
a fresh streaming query, with its own checkpoint, every time. So is a batch query, which takes in whole loads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridsky.registry.queries import all_queries  # noqa: E402
from gridsky.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 1)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "gridsky-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="gridsky-bench-"),
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = all_queries()
    names = wanted.split(",") if wanted else list(queries)
    seconds = {}
    for name in names:

        def once() -> float:
            begun = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begun

        once()
        repeat = 1 if name.startswith(("stream_", "batch_")) else runs
        seconds[name] = round(statistics.median(once() for _ in range(repeat)), 4)

    print(
        json.dumps(
            {
                "metric": "total seconds, median warm run per query",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
