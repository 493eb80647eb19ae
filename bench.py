"""Times every catalogue query on the sample tables and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_QUERIES an optional comma list.
A small scan warms the session up; then each query runs once and is timed from building its plan to the
last row of its result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from txwatch.plans.catalogue import catalogue
from txwatch.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "txwatch-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalogue()
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()

    seconds: dict[str, float] = {}
    for name in chosen or registered:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.2f} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "txwatch_catalogue_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
