"""Times every registered query and prints one JSON line.

Each query runs once to warm up and then once for the record; both runs compute
all rows and columns. ``value`` is the sum of the recorded seconds.
"""

from __future__ import annotations

import json
import os
import time

from tributary.session import build_session
from tributary.sources import clear_scratch
from workloads import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    folder = os.environ.get("BENCH_SCRATCH", os.path.abspath("spark-warehouse"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": f"{folder}/scratch",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        for _ in range(2):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "master": f"local[{cpus}]",
                "shuffle_partitions": cpus,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
