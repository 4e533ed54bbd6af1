"""Time the registered queries: one JSON line on stdout.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: cores (default 8);
BENCH_RUNS: timed runs per query after one warm-up, the median counts (default 2, streams 1);
BENCH_QUERIES: comma list to restrict the run. Of the queries that replay the ad job in the same way
one is timed by default.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from clickloom.checks.registry import QUERIES

SAME_REPLAY = ("ad_clean_clicks_stream", "ad_published_stat_stream")


def _seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else [n for n in QUERIES if n not in SAME_REPLAY]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        query = QUERIES[name]
        _seconds(query, spark, sf_dir)
        timed = 1 if name.endswith("_stream") else runs
        times[name] = round(
            statistics.median(_seconds(query, spark, sf_dir) for _ in range(timed)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()


if __name__ == "__main__":
    main()
