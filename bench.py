"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) holds the tables, ``BENCH_CPUS`` (default 8) sets
``local[N]``. Each query runs once to warm up and ``BENCH_RUNS`` (default 1) times measured; the
median counts and covers building the plan, staging and fetching the whole result. The brute-force
forms of COMPARED are timed in the same session, under ``naive``; ``BENCH_NAIVE=0`` leaves them out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "clean_strip_first", "clean_fold_first", "token_vocabulary", "fuzzy_dictionary",
    "fuzzy_dictionary_documents", "fuzzy_correct_names", "fuzzy_correct_documents", "overlap_best",
    "overlap_documents", "overlap_large_taxonomy", "level_lookup", "classify_names", "cosine_best", "match_by_vector",
    "mean_vector",
)

#: Queries whose brute-force form ends in reasonable time at any scale factor of the test data.
COMPARED = ("fuzzy_dictionary", "overlap_best", "classify_names")


def timed(run: Callable[[], DataFrame], runs: int) -> float:
    seconds = []
    for attempt in range(runs + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        if attempt:
            seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    seconds = {name: timed(lambda n=name: QUERIES[n](spark, sf_dir), runs) for name in chosen}
    result = {
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_NAIVE", "1") == "1":
        from workload.naive import NAIVE

        result["naive"] = {
            name: timed(lambda n=name: NAIVE[n](spark, sf_dir), runs) for name in COMPARED if name in chosen
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
