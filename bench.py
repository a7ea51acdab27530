"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local threads.  Each
query is planned and run in full, written to Spark's no-op sink; the best of
three runs counts, so that the first query does not carry the start of the JVM.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from platewatch.plans.queries import QUERIES

HEADLINE = [
    "sightings_since",
    "plate_trail",
    "site_sequences",
    "clone_plate_pairs",
    "clone_plate_adjacent",
    "clone_plate_report",
    "clone_watchlist",
    "cotravel_groups",
    "cotravel_all",
    "cotravel_pairs",
    "first_entry",
    "seen_before_counted",
    "seen_before_repeated",
    "watchlist_alerts",
    "decode_messages",
    "csv_sightings",
    "watchlist_alerts_stream",
    "first_entry_stream",
    "message_alerts_stream",
]
RUNS = 3


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("platewatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Skips recording the Python line of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of headline query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
