"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Every query runs once to warm
up and then BENCH_RUNS times; the median counts. Results go to a sink that reads and drops all rows, while the job
queries also write their files.
"""

import json
import os
import statistics
import sys
import time

from millrace.plans.catalog import QUERIES
from millrace.session import build_session

HEADLINE = (
    "dedup_json", "dedup_record", "dedup_composite", "dedup_hot_key", "dedup_hot_third", "dedup_bytes",
    "dedup_stream", "dedup_stateful", "parse_json", "parse_drop", "flatten_arrays", "flatten_embeddings",
    "csv_lines", "csv_quoted", "json_lines", "stream_copy", "generate_events", "csv_job", "parquet_job",
)


def seconds(spark, folder, name):
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("millrace-bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": cores,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, folder, name)
        timings[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
