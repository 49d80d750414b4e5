"""Time every query and print one line of JSON.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of threads, and
BENCH_QUERIES, if set, the queries to run, separated by commas.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

REPEATS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/part.parquet").groupBy("p_brand").count().collect()

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {
        name: round(min(run(name) for _ in range(REPEATS)), 3) for name in names or QUERIES
    }
    print(json.dumps({
        "metric": "total time of all queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
