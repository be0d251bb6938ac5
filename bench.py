"""Times the registered queries, one JSON line on stdout.

BENCH_SF_DIR  folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names (default: all queries of the library's own operators)
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from leadlift.plans.queries import QUERIES

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("leadlift-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        # HotSpot does not compile methods above 8000 bytes of bytecode; let Spark split those instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one unmeasured run, so that the first query is not charged for starting the JVM's compilers
    QUERIES["decile_table"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in only or list(QUERIES):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale[1]) if scale else None,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
