"""Times the headline queries and prints one JSON line.

Logs are written before the clock starts; each query is run once to warm up, and its best of three runs counts. The
result is computed in full but not collected (Spark's no-op sink).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from skein.operators import queries as q
from skein.plans.reader import read_log
from skein.sources.writer import write_log

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

#: Registered queries that read the one events log.
OVER_EVENTS = ["scan_all_types", "count_star", "projection", "filter_and", "filter_range_port", "filter_time", "group_sum_order", "distinct_count", "inet_contained_by", "inet_group", "top_n", "window_rank"]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def timed(make) -> float:
    best = float("inf")
    for _ in range(4):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    q.events_log(spark, SF_DIR)
    rows = q.event_rows(spark, SF_DIR)
    packed, many = q.folder(spark, "bench-gzip"), q.folder(spark, "bench-many")
    write_log(rows.repartition(int(CPUS)), packed, q.EVENTS, compression="gzip")
    write_log(rows.repartition(200), many, q.EVENTS)
    registry = q.queries()
    times = {name: timed(lambda name=name: registry[name](spark, SF_DIR)) for name in OVER_EVENTS}
    times["scan_gzip"] = timed(lambda: read_log(spark, f"{packed}/part-*.gz"))
    times["scan_200_files_strict"] = timed(lambda: read_log(spark, f"{many}/part-*"))
    times["scan_200_files_union"] = timed(lambda: read_log(spark, f"{many}/part-*", union_by_name=True, filename=True))
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "log_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
