"""One run at the published size: 7.05 M trips and 3 M change messages, real sinks, session start included.

``python tools/trial.py`` prints seconds per step. The inputs are the test tables at sf0.1, repeated, in a scratch folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from tidemark.plans import testbed as B
from tidemark.plans.medallion import Layout, backfill, file_log, refresh_changes, refresh_gold, refresh_trips
from tidemark.schemas import CUSTOMERS, DRIVERS
from tidemark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
TRIPS, MESSAGES = 7_052_769, 3_000_000


def main() -> None:
    root = tempfile.mkdtemp(prefix="tidemark-trial-")
    began = time.perf_counter()
    spark = build_session("trial", f"local[{os.environ.get('BENCH_CPUS', '8')}]", spark__sql__shuffle__partitions="32",
                          spark__driver__memory="12g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spent = {"session start": time.perf_counter() - began}

    def copies(rows: int, of: int):
        return spark.range(-(-rows // of)).withColumnRenamed("id", "copy")

    trips = B.trips(spark, SF_DIR).drop("trip_id")
    trips.join(copies(TRIPS, trips.count())).drop("copy").limit(TRIPS).repartition(16).write.parquet(f"{root}/trips")
    log = B.messages(spark, SF_DIR)
    each = log.agg(F.max("offset")).head()[0] + 1
    log.join(copies(MESSAGES, log.count())).withColumn("offset", F.col("offset") + F.col("copy") * each).drop("copy") \
        .repartition(16).write.parquet(f"{root}/messages")
    trips, log, layout = spark.read.parquet(f"{root}/trips"), spark.read.parquet(f"{root}/messages"), Layout(f"{root}/lake", 16)
    most, specs = log.agg(F.max("offset")).head()[0], [CUSTOMERS, DRIVERS]

    def step(name: str, work) -> None:
        start = time.perf_counter()
        work()
        spent[name] = time.perf_counter() - start

    step("changes, first 80 %", lambda: refresh_changes(spark, file_log(log.filter(F.col("offset") < most * 8 // 10)), layout, specs))
    step("changes, last 20 %", lambda: refresh_changes(spark, file_log(log), layout, specs))
    step("changes, idle", lambda: refresh_changes(spark, file_log(log), layout, specs))
    step("trips to bronze and silver", lambda: refresh_trips(spark, trips, B.zones(spark, SF_DIR), layout))
    step("gold tables", lambda: refresh_gold(spark, layout))
    step("mirrors rebuilt from bronze", lambda: backfill(spark, layout, specs))
    for name, seconds in spent.items():
        print(f"| {name} | {seconds:.1f} |")
    print(f"| all, of {trips.count():,} trips and {log.count():,} messages | {sum(spent.values()):.1f} |")
    spark.stop()


if __name__ == "__main__":
    main()
