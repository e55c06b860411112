"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` an
optional comma-separated choice. Every result is written out in full to Spark's no-op sink. Mirrors are also timed over
a log that is stored beforehand (``stored_log``, not in the total), as most of their time goes into making its messages.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.operators.changelog import current_state
from tidemark.operators.envelope import bronze_table
from tidemark.plans import queries, testbed
from tidemark.schemas import CUSTOMERS, DRIVERS
from tidemark.session import build_session, materialize

HEADLINE = (
    "cdc_mirror_customers", "cdc_mirror_drivers", "cdc_current_state", "cdc_apply_changes", "cdc_state_as_of",
    "cdc_snapshot_diff", "cdc_reconcile", "trips_clean", "trips_enriched", "trips_rejects", "ids_dense",
    "tips_behavior", "tips_rankings", "tips_best_zone_hour", "tips_driver_report", "tips_driver_by_key",
    "stream_bronze", "stream_silver", "medallion_driver_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries.catalog()
    catalog["trips_clean"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's engines
    spent = {}
    for name in names:
        start = time.perf_counter()
        catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    stored = {}
    if not chosen:
        log = materialize(testbed.messages(spark, sf_dir), "messages")
        for spec in (CUSTOMERS, DRIVERS):
            start = time.perf_counter()
            current_state(bronze_table(log, spec), spec).write.format("noop").mode("overwrite").save()
            stored[f"mirror_{spec.name}"] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(spent.values()), 3), "unit": "sec",
                      "queries": spent, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "event_rows": rows, "stored_log": stored}))
    spark.stop()


if __name__ == "__main__":
    main()
