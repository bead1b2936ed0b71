"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query computes every row (noop
sink); the figure is the better of two runs after a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import time

from millrace.catalog import QUERIES
from millrace.session import build_session
from millrace.sinks.files import drop_scratch

HEADLINE = (
    "city_counts",
    "average_per_department",
    "top_accounts",
    "raw_line_contains",
    "aggregate_then_join",
    "global_sort_descending",
    "store_sales",
    "hourly_sensor_average",
    "inner_join_on_key",
    "posts_by_age_band",
    "product_totals",
    "three_table_chain",
    "currency_left_join",
    "word_frequency",
    "running_sum",
    "one_row_per_transaction",
    "trip_distance_by_vehicle",
    "daily_customer_summary",
    "customer_profiles",
    "event_archive_stream",
    "escalation_events",
    "planned_reminders",
    "overdue_messages",
    "storage_format_round_trips",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    drop_scratch(spark)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
