"""Times the headline queries and prints one JSON line.

`refreshed_batch` is one day's batch through the stored path, refresh of all marts included, on a warehouse that
holds the 29 days before it. It is listed beside the queries and not part of the total.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hydrolens.catalog import DAY, Telemetry, all_queries  # noqa: E402
from hydrolens.sources.warehouse import Warehouse  # noqa: E402

HEADLINE = [
    "fact_sensor_reading",
    "fact_water_quality_index",
    "fact_sensor_health",
    "fact_alert",
    "dedup_readings",
    "latest_wqi",
    "station_wqi_daily",
    "mart_station_latest_status",
    "mart_governorate_daily_summary",
    "mart_parameter_trend",
    "mart_alert_monitor",
    "mart_data_quality_monitor",
    "mart_station_daily_snapshot",
    "mart_system_readiness_summary",
    "wqi_box",
    "readiness_score",
    "streamed_readings",
]


def seconds(query, spark: SparkSession, folder: str) -> float:
    """Planning, intermediate tables and the full result."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def refreshed_batch(spark: SparkSession, folder: str) -> float:
    tables = Telemetry(spark, folder)
    warehouse = Warehouse(spark, f"{tables.run.path}/warehouse", tables.stations)
    for number, days in enumerate(["between 1 and 28", "= 29", "= 30"]):
        start = time.perf_counter()
        warehouse.append_batch(tables.scored.where(f"day(event_date) {days}"), number)
        warehouse.refresh(DAY)
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    times = {}
    for name in HEADLINE:
        # The first run compiles the generated code; the second one is reported.
        runs = [seconds(registered[name], spark, folder) for _ in range(2)]
        times[name] = round(runs[-1], 3)
    total = round(sum(times.values()), 3)
    times["refreshed_batch"] = round(refreshed_batch(spark, folder), 3)
    result = {
        "metric": "total seconds of headline queries, second run",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
