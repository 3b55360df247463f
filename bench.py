"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query runs once to warm up and then
$BENCH_RUNS times; its value is the median. A result is computed in full and thrown away.
"""

import json
import os
import statistics
import time
from tempfile import mkdtemp

from pyspark.sql import SparkSession

from farelens.plans.queries import QUERIES

HEADLINE = [
    "avg_price_by_weekday",
    "avg_price_30d",
    "avg_price_by_company",
    "tickets_by_company",
    "price_points",
    "bookable_offers",
    "explode_itineraries",
    "dedup_by_id_direct",
    "dedup_by_id_connecting",
    "direct_tickets",
    "connecting_tickets",
    "ticket_table_connecting",
    "connecting_price_by_weekday",
    "csv_glob_scan",
    "json_offer_scan",
    "ticket_export_roundtrip",
    "avg_price_by_weekday_stream",
    "avg_price_30d_stream",
    "avg_price_by_company_stream",
    "tickets_by_company_stream",
    "stream_events_by_type",
    "export_to_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("farelens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or mkdtemp())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per query",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
