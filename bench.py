"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from raillark.plans import registry, views

HEADLINE = [
    "top_departure_board", "top_departure_boards", "job_city_departures", "job_compact_departures", "job_station_departures", "job_route_index", "job_trip_index",
    "join_point_in_polygon", "join_radius", "join_map_match", "join_catalogue_fill", "agg_trip_variants", "job_trip_updates", "job_vehicle_positions", "job_business_events", "str_hourly_network", "win_family_decision",
]


def timed(spark: SparkSession, folder: str, runs: int) -> dict[str, float]:
    """Median seconds of each query after a warm-up."""
    took = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs):
            began = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - began)
        took[name] = round(statistics.median(seconds[1:]), 3)
    return took


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.local.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")}
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = timed(spark, folder, 3)
    # once more with the views stored, so that the operators alone are timed
    kept = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for name in views.VIEWS:
        views.load(spark, folder, name).write.parquet(f"{kept}/{name}")
    views.load = lambda spark, folder, name: spark.read.parquet(f"{kept}/{name}")
    alone = timed(spark, folder, 2)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "on_stored_views": alone, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
