"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbwatch.plans import catalog, derived  # noqa: E402
from kerbwatch.session import build_session, ship_package  # noqa: E402

HEADLINE = [
    "flagship_crossings_by_hour", "f02_checked_crossings", "i01_centroid_tracks", "i02_i07_lane_violations",
    "i06_red_light_on_tracks", "i06_red_light_from_detections", "i05_helmet_violations", "c03_zone_filter",
    "d04_heads_to_persons", "d04_heads_to_persons_exact", "d05_person_on_vehicle", "d06_top_riders", "d06_riders_exact",
    "d07_without_helmet", "g06_suppressed_boxes", "g06_suppressed_boxes_exact", "d12_first_of_cluster",
    "d13_nearest_in_previous_frame", "f03_first_red_crossing", "f04_cooldown", "e10_frame_light", "e11_light_from_pixels",
    "d02_recent_violations", "d03_e07_camera_stats", "e01_e04_window_counts", "e05_hourly_trend", "e08_hourly_summary",
    "g01_page", "d11_g03_merged_feed", "a07_insert_new", "a08_summary_sum", "i09_hourly_stream", "j01_batch_scoring",
]
RULES = ("i01_centroid_tracks", "i02_i07_lane_violations", "i06_red_light_from_detections", "i05_helmet_violations")


def warm_up(spark) -> None:
    """Start the JVM's and the Python workers' first job before anything is timed; it touches no benchmark table."""
    ship_package(spark)
    rows = spark.range(10_000, numPartitions=spark.sparkContext.defaultParallelism)
    rows.mapInArrow(lambda batches: batches, "id bigint").groupBy((F.col("id") % 7).alias("k")).count().collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("OFF")
    warm_up(spark)
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    start = time.perf_counter()
    detections = derived.boxes(spark, sf_dir).count()
    seconds["derive_detections"] = round(time.perf_counter() - start, 3)
    for name in wanted:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "detections": detections,
        "detections_per_sec": {n: round(detections / seconds[n]) for n in RULES if n in seconds},
    }))


if __name__ == "__main__":
    main()
