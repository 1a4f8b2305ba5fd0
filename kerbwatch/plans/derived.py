"""Road-event tables derived from the benchmark tables, so that every query grows with its input.

The same arithmetic is stated once more in SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.session import materialise
from kerbwatch.sources import config

FRAME_W, FRAME_H = 1920, 1080

# Made-up geometry of three cameras and the default entry; the SQL of the queries states the same.
CAMERA_CONFIG = """{
 "_comment": "one entry per camera",
 "default": {"stop_line": {"y": 640, "tolerance": 30},
             "traffic_light_roi": {"x1": 900, "y1": 360, "x2": 1040, "y2": 470}},
 "cam1": {"frame_width": 1920, "frame_height": 1080,
          "stop_line": {"y": 700, "tolerance": 30, "violation_direction": "above"},
          "traffic_light_roi": {"x1": 60, "y1": 40, "x2": 220, "y2": 230},
          "detection_zone": [[500, 260], [1420, 280], [1820, 1040], [90, 1000]],
          "lane_lines": [{"x1": 700, "y1": 300, "x2": 480, "y2": 980, "type": "solid"},
                         {"x1": 960, "y1": 300, "x2": 980, "y2": 980, "type": "dashed"},
                         {"x1": 1220, "y1": 310, "x2": 1460, "y2": 970, "type": "solid"}],
          "lane_crossing_threshold": 40},
 "cam2": {"frame_width": 1280, "frame_height": 720,
          "stop_line": {"y": 480, "tolerance": 30, "violation_direction": "below"},
          "traffic_light_roi": {"x1": 980, "y1": 500, "x2": 1110, "y2": 610},
          "detection_zone": [[300, 200], [60, 680], [1180, 690], [900, 210]]},
 "cam3": {"frame_width": 1280, "frame_height": 720,
          "stop_line": {"y": 421, "tolerance": 30, "violation_direction": "above"},
          "traffic_light_roi": {"x1": 440, "y1": 150, "x2": 530, "y2": 260},
          "detection_zone": [[421, 701], [250, 150], [640, 160], [1010, 690]]}
}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written once per session and input, then read like any stored table.

    The rules expect detections as stored columns. Left as expressions, the derivation would be repeated
    in every predicate that mentions a coordinate, and the one input file would be one task.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialise(make(), name)
    return _STORED[key]


def camera_config(spark: SparkSession) -> DataFrame:
    return stored(spark, "", "camera-config", lambda: config.config_from_text(spark, CAMERA_CONFIG).coalesce(1))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.sparkContext.defaultParallelism
    return stored(spark, sf_dir, "detections", lambda: derive_detections(spark, sf_dir, parts))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections cut to the frame."""
    return stored(spark, sf_dir, "boxes", lambda: clamped(detections(spark, sf_dir)))


def derive_detections(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """Eight frames for each scene of thirty moving objects, over three cameras."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id").repartition(parts, "event_id")
    e = e.select(
        "event_id", "user_id",
        F.expr("event_id div 3").alias("g"), (F.col("event_id") % 3).alias("role"),
        F.expr("event_id div 30").alias("scene"),
        F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"),
    )
    g_, role, k, user = F.col("g"), F.col("role"), F.col("k"), F.col("user_id")
    x0 = (g_ * 7919) % 1600 + k * ((g_ * 31) % 61 - 30)
    y0 = (g_ * 104729) % 800 + k * ((g_ * 17) % 81 - 40)
    j = user % 20 - 10
    vehicle = F.when(user % 4 == 0, 1).when(user % 4 == 1, 3).when(user % 4 == 2, 2).otherwise(5)
    head = F.when(user % 2 == 0, 6).otherwise(7)
    is_person, is_vehicle = role == 0, role == 1
    return e.select(
        F.concat(F.lit("cam"), (F.col("scene") % 3 + 1).cast("string")).alias("camera_id"),
        (F.col("scene") * 8 + k).alias("frame_number"),
        (F.col("scene") * F.lit(60.0) + k * F.lit(0.2)).alias("ts_sec"),
        F.col("event_id").alias("det_id"),
        F.when(is_person, 0).when(is_vehicle, vehicle).otherwise(head).alias("class_id"),
        (x0 + F.when(is_person, 0).when(is_vehicle, j - 20).otherwise(j + 10)).cast("int").alias("x"),
        (y0 + F.when(is_person, 0).when(is_vehicle, j + 70).otherwise(j + 5)).cast("int").alias("y"),
        F.when(is_person, 50).when(is_vehicle, 100).otherwise(30).alias("w"),
        F.when(is_person, 120).when(is_vehicle, 80).otherwise(30).alias("h"),
        (F.lit(0.25) + ((F.col("event_id") * 37) % 75) / F.lit(100.0)).alias("conf"),
    )


def clamped(dets: DataFrame) -> DataFrame:
    b = g.clamp(g.box(), FRAME_W, FRAME_H)
    return dets.withColumns({"x": b.x, "y": b.y, "w": b.w, "h": b.h})


def frame_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light state per frame; it changes in the middle of every scene."""
    frames = detections(spark, sf_dir).select("camera_id", "frame_number").distinct()
    phase = (F.expr("frame_number div 8") + F.expr("(frame_number % 8) div 4")) % 4
    state = F.when(phase == 0, "RED").when(phase == 1, "GREEN").when(phase == 2, "YELLOW").otherwise("UNKNOWN")
    return frames.select("camera_id", "frame_number", state.alias("light_state"))


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    vehicle = F.col("event_id") % 5
    return e.select(
        F.col("event_id").alias("violation_id"), F.col("ts").alias("detected_at"),
        F.concat(F.lit("cam"), (F.col("user_id") % 30).cast("string")).alias("camera_id"),
        F.col("user_id").alias("track_id"),
        F.when(kind == "click", "no_helmet").when(kind == "view", "RED_LIGHT")
        .when(kind == "purchase", "lane_violation").when(kind == "signup", "stop_line_crossing")
        .otherwise("red_light_running").alias("violation_type"),
        F.when(vehicle == 0, "car").when(vehicle == 1, "motorcycle").when(vehicle == 2, "bus")
        .when(vehicle == 3, "truck").alias("vehicle_type"),
        (((F.col("event_id") * 37) % 100) / F.lit(100.0)).alias("confidence"), "value", "props",
    )


def frame_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSV pixels with their place, for the frames of ten scenes; some lie outside their camera's light region."""
    p = table(spark, sf_dir, "lineitem")
    scene, k = F.col("l_orderkey") % 10, F.col("l_partkey") % 8
    camera = scene % 3
    left = F.when(camera == 0, 40).when(camera == 1, 1440).otherwise(640)
    top = F.when(camera == 0, 20).when(camera == 1, 730).otherwise(205)
    return p.select(
        F.concat(F.lit("cam"), (camera + 1).cast("string")).alias("camera_id"), (scene * 8 + k).alias("frame_number"),
        (left + (F.col("l_suppkey") * 7 + F.col("l_linenumber") * 31) % 240).alias("px"),
        (top + (F.col("l_partkey") * 13 + F.col("l_linenumber")) % 230).alias("py"),
        ((scene * 41 + k * 10 + F.col("l_suppkey") % 15) % 181).alias("h"),
        (80 + (F.col("l_suppkey") * 13 + F.col("l_partkey")) % 176).alias("s"),
        (80 + (F.col("l_orderkey") * 29 + F.col("l_suppkey")) % 176).alias("v"))


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("cam"), F.col("n_nationkey").cast("string")).alias("camera_id"),
        F.col("n_name").alias("name"), F.col("r_name").alias("location"),
        (F.col("n_nationkey") % 5 != 0).alias("is_active"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSV pixels (hue 0-180) of twenty light crops."""
    p = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 20).alias("image_id"),
                                                "l_orderkey", "l_partkey", "l_suppkey")
    return p.select(
        "image_id",
        ((F.col("image_id") * 37 + F.col("l_partkey") % 25) % 181).alias("h"),
        ((F.col("l_suppkey") * 13 + F.col("l_partkey")) % 256).alias("s"),
        ((F.col("l_orderkey") * 29 + F.col("l_suppkey")) % 256).alias("v"),
    )


def newest(violations_df: DataFrame):
    """``as_of`` for the relative time windows: the newest detection in the table."""
    return violations_df.agg(F.max("detected_at")).first()[0]
