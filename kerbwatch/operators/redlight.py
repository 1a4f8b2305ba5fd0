"""Red-light and stop-line rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators import fold, rules, select, tracking
from kerbwatch.operators.light import camera_light
from kerbwatch.session import materialise
from kerbwatch.sources import config

MIN_CONF = 0.4
CONFIDENCE = 0.9


def past_line(dets: DataFrame) -> Column:
    """Bottom centre strictly beyond the camera's stop line (defaults where the entry has none)."""
    _, foot = g.bottom_center(g.box())
    return g.past_stop_line(foot, F.coalesce("stop_y", F.lit(config.STOP_Y)), F.col("direction"))


def red_light_inputs(dets: DataFrame, cfg: DataFrame, light: DataFrame, min_conf: float = MIN_CONF,
                     classes: Iterable[int] = tuple(g.ROAD_VEHICLES)) -> DataFrame:
    """Vehicles in the zone of configured cameras, with the light state of their frame."""
    vehicles = select.of_classes(dets, classes, min_conf)
    flat, edges = config.flat_zone(cfg.select("camera_id", "zone", "stop_y", "direction"))
    zoned = select.in_detection_zone(config.with_own_config(vehicles, flat), edges)
    lit = zoned.join(light.select("camera_id", "frame_number", "light_state"), ["camera_id", "frame_number"], "left")
    return lit.withColumns({"past_line": past_line(lit),
                            "is_red": F.coalesce(F.col("light_state") == "RED", F.lit(False)),
                            "vehicle_type": g.class_name(F.col("class_id"))})


def first_red_crossings(rows: DataFrame, keys=("camera_id", "track_id")) -> DataFrame:
    """First sighting of each track beyond the line while the light is red.

    One aggregation with map-side merging instead of a window, so a long track costs one row per task.
    """
    hit = rows.where(F.col("is_red") & F.col("past_line"))
    first = F.min(F.struct("frame_number", "det_id", "ts_sec", "vehicle_type", "x", "y", "w", "h"))
    return hit.groupBy(*keys).agg(first.alias("f")).select(*keys, "f.*")


def first_transitions(rows: DataFrame, keys=("camera_id", "track_id")) -> DataFrame:
    """Stricter form: only tracks whose first sighting beyond the line, under any light, is under red."""
    hit = rows.where("past_line")
    first = F.min(F.struct("frame_number", "det_id", "ts_sec", "is_red"))
    return (hit.groupBy(*keys).agg(first.alias("f")).where("f.is_red")
            .select(*keys, "f.frame_number", "f.det_id", "f.ts_sec"))


def red_light_violations(dets: DataFrame, cfg: DataFrame, light: DataFrame, min_conf: float = MIN_CONF,
                         classes: Iterable[int] = tuple(g.ROAD_VEHICLES), require_transition: bool = False,
                         **chunks) -> DataFrame:
    """The whole red-light rule from raw detections: gate, zone, light, tracking, first crossing."""
    rows = tracking.with_centroid(red_light_inputs(dets, cfg, light, min_conf, classes))
    out = fold.run_rule(rows, rules.RedLightWatch(require_transition=require_transition), ["camera_id"],
                        tracking.ORDER, ["frame_number", "ts_sec", "det_id", "x", "y", "w", "h"],
                        new_id="track_id", **chunks)
    return out.withColumnRenamed("first_type", "vehicle_type").withColumn("confidence", F.lit(CONFIDENCE))


def red_light_violations_on_tracks(dets: DataFrame, cfg: DataFrame, light: DataFrame,
                                   min_conf: float = MIN_CONF,
                                   classes: Iterable[int] = tuple(g.ROAD_VEHICLES)) -> DataFrame:
    """The red-light rule for detections that already carry ``track_id``."""
    return first_red_crossings(red_light_inputs(dets, cfg, light, min_conf, classes))


def red_light_violations_from_pixels(dets: DataFrame, pixels: DataFrame, cfg: DataFrame, **options) -> DataFrame:
    """The whole rule without a light detector: states come from each camera's light region and colours."""
    lit = materialise(camera_light(pixels, cfg), "light-states")
    rule = red_light_violations_on_tracks if "track_id" in dets.columns else red_light_violations
    return rule(dets, cfg, lit, **options)


# ---------------------------------------------------------------- frame-level rule on detection arrays


def light_in(items: Column) -> Column:
    """Light state of a detection array: any red, else any green, else any yellow."""
    def shows(colour: str) -> Column:
        return F.exists(items, lambda d: (d.getField("class_name") == "traffic light") & (d.getField("state") == colour))

    return (F.when(shows("RED"), "RED").when(shows("GREEN"), "GREEN").when(shows("YELLOW"), "YELLOW")
            .otherwise("UNKNOWN"))


def stop_line_items(items: Column, stop_y: Column) -> Column:
    """Violations of one frame: vehicles whose centre is below the stop line while a light shows red."""
    def over(d: Column) -> Column:
        vehicle = d.getField("class_name").isin(*g.ROAD_VEHICLES.values())
        return vehicle & (F.get(d.getField("center"), F.lit(1)) > stop_y)

    def report(d: Column) -> Column:
        return F.struct(
            F.lit("stop_line_crossing").alias("type"), d.getField("class_name").alias("vehicle"),
            d.getField("confidence").cast("double").alias("confidence"),
            d.getField("center").cast("array<double>").alias("position"), F.lit("RED").alias("traffic_light_state"))

    found = F.transform(F.filter(items, over), report)
    return F.when((light_in(items) == "RED") & stop_y.isNotNull(), found).otherwise(F.slice(found, 1, 0))


def stop_line_violations(frames: DataFrame, cfg: DataFrame, items: str = "detections") -> DataFrame:
    """Frames (with a detection array) that have violations; stateless, no Python, no shuffle."""
    known = config.with_own_config(frames, cfg.select("camera_id", "stop_y"))
    found = known.withColumn("violations", stop_line_items(F.col(items), F.col("stop_y")))
    return found.where(F.size("violations") > 0).drop("stop_y")
