"""Traffic-light state from detections or from pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.session import broadcast_checked

# Inclusive HSV ranges (hue 0-180) and the least number of pixels.
HSV = {
    "red_lower1": (0, 100, 100), "red_upper1": (10, 255, 255),
    "red_lower2": (160, 100, 100), "red_upper2": (180, 255, 255),
    "green_lower": (40, 100, 100), "green_upper": (80, 255, 255),
    "yellow_lower": (20, 100, 100), "yellow_upper": (35, 255, 255),
}
MIN_PIXELS = 50


def frame_state(lights: DataFrame, keys: Sequence[str] = ("camera_id", "frame_number"),
                state: str = "state") -> DataFrame:
    """One state per frame from the lights seen in it: any red, else any green, else any yellow."""
    seen = {colour: F.bool_or(F.col(state) == colour) for colour in ("RED", "GREEN", "YELLOW")}
    pick = (F.when(seen["RED"], "RED").when(seen["GREEN"], "GREEN").when(seen["YELLOW"], "YELLOW")
            .otherwise("UNKNOWN"))
    return lights.groupBy(*keys).agg(pick.alias("light_state"))


def _inside(lower, upper) -> Column:
    def bound(limit, i):
        return F.get(limit, F.lit(i)) if isinstance(limit, Column) else F.lit(limit[i])

    tests = [F.col(channel).between(bound(lower, i), bound(upper, i)) for i, channel in enumerate("hsv")]
    return tests[0] & tests[1] & tests[2]


def _ranges(ranges) -> dict[str, Column]:
    def limit(name):
        if ranges is None:
            return HSV[name]
        return F.coalesce(ranges.getField(name), F.array(*map(F.lit, HSV[name])))

    return {
        "red": _inside(limit("red_lower1"), limit("red_upper1")) | _inside(limit("red_lower2"), limit("red_upper2")),
        "green": _inside(limit("green_lower"), limit("green_upper")),
        "yellow": _inside(limit("yellow_lower"), limit("yellow_upper")),
    }


def colour_state(red: Column, green: Column, yellow: Column, min_pixels: int = MIN_PIXELS) -> Column:
    """Red and green must be the strict maximum; yellow only has to be frequent enough."""
    return (F.when((red > green) & (red > yellow) & (red > min_pixels), "RED")
            .when((green > red) & (green > yellow) & (green > min_pixels), "GREEN")
            .when(yellow > min_pixels, "YELLOW").otherwise("UNKNOWN"))


def state_from_pixels(pixels: DataFrame, keys: Sequence[str] = ("image_id",), ranges: Column | None = None,
                      min_pixels: int = MIN_PIXELS) -> DataFrame:
    """Classify light crops given as pixels(h, s, v): one conditional count per colour.

    ``ranges`` may be a per-row struct of thresholds (a camera's own colour settings).
    """
    tests = _ranges(ranges)
    counts = pixels.groupBy(*keys).agg(*(F.count_if(test).alias(f"{name}_pixels") for name, test in tests.items()))
    return counts.withColumn("light_state", colour_state(
        F.col("red_pixels"), F.col("green_pixels"), F.col("yellow_pixels"), min_pixels))


def in_light_region(pixels: DataFrame, px: str = "px", py: str = "py") -> DataFrame:
    """Keep the pixels of the configured light region (far edges excluded, as in a crop)."""
    return pixels.where((F.col(px) >= F.greatest(F.lit(0), F.col("light_x1"))) & (F.col(px) < F.col("light_x2"))
                        & (F.col(py) >= F.greatest(F.lit(0), F.col("light_y1"))) & (F.col(py) < F.col("light_y2")))


def camera_light(pixels: DataFrame, cfg: DataFrame, keys: Sequence[str] = ("camera_id", "frame_number"),
                 min_pixels: int = MIN_PIXELS) -> DataFrame:
    """Light state of every frame from its pixels (px, py, h, s, v), each camera with its own region and colours.

    One range join with the (size-checked) configuration: a pixel meets its camera's entry if it lies in the entry's light
    region, so all others end before the count. A camera without a region has no state; a frame without a pixel in
    the region is UNKNOWN. Colours that an entry does not set take the usual ranges.
    """
    keys = list(keys)
    regions = cfg.where("light_x1 IS NOT NULL").select(
        F.col("camera_id").alias("_camera"), *(f"light_{c}" for c in ("x1", "y1", "x2", "y2")), "color_detection")
    regions = broadcast_checked(regions)
    tests = _ranges(F.col("color_detection"))
    within = in_light_region(pixels.join(regions, F.col("camera_id") == F.col("_camera")))
    counts = within.groupBy(*keys).agg(*(F.count_if(test).alias(f"{name}_pixels") for name, test in tests.items()))
    seen = pixels.join(regions, F.col("camera_id") == F.col("_camera"), "left_semi").select(*keys).distinct()
    names = [f"{name}_pixels" for name in tests]
    out = seen.join(counts, keys, "left").fillna(0, names)
    return out.withColumn("light_state", colour_state(*(F.col(n) for n in names), min_pixels))
