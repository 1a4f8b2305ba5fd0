"""Tracks: identity over time, first-seen type, lifetimes, next-frame neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators import cuts, fold, rules
from kerbwatch.operators.pointers import same_keys
from kerbwatch.operators.prefix import with_previous, with_running_sum
from kerbwatch.session import materialise

ORDER = ("frame_number", "det_id")
FRAMES_PER_BUCKET = 50_000


def with_centroid(dets: DataFrame) -> DataFrame:
    cx, cy = g.centroid(g.box())
    return dets.withColumn("cx", cx.cast("double")).withColumn("cy", cy.cast("double"))


def track(dets: DataFrame, max_distance: float = rules.VEHICLE_DISTANCE, ttl: float = rules.VEHICLE_TTL,
          **chunks) -> DataFrame:
    """Exact per-camera centroid tracking: (camera, frame, det_id) with track_id and is_new.

    Pieces of a camera that no track can connect (see ``cuts``) are tracked apart. Tracks are numbered per camera in
    order of their first box. Boxes without a place or time are left out.
    """
    points = with_centroid(dets).where("cx IS NOT NULL AND cy IS NOT NULL AND ts_sec IS NOT NULL")
    points = cuts.with_piece(points.select("camera_id", "frame_number", "det_id", "ts_sec", "cx", "cy"), ["camera_id"], max_distance, ttl)
    found = fold.run_rule(points, rules.Tracker(max_distance, ttl), ["camera_id", "_piece"], ORDER,
                          ["frame_number", "det_id", "ts_sec"], new_id="track_id", **chunks)
    found = materialise(found, "tracks")
    first = with_running_sum(found.where("is_new"), ["camera_id"], ["ts_sec", *ORDER], "_number", F.lit(1), 3600.0)
    own = ["camera_id", "_piece", "track_id"]
    numbered = same_keys(found, first.select(*own, "_number"), own, "inner")
    return numbered.select("camera_id", "frame_number", "det_id", F.col("_number").alias("track_id"), "is_new")


def first_type(dets: DataFrame, keys: Sequence[str] = ("camera_id", "track_id"), value: str = "vehicle_type",
               order: Sequence[str] = ORDER) -> DataFrame:
    """Type of each track at its first sighting; partial aggregation, so no track is gathered."""
    return dets.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(value))


def lifetimes(dets: DataFrame, ttl: float, keys: Sequence[str] = ("camera_id", "track_id"), ts: str = "ts_sec",
              width: float = 3600.0) -> DataFrame:
    """Sightings closer than ``ttl`` belong together: numbers each track's lifetimes from 1."""
    seen = with_previous(dets, keys, [ts, "frame_number"], {"_last_ts": ts}, width)
    starts = (F.col("_last_ts").isNull() | (F.col(ts) - F.col("_last_ts") > F.lit(ttl))).cast("int")
    return with_running_sum(seen, keys, [ts, "frame_number"], "lifetime", starts, width).drop("_last_ts")


def nearest_in_previous_frame(dets: DataFrame, max_distance: float = rules.VEHICLE_DISTANCE) -> DataFrame:
    """For each box the closest box of the preceding frame number: the relational view of tracking.

    Candidates meet on camera, frame and a grid cell twice as wide as the reach, so a box looks into at
    most four cells and a crowded frame is spread over many join keys.
    """
    size = 2.0 * max_distance
    p = with_centroid(dets).select("camera_id", "frame_number", "det_id", "cx", "cy")

    def reach(value):
        return F.explode(F.sequence(F.floor((value - max_distance) / size), F.floor((value + max_distance) / size)))

    now = p.withColumn("gx", F.floor(F.col("cx") / size)).withColumn("gy", F.floor(F.col("cy") / size))
    before = (p.select("camera_id", (F.col("frame_number") + 1).alias("frame_number"),
                       F.col("det_id").alias("prev_det_id"), F.col("cx").alias("px"), F.col("cy").alias("py"))
              .withColumn("gx", reach(F.col("px"))).withColumn("gy", reach(F.col("py"))))
    dx, dy = F.col("cx") - F.col("px"), F.col("cy") - F.col("py")
    pairs = (now.join(before, ["camera_id", "frame_number", "gx", "gy"])
             .withColumn("distance", F.sqrt(dx * dx + dy * dy)).where(F.col("distance") <= F.lit(max_distance)))
    return (pairs.groupBy("camera_id", "frame_number", "det_id").agg(F.min(F.struct("distance", "prev_det_id")).alias("m"))
            .select("camera_id", "frame_number", "det_id", "m.prev_det_id", "m.distance"))


def frame_index(frames: DataFrame) -> DataFrame:
    """Consecutive numbers for the frames a camera really delivered."""
    distinct = frames.select("camera_id", "frame_number").distinct()
    return with_running_sum(distinct, ["camera_id"], ["frame_number"], "frame_index", F.lit(1), FRAMES_PER_BUCKET)


def cadence(frames: DataFrame, interval: float, width: float = 3600.0) -> DataFrame:
    """Frame n is due at start + n * interval: lag behind that plan and gap to the frame before."""
    f = frames.select("camera_id", "frame_number", "ts_sec").distinct()
    order = ["ts_sec", "frame_number"]
    numbered = with_running_sum(f, ["camera_id"], order, "n", F.lit(1), width)
    gaps = with_previous(numbered, ["camera_id"], order, {"prev_ts": "ts_sec"}, width)
    start = f.groupBy(F.col("camera_id").alias("_cam")).agg(F.min("ts_sec").alias("start_ts"))
    due = F.col("start_ts") + F.col("n") * F.lit(interval)
    return (gaps.join(start, F.col("camera_id") == F.col("_cam")).drop("_cam")
            .select("camera_id", "frame_number", "n", due.alias("due_ts"), (F.col("ts_sec") - due).alias("behind"),
                    (F.col("ts_sec") - F.col("prev_ts")).alias("gap")))
