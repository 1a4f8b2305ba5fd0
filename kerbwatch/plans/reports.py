"""Dashboard and reporting queries over the violations and cameras tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.functions import fields
from kerbwatch.operators import select
from kerbwatch.operators.dedup import first_rows

MAX_PAGE = 100
NEAR_PAGES = 10_000
LIVE_ROWS, FEED_ROWS, FIRST_ROWS = 100, 50, 10


# ---------------------------------------------------------------- views


def recent_violations(violations: DataFrame, cameras: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """Last 24 hours with the camera name; violations of unknown cameras stay."""
    recent = violations.where(select.since("detected_at", as_of, "24 HOURS"))
    names = cameras.select("camera_id", F.col("name").alias("camera_name"))
    image = [c for c in ("image_path",) if c in violations.columns]
    out = recent.join(names, "camera_id", "left").select(
        "violation_id", "camera_id", "camera_name", "violation_type", "vehicle_type", "confidence", "detected_at", *image)
    return out.orderBy(F.desc("detected_at")) if ordered else out


def camera_violation_stats(violations: DataFrame, cameras: DataFrame, as_of=None) -> DataFrame:
    """Violations and active hours of the last 24 hours for every active camera, quiet ones included.

    Violations are counted per camera before the join, so a busy camera never becomes a join key.
    """
    counts = (violations.where(select.since("detected_at", as_of, "24 HOURS")).groupBy("camera_id")
              .agg(F.count("violation_id").alias("n"), F.count_distinct(F.date_trunc("hour", "detected_at")).alias("h")))
    return (cameras.where(F.coalesce("is_active", F.lit(True))).join(counts, "camera_id", "left").select(
        "camera_id", F.col("name").alias("camera_name"), "location",
        F.coalesce("n", F.lit(0)).alias("total_violations_24h"), F.coalesce("h", F.lit(0)).alias("active_hours"))
        .orderBy(F.desc("total_violations_24h"), "camera_id"))


def hourly_trend(violations: DataFrame, as_of=None) -> DataFrame:
    hour = F.date_trunc("hour", "detected_at")
    return (violations.where(select.since("detected_at", as_of, "24 HOURS"))
            .groupBy(hour.alias("hour"), "violation_type").agg(F.count("*").alias("count"))
            .orderBy(F.desc("hour"), "violation_type"))


def daily_summary(violations: DataFrame) -> DataFrame:
    day = F.date_trunc("day", "detected_at")
    return violations.groupBy("camera_id", day.alias("day"), "violation_type").agg(F.count("*").alias("count"))


def model_performance(registry: DataFrame) -> DataFrame:
    """Registered models with two metrics pulled out of their JSON."""
    def metric(name: str) -> Column:
        return F.get_json_object("metrics", f"$.{name}")

    return registry.select("model_name", F.col("timestamp").alias("trained_at"), "is_production",
                           metric("Accuracy").alias("accuracy"), metric("F1").alias("f1_score"), "created_at"
                           ).orderBy(F.desc("created_at"))


# ---------------------------------------------------------------- statistics


def window_counts(violations: DataFrame, as_of=None) -> DataFrame:
    """Total, today, last hour and last 15 minutes in one scan."""
    return violations.agg(
        F.count("*").alias("total"), F.count_if(select.same_day("detected_at", as_of)).alias("today"),
        F.count_if(select.since("detected_at", as_of, "1 HOUR", inclusive=True)).alias("last_hour"),
        F.count_if(select.since("detected_at", as_of, "15 MINUTES")).alias("last_15_minutes"))


def count_by(violations: DataFrame, *columns: str) -> DataFrame:
    return violations.groupBy(*columns).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *columns)


def combined_stats(sources: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Window counts summed over several violation sources, plus each source's own."""
    parts = None
    for name, df in sources.items():
        one = window_counts(df, as_of).withColumn("source", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    sums = {c: F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "today", "last_hour")}
    own = [F.coalesce(F.sum(F.when(F.col("source") == name, F.col(c))), F.lit(0)).alias(f"{name}_{c}")
           for name in sources for c in ("total", "today", "last_hour")]
    return parts.agg(*sums.values(), *own)


def hourly_breakdown(violations: DataFrame) -> DataFrame:
    """Counts per camera, hour and value of both breakdowns, in long form (one scan, one shuffle)."""
    items = F.array(F.struct(F.lit("vehicle").alias("kind"), F.coalesce("vehicle_type", F.lit("unknown")).alias("value")),
                    F.struct(F.lit("violation").alias("kind"), F.col("violation_type").alias("value")))
    return (violations.select("camera_id", F.date_trunc("hour", "detected_at").alias("hour_bucket"),
                              F.inline(items)).groupBy("camera_id", "hour_bucket", "kind", "value")
            .agg(F.count("*").alias("n")))


def hourly_summary(violations: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """One row per camera and hour with totals and both breakdowns as maps.

    Counting happens before the maps are built, so a map is made of a handful of counted values.
    ``frames`` (camera_id, captured_at, detection_count) adds frame and detection totals.
    """
    def as_map(kind: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("value", "n"))))
        return F.map_from_entries(pairs)

    out = hourly_breakdown(violations).groupBy("camera_id", "hour_bucket").agg(
        F.sum(F.when(F.col("kind") == "violation", F.col("n"))).alias("total_violations"),
        as_map("vehicle").alias("vehicle_breakdown"), as_map("violation").alias("violation_breakdown"))
    if frames is None:
        return out.withColumns({"total_frames": F.lit(0).cast("bigint"), "total_detections": F.lit(0).cast("bigint")})
    seen = frames.groupBy("camera_id", F.date_trunc("hour", "captured_at").alias("hour_bucket")).agg(
        F.count("*").alias("total_frames"), F.coalesce(F.sum("detection_count"), F.lit(0)).alias("total_detections"))
    zero, none = F.lit(0).cast("bigint"), F.create_map().cast("map<string,bigint>")
    return out.join(seen, ["camera_id", "hour_bucket"], "full").withColumns({
        **{c: F.coalesce(c, zero) for c in ("total_violations", "total_frames", "total_detections")},
        **{c: F.coalesce(c, none) for c in ("vehicle_breakdown", "violation_breakdown")}})


def stream_stats(frames: DataFrame, sent: Column, ts: str = "ts_sec") -> DataFrame:
    """Frames seen and sent, elapsed seconds and average rate per camera."""
    elapsed = F.max(ts) - F.min(ts)
    n_sent = F.count_if(sent)
    return frames.groupBy("camera_id").agg(
        F.count("*").alias("frames_seen"), n_sent.alias("frames_sent"), elapsed.alias("elapsed"),
        F.when(elapsed > 0, n_sent / elapsed).otherwise(F.lit(0.0)).alias("avg_fps"))


def latest_frames(frames: DataFrame, order: Sequence[str] = ("ts_sec", "frame_number")) -> DataFrame:
    """Newest frame of every camera, by aggregation (no per-camera sort)."""
    rest = [c for c in frames.columns if c != "camera_id"]
    return (frames.groupBy("camera_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("f"))
            .select("camera_id", "f.*"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with their row counts (null keys are allowed, as in a foreign key)."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key or key).alias(key))
    return keys.join(known, key, "left_anti")


def broken_references(references: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """reference, value, rows: values of every child table's key that its parent table does not have, nulls aside."""
    out = None
    for name, (child, parent, key) in references.items():
        found = orphans(child.where(F.col(key).isNotNull()), parent, key)
        found = found.select(F.lit(name).alias("reference"), F.col(key).cast("string").alias("value"), "rows")
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------- pages and feeds


def page(violations: DataFrame, skip: int = 0, limit: int = 50, ts: str = "detected_at", key: str = "violation_id",
         **filters) -> DataFrame:
    """One page, newest first, ties by id. Deep pages first skip whole days by counting."""
    if skip < 0 or not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"skip must be >= 0 and limit between 1 and {MAX_PAGE}")
    rows = select.matching(violations, **filters)
    if skip > NEAR_PAGES:
        rows, skip = _without_newer(rows, skip, limit, ts)
    return rows.orderBy(F.desc(ts), key).offset(skip).limit(limit)


def _without_newer(rows: DataFrame, skip: int, limit: int, ts: str) -> tuple[DataFrame, int]:
    """Drop the minutes that lie completely before the page, so that few rows are left to sort."""
    minute = F.date_trunc("minute", ts)
    counts = rows.groupBy(minute.alias("m")).agg(F.count("*").alias("n"))
    newer = Window.orderBy(F.desc("m")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per minute of the table: small enough for the single task an unkeyed window needs
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    around = placed.where((F.col("before") < skip + limit) & (F.col("before") + F.col("n") > skip))
    first, last, left = around.agg(F.max("m"), F.min("m"), F.min("before")).first()
    if first is None:
        return rows.where(F.lit(False)), 0
    return rows.where(minute.between(F.lit(last), F.lit(first))), int(skip - left)


def page_total(violations: DataFrame, **filters) -> DataFrame:
    return select.matching(violations, **filters).agg(F.count("*").alias("total"))


def by_id(violations: DataFrame, violation_id, key: str = "violation_id") -> DataFrame:
    return violations.where(F.col(key) == F.lit(violation_id))


def newest(violations: DataFrame, n: int = LIVE_ROWS, ts: str = "detected_at", key: str = "violation_id") -> DataFrame:
    return violations.orderBy(F.desc(ts), key).limit(n)


def tagged_feed(helmet: DataFrame, red_light: DataFrame, lane: DataFrame | None = None) -> DataFrame:
    """Union of the feeds under their dashboard types."""
    out = (helmet.withColumn("violation_type", fields.feed_type(F.col("violation_type")))
           .unionByName(red_light.withColumn("violation_type", fields.feed_type(F.col("violation_type"), F.lit(True))),
                        allowMissingColumns=True))
    if lane is None:
        return out
    return out.unionByName(lane.withColumn("violation_type", F.lit("LANE")), allowMissingColumns=True)


def merged_feed(live: DataFrame, stored: DataFrame, n: int = FEED_ROWS, ts: str = "detected_at",
                key: str = "violation_id", image: str = "image_base64") -> DataFrame:
    """Newest rows of live and stored together; a stored row takes the image of its live twin.

    Both sides are cut to their newest ``n`` first: no older row can reach the result.
    """
    live = first_rows(live, [key], [ts])
    live_only = newest(live.join(stored.select(key), key, "left_anti"), n, ts, key)
    top = newest(stored, n, ts, key)
    images = live.select(key, F.nullif(image, F.lit("")).alias("_live_image"))
    enriched = top.join(images, key, "left")
    own = F.col(image) if image in stored.columns else F.lit(None).cast("string")
    enriched = enriched.withColumn(image, F.coalesce("_live_image", own)).drop("_live_image")
    return newest(live_only.unionByName(enriched, allowMissingColumns=True), n, ts, key)
