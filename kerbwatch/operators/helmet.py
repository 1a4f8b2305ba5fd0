"""Missing-helmet rule: direct head detections first, then riders without a helmet over their head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators import fold, relate, rules
from kerbwatch.operators.prefix import split_hot
from kerbwatch.session import materialise

FRAME = relate.FRAME

# Confidences where a part of the evidence is missing.
HEAD_ONLY, OFF_VEHICLE, FALLBACK_FACTOR = 0.6, 0.3, 0.6


def class_counts(dets: DataFrame, keys=tuple(FRAME)) -> DataFrame:
    """Persons, two-wheelers, helmets and bare heads per frame."""
    c = F.col("class_id")
    return dets.groupBy(*keys).agg(
        F.count_if(c == g.PERSON).alias("persons_detected"), F.count_if(c.isin(*g.TWO_WHEELERS)).alias("vehicles_detected"),
        F.count_if(c == g.WITH_HELMET).alias("helmets_detected"),
        F.count_if(c == g.WITHOUT_HELMET).alias("no_helmets_detected"))


def direct_confidence(person_conf: Column, vehicle_conf: Column, head_conf: Column) -> Column:
    """Confidence of a direct head detection; null person or vehicle means none was found."""
    mixed = g.violation_confidence(F.coalesce(person_conf, F.lit(HEAD_ONLY)),
                                   F.coalesce(vehicle_conf, F.lit(OFF_VEHICLE)), head_conf)
    return g.boosted(mixed, vehicle_conf.isNotNull())


def direct_method(on_vehicle: Column) -> Column:
    return F.when(on_vehicle, "direct_no_helmet").otherwise("head_only_detection")


def _plain(item: Column) -> Column:
    return F.struct(*(item.getField(c).alias(c) for c in "xywh"))


def candidates(dets: DataFrame, max_boxes: int = relate.MAX_BOXES) -> DataFrame:
    """Ordered violation candidates of each frame: everything that needs no memory."""
    wanted = dets.where(F.col("class_id").isin(g.PERSON, *g.TWO_WHEELERS, g.WITH_HELMET, g.WITHOUT_HELMET))
    usual, hot = split_hot(wanted, FRAME, max_boxes)
    out = _candidates(usual, None)
    return out if hot is None else out.unionByName(_candidates(hot, relate.CELL))


def _candidates(dets: DataFrame, cell: int | None) -> DataFrame:
    """Candidates of small frames (``cell=None``) or, keyed by grid cells and by rounds, of oversized ones."""
    c, max_boxes = F.col("class_id"), None if cell is None else 0
    persons, vehicles = dets.where(c == g.PERSON), dets.where(c.isin(*g.TWO_WHEELERS))
    helmets, heads = dets.where(c == g.WITH_HELMET), dets.where(c == g.WITHOUT_HELMET)

    def with_twin(df: DataFrame) -> DataFrame:
        """Add the first box of the frame with the same place and size: detectors do repeat boxes."""
        first = F.min(F.struct("det_id", "conf")).over(Window.partitionBy(*FRAME, *"xywh"))
        # small frames are dealt as the join of riders needs them, so they move once
        return (df if cell is not None else df.repartition(*FRAME)).withColumn("twin", first)

    # direct: bare heads with their person, and the vehicle that person (or the head itself) is on
    head = F.struct("det_id", "x", "y", "w", "h", "conf").alias("head")
    matched = relate.assign_heads(heads, persons, max_boxes=max_boxes).join(
        heads.select(*FRAME, F.col("det_id").alias("head_det_id"), "ts_sec", head), [*FRAME, "head_det_id"])
    matched = materialise(matched, "matched-heads")  # read three times below
    standing = matched.select(*FRAME, F.coalesce("person", "head").alias("b"), "head_det_id").select(
        *FRAME, F.col("head_det_id").alias("det_id"), "b.x", "b.y", "b.w", "b.h", "b.conf")
    mounted = relate.on_vehicle(standing, vehicles, cell=cell).withColumnRenamed("person_det_id", "head_det_id")
    on = F.col("vehicle_conf").isNotNull()
    direct = matched.join(mounted, [*FRAME, "head_det_id"], "left").select(
        *FRAME, "ts_sec", F.lit(True).alias("direct"), F.col("head_det_id").alias("place"), F.lit(0.0).alias("wish"),
        F.lit(0).cast("bigint").alias("rider"), F.col("person.det_id").alias("person"),
        _plain(F.coalesce("person", "head")).alias("box"), _plain(F.col("head")).alias("head_box"),
        direct_confidence(F.col("person.conf"), F.col("vehicle_conf"), F.col("head.conf")).alias("confidence"),
        direct_method(on).alias("method"), on.alias("on_vehicle"), F.lit(False).alias("has_helmet"))

    # fallback: riders whose person no head has claimed, with or without a helmet over their head
    bare = relate.without_helmet(persons, helmets).select(*FRAME, F.col("det_id").alias("person_det_id"),
                                                          F.lit(True).alias("bare"))
    claimed = matched.where("person_det_id IS NOT NULL").select(*FRAME, F.col("person_det_id").alias("first_id"))
    riders = (relate.assign_riders(with_twin(persons), with_twin(vehicles), max_boxes=max_boxes, extra=["twin", "ts_sec"])
              .withColumn("first_id", F.col("person_twin.det_id"))
              .join(claimed, [*FRAME, "first_id"], "left_anti").join(bare, [*FRAME, "person_det_id"], "left"))
    strip = g.head_region(g.box_of(F.col("person")), relate.HEAD_RATIO)
    fallback = riders.select(
        *FRAME, F.col("person_ts_sec").alias("ts_sec"), F.lit(False).alias("direct"), F.col("vehicle_det_id").alias("place"), "wish",
        F.col("person_det_id").alias("rider"), F.col("first_id").alias("person"),
        _plain(F.col("person")).alias("box"), F.struct(*(v.alias(n) for n, v in zip("xywh", strip))).alias("head_box"),
        g.violation_confidence(F.col("person_twin.conf"), F.col("vehicle_twin.conf"), F.lit(FALLBACK_FACTOR)).alias("confidence"),
        F.lit("fallback_no_helmet").alias("method"), F.lit(True).alias("on_vehicle"),
        F.col("bare").isNull().alias("has_helmet"))
    return direct.unionByName(fallback)


ORDER = ["frame_number", "strategy", "place", "wish", "rider"]


def ordered_candidates(dets: DataFrame, max_boxes: int = relate.MAX_BOXES) -> DataFrame:
    """Candidates with the point they are compared by and flat order columns: input of ``rules.HelmetWatch``."""
    found = candidates(dets, max_boxes)
    seen = F.when(F.col("direct"), F.col("head_box")).otherwise(F.col("box"))
    return found.withColumns({
        "cx": g.box_of(seen).mid_x, "cy": g.box_of(seen).mid_y, "strategy": F.when(F.col("direct"), 1).otherwise(2)})


def helmet_watch(dets: DataFrame, max_boxes: int = relate.MAX_BOXES, **chunks) -> DataFrame:
    """Violations and protected riders with their track, after repeat suppression."""
    return fold.run_rule(ordered_candidates(dets, max_boxes), rules.HelmetWatch(), ["camera_id"], ORDER,
                         ["frame_number", "ts_sec", "box", "head_box", "confidence", "method", "on_vehicle"],
                         new_id="track_id", **chunks)


def helmet_violations(dets: DataFrame, **options) -> DataFrame:
    return helmet_watch(dets, **options).where("violation").drop("violation")
