"""Relations between boxes of one frame: who rides what, whose head is it, which boxes repeat.

Two forms are offered.

* Joins (``heads_to_persons``, ``on_vehicle`` …): equi-joins on camera, frame and a grid cell, then the
  geometric predicate. The cell keeps a crowded frame from becoming one join key.
* Exact ordered assignment (``assign_heads``, ``assign_riders``, ``suppress_overlaps``): the same predicates,
  joined per frame, leave a short list of pairs per frame, and that list is walked in order. Frames above
  ``MAX_BOXES`` boxes are never gathered; they are settled by rounds of joins that reach the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators.prefix import split_hot
from kerbwatch.session import materialise

FRAME = ["camera_id", "frame_number"]
MIN_TOUCH_IOU = 0.15
HEAD_RATIO = 0.40
MAX_RIDERS = 3
NMS_SCORE, NMS_OVERLAP = 0.5, 0.4
CELL = 256
MAX_BOXES = 1024

_ITEM = ("det_id", "x", "y", "w", "h", "conf")


# ---------------------------------------------------------------- joins


def _named(dets: DataFrame, prefix: str, extra: Sequence[str] = ()) -> DataFrame:
    return dets.select(*FRAME, *(F.col(c).alias(prefix + c) for c in (*_ITEM, *extra)))


def _cells(df: DataFrame, prefix: str, cell: int) -> DataFrame:
    """One row per grid cell a box reaches."""
    b = g.box(prefix)

    def span(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / cell), F.floor(F.greatest(low, high) / cell)))

    return df.withColumn("cell_x", span(b.x, b.right)).withColumn("cell_y", span(b.y, b.bottom))


def frame_pairs(left: DataFrame, right: DataFrame, related: Callable[[g.Box, g.Box], Column],
                lp: str = "a_", rp: str = "b_", cell: int | None = CELL,
                extra: tuple[Sequence[str], Sequence[str]] = ((), ())) -> DataFrame:
    """Pairs of one frame for which ``related`` holds; it must imply that the two boxes meet.

    A pair meets in several cells; it is reported in the one that holds the upper left corner of the
    common area. With ``cell=None`` (frames known to be small) the frame alone is the join key.
    """
    a, b = g.box(lp), g.box(rp)
    left, right = _named(left, lp, extra[0]), _named(right, rp, extra[1])
    if cell is None:
        return left.join(right, FRAME).where(related(a, b))
    corner = ((F.floor(F.greatest(a.x, b.x) / cell) == F.col("cell_x"))
              & (F.floor(F.greatest(a.y, b.y) / cell) == F.col("cell_y")))
    joined = _cells(left, lp, cell).join(_cells(right, rp, cell), [*FRAME, "cell_x", "cell_y"])
    return joined.where(corner & related(a, b)).drop("cell_x", "cell_y")


def related_ids(left: DataFrame, right: DataFrame, related: Callable[[g.Box, g.Box], Column],
                cell: int = CELL) -> DataFrame:
    """Ids of left boxes with at least one related right box. A semi-join: no pair is ever emitted."""
    keys = [*FRAME, "cell_x", "cell_y"]
    mine = _cells(_named(left, "a_"), "a_", cell)
    mine = mine.select(*(F.col(c).alias(f"l_{c}") if c in keys else c for c in mine.columns))
    same = [F.col(f"l_{c}") == F.col(c) for c in keys]
    hit = mine.join(_cells(_named(right, "b_"), "b_", cell), [*same, related(g.box("a_"), g.box("b_"))], "left_semi")
    return hit.select(*(F.col(f"l_{c}").alias(c) for c in FRAME), F.col("a_det_id").alias("det_id"))


def heads_to_persons(heads: DataFrame, persons: DataFrame, ratio: float = 0.5) -> DataFrame:
    """First person (lowest det_id) containing each head; a person may serve several heads."""
    pairs = frame_pairs(heads, persons, lambda h, p: g.head_in_person(h, p, ratio), "head_", "person_")
    return pairs.groupBy(*FRAME, "head_det_id").agg(F.min("person_det_id").alias("person_det_id"))


def on_vehicle(persons: DataFrame, vehicles: DataFrame, min_iou: float = MIN_TOUCH_IOU,
               cell: int | None = CELL) -> DataFrame:
    """First vehicle (lowest det_id) each person or head is on, with that vehicle's confidence."""
    pairs = frame_pairs(persons, vehicles, lambda p, v: g.touches(p, v, min_iou), "person_", "vehicle_", cell)
    # two plain aggregates instead of the least struct: their buffers fit a hash table, a struct's does not
    return pairs.groupBy(*FRAME, "person_det_id").agg(
        F.min_by("vehicle_conf", "vehicle_det_id").alias("vehicle_conf"), F.min("vehicle_det_id").alias("vehicle_det_id"))


def rider_candidates(persons: DataFrame, vehicles: DataFrame, min_iou: float = MIN_TOUCH_IOU,
                     cell: int | None = CELL, extra: tuple[Sequence[str], Sequence[str]] = ((), ())) -> DataFrame:
    """Scored person-vehicle pairs: overlap, plus a bonus when the feet are inside the vehicle."""
    pairs = frame_pairs(persons, vehicles, lambda p, v: g.touches(p, v, min_iou), "person_", "vehicle_", cell, extra)
    return pairs.withColumn("score", _rider_score(g.box("person_"), g.box("vehicle_")))


def _rider_score(p: g.Box, v: g.Box) -> Column:
    feet_inside = g.covers(v, *g.bottom_center(p))
    return g.iou(p, v) + F.when(feet_inside, F.lit(0.1)).otherwise(F.lit(0.0))


def top_riders(persons: DataFrame, vehicles: DataFrame, limit: int = MAX_RIDERS) -> DataFrame:
    """Best ``limit`` persons per vehicle; a person may be counted on several vehicles."""
    order = Window.partitionBy(*FRAME, "vehicle_det_id").orderBy(F.desc("score"), "person_det_id")
    ranked = rider_candidates(persons, vehicles).withColumn("rider_rank", F.row_number().over(order))
    return ranked.where(F.col("rider_rank") <= limit)


def without_helmet(persons: DataFrame, helmets: DataFrame, ratio: float = HEAD_RATIO,
                   min_iou: float = MIN_TOUCH_IOU, centre_counts: bool = False) -> DataFrame:
    """Persons with no helmet box over their head region.

    ``centre_counts`` also accepts a helmet whose centre lies in the head region.
    """
    strip = g.head_region(g.box(), ratio)
    regions = persons.withColumns({"y": strip.y, "h": strip.h})

    def protects(region: g.Box, helmet: g.Box) -> Column:
        hit = g.iou(helmet, region) >= F.lit(min_iou)
        return hit | g.covers(region, *g.centroid(helmet)) if centre_counts else hit

    protected = related_ids(regions, helmets, protects)
    return persons.join(protected, [*FRAME, "det_id"], "left_anti")


def weaker_overlaps(dets: DataFrame, min_conf: float = NMS_SCORE, overlap: float = NMS_OVERLAP) -> DataFrame:
    """Boxes that no better-scored box of the frame overlaps: a one-step form of suppression."""
    strong = dets.where(F.col("conf") > min_conf)
    beaten = related_ids(strong, strong, lambda a, b: (g.iou(a, b) > F.lit(overlap)) & _better("b_", "a_"))
    return strong.join(beaten, [*FRAME, "det_id"], "left_anti")


def _better(p: str, q: str) -> Column:
    """Box p is visited before box q: higher score, then detection order."""
    return (F.col(p + "conf") > F.col(q + "conf")) | (
        (F.col(p + "conf") == F.col(q + "conf")) & (F.col(p + "det_id") < F.col(q + "det_id")))


# ---------------------------------------------------------------- exact ordered assignment


def _first_come(pairs: DataFrame, capacity: int) -> DataFrame:
    """Takers in ascending order each take their ``capacity`` most wished free items (small frames).

    ``pairs`` has taker, wish, taken and whatever is to be carried along. One frame's pairs are walked
    once in that order; the geometry is already decided, so a step only compares numbers. A frame in which no item
    is wished for twice and no taker wishes for more than it may take needs no walk.
    """
    pairs = pairs.where("taken IS NOT NULL")
    carried = [c for c in pairs.columns if c not in FRAME and c not in ("taker", "wish", "taken")]
    row = F.struct("taker", "wish", "taken", *carried)
    ordered = pairs.groupBy(*FRAME).agg(F.sort_array(F.collect_list(row)).alias("p"))
    kind = ordered.schema["p"].dataType.simpleString()

    def take(acc: Column, r: Column) -> Column:
        n = F.when(acc.getField("taker") == r.getField("taker"), acc.getField("n")).otherwise(F.lit(0))
        free = (n < capacity) & ~F.array_contains(acc.getField("used"), r.getField("taken"))
        return F.when(free, F.struct(
            r.getField("taker").alias("taker"), (n + 1).alias("n"),
            F.array_append(acc.getField("used"), r.getField("taken")).alias("used"),
            F.array_append(acc.getField("held"), r).alias("held"),
        )).otherwise(F.struct(r.getField("taker").alias("taker"), n.alias("n"), acc.getField("used").alias("used"),
                              acc.getField("held").alias("held")))

    start = F.struct(F.lit(-1).cast("bigint").alias("taker"), F.lit(0).alias("n"),
                     F.array().cast("array<bigint>").alias("used"), F.array().cast(kind).alias("held"))
    size, takers, items = F.size("p"), F.size(F.array_distinct("p.taker")), F.size(F.array_distinct("p.taken"))
    held = F.when((items == size) & (size - takers < capacity), F.col("p")).otherwise(
        F.aggregate("p", start, take, lambda acc: acc.getField("held")))
    return ordered.select(*FRAME, F.inline(held))


def _assigned(pairs_of: Callable[[DataFrame, int | None], DataFrame], boxes: DataFrame, capacity: int,
              max_boxes: int | None) -> DataFrame:
    """Taker-taken rows for all frames; ``max_boxes=None`` says that no frame is oversized."""
    usual, hot = (boxes, None) if max_boxes is None else split_hot(boxes, FRAME, max_boxes)
    held = _first_come(pairs_of(usual, None), capacity)
    return held if hot is None else held.unionByName(settle(pairs_of(hot, CELL), capacity))


def assign_heads(heads: DataFrame, persons: DataFrame, ratio: float = 0.5,
                 max_boxes: int | None = MAX_BOXES) -> DataFrame:
    """Exact one-to-one assignment: heads in order, each taking the first free person that contains it.

    Every head is returned, with its person (also as a struct) or null.
    """
    def pairs_of(boxes: DataFrame, cell: int | None) -> DataFrame:
        found = frame_pairs(boxes.where("_head"), boxes.where("NOT _head"),
                            lambda h, p: g.head_in_person(h, p, ratio), "head_", "person_", cell)
        return found.select(*FRAME, F.col("head_det_id").alias("taker"), F.lit(0.0).alias("wish"),
                            F.col("person_det_id").alias("taken"), _packed("person_"))

    both = heads.withColumn("_head", F.lit(True)).unionByName(persons.withColumn("_head", F.lit(False)))
    held = _assigned(pairs_of, both, 1, max_boxes).select(
        *FRAME, F.col("taker").alias("head_det_id"), F.col("taken").alias("person_det_id"), "person")
    return heads.select(*FRAME, F.col("det_id").alias("head_det_id")).join(held, [*FRAME, "head_det_id"], "left")


def _packed(prefix: str) -> Column:
    return F.struct(*(F.col(prefix + c).alias(c) for c in _ITEM)).alias(prefix.rstrip("_"))


def assign_riders(persons: DataFrame, vehicles: DataFrame, limit: int = MAX_RIDERS,
                  max_boxes: int | None = MAX_BOXES, extra: Sequence[str] = ()) -> DataFrame:
    """Exact rider assignment: vehicles in order, each taking its ``limit`` best free persons.

    Returns ids, the ``wish`` (negative score) and the person struct; ``extra`` columns of both sides
    come along as person_… and vehicle_….
    """
    def pairs_of(boxes: DataFrame, cell: int | None) -> DataFrame:
        found = rider_candidates(boxes.where("_person"), boxes.where("NOT _person"), cell=cell, extra=(extra, extra))
        more = [f"{side}_{c}" for side in ("person", "vehicle") for c in extra]
        return found.select(*FRAME, F.col("vehicle_det_id").alias("taker"), (-F.col("score")).alias("wish"),
                            F.col("person_det_id").alias("taken"), _packed("person_"), *more)

    both = persons.withColumn("_person", F.lit(True)).unionByName(vehicles.withColumn("_person", F.lit(False)))
    held = _assigned(pairs_of, both, limit, max_boxes)
    return held.withColumnsRenamed({"taken": "person_det_id", "taker": "vehicle_det_id"})


def suppress_overlaps(dets: DataFrame, min_conf: float = NMS_SCORE, overlap: float = NMS_OVERLAP,
                      max_boxes: int | None = MAX_BOXES) -> DataFrame:
    """Exact non-maximum suppression per frame: best score first, boxes overlapping a kept one go."""
    strong = dets.where(F.col("conf") > min_conf).select(*FRAME, *_ITEM)
    usual, hot = (strong, None) if max_boxes is None else split_hot(strong, FRAME, max_boxes)
    pairs = frame_pairs(usual, usual, lambda a, b: _better("a_", "b_") & (g.iou(a, b) > F.lit(overlap)), cell=None)
    edge = F.struct((-F.col("a_conf")).alias("order"), F.col("a_det_id").alias("winner"), F.col("b_det_id").alias("loser"))
    ordered = pairs.groupBy(*FRAME).agg(F.sort_array(F.collect_list(edge)).alias("p"))

    def drop(gone: Column, r: Column) -> Column:
        # all edges that could remove this winner come earlier, so its fate is settled here
        idle = F.array_contains(gone, r.getField("winner")) | F.array_contains(gone, r.getField("loser"))
        return F.when(idle, gone).otherwise(F.array_append(gone, r.getField("loser")))

    gone = ordered.select(*FRAME, F.explode(F.aggregate("p", F.array().cast("array<bigint>"), drop)).alias("det_id"))
    out = usual.join(gone, [*FRAME, "det_id"], "left_anti")
    return out if hot is None else out.unionByName(_suppress_by_rounds(hot, overlap))


# ---------------------------------------------------------------- rounds for oversized frames


def settle(pairs: DataFrame, capacity: int) -> DataFrame:
    """Takers in ascending order each take their ``capacity`` most wished free items, by rounds of joins.

    Every taker claims its best remaining items, an item goes to the first taker claiming it, and lost
    claims are struck off until none is lost. Because all items rank the takers the same way, this
    ends in the assignment that visiting the takers one after the other gives.
    """
    open_pairs = materialise(pairs, "claims")
    order = Window.partitionBy(*FRAME, "taker").orderBy("wish", "taken")
    while True:
        claims = open_pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= capacity).drop("_r")
        owner = claims.groupBy(*FRAME, "taken").agg(F.min("taker").alias("owner"))
        lost = open_pairs.join(owner, [*FRAME, "taken"]).where(F.col("taker") > F.col("owner"))
        lost = materialise(lost.select(*FRAME, "taker", "taken"), "lost-claims")
        if not lost.take(1):
            return claims
        open_pairs = materialise(open_pairs.join(lost, [*FRAME, "taker", "taken"], "left_anti"), "claims")


def _suppress_by_rounds(dets: DataFrame, overlap: float) -> DataFrame:
    """Suppression without gathering a frame: boxes nobody beats are kept, those they cover go."""
    edges = (frame_pairs(dets, dets, lambda a, b: g.iou(a, b) > F.lit(overlap)).where(_better("a_", "b_"))
             .select(*FRAME, F.col("a_det_id").alias("winner"), F.col("b_det_id").alias("loser")))
    edges = materialise(edges, "overlaps")
    removed = None
    while edges.take(1):
        beaten = edges.select(*FRAME, F.col("loser").alias("winner")).distinct()
        gone = materialise(edges.join(beaten, [*FRAME, "winner"], "left_anti")
                           .select(*FRAME, F.col("loser").alias("det_id")).distinct(), "suppressed")
        removed = gone if removed is None else removed.unionByName(gone)
        for side in ("winner", "loser"):
            edges = edges.join(gone.withColumnRenamed("det_id", side), [*FRAME, side], "left_anti")
        edges = materialise(edges, "overlaps")
    return dets if removed is None else dets.join(removed, [*FRAME, "det_id"], "left_anti")
