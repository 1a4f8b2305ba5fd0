"""Box, line and zone geometry as column expressions.

Nothing here is a UDF: every function returns a ``Column`` (or a tuple of them), so the
expressions stay inside generated code and can be pushed below joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = Column | int | float


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


class Box(NamedTuple):
    """Left, top, width, height columns."""

    x: Column
    y: Column
    w: Column
    h: Column

    @property
    def right(self) -> Column:
        return self.x + self.w

    @property
    def bottom(self) -> Column:
        return self.y + self.h

    @property
    def mid_x(self) -> Column:
        return self.x + self.w / F.lit(2.0)

    @property
    def mid_y(self) -> Column:
        return self.y + self.h / F.lit(2.0)


def box(prefix: str = "") -> Box:
    """Box from the columns ``<prefix>x, <prefix>y, <prefix>w, <prefix>h``."""
    return Box(*(F.col(prefix + part) for part in "xywh"))


def box_of(struct: Column) -> Box:
    """Box from a struct column with fields x, y, w, h."""
    return Box(*(struct.getField(part) for part in "xywh"))


# ---------------------------------------------------------------- boxes


def _at_least_zero(value: Column) -> Column:
    """Like ``greatest(0, value)``, but an unknown value stays unknown."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def clamp(b: Box, frame_w: Number, frame_h: Number) -> Box:
    """Cut a box to the frame. The origin moves first; the width is only cut on the far side."""
    x, y = _at_least_zero(b.x), _at_least_zero(b.y)
    room_w, room_h = _c(frame_w) - x, _c(frame_h) - y
    w = _at_least_zero(F.when(b.w > room_w, room_w).otherwise(b.w))
    h = _at_least_zero(F.when(b.h > room_h, room_h).otherwise(b.h))
    return Box(x, y, w, h)


def corners(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x, b.y, b.right, b.bottom


def from_corners(x1: Column, y1: Column, x2: Column, y2: Column) -> Box:
    return Box(x1, y1, x2 - x1, y2 - y1)


def corner_center(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
    return (x1 + x2) / F.lit(2.0), (y1 + y2) / F.lit(2.0)


def centroid(b: Box) -> tuple[Column, Column]:
    return b.mid_x, b.mid_y


def bottom_center(b: Box) -> tuple[Column, Column]:
    return b.mid_x, b.bottom


def iou(a: Box, b: Box) -> Column:
    """Shared area over joint area; null when one of the boxes is missing."""
    zero = F.lit(0)
    overlap_w = F.greatest(zero, F.least(a.right, b.right) - F.greatest(a.x, b.x))
    overlap_h = F.greatest(zero, F.least(a.bottom, b.bottom) - F.greatest(a.y, b.y))
    shared = (overlap_w * overlap_h).cast("double")
    area_a = F.greatest(zero, a.w) * F.greatest(zero, a.h)
    area_b = F.greatest(zero, b.w) * F.greatest(zero, b.h)
    # greatest and least skip nulls, so a missing box has to be ruled out explicitly
    return F.when(a.w.isNotNull() & b.w.isNotNull(), shared / (area_a + area_b - shared + F.lit(1e-9)))


def covers(b: Box, px: Column, py: Column) -> Column:
    """Point in box; all four sides belong to the box."""
    return px.between(b.x, b.right) & py.between(b.y, b.bottom)


def touches(person: Box, vehicle: Box, min_iou: float = 0.15) -> Column:
    """Person is on the vehicle: enough overlap, or feet inside it."""
    return (iou(person, vehicle) >= F.lit(min_iou)) | covers(vehicle, *bottom_center(person))


def head_region(b: Box, ratio: float = 0.35) -> Box:
    """Top strip of a person box, at least one row high."""
    rows = (b.h * F.lit(float(ratio))).cast("int")
    return Box(b.x, b.y, b.w, F.greatest(F.lit(1), rows))


def head_in_person(head: Box, person: Box, ratio: float = 0.5) -> Column:
    """Head centre lies in the upper part of the person box."""
    return head.mid_x.between(person.x, person.right) & head.mid_y.between(
        person.y, person.y + person.h * F.lit(float(ratio))
    )


def bbox_struct(arr: Column) -> Column:
    """Four-element list to a named box; any other length becomes null."""
    named = F.struct(*(F.get(arr, F.lit(i)).alias(n) for i, n in enumerate("xywh")))
    return F.when(F.size(arr) == 4, named)


# ---------------------------------------------------------------- zones


def _edge_toggles(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Does the ray from (px, py) to the right cross this edge?"""
    spans = (py > F.least(y1, y2)) & (py <= F.greatest(y1, y2))
    # only read where y1 <> y2 (implied by ``spans``); nullif keeps level edges from dividing by zero
    meets = (py - y1) * (x2 - x1) / F.nullif((y2 - y1).cast("double"), F.lit(0.0)) + x1
    return spans & (px <= F.greatest(x1, x2)) & ((x1 == x2) | (px <= meets))


def in_zone(px: Column, py: Column, zone: Column) -> Column:
    """Even-odd point-in-polygon test; a zone of fewer than three points lets everything through.

    Works on any array of points by a higher-order function. ``in_flat_zone`` is the faster form for a
    configuration whose points were spread over columns.
    """
    def toggles(i: Column) -> Column:
        nxt = F.when(i + 1 >= F.size(zone), F.lit(0)).otherwise(i + 1)
        ends = [F.get(F.get(zone, at), F.lit(axis)) for at in (i, nxt) for axis in (0, 1)]
        return _edge_toggles(px, py, *ends)

    crossings = F.size(F.filter(F.sequence(F.lit(0), F.size(zone) - 1), toggles))
    return F.when(F.coalesce(F.size(zone), F.lit(0)) < 3, F.lit(True)).otherwise(crossings % 2 == 1)


def in_flat_zone(px: Column, py: Column, edges: list[tuple[Column, ...]], corners: Column) -> Column:
    """The same test over the edge columns of ``config.flat_zone`` (null where a zone has fewer edges)."""
    crossings = F.lit(0)
    for x1, y1, dx, dy, low, high, reach in edges:
        hit = (py > low) & (py <= high) & (px <= reach) & ((dx == 0) | (px <= (py - y1) * dx / F.nullif(dy, F.lit(0.0)) + x1))
        crossings = crossings + F.when(hit, 1).otherwise(0)
    return F.when(F.coalesce(corners, F.lit(0)) < 3, F.lit(True)).otherwise(crossings % 2 == 1)


# ---------------------------------------------------------------- lines


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    """Distance from a point to a finite segment; a zero-length segment counts as a point."""
    px, py, x1, y1, x2, y2 = (_c(v).cast("double") for v in (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    length_sq = dx * dx + dy * dy
    along = ((px - x1) * dx + (py - y1) * dy) / F.nullif(length_sq, F.lit(0.0))
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)), F.lit(0.0))
    off_x, off_y = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(off_x * off_x + off_y * off_y)


def line_side(px, py, x1, y1, x2, y2) -> Column:
    """-1, 0 or 1 by the sign of the cross product; nearly zero counts as on the line."""
    px, py, x1, y1, x2, y2 = (_c(v).cast("double") for v in (px, py, x1, y1, x2, y2))
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return F.when(F.abs(cross) < 1e-6, 0).when(cross > 0, 1).otherwise(-1)


def side_name(side: Column) -> Column:
    return F.when(side == -1, "left").otherwise("right")


def past_stop_line(y: Column, line_y: Column, direction: Column) -> Column:
    """Strictly beyond the stop line, seen in the camera's travel direction (default below)."""
    return F.when(F.coalesce(direction, F.lit("below")) == "above", y < line_y).otherwise(y > line_y)


# ---------------------------------------------------------------- confidence


def violation_confidence(person: Column, vehicle: Column, factor: Column) -> Column:
    """Weighted mix (quarter, quarter, half) kept inside [0.1, 0.99]."""
    mixed = person * F.lit(0.25) + vehicle * F.lit(0.25) + factor * F.lit(0.5)
    return F.least(F.lit(0.99), F.greatest(F.lit(0.1), mixed))


def boosted(confidence: Column, on_vehicle: Column) -> Column:
    return F.when(on_vehicle, F.least(F.lit(0.99), confidence + F.lit(0.1))).otherwise(confidence)


# ---------------------------------------------------------------- classes and raw model output

# Class ids of the two models the rules are written for.
ROAD_VEHICLES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
TRAFFIC_LIGHT = 9
HELMET_CLASSES = {
    0: "person", 1: "bicycle", 2: "car", 3: "motorcycle",
    4: "bus", 5: "truck", 6: "with_helmet", 7: "without_helmet",
}
PERSON, WITH_HELMET, WITHOUT_HELMET = 0, 6, 7
TWO_WHEELERS = (1, 3)


def class_name(class_id: Column, names: Mapping[int, str] = ROAD_VEHICLES, default: str = "vehicle") -> Column:
    out = F.lit(default)
    for key, name in names.items():
        out = F.when(class_id == key, F.lit(name)).otherwise(out)
    return out


def decode_head(vector: Column, frame_w: int, frame_h: int, n_classes: int) -> dict[str, Column]:
    """One raw output vector (cx, cy, w, h, objectness, scores…) to class, score and pixel box."""
    scores = F.slice(vector, 6, n_classes)
    top = F.array_max(scores)

    def px(i: int, extent: int) -> Column:
        # single precision on purpose: the model emits floats and the product is truncated
        return (F.get(vector, F.lit(i)).cast("float") * F.lit(extent).cast("float")).cast("int")

    cx, cy, w, h = px(0, frame_w), px(1, frame_h), px(2, frame_w), px(3, frame_h)
    return {
        "class_id": (F.array_position(scores, top) - 1).cast("int"),
        "conf": top.cast("double"),
        "x": (cx - w / F.lit(2.0)).cast("int"),
        "y": (cy - h / F.lit(2.0)).cast("int"),
        "w": w,
        "h": h,
    }


def resize_plan(width: Column, height: Column, limit: int = 720) -> tuple[Column, Column]:
    """Target size when frames taller than ``limit`` are shrunk with their aspect ratio kept."""
    scale = F.lit(float(limit)) / height
    tall = height > limit
    return (
        F.when(tall, F.rint(width * scale).cast("int")).otherwise(width),
        F.when(tall, F.lit(limit)).otherwise(height),
    )
