"""Lane rules: which side of which line, crossings of solid lines, lane index."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators import dedup, fold, rules, select, tracking, transitions
from kerbwatch.operators.pointers import same_keys
from kerbwatch.operators.prefix import with_last_value
from kerbwatch.session import materialise
from kerbwatch.sources import config

MIN_CONF = 0.4


def lane_of(lane_lines: Column, px: Column, py: Column) -> Column:
    """Lane index: how many lines the point is right of; -1 with fewer than two lines."""
    right = F.filter(lane_lines, lambda ln: g.line_side(px, py, *_ends(ln)) > 0)
    return F.when(F.size(lane_lines) < 2, F.lit(-1)).otherwise(F.size(right))


def _ends(line: Column) -> tuple[Column, ...]:
    return tuple(line.getField(n) for n in ("x1", "y1", "x2", "y2"))


def is_solid(line: Column) -> Column:
    return F.coalesce(line.getField("type"), F.lit("solid")) == "solid"


def line_distances(dets: DataFrame) -> DataFrame:
    """One row per box and lane line of its camera: side, distance, solid or not."""
    px, py = g.bottom_center(g.box())
    rows = dets.select("*", F.posexplode("lane_lines").alias("line_id", "line"))
    ends = _ends(F.col("line"))
    return rows.withColumns({
        "side": g.line_side(px, py, *ends), "distance": g.segment_distance(px, py, *ends),
        "solid": is_solid(F.col("line"))}).drop("line", "lane_lines")


def with_sides(dets: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Add ``sides``, one letter per lane line of the box's camera (see ``rules.LaneWatch``).

    Needs the columns and line names of ``config.flat_lines``, which are dropped again.
    """
    px, py = g.bottom_center(g.box())
    flat = [f"{name}_{p}" for name in lines for p in config.LINE_PARTS]
    scratch: list[str] = []

    def stage(df: DataFrame, make) -> DataFrame:
        # one projection per step: inlined into each other the steps become a method too large to compile
        columns = {f"_{name}_{part}": c for name in lines for part, c in make(name).items()}
        scratch.extend(columns)
        return df.withColumns(columns)

    def at(name: str, part: str) -> Column:
        return F.col(f"{name}_{part}")

    def relative(name: str) -> dict[str, Column]:
        return {"rx": F.col("_px") - at(name, "x1"), "ry": F.col("_py") - at(name, "y1")}

    def along(name: str) -> dict[str, Column]:
        rx, ry, dx, dy = at(f"_{name}", "rx"), at(f"_{name}", "ry"), at(name, "dx"), at(name, "dy")
        t = (rx * dx + ry * dy) / F.nullif(at(name, "len2"), F.lit(0.0))
        return {"cross": dx * ry - dy * rx, "t": F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), F.lit(0.0))}

    def away(name: str) -> dict[str, Column]:
        t = at(f"_{name}", "t")
        return {"ox": F.col("_px") - (at(name, "x1") + t * at(name, "dx")),
                "oy": F.col("_py") - (at(name, "y1") + t * at(name, "dy"))}

    def letter(name: str) -> dict[str, Column]:
        cross, ox, oy = (at(f"_{name}", p) for p in ("cross", "ox", "oy"))
        near = F.sqrt(ox * ox + oy * oy) < F.col("crossing_threshold") * 2
        side = (F.when(F.abs(cross) < 1e-6, "0").when(near, F.when(cross < 0, "L").otherwise("R"))
                .when(cross < 0, "l").otherwise("r"))
        return {"letter": F.when(at(name, "type") == "solid", side).when(at(name, "type").isNotNull(), "-").otherwise("")}

    out = dets.withColumns({"_px": px, "_py": py.cast("double")})
    for step in (relative, along, away, letter):
        out = stage(out, step)
    out = out.withColumn("sides", F.concat(F.lit(""), *(F.col(f"_{name}_letter") for name in lines)))
    return out.drop("crossing_threshold", "n_lines", "_px", "_py", *flat, *scratch)


def with_lane_sides(dets: DataFrame, cfg: DataFrame, edges: Sequence[str] | None = None) -> DataFrame:
    """Boxes of cameras with lane lines (and, given ``edges``, inside the zone) with their side letters."""
    flat, lines = config.flat_lines(cfg)
    keep = [c for c in flat.columns if c in ("camera_id", "corners", "crossing_threshold", "n_lines")
            or c.startswith(("edge", "line"))]
    known = config.with_config(dets, flat.select(*keep)).where(F.col("n_lines") > 0)
    return with_sides(known if edges is None else select.in_detection_zone(known, edges), lines)


def _letter(i: int) -> Column:
    return F.substring("sides", i + 1, 1)


def _side(i: int) -> Column:
    up = F.upper(_letter(i))
    return F.when(up == "L", -1).when(up == "R", 1)


def _crossing(i: int, before: Column, extra: Column | None = None) -> Column:
    hit = _letter(i).isin("L", "R") & (before != _side(i))
    return F.coalesce(hit if extra is None else hit & extra, F.lit(False))


def _report(i: int, before: Column) -> Column:
    return F.struct(F.lit(i).alias("line_id"), g.side_name(before).alias("from_side"),
                    g.side_name(_side(i)).alias("to_side"))


def line_crossings(dets: DataFrame, n_lines: int, keys: Sequence[str] = ("camera_id", "track_id"),
                   width: float = tracking.FRAMES_PER_BUCKET) -> DataFrame:
    """Every crossing of every solid line: last known side differs from the side now, line within reach.

    Needs ``sides``. Lines are judged independently, in one pass over the track.
    """
    seen = with_last_value(dets, keys, ["frame_number"], {f"_p{i}": _side(i) for i in range(n_lines)}, width)
    hits = F.array_compact(F.array(*(F.when(_crossing(i, F.col(f"_p{i}")), _report(i, F.col(f"_p{i}")))
                                     for i in range(n_lines))))
    return (seen.withColumn("_hits", hits).where(F.size("_hits") > 0)
            .withColumn("_hit", F.explode("_hits")).select("*", "_hit.*")
            .drop("_hits", "_hit", *(f"_p{i}" for i in range(n_lines))))


def checked_crossings(dets: DataFrame, frames: DataFrame | None = None, keys: Sequence[str] = ("camera_id", "track_id"),
                      extra: Sequence[str] = (), **chunks) -> DataFrame:
    """Crossings as the sequential checker reports them, for rows that already carry a track.

    The first sighting only records sides; a frame reports at most one line, and the lines after it keep
    their old side for one more sighting; a track missing from a frame starts over. Tracks are cut into time
    chunks whose transitions are composed (see ``transitions``).

    ``frames`` lists the frames the camera delivered (default: those with rows in ``dets``); ``extra`` columns of the
    sighting come along.
    """
    numbered = tracking.frame_index(dets if frames is None else frames)
    rows = dets.join(numbered, ["camera_id", "frame_number"])
    kept = [c for c in ("frame_number", "det_id", "ts_sec", *extra) if c not in keys]
    return transitions.checked(rows, keys, kept, **chunks).select(*keys, *kept, "line_id", "from_side", "to_side")


def lane_inputs(dets: DataFrame, cfg: DataFrame, min_conf: float = MIN_CONF,
                classes: Iterable[int] = tuple(g.ROAD_VEHICLES)) -> DataFrame:
    """Vehicles in the zone of cameras with lane lines, with side letters. ``cfg`` is already scaled."""
    vehicles = select.of_classes(dets, classes, min_conf)
    lettered = with_lane_sides(vehicles, *config.flat_zone(cfg))
    return tracking.with_centroid(lettered.withColumn("vehicle_type", g.class_name(F.col("class_id"))))


def lane_violations(dets: DataFrame, cfg: DataFrame, min_conf: float = MIN_CONF,
                    classes: Iterable[int] = tuple(g.ROAD_VEHICLES), **chunks) -> DataFrame:
    """The whole lane rule from raw detections: gate, zone, tracking, crossing, cooldown.

    ``dets`` must hold all detections of the cameras, because a frame without vehicles still makes tracks
    forget their sides.
    """
    rows = lane_inputs(dets, cfg, min_conf, classes)
    columns = ["camera_id", "frame_number", "ts_sec", "det_id", "x", "y", "w", "h", "conf",
               "cx", "cy", "sides", "vehicle_type"]
    gated = config.lane_configured(dets, cfg)
    ticks = gated.select("camera_id", "frame_number", "ts_sec").distinct()
    both = rows.select(*columns).unionByName(ticks, allowMissingColumns=True)
    return fold.run_rule(both, rules.LaneWatch(), ["camera_id"], tracking.ORDER,
                         ["frame_number", "ts_sec", "det_id", "x", "y", "w", "h"], new_id="track_id",
                         **chunks).withColumnRenamed("first_type", "vehicle_type")


def lane_violations_on_tracks(dets: DataFrame, cfg: DataFrame, min_conf: float = MIN_CONF,
                              classes: Iterable[int] = tuple(g.ROAD_VEHICLES), **chunks) -> DataFrame:
    """The lane rule for detections that already carry ``track_id``."""
    rows = lane_inputs(dets, cfg, min_conf, classes)
    found = materialise(checked_crossings(rows, config.lane_configured(dets, cfg), extra="xywh", **chunks), "crossings")
    kept = dedup.cooldown(found, order=("ts_sec", "det_id"))
    found = same_keys(found, kept, ["camera_id", "track_id", "ts_sec", "det_id"], "left_semi")
    return same_keys(found, tracking.first_type(rows), ["camera_id", "track_id"], "left")
