"""Queries for within-frame relations, light state, lanes, tracks and ordered rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.operators import dedup, helmet, lanes, light, records, redlight, relate, tracking
from kerbwatch.plans import derived as d
from kerbwatch.plans.oracle import KEPT, KIND, LANE_WALK, feet_in, head_in, iou, recursive, sql_with, strip, tracked
from kerbwatch.plans.registry import query, r6
from kerbwatch.sources import config

ID = ("camera_id", "frame_number", "det_id")
# the derived detections use the helmet model's classes; these are the road vehicles among them
VEHICLES = (2, 3, 5)


def _boxes(spark, sf):
    return d.boxes(spark, sf)


def _scaled(spark):
    return config.scale_config(d.camera_config(spark), d.FRAME_W, d.FRAME_H)


def _groups(spark, sf):
    b = _boxes(spark, sf)
    return (b.where("class_id = 0"), b.where("class_id IN (1, 3)"), b.where("class_id = 6"), b.where("class_id = 7"))


# ---------------------------------------------------------------- within a frame


@query("d01_config_with_default", sql_with("viol cfg", """
SELECT v.camera_id, c.stop_y, c.direction, count(*) AS n
FROM viol v JOIN cfg c ON c.camera_id = CASE WHEN v.camera_id IN (SELECT camera_id FROM cfg) THEN v.camera_id ELSE 'default' END
GROUP BY ALL"""))
def _(spark, sf):
    cfg = d.camera_config(spark).select("camera_id", "stop_y", "direction")
    return config.with_config(d.violations(spark, sf), cfg).groupBy("camera_id", "stop_y", "direction").agg(
        F.count("*").alias("n"))


@query("d04_heads_to_persons", sql_with("heads persons", f"""
SELECT h.camera_id, h.frame_number, h.det_id AS head_det_id, min(p.det_id) AS person_det_id
FROM heads h JOIN persons p ON h.camera_id = p.camera_id AND h.frame_number = p.frame_number AND {head_in('h', 'p')}
GROUP BY ALL"""))
def _(spark, sf):
    persons, _, _, heads = _groups(spark, sf)
    return relate.heads_to_persons(heads, persons)


_HEADS = f"""
, head_wishes AS MATERIALIZED (SELECT h.camera_id, h.frame_number, h.det_id, list(p.det_id ORDER BY p.det_id) FILTER (p.det_id IS NOT NULL) AS fit,
    row_number() OVER (PARTITION BY h.camera_id, h.frame_number ORDER BY h.det_id) AS n
  FROM heads h LEFT JOIN persons p ON h.camera_id = p.camera_id AND h.frame_number = p.frame_number AND {head_in('h', 'p')}
  GROUP BY h.camera_id, h.frame_number, h.det_id),
head_walk AS (
  SELECT camera_id, frame_number, n, det_id, fit[1] AS got, [fit[1]] AS used FROM head_wishes WHERE n = 1
  UNION ALL
  SELECT camera_id, frame_number, n, det_id, got, list_append(used, got) FROM (
    SELECT s.*, w.used, list_filter(s.fit, lambda p: NOT coalesce(list_contains(w.used, p), false))[1] AS got
    FROM head_walk w JOIN head_wishes s ON s.camera_id = w.camera_id AND s.frame_number = w.frame_number AND s.n = w.n + 1) a),
head_match AS MATERIALIZED (SELECT camera_id, frame_number, det_id AS head_det_id, got AS person_det_id FROM head_walk)"""


@query("d04_heads_to_persons_exact", recursive("heads persons", _HEADS, "\nSELECT * FROM head_match"))
def _(spark, sf):
    persons, _, _, heads = _groups(spark, sf)
    return relate.assign_heads(heads, persons).drop("person")


@query("d05_person_on_vehicle", sql_with("persons bikes", f"""
SELECT p.camera_id, p.frame_number, p.det_id AS person_det_id, min(v.det_id) AS vehicle_det_id,
  round(arg_min(v.conf, v.det_id), 6) AS vehicle_conf
FROM persons p JOIN bikes v ON p.camera_id = v.camera_id AND p.frame_number = v.frame_number
  AND ({iou('p', 'v')} >= 0.15e0 OR {feet_in('p', 'v')}) GROUP BY ALL"""))
def _(spark, sf):
    persons, vehicles, _, _ = _groups(spark, sf)
    return relate.on_vehicle(persons, vehicles).withColumn("vehicle_conf", r6("vehicle_conf"))


@query("d06_top_riders", sql_with("persons bikes", f"""
SELECT camera_id, frame_number, vehicle_det_id, person_det_id, round(score, 6) AS score, rider_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id, frame_number, vehicle_det_id ORDER BY score DESC, person_det_id) AS rider_rank
  FROM (SELECT p.camera_id, p.frame_number, v.det_id AS vehicle_det_id, p.det_id AS person_det_id,
          {iou('p', 'v')} + CASE WHEN {feet_in('p', 'v')} THEN 0.1e0 ELSE 0.0e0 END AS score
        FROM persons p JOIN bikes v ON p.camera_id = v.camera_id AND p.frame_number = v.frame_number
          AND ({iou('p', 'v')} >= 0.15e0 OR {feet_in('p', 'v')})) s) r WHERE rider_rank <= 3"""))
def _(spark, sf):
    persons, vehicles, _, _ = _groups(spark, sf)
    return relate.top_riders(persons, vehicles).select(
        "camera_id", "frame_number", "vehicle_det_id", "person_det_id", r6("score").alias("score"),
        F.col("rider_rank").cast("bigint").alias("rider_rank"))


_RIDERS = f"""
, rider_wishes AS MATERIALIZED (SELECT v.camera_id, v.frame_number, v.det_id, list(p.det_id ORDER BY
      {iou('p', 'v')} + CASE WHEN {feet_in('p', 'v')} THEN 0.1e0 ELSE 0.0e0 END DESC, p.det_id) AS fit,
    row_number() OVER (PARTITION BY v.camera_id, v.frame_number ORDER BY v.det_id) AS n
  FROM bikes v JOIN persons p ON p.camera_id = v.camera_id AND p.frame_number = v.frame_number
    AND ({iou('p', 'v')} >= 0.15e0 OR {feet_in('p', 'v')}) GROUP BY v.camera_id, v.frame_number, v.det_id),
rider_walk AS (
  SELECT camera_id, frame_number, n, det_id, fit[1:3] AS got, fit[1:3] AS used FROM rider_wishes WHERE n = 1
  UNION ALL
  SELECT camera_id, frame_number, n, det_id, got, list_concat(used, got) FROM (
    SELECT s.*, w.used, list_filter(s.fit, lambda p: NOT list_contains(w.used, p))[1:3] AS got
    FROM rider_walk w JOIN rider_wishes s ON s.camera_id = w.camera_id AND s.frame_number = w.frame_number AND s.n = w.n + 1) a),
rider_match AS MATERIALIZED (SELECT camera_id, frame_number, det_id AS vehicle_det_id, unnest(got) AS person_det_id FROM rider_walk)"""


@query("d06_riders_exact", recursive("persons bikes", _RIDERS, "\nSELECT * FROM rider_match"))
def _(spark, sf):
    persons, vehicles, _, _ = _groups(spark, sf)
    return relate.assign_riders(persons, vehicles).drop("wish", "person")


def _bare(extra: str = "") -> str:
    return sql_with("persons helmets", f"""
SELECT p.camera_id, p.frame_number, p.det_id FROM persons p WHERE NOT EXISTS (
  SELECT 1 FROM helmets b, (SELECT {strip('p')}) s
  WHERE b.camera_id = p.camera_id AND b.frame_number = p.frame_number AND ({iou('b', 's')} >= 0.15e0 {extra}))""")


@query("d07_without_helmet", _bare())
def _(spark, sf):
    persons, _, helmets, _ = _groups(spark, sf)
    return relate.without_helmet(persons, helmets).select(*ID)


@query("d08_without_helmet_centre", _bare(
    "OR (b.x + b.w / 2.0e0 BETWEEN s.x AND s.x + s.w AND b.y + b.h / 2.0e0 BETWEEN s.y AND s.y + s.h)"))
def _(spark, sf):
    persons, _, helmets, _ = _groups(spark, sf)
    return relate.without_helmet(persons, helmets, centre_counts=True).select(*ID)


@query("d09_vehicles_by_lines", sql_with("sided", """
SELECT camera_id, frame_number, det_id, line_id, type = 'solid' AS solid FROM sided WHERE class_id IN (2, 3, 5)"""))
def _(spark, sf):
    cfg = _scaled(spark).select("camera_id", "lane_lines")
    boxes = config.with_config(_boxes(spark, sf).where(F.col("class_id").isin(*VEHICLES)), cfg)
    return lanes.line_distances(boxes).select(*ID, "line_id", "solid")


@query("d10_light_by_vehicle", sql_with("det light", """
SELECT d.camera_id, light_state, class_id, count(*) AS n FROM det d JOIN light l USING (camera_id, frame_number)
WHERE class_id IN (2, 3, 5) GROUP BY ALL"""))
def _(spark, sf):
    dets = d.detections(spark, sf).where(F.col("class_id").isin(*VEHICLES))
    return (dets.join(d.frame_light(spark, sf), ["camera_id", "frame_number"])
            .groupBy("camera_id", "light_state", "class_id").agg(F.count("*").alias("n")))


@query("e12_class_counts", sql_with("det", """
SELECT camera_id, frame_number, count(*) FILTER (class_id = 0) AS persons_detected,
  count(*) FILTER (class_id IN (1, 3)) AS vehicles_detected, count(*) FILTER (class_id = 6) AS helmets_detected,
  count(*) FILTER (class_id = 7) AS no_helmets_detected FROM det GROUP BY ALL"""))
def _(spark, sf):
    return helmet.class_counts(d.detections(spark, sf))


@query("g06_suppressed_boxes", sql_with("cl", f"""
SELECT a.camera_id, a.frame_number, a.det_id FROM cl a WHERE a.conf > 0.5e0 AND NOT EXISTS (
  SELECT 1 FROM cl b WHERE b.camera_id = a.camera_id AND b.frame_number = a.frame_number AND b.conf > 0.5e0
    AND (b.conf > a.conf OR (b.conf = a.conf AND b.det_id < a.det_id)) AND {iou('a', 'b')} > 0.4e0)"""))
def _(spark, sf):
    return relate.weaker_overlaps(_boxes(spark, sf)).select(*ID)


_OVER = ("greatest(0, least(s.x+s.w, k.x+k.w) - greatest(s.x, k.x)) * greatest(0, least(s.y+s.h, k.y+k.h) - greatest(s.y, k.y))")


@query("g06_suppressed_boxes_exact", recursive("cl", f"""
, strong AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY camera_id, frame_number ORDER BY conf DESC, det_id) AS n FROM cl WHERE conf > 0.5e0),
walk AS (
  SELECT camera_id, frame_number, n, true AS stays, [{{'x': x, 'y': y, 'w': w, 'h': h}}] AS kept FROM strong WHERE n = 1
  UNION ALL
  SELECT camera_id, frame_number, n, NOT hit, CASE WHEN hit THEN kept ELSE list_append(kept, {{'x': x, 'y': y, 'w': w, 'h': h}}) END FROM (
    SELECT s.*, w.kept, len(list_filter(w.kept, lambda k: CAST({_OVER} AS DOUBLE)
      / (s.w*s.h + k.w*k.h - {_OVER} + CAST(1e-9 AS DOUBLE)) > 0.4e0)) > 0 AS hit
    FROM walk w JOIN strong s ON s.camera_id = w.camera_id AND s.frame_number = w.frame_number AND s.n = w.n + 1) a)
SELECT s.camera_id, s.frame_number, s.det_id, round(s.conf, 6) AS conf
FROM strong s JOIN walk w ON w.camera_id = s.camera_id AND w.frame_number = s.frame_number AND w.n = s.n AND stays"""))
def _(spark, sf):
    return relate.suppress_overlaps(_boxes(spark, sf)).select(*ID, r6("conf").alias("conf"))


# ---------------------------------------------------------------- light


@query("e10_frame_light", sql_with("det", """
SELECT camera_id, frame_number, CASE WHEN bool_or(s = 'RED') THEN 'RED' WHEN bool_or(s = 'GREEN') THEN 'GREEN'
  WHEN bool_or(s = 'YELLOW') THEN 'YELLOW' ELSE 'UNKNOWN' END AS light_state
FROM (SELECT camera_id, frame_number, CASE (det_id * 7 + frame_number) % 23 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN'
        WHEN 2 THEN 'YELLOW' ELSE 'UNKNOWN' END AS s FROM det WHERE class_id = 3) t GROUP BY ALL"""))
def _(spark, sf):
    phase = (F.col("det_id") * 7 + F.col("frame_number")) % 23
    state = F.when(phase == 0, "RED").when(phase == 1, "GREEN").when(phase == 2, "YELLOW").otherwise("UNKNOWN")
    return light.frame_state(d.detections(spark, sf).where("class_id = 3").withColumn("state", state))


@query("e11_light_from_pixels", sql_with("pixels", """
SELECT image_id, r AS red_pixels, g AS green_pixels, y AS yellow_pixels,
  CASE WHEN r > g AND r > y AND r > 50 THEN 'RED' WHEN g > r AND g > y AND g > 50 THEN 'GREEN' WHEN y > 50 THEN 'YELLOW'
  ELSE 'UNKNOWN' END AS light_state
FROM (SELECT image_id,
        count(*) FILTER ((h BETWEEN 0 AND 10 OR h BETWEEN 160 AND 180) AND s BETWEEN 100 AND 255 AND v BETWEEN 100 AND 255) AS r,
        count(*) FILTER (h BETWEEN 40 AND 80 AND s BETWEEN 100 AND 255 AND v BETWEEN 100 AND 255) AS g,
        count(*) FILTER (h BETWEEN 20 AND 35 AND s BETWEEN 100 AND 255 AND v BETWEEN 100 AND 255) AS y
      FROM pixels GROUP BY image_id) c"""))
def _(spark, sf):
    return light.state_from_pixels(d.pixels(spark, sf))


# ---------------------------------------------------------------- lanes


def _lane_rows(spark, sf):
    """Clamped boxes with side letters; the known object number is the track."""
    boxes = _boxes(spark, sf).withColumn("track_id", F.col("det_id"))
    return lanes.with_lane_sides(boxes, _scaled(spark))


_CROSSED = """
SELECT camera_id, frame_number, track_id, line_id, CASE prev WHEN -1 THEN 'left' ELSE 'right' END AS from_side,
  CASE side WHEN -1 THEN 'left' ELSE 'right' END AS to_side
FROM (SELECT *, det_id AS track_id, last_value(nullif(side, 0) IGNORE NULLS) OVER (PARTITION BY camera_id, det_id, line_id
        ORDER BY frame_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM sided) s
WHERE type = 'solid' AND side <> 0 AND prev <> side AND distance < 2 * threshold"""


@query("f01_line_crossings", sql_with("sided", _CROSSED))
def _(spark, sf):
    out = lanes.line_crossings(_lane_rows(spark, sf), config.most_lines(d.camera_config(spark)))
    return out.select("camera_id", "frame_number", "track_id", "line_id", "from_side", "to_side")


@query("f02_checked_crossings", sql_with("sided", """
SELECT camera_id, frame_number, track_id, CAST(line_id AS INT) AS line_id, CASE prev WHEN -1 THEN 'left' ELSE 'right' END AS from_side,
  CASE side WHEN -1 THEN 'left' ELSE 'right' END AS to_side FROM (
  SELECT *, CASE WHEN fired0 THEN 0 WHEN NOT fired0 AND p2 <> s2 AND s2 <> 0 AND d2 < 2 * threshold THEN 2 END AS line_id,
    CASE WHEN fired0 THEN p0 ELSE p2 END AS prev, CASE WHEN fired0 THEN s0 ELSE s2 END AS side FROM (
    SELECT *, last_value(CASE WHEN NOT fired0 THEN nullif(s2, 0) END IGNORE NULLS) OVER (PARTITION BY camera_id, track_id
        ORDER BY frame_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p2 FROM (
      SELECT *, coalesce(p0 <> s0 AND s0 <> 0 AND d0 < 2 * threshold, false) AS fired0 FROM (
        SELECT *, last_value(nullif(s0, 0) IGNORE NULLS) OVER (PARTITION BY camera_id, track_id
          ORDER BY frame_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p0 FROM (
          SELECT camera_id, frame_number, det_id AS track_id, any_value(threshold) AS threshold,
            max(side) FILTER (line_id = 0) AS s0, max(distance) FILTER (line_id = 0) AS d0,
            max(side) FILTER (line_id = 2) AS s2, max(distance) FILTER (line_id = 2) AS d2
          FROM sided GROUP BY ALL) a) b) c) e) f WHERE line_id IS NOT NULL"""))
def _(spark, sf):
    out = lanes.checked_crossings(_lane_rows(spark, sf), d.detections(spark, sf))
    return out.select("camera_id", "frame_number", "track_id", "line_id", "from_side", "to_side")


@query("e13_vehicle_lane", sql_with("sided", """
SELECT camera_id, frame_number, det_id, CAST(count(*) FILTER (side > 0) AS INT) AS lane FROM sided GROUP BY ALL"""))
def _(spark, sf):
    boxes = config.with_config(_boxes(spark, sf), _scaled(spark).select("camera_id", "lane_lines"))
    boxes = boxes.where(F.size("lane_lines") > 0)
    return boxes.select(*ID, lanes.lane_of(F.col("lane_lines"), *g.bottom_center(g.box())).alias("lane"))


@query("flagship_crossings_by_hour", sql_with("sided", f"""
SELECT camera_id, CAST(floor(ts_sec / 3600) AS BIGINT) AS hour, line_id, count(*) AS crossings
FROM ({_CROSSED.replace('SELECT camera_id,', 'SELECT camera_id, ts_sec,', 1)} AND class_id IN (2, 3, 5) AND conf >= 0.4e0) c
GROUP BY ALL"""))
def _(spark, sf):
    rows = _lane_rows(spark, sf).where(F.col("class_id").isin(*VEHICLES) & (F.col("conf") >= 0.4))
    crossed = lanes.line_crossings(rows, config.most_lines(d.camera_config(spark)))
    hour = F.floor(F.col("ts_sec") / 3600).cast("bigint")
    return crossed.groupBy("camera_id", hour.alias("hour"), "line_id").agg(F.count("*").alias("crossings"))


# ---------------------------------------------------------------- red light


_RED = """
SELECT camera_id, track_id, frame_number FROM (
  SELECT c.camera_id, c.det_id AS track_id, c.frame_number, row_number() OVER (PARTITION BY c.camera_id, c.det_id ORDER BY c.frame_number) AS n
  FROM {src} c JOIN light l USING (camera_id, frame_number) JOIN cfgs ON cfgs.camera_id = c.camera_id
  WHERE {cond} light_state = 'RED' AND CASE direction WHEN 'above' THEN y + h < stop_y ELSE y + h > stop_y END) r WHERE n = 1"""


@query("f03_first_red_crossing", sql_with("cl light cfgs", _RED.format(src="cl", cond="")))
def _(spark, sf):
    rows = config.with_own_config(_boxes(spark, sf), _scaled(spark).select("camera_id", "stop_y", "direction"))
    rows = rows.join(d.frame_light(spark, sf), ["camera_id", "frame_number"]).withColumns({
        "track_id": F.col("det_id"), "is_red": F.col("light_state") == "RED", "past_line": redlight.past_line(rows),
        "vehicle_type": g.class_name(F.col("class_id"))})
    return redlight.first_red_crossings(rows).select("camera_id", "track_id", "frame_number")


@query("i06_red_light_on_tracks", sql_with("zoned light cfgs", _RED.format(
    src="zoned", cond="class_id IN (2, 3, 5) AND conf >= 0.4e0 AND")))
def _(spark, sf):
    dets = _boxes(spark, sf).withColumn("track_id", F.col("det_id"))
    out = redlight.red_light_violations_on_tracks(dets, _scaled(spark), d.frame_light(spark, sf), classes=VEHICLES)
    return out.select("camera_id", "track_id", "frame_number")


@query("i06_red_light_from_detections", recursive("zoned light cfgs", f"""
, moves AS (SELECT *, {KIND} FROM zoned WHERE class_id IN (2, 3, 5) AND conf >= 0.4e0)""", tracked("moves"), """
SELECT camera_id, frame_number, ts_sec, det_id, x, y, w, h, track_id, first_type AS vehicle_type, 0.9e0 AS confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id, track_id ORDER BY frame_number, det_id) AS nth FROM (
    SELECT t.*, first_value(vehicle_type) OVER (PARTITION BY t.camera_id, track_id ORDER BY t.frame_number) AS first_type, light_state, stop_y, direction
    FROM tracks t LEFT JOIN light USING (camera_id, frame_number) JOIN cfgs ON cfgs.camera_id = t.camera_id) a
  WHERE light_state = 'RED' AND CASE direction WHEN 'above' THEN y + h < stop_y ELSE y + h > stop_y END) b WHERE nth = 1"""))
def _(spark, sf):
    return redlight.red_light_violations(_boxes(spark, sf), _scaled(spark), d.frame_light(spark, sf), classes=VEHICLES)


_PIXEL_LIGHT = """
, shot AS (SELECT concat('cam', CAST(scene % 3 + 1 AS VARCHAR)) AS camera_id, scene * 8 + k AS frame_number,
    CASE scene % 3 WHEN 0 THEN 40 WHEN 1 THEN 1440 ELSE 640 END + (l_suppkey * 7 + l_linenumber * 31) % 240 AS px,
    CASE scene % 3 WHEN 0 THEN 20 WHEN 1 THEN 730 ELSE 205 END + (l_partkey * 13 + l_linenumber) % 230 AS py,
    (scene * 41 + k * 10 + l_suppkey % 15) % 181 AS h, 80 + (l_suppkey * 13 + l_partkey) % 176 AS s, 80 + (l_orderkey * 29 + l_suppkey) % 176 AS v
  FROM (SELECT *, l_orderkey % 10 AS scene, l_partkey % 8 AS k FROM lineitem) q),
counted AS (SELECT p.camera_id, frame_number,
    count(*) FILTER (s >= 100 AND v >= 100 AND (h <= CASE p.camera_id WHEN 'cam3' THEN 30 ELSE 10 END OR h BETWEEN 160 AND 180)) AS red_pixels,
    count(*) FILTER (s >= 100 AND v >= 100 AND h BETWEEN 40 AND 80) AS green_pixels, count(*) FILTER (s >= 100 AND v >= 100 AND h BETWEEN 20 AND 35) AS yellow_pixels
  FROM shot p JOIN cfgs c ON p.camera_id = c.camera_id AND px >= lx1 AND px < lx2 AND py >= ly1 AND py < ly2 GROUP BY ALL),
states AS (SELECT camera_id, frame_number, red_pixels, green_pixels, yellow_pixels,
    CASE WHEN red_pixels > green_pixels AND red_pixels > yellow_pixels AND red_pixels > 50 THEN 'RED'
      WHEN green_pixels > red_pixels AND green_pixels > yellow_pixels AND green_pixels > 50 THEN 'GREEN' WHEN yellow_pixels > 50 THEN 'YELLOW' ELSE 'UNKNOWN' END AS light_state
  FROM (SELECT camera_id, frame_number, coalesce(red_pixels, 0) AS red_pixels, coalesce(green_pixels, 0) AS green_pixels, coalesce(yellow_pixels, 0) AS yellow_pixels
        FROM (SELECT DISTINCT camera_id, frame_number FROM shot) f LEFT JOIN counted USING (camera_id, frame_number)) t)"""


def _own_colours(spark):
    """The scaled configuration; the third camera sees a wider red."""
    names = ("red_lower1", "red_upper1", "red_lower2", "red_upper2", "green_lower", "green_upper", "yellow_lower", "yellow_upper")
    wide = {"red_lower1": (0, 100, 100), "red_upper1": (30, 255, 255)}
    own = F.struct(*(F.array(*map(F.lit, wide[n])).alias(n) if n in wide else F.lit(None).cast("array<int>").alias(n) for n in names))
    return _scaled(spark).withColumn("color_detection", F.when(F.col("camera_id") == "cam3", own).otherwise(F.col("color_detection")))


@query("e11_light_by_camera", sql_with("cfgs", "").rstrip() + _PIXEL_LIGHT + "\nSELECT * FROM states")
def _(spark, sf):
    return light.camera_light(d.frame_pixels(spark, sf), _own_colours(spark))


@query("i06_red_light_from_pixels", sql_with("zoned cfgs", "").rstrip() + _PIXEL_LIGHT + """
SELECT camera_id, track_id, frame_number FROM (
  SELECT c.camera_id, c.det_id AS track_id, c.frame_number, row_number() OVER (PARTITION BY c.camera_id, c.det_id ORDER BY c.frame_number) AS n
  FROM zoned c JOIN states l ON l.camera_id = c.camera_id AND l.frame_number = c.frame_number JOIN cfgs ON cfgs.camera_id = c.camera_id
  WHERE class_id IN (2, 3, 5) AND conf >= 0.4e0 AND light_state = 'RED'
    AND CASE direction WHEN 'above' THEN y + h < stop_y ELSE y + h > stop_y END) r WHERE n = 1""")
def _(spark, sf):
    out = redlight.red_light_violations_from_pixels(_on_tracks(spark, sf), d.frame_pixels(spark, sf), _own_colours(spark), classes=VEHICLES)
    return out.select("camera_id", "track_id", "frame_number")


@query("i08_stop_line_rule", sql_with("cl light cfgs", """
SELECT c.camera_id, frame_number, CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' ELSE 'bus' END AS vehicle,
  x + w / 2.0e0 AS cx, y + h / 2.0e0 AS cy
FROM cl c JOIN light l USING (camera_id, frame_number) JOIN cfgs ON cfgs.camera_id = c.camera_id
WHERE class_id IN (2, 3, 5) AND light_state = 'RED' AND y + h / 2.0e0 > stop_y"""))
def _(spark, sf):
    b = g.box()
    item = F.struct(F.col("class_id").alias("class_id"), g.class_name(F.col("class_id")).alias("class_name"),
                    F.col("conf").cast("float").alias("confidence"), F.array(*g.centroid(b)).alias("center"),
                    F.lit("UNKNOWN").alias("state"))
    lamp = F.struct(F.lit(9).alias("class_id"), F.lit("traffic light").alias("class_name"), F.lit(1.0).cast("float").alias("confidence"),
                    F.array(F.lit(0.0), F.lit(0.0)).alias("center"), F.col("light_state").alias("state"))
    boxes = _boxes(spark, sf).where(F.col("class_id").isin(*VEHICLES))
    per_frame = boxes.groupBy("camera_id", "frame_number").agg(F.collect_list(item).alias("found"))
    frames = per_frame.join(d.frame_light(spark, sf), ["camera_id", "frame_number"]).select(
        "camera_id", "frame_number", F.concat("found", F.array(lamp)).alias("detections"))
    out = redlight.stop_line_violations(frames, _scaled(spark)).select("camera_id", "frame_number", F.inline("violations"))
    return out.select("camera_id", "frame_number", "vehicle", F.get("position", F.lit(0)).alias("cx"),
                      F.get("position", F.lit(1)).alias("cy"))


# ---------------------------------------------------------------- tracks


@query("d13_nearest_in_previous_frame", sql_with("cl", """
SELECT camera_id, frame_number, det_id, prev_det_id, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id, frame_number, det_id ORDER BY distance, prev_det_id) AS n FROM (
    SELECT a.camera_id, a.frame_number, a.det_id, b.det_id AS prev_det_id,
      sqrt(pow(a.x + a.w / 2.0e0 - b.x - b.w / 2.0e0, 2) + pow(a.y + a.h / 2.0e0 - b.y - b.h / 2.0e0, 2)) AS distance
    FROM cl a JOIN cl b ON a.camera_id = b.camera_id AND b.frame_number = a.frame_number - 1
    WHERE a.class_id IN (2, 3, 5) AND b.class_id IN (2, 3, 5)) p WHERE distance <= 100) q WHERE n = 1"""))
def _(spark, sf):
    rows = _boxes(spark, sf).where(F.col("class_id").isin(*VEHICLES))
    return tracking.nearest_in_previous_frame(rows).withColumn("distance", r6("distance"))


@query("f05_first_type", sql_with("det", """
SELECT camera_id, det_id AS track_id, arg_min(t, frame_number) AS vehicle_type FROM (
  SELECT *, CASE (class_id + frame_number) % 4 WHEN 0 THEN 'car' WHEN 1 THEN 'bus' WHEN 2 THEN 'truck' ELSE 'motorcycle' END AS t
  FROM det) x GROUP BY ALL"""))
def _(spark, sf):
    t = (F.col("class_id") + F.col("frame_number")) % 4
    kind = F.when(t == 0, "car").when(t == 1, "bus").when(t == 2, "truck").otherwise("motorcycle")
    rows = d.detections(spark, sf).withColumns({"track_id": F.col("det_id"), "vehicle_type": kind})
    return tracking.first_type(rows)


@query("f06_latest_frame", sql_with("det", """
SELECT camera_id, max(frame_number) AS frame_number, round(max(ts_sec), 6) AS ts_sec FROM det GROUP BY 1"""))
def _(spark, sf):
    from kerbwatch.plans import reports

    frames = d.detections(spark, sf).select("camera_id", "frame_number", "ts_sec")
    return reports.latest_frames(frames).withColumn("ts_sec", r6("ts_sec"))


@query("f07_frame_cadence", sql_with("det", """
SELECT camera_id, frame_number, n, round(s + n * 0.2e0, 6) AS due_ts, round(ts_sec - (s + n * 0.2e0), 6) AS behind, round(ts_sec - p, 6) AS gap
FROM (SELECT *, row_number() OVER w AS n, lag(ts_sec) OVER w AS p, min(ts_sec) OVER (PARTITION BY camera_id) AS s
      FROM (SELECT DISTINCT camera_id, frame_number, ts_sec FROM det) f
      WINDOW w AS (PARTITION BY camera_id ORDER BY ts_sec, frame_number)) g"""))
def _(spark, sf):
    out = tracking.cadence(d.detections(spark, sf), 0.2)
    return out.select("camera_id", "frame_number", "n", *(r6(c).alias(c) for c in ("due_ts", "behind", "gap")))


@query("f08_track_lifetimes", sql_with("viol", """
SELECT violation_id, camera_id, track_id, CAST(sum(CASE WHEN gap IS NULL OR gap > 43200 THEN 1 ELSE 0 END) OVER
  (PARTITION BY camera_id, track_id ORDER BY ts_sec, violation_id) AS BIGINT) AS lifetime
FROM (SELECT *, ts_sec - lag(ts_sec) OVER (PARTITION BY camera_id, track_id ORDER BY ts_sec, violation_id) AS gap
      FROM (SELECT *, epoch_us(detected_at) / 1000000.0e0 AS ts_sec FROM viol) a) b"""))
def _(spark, sf):
    rows = _timed(d.violations(spark, sf)).withColumn("frame_number", F.col("violation_id"))
    out = tracking.lifetimes(rows, 43200.0, width=86400.0)
    return out.select("violation_id", "camera_id", "track_id", "lifetime")


def _timed(violations):
    seconds = F.unix_micros(F.col("detected_at").cast("timestamp")) / F.lit(1e6)
    return violations.withColumns({"ts_sec": seconds, "det_id": F.col("violation_id")})


@query("h02_gone_tracks", sql_with("det", """
SELECT camera_id, count(*) AS gone FROM (SELECT DISTINCT camera_id, det_id FROM det WHERE frame_number % 8 < 4 AND class_id = 2
  EXCEPT SELECT DISTINCT camera_id, det_id FROM det WHERE frame_number % 8 >= 4 AND class_id = 2 AND det_id % 3 <> 1 OR det_id % 5 = 0)
GROUP BY 1"""))
def _(spark, sf):
    dets = d.detections(spark, sf)
    stored = dets.where("frame_number % 8 < 4 AND class_id = 2").select("camera_id", "det_id")
    active = dets.where("frame_number % 8 >= 4 AND class_id = 2 AND det_id % 3 <> 1 OR det_id % 5 = 0").select("camera_id", "det_id")
    return stored.subtract(active).groupBy("camera_id").agg(F.count("*").alias("gone"))


# ---------------------------------------------------------------- ordered rules


@query("f04_cooldown", sql_with("viol", """
, v AS (SELECT *, epoch_us(detected_at) AS us FROM viol),
kept(camera_id, track_id, us) AS (
  SELECT camera_id, track_id, min(us) FROM v GROUP BY ALL
  UNION ALL
  SELECT k.camera_id, k.track_id, (SELECT min(v.us) FROM v WHERE v.camera_id = k.camera_id AND v.track_id = k.track_id
                                     AND v.us >= k.us + 43200000000) FROM kept k WHERE k.us IS NOT NULL)
SELECT v.camera_id, v.track_id, v.violation_id FROM kept JOIN v USING (camera_id, track_id, us)""", recursive=True).replace(")\n,", "),", 1))
def _(spark, sf):
    rows = _timed(d.violations(spark, sf))
    out = dedup.cooldown(rows, 43200.0)
    return out.select("camera_id", "track_id", F.col("det_id").alias("violation_id"))


@query("d12_first_of_cluster", sql_with("cl", """
SELECT a.camera_id, a.ts_sec, a.det_id FROM cl a WHERE a.class_id = 7 AND NOT EXISTS (
  SELECT 1 FROM cl b WHERE b.class_id = 7 AND b.camera_id = a.camera_id
    AND (b.ts_sec < a.ts_sec OR (b.ts_sec = a.ts_sec AND b.det_id < a.det_id)) AND a.ts_sec - b.ts_sec < 3
    AND sqrt(pow(a.x + a.w / 2.0e0 - b.x - b.w / 2.0e0, 2) + pow(a.y + a.h / 2.0e0 - b.y - b.h / 2.0e0, 2)) < 50)"""))
def _(spark, sf):
    heads = tracking.with_centroid(_boxes(spark, sf).where("class_id = 7"))
    return dedup.first_of_cluster(heads).select("camera_id", "ts_sec", "det_id")


REPEATS = recursive("cl", """
, reports AS (SELECT *, x + w / 2.0e0 AS cx, y + h / 2.0e0 AS cy, det_id AS track_id FROM cl WHERE class_id = 7)""", KEPT)


@query("d12_without_repeats_exact", REPEATS + "\nSELECT camera_id, ts_sec, det_id, track_id FROM kept_rows")
def _(spark, sf):
    heads = tracking.with_centroid(_boxes(spark, sf).where("class_id = 7")).withColumn("track_id", F.col("det_id"))
    return dedup.without_repeats(heads)


TRACKS = recursive("cl", ", moves AS (SELECT * FROM cl WHERE class_id IN (2, 3, 5))", tracked("moves"))


@query("i01_centroid_tracks", TRACKS + "\nSELECT camera_id, frame_number, det_id, track_id, is_new FROM tracks")
def _(spark, sf):
    return tracking.track(_boxes(spark, sf).where(F.col("class_id").isin(*VEHICLES)))


LANES = recursive("zoned sided", f"""
, moves AS (SELECT *, {KIND} FROM zoned WHERE class_id IN (2, 3, 5) AND conf >= 0.4e0 AND camera_id IN (SELECT camera_id FROM lines))""",
                  tracked("moves"), LANE_WALK)
_SIDE = "CASE {} WHEN -1 THEN 'left' WHEN 1 THEN 'right' END"


@query("i02_i07_lane_violations", LANES + f"""
SELECT s.camera_id, s.frame_number, s.ts_sec, s.det_id, s.x, s.y, s.w, s.h, s.track_id, w.vehicle_type, w.line AS line_id,
  {_SIDE.format('w.was')} AS from_side, {_SIDE.format('w.now')} AS to_side
FROM watch w JOIN sights s ON s.camera_id = w.camera_id AND s.track_id = w.track_id AND s.m = w.m WHERE w.line IS NOT NULL""")
def _(spark, sf):
    return lanes.lane_violations(_boxes(spark, sf), _scaled(spark), classes=VEHICLES)


ON_TRACKS = recursive("zoned sided", f"""
, moves AS (SELECT *, {KIND} FROM zoned WHERE class_id IN (2, 3, 5) AND conf >= 0.4e0 AND camera_id IN (SELECT camera_id FROM lines)),
tracks AS (SELECT *, det_id AS track_id FROM moves)""", LANE_WALK)
_LANE_ROWS = f"""
SELECT s.camera_id, s.track_id, s.frame_number, s.det_id, s.ts_sec, s.x, s.y, s.w, s.h, w.line AS line_id, {_SIDE.format('w.was')} AS from_side,
  {_SIDE.format('w.now')} AS to_side, w.vehicle_type
FROM watch w JOIN sights s ON s.camera_id = w.camera_id AND s.track_id = w.track_id AND s.m = w.m WHERE w.line IS NOT NULL"""


def _on_tracks(spark, sf):
    return _boxes(spark, sf).withColumn("track_id", F.col("det_id"))


@query("i07_lane_violations_on_tracks", ON_TRACKS + _LANE_ROWS)
def _(spark, sf):
    return lanes.lane_violations_on_tracks(_on_tracks(spark, sf), _scaled(spark), classes=VEHICLES)


_TWIN = "OVER (PARTITION BY camera_id, frame_number, x, y, w, h ORDER BY det_id)"
_SURE = "least(0.99e0, greatest(0.1e0, {} * 0.25e0 + {} * 0.25e0 + {} * 0.5e0))"

HELMETS = recursive("heads persons bikes helmets", _HEADS, _RIDERS, f"""
, twins AS MATERIALIZED (SELECT *, first_value(det_id) {_TWIN} AS first_id, first_value(conf) {_TWIN} AS first_conf FROM persons),
mounts AS MATERIALIZED (SELECT *, first_value(conf) {_TWIN} AS first_conf FROM bikes),
standing AS (SELECT h.camera_id, h.frame_number, h.ts_sec, h.det_id, h.conf AS head_conf, p.conf AS person_conf, p.det_id AS person,
    h.x AS hx, h.y AS hy, h.w AS hw, h.h AS hh, coalesce(p.x, h.x) AS x, coalesce(p.y, h.y) AS y, coalesce(p.w, h.w) AS w, coalesce(p.h, h.h) AS h
  FROM heads h JOIN head_match m ON m.camera_id = h.camera_id AND m.frame_number = h.frame_number AND m.head_det_id = h.det_id
  LEFT JOIN persons p ON p.camera_id = h.camera_id AND p.frame_number = h.frame_number AND p.det_id = m.person_det_id),
direct AS (SELECT s.camera_id, s.frame_number, s.ts_sec, true AS direct, s.det_id AS place, 0.0e0 AS wish, CAST(0 AS BIGINT) AS rider, any_value(person) AS person,
    any_value(s.x) AS x, any_value(s.y) AS y, any_value(s.w) AS w, any_value(s.h) AS h, any_value(hx + hw / 2.0e0) AS cx, any_value(hy + hh / 2.0e0) AS cy,
    any_value(person_conf) AS person_conf, any_value(head_conf) AS head_conf, arg_min(v.conf, v.det_id) AS vehicle_conf
  FROM standing s LEFT JOIN bikes v ON v.camera_id = s.camera_id AND v.frame_number = s.frame_number AND ({iou('s', 'v')} >= 0.15e0 OR {feet_in('s', 'v')})
  GROUP BY s.camera_id, s.frame_number, s.ts_sec, s.det_id),
guarded AS (SELECT DISTINCT p.camera_id, p.frame_number, p.det_id FROM (SELECT camera_id, frame_number, det_id, {strip('q')} FROM persons q) p
  JOIN helmets k ON k.camera_id = p.camera_id AND k.frame_number = p.frame_number AND {iou('k', 'p')} >= 0.15e0),
fallback AS (SELECT p.camera_id, p.frame_number, p.ts_sec, p.det_id AS rider, v.det_id AS place, p.first_id AS person,
    -({iou('p', 'v')} + CASE WHEN {feet_in('p', 'v')} THEN 0.1e0 ELSE 0.0e0 END) AS wish, p.x, p.y, p.w, p.h, p.first_conf AS person_conf, v.first_conf AS vehicle_conf,
    k.det_id IS NOT NULL AS has_helmet
  FROM rider_match r JOIN twins p ON p.camera_id = r.camera_id AND p.frame_number = r.frame_number AND p.det_id = r.person_det_id
  JOIN mounts v ON v.camera_id = r.camera_id AND v.frame_number = r.frame_number AND v.det_id = r.vehicle_det_id
  LEFT JOIN guarded k ON k.camera_id = p.camera_id AND k.frame_number = p.frame_number AND k.det_id = p.det_id
  WHERE NOT EXISTS (SELECT 1 FROM head_match m WHERE m.camera_id = p.camera_id AND m.frame_number = p.frame_number AND m.person_det_id = p.first_id)),
asked AS (
  SELECT camera_id, frame_number, ts_sec, direct, place, wish, rider, person, x, y, w, h, cx, cy, false AS has_helmet,
    CASE WHEN vehicle_conf IS NULL THEN sure ELSE least(0.99e0, sure + 0.1e0) END AS confidence,
    CASE WHEN vehicle_conf IS NULL THEN 'head_only_detection' ELSE 'direct_no_helmet' END AS method, vehicle_conf IS NOT NULL AS on_vehicle
  FROM (SELECT *, {_SURE.format('coalesce(person_conf, 0.6e0)', 'coalesce(vehicle_conf, 0.3e0)', 'head_conf')} AS sure FROM direct) d
  UNION ALL
  SELECT camera_id, frame_number, ts_sec, false, place, wish, rider, person, x, y, w, h, x + w / 2.0e0, y + h / 2.0e0, has_helmet,
    {_SURE.format('person_conf', 'vehicle_conf', '0.6e0')}, 'fallback_no_helmet', true FROM fallback),
spaced AS (SELECT *, ts_sec - lag(ts_sec) OVER (PARTITION BY camera_id ORDER BY ts_sec, frame_number) AS pause FROM asked),
scenes AS (SELECT *, sum(CASE WHEN pause < 3 THEN 0 ELSE 1 END) OVER (PARTITION BY camera_id ORDER BY ts_sec, frame_number ROWS UNBOUNDED PRECEDING) AS piece0 FROM spaced),
turns AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY camera_id, piece
    ORDER BY ts_sec, frame_number, CASE WHEN direct THEN 1 ELSE 2 END, place, wish, rider) AS n
  FROM (SELECT *, max(piece0) OVER (PARTITION BY camera_id, ts_sec, frame_number) AS piece FROM scenes) z),
start AS (SELECT DISTINCT camera_id, piece FROM turns),
rule AS (
  SELECT camera_id, piece, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS frame, CAST(NULL AS BIGINT) AS track, false AS violation, CAST(0 AS BIGINT) AS used,
    [{{'id': CAST(0 AS BIGINT), 'x': 0.0e0, 'y': 0.0e0, 't': -1e9}}] AS live, [{{'t': -1e9, 'k': CAST(0 AS BIGINT), 'x': 0.0e0, 'y': 0.0e0}}] AS recent,
    [CAST(-1 AS BIGINT)] AS done FROM start
  UNION ALL
  SELECT camera_id, piece, n, frame_number, track, violation, CASE WHEN counts THEN used + 1 ELSE used END,
    CASE WHEN direct OR skip THEN live WHEN hit THEN list_transform(live, lambda k: CASE WHEN k.id = best.id THEN {{'id': k.id, 'x': cx, 'y': cy, 't': ts_sec}} ELSE k END)
      ELSE list_append(live, {{'id': used + 1, 'x': cx, 'y': cy, 't': ts_sec}}) END,
    CASE WHEN violation THEN list_append(recent, {{'t': ts_sec, 'k': track, 'x': cx, 'y': cy}}) ELSE recent END,
    CASE WHEN NOT direct AND NOT skip AND (has_helmet OR violation) THEN list_append(done, person) ELSE done END
  FROM (SELECT *, NOT skip AND NOT has_helmet AND NOT seen AS violation, CASE WHEN direct THEN NOT seen ELSE NOT skip AND NOT hit END AS counts FROM (
    SELECT *, len(list_filter(recent, lambda r: r.k = track OR sqrt(pow(cx - r.x, 2) + pow(cy - r.y, 2)) < 50)) > 0 AS seen FROM (
      SELECT *, CASE WHEN direct OR NOT hit THEN used + 1 ELSE best.id END AS track FROM (
        SELECT *, NOT direct AND list_contains(done, person) AS skip, NOT direct AND coalesce(best.d <= 80, false) AS hit FROM (
          SELECT s.*, r.used, list_filter(r.recent, lambda q: s.ts_sec - q.t < 3) AS recent,
            CASE WHEN s.direct THEN r.live ELSE list_filter(r.live, lambda k: s.ts_sec - k.t <= 1) END AS live,
            CASE WHEN r.frame = s.frame_number THEN r.done ELSE [CAST(-1 AS BIGINT)] END AS done,
            list_sort(list_transform(list_filter(r.live, lambda k: s.ts_sec - k.t <= 1), lambda k: {{'d': sqrt(pow(s.cx - k.x, 2) + pow(s.cy - k.y, 2)), 'id': k.id}}))[1] AS best
          FROM rule r JOIN turns s ON s.camera_id = r.camera_id AND s.piece = r.piece AND s.n = r.n + 1) a) b) c) d) e),
offsets AS (SELECT camera_id, piece, sum(most) OVER (PARTITION BY camera_id ORDER BY piece) - most AS ahead
  FROM (SELECT camera_id, piece, max(used) AS most FROM rule GROUP BY ALL) u),
bare AS (SELECT s.*, CAST(r.track + ahead AS BIGINT) AS track_id FROM rule r JOIN turns s ON s.camera_id = r.camera_id AND s.piece = r.piece AND s.n = r.n
  JOIN offsets o ON o.camera_id = r.camera_id AND o.piece = r.piece WHERE violation)""")


# ---------------------------------------------------------------- records and messages


_ID = """md5(concat_ws('|', camera_id, track_id, frame_number, '{kind}'))"""
_UUID = "concat_ws('-', substring(hash, 1, 8), substring(hash, 9, 4), substring(hash, 13, 4), substring(hash, 17, 4), substring(hash, 21, 12))"
_STAMPED = """SELECT *, make_timestamp(CAST(round(ts_sec * 1e6) AS BIGINT)) AS moment, {uuid} AS violation_id
  FROM (SELECT *, {ident} AS hash FROM ({rows}) r) q"""
_PATH = "'{folder}/{prefix}_' || camera_id || '_' || strftime(moment, '%Y%m%d_%H%M%S') || '_' || substring(violation_id, 1, 8) || '.jpg'"


def _stamped(rows: str, kind: str) -> str:
    return _STAMPED.format(uuid=_UUID, ident=_ID.format(kind=kind), rows=rows)


_RED_ROWS = """SELECT z.*, first_type AS vehicle_type, stop_y, direction FROM (
    SELECT t.*, first_value(t.kind) OVER w AS first_type, row_number() OVER w AS n FROM (
      SELECT c.camera_id, c.det_id AS track_id, c.frame_number, c.ts_sec, x, y, w, h, stop_y, direction,
        CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' ELSE 'bus' END AS kind
      FROM zoned c JOIN light l USING (camera_id, frame_number) JOIN cfgs ON cfgs.camera_id = c.camera_id
      WHERE class_id IN (2, 3, 5) AND conf >= 0.4e0 AND light_state = 'RED'
        AND CASE direction WHEN 'above' THEN y + h < stop_y ELSE y + h > stop_y END) t
    WINDOW w AS (PARTITION BY camera_id, track_id ORDER BY frame_number)) z WHERE n = 1"""


def _red_records(spark, sf):
    cfg = _scaled(spark)
    found = redlight.red_light_violations_on_tracks(_on_tracks(spark, sf), cfg, d.frame_light(spark, sf), classes=VEHICLES)
    return records.red_light_records(found, cfg, d.FRAME_W, d.FRAME_H)


def _lane_records(spark, sf):
    cfg = _scaled(spark)
    found = lanes.lane_violations_on_tracks(_on_tracks(spark, sf), cfg, classes=VEHICLES)
    return records.lane_records(found, cfg, d.FRAME_W, d.FRAME_H)


def _helmet_records(spark, sf):
    boxes = _boxes(spark, sf)
    return records.helmet_records(helmet.helmet_violations(boxes), boxes, d.FRAME_W, d.FRAME_H)


def _plain_times(rows):
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("timestamp", "created_at")}).drop("metadata")


_BOXES = "x AS bbox_x, y AS bbox_y, w AS bbox_w, h AS bbox_h"


@query("m07_red_light_records", sql_with("zoned light cfgs", f"""
SELECT violation_id, moment AS timestamp, camera_id, track_id, frame_number, 'RED_LIGHT' AS violation_type, vehicle_type, 'RED' AS traffic_light_state,
  CAST(NULL AS VARCHAR) AS crossed_line_type, CAST(NULL AS INT) AS line_id, CAST(NULL AS VARCHAR) AS from_side, CAST(NULL AS VARCHAR) AS to_side,
  0.9e0 AS confidence, {_BOXES}, {_PATH.format(folder='violations/redlight', prefix='redlight')} AS image_path, moment AS created_at
FROM ({_stamped(_RED_ROWS, 'RED_LIGHT')}) s"""))
def _(spark, sf):
    return _plain_times(_red_records(spark, sf))


@query("m07_red_light_messages", sql_with("zoned light cfgs", f"""
SELECT camera_id AS key, violation_id, strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, vehicle_type, 'RED' AS traffic_light_state,
  x, y, w, h, track_id, frame_number, 0.9e0 AS confidence, stop_y AS stop_line_y, direction AS violation_direction, 1920 AS width, 1080 AS height
FROM ({_stamped(_RED_ROWS, 'RED_LIGHT')}) s"""))
def _(spark, sf):
    topic = records.messages(_red_records(spark, sf), records.RED_LIGHT)
    good, _ = records.read_messages(topic, records.RED_LIGHT)
    return good.select(F.col("camera_id").alias("key"), "violation_id", "timestamp", "vehicle_type", "traffic_light_state", "bounding_box.*",
                       "track_id", "frame_number", "confidence", "metadata.stop_line_y", "metadata.violation_direction",
                       F.get("metadata.frame_size", F.lit(0)).alias("width"), F.get("metadata.frame_size", F.lit(1)).alias("height"))


_LANE_AT = f"""SELECT r.*, a.distance, a.type FROM ({_LANE_ROWS}) r JOIN sided a USING (camera_id, frame_number, det_id, line_id)"""


@query("m08_lane_records", ON_TRACKS + f"""
SELECT violation_id, moment AS timestamp, camera_id, track_id, frame_number, 'lane_violation' AS violation_type, vehicle_type,
  CAST(NULL AS VARCHAR) AS traffic_light_state, type AS crossed_line_type, CAST(line_id AS INT) AS line_id, from_side, to_side,
  CAST(NULL AS DOUBLE) AS confidence, {_BOXES}, {_PATH.format(folder='violations/lane', prefix='lane')} AS image_path, moment AS created_at
FROM ({_stamped(_LANE_AT, 'lane_violation')}) s""")
def _(spark, sf):
    return _plain_times(_lane_records(spark, sf))


@query("m08_lane_messages", ON_TRACKS + f"""
SELECT violation_id, camera_id, track_id, strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, type AS crossed_line_type, CAST(line_id AS INT) AS line_id,
  from_side, to_side, x, w, x + w / 2.0e0 AS px, CAST(y + h AS DOUBLE) AS py, round(distance, 6) AS distance
FROM ({_stamped(_LANE_AT, 'lane_violation')}) s""")
def _(spark, sf):
    good, _ = records.read_messages(records.messages(_lane_records(spark, sf), records.LANE), records.LANE)
    box, place = F.col("bounding_box"), F.col("metadata.violation_position")
    return good.select("violation_id", "camera_id", "track_id", "timestamp", "crossed_line_type", "line_id", "from_side", "to_side",
                       F.get(box, F.lit(0)).alias("x"), F.get(box, F.lit(2)).alias("w"), F.get(place, F.lit(0)).alias("px"),
                       F.get(place, F.lit(1)).alias("py"), r6("metadata.distance_to_line").alias("distance"))


@query("m06_helmet_records", HELMETS + f"""
SELECT violation_id, moment AS timestamp, camera_id, track_id, frame_number, 'no_helmet' AS violation_type, CAST(NULL AS VARCHAR) AS vehicle_type,
  CAST(NULL AS VARCHAR) AS traffic_light_state, CAST(NULL AS VARCHAR) AS crossed_line_type, CAST(NULL AS INT) AS line_id, CAST(NULL AS VARCHAR) AS from_side,
  CAST(NULL AS VARCHAR) AS to_side, round(confidence, 6) AS confidence, {_BOXES}, {_PATH.format(folder='violations', prefix='helmet')} AS image_path,
  moment AS created_at FROM ({_stamped('SELECT * FROM bare', 'no_helmet')}) s""")
def _(spark, sf):
    return _plain_times(_helmet_records(spark, sf)).withColumn("confidence", r6("confidence"))


@query("m06_helmet_messages", HELMETS + f"""
SELECT violation_id, s.camera_id, strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, track_id, s.frame_number, x, y, w, h, round(confidence, 6) AS confidence,
  method AS detection_method, CAST(persons_detected AS INT) AS persons_detected, CAST(no_helmets_detected AS INT) AS no_helmets_detected
FROM ({_stamped('SELECT * FROM bare', 'no_helmet')}) s JOIN (SELECT camera_id, frame_number, count(*) FILTER (class_id = 0) AS persons_detected,
  count(*) FILTER (class_id = 7) AS no_helmets_detected FROM cl GROUP BY ALL) c ON c.camera_id = s.camera_id AND c.frame_number = s.frame_number""")
def _(spark, sf):
    good, _ = records.read_messages(records.messages(_helmet_records(spark, sf), records.HELMET), records.HELMET)
    return good.select("violation_id", "camera_id", "timestamp", "track_id", "frame_number", "bounding_box.*", r6("confidence").alias("confidence"),
                       "detection_method", "metadata.persons_detected", "metadata.no_helmets_detected")


@query("i05_helmet_candidates", sql_with("heads persons bikes", f"""
SELECT camera_id, frame_number, head_id, person_id, round(least(0.99e0, c + CASE WHEN vehicle_conf IS NULL THEN 0 ELSE 0.1e0 END), 6) AS confidence,
  CASE WHEN vehicle_conf IS NULL THEN 'head_only_detection' ELSE 'direct_no_helmet' END AS method
FROM (SELECT *, least(0.99e0, greatest(0.1e0, coalesce(person_conf, 0.6e0) * 0.25e0 + coalesce(vehicle_conf, 0.3e0) * 0.25e0 + head_conf * 0.5e0)) AS c
  FROM (SELECT s.camera_id, s.frame_number, head_id, person_id, any_value(person_conf) AS person_conf, any_value(head_conf) AS head_conf,
          arg_min(v.conf, v.det_id) AS vehicle_conf
    FROM (SELECT h.camera_id, h.frame_number, h.det_id AS head_id, h.conf AS head_conf, p.det_id AS person_id, p.conf AS person_conf,
            coalesce(p.x, h.x) AS x, coalesce(p.y, h.y) AS y, coalesce(p.w, h.w) AS w, coalesce(p.h, h.h) AS h
          FROM heads h LEFT JOIN (
            SELECT h.camera_id, h.frame_number, h.det_id, min(p.det_id) AS pid FROM heads h JOIN persons p
              ON h.camera_id = p.camera_id AND h.frame_number = p.frame_number AND {head_in('h', 'p')} GROUP BY ALL) m
            USING (camera_id, frame_number, det_id)
          LEFT JOIN persons p ON p.camera_id = h.camera_id AND p.frame_number = h.frame_number AND p.det_id = m.pid) s
    LEFT JOIN bikes v ON s.camera_id = v.camera_id AND s.frame_number = v.frame_number
      AND ({iou('s', 'v')} >= 0.15e0 OR {feet_in('s', 'v')}) GROUP BY ALL) t) u"""))
def _(spark, sf):
    persons, vehicles, _, heads = _groups(spark, sf)
    frame = list(relate.FRAME)
    item = F.struct("det_id", "x", "y", "w", "h", "conf")
    match = relate.heads_to_persons(heads, persons).withColumnRenamed("head_det_id", "det_id")
    h = heads.select(*frame, "det_id", item.alias("head")).join(match, [*frame, "det_id"], "left")
    h = h.join(persons.select(*frame, F.col("det_id").alias("person_det_id"), item.alias("person")), [*frame, "person_det_id"], "left")
    standing = h.select(*frame, F.col("det_id").alias("id"), F.coalesce("person", "head").alias("b")).select(
        *frame, F.col("id").alias("det_id"), "b.x", "b.y", "b.w", "b.h", "b.conf")
    on = relate.on_vehicle(standing, vehicles).withColumnRenamed("person_det_id", "det_id")
    h = h.join(on, [*frame, "det_id"], "left")
    conf = helmet.direct_confidence(F.col("person.conf"), F.col("vehicle_conf"), F.col("head.conf"))
    return h.select(*frame, F.col("det_id").alias("head_id"), F.col("person_det_id").alias("person_id"), r6(conf).alias("confidence"),
                    helmet.direct_method(F.col("vehicle_conf").isNotNull()).alias("method"))


@query("i05_helmet_violations", HELMETS + """
SELECT camera_id, frame_number, ts_sec, track_id, x, y, w, h, round(confidence, 6) AS confidence, method, on_vehicle FROM bare""")
def _(spark, sf):
    out = helmet.helmet_violations(_boxes(spark, sf))
    return out.select("camera_id", "frame_number", "ts_sec", "track_id", "box.*", r6("confidence").alias("confidence"),
                      "method", "on_vehicle")
