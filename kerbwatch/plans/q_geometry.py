"""Queries for filters, projections and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbwatch.functions import fields
from kerbwatch.functions import geometry as g
from kerbwatch.operators import lanes, select
from kerbwatch.plans import derived as d
from kerbwatch.plans.oracle import feet_in, head_in, iou, sql_with
from kerbwatch.plans.registry import query, r6
from kerbwatch.sources import config

ID = ("camera_id", "frame_number", "det_id")


def _scaled(spark):
    return config.scale_config(d.camera_config(spark), d.FRAME_W, d.FRAME_H)


def _boxes(spark, sf):
    return d.boxes(spark, sf)


# ---------------------------------------------------------------- boxes


@query("b01_clamp_box", sql_with("cl", "SELECT camera_id, frame_number, det_id, x, y, w, h FROM cl"))
def _(spark, sf):
    return d.clamped(d.detections(spark, sf)).select(*ID, "x", "y", "w", "h")


@query("b02_box_corners", sql_with("cl", """
SELECT camera_id, frame_number, det_id, x AS x1, y AS y1, x + w AS x2, y + h AS y2 FROM cl"""))
def _(spark, sf):
    x1, y1, x2, y2 = g.corners(g.box())
    return _boxes(spark, sf).select(*ID, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


@query("b03_centroid", sql_with("cl", """
SELECT camera_id, frame_number, det_id, x + w / 2.0e0 AS cx, y + h / 2.0e0 AS cy FROM cl"""))
def _(spark, sf):
    cx, cy = g.centroid(g.box())
    return _boxes(spark, sf).select(*ID, cx.alias("cx"), cy.alias("cy"))


@query("b04_bottom_center", sql_with("cl", """
SELECT camera_id, frame_number, det_id, x + w / 2.0e0 AS cx, y + h AS bottom FROM cl"""))
def _(spark, sf):
    cx, bottom = g.bottom_center(g.box())
    return _boxes(spark, sf).select(*ID, cx.alias("cx"), bottom.alias("bottom"))


@query("b05_iou_with_next_frame", sql_with("cl", f"""
SELECT a.camera_id, a.frame_number, a.det_id, round({iou('a', 'b')}, 6) AS overlap
FROM cl a JOIN cl b ON a.camera_id = b.camera_id AND a.det_id = b.det_id AND b.frame_number = a.frame_number + 1"""))
def _(spark, sf):
    a = _boxes(spark, sf).select(*ID, *(F.col(c).alias("a_" + c) for c in "xywh"))
    b = _boxes(spark, sf).select("camera_id", (F.col("frame_number") - 1).alias("frame_number"), "det_id",
                                 *(F.col(c).alias("b_" + c) for c in "xywh"))
    return a.join(b, list(ID)).select(*ID, r6(g.iou(g.box("a_"), g.box("b_"))).alias("overlap"))


@query("b06_point_in_box", sql_with("cl", """
SELECT camera_id, frame_number, det_id,
  (x + w / 2.0e0 BETWEEN 400 AND 1000 AND y + h BETWEEN 300 AND 750) AS inside FROM cl"""))
def _(spark, sf):
    target = g.Box(F.lit(400), F.lit(300), F.lit(600), F.lit(450))
    return _boxes(spark, sf).select(*ID, g.covers(target, *g.bottom_center(g.box())).alias("inside"))


@query("b07_point_in_polygon", sql_with("cl zoned", """
SELECT c.camera_id, c.frame_number, c.det_id, z.det_id IS NOT NULL AS inside
FROM cl c LEFT JOIN zoned z USING (camera_id, frame_number, det_id)"""))
def _(spark, sf):
    boxes = config.with_config(_boxes(spark, sf), _scaled(spark).select("camera_id", "zone"))
    return boxes.select(*ID, g.in_zone(*g.centroid(g.box()), F.col("zone")).alias("inside"))


@query("b08_head_region", sql_with("persons", """
SELECT camera_id, frame_number, det_id, x, y, w, CAST(greatest(1, trunc(h * 0.4e0)) AS INT) AS h FROM persons"""))
def _(spark, sf):
    r = g.head_region(g.box(), 0.40)
    return _boxes(spark, sf).where("class_id = 0").select(*ID, "x", "y", "w", r.h.alias("h"))


@query("b09_scale_config", sql_with("det cfgs", """
SELECT c.*, n FROM cfgs c LEFT JOIN (SELECT camera_id, count(*) AS n FROM det GROUP BY 1) USING (camera_id)"""))
def _(spark, sf):
    n = d.detections(spark, sf).groupBy("camera_id").agg(F.count("*").alias("n"))
    return _scaled(spark).join(n, "camera_id", "left").select(
        "camera_id", "stop_y", "tolerance", "direction", F.col("light_x1").alias("lx1"), F.col("light_y1").alias("ly1"),
        F.col("light_x2").alias("lx2"), F.col("light_y2").alias("ly2"), F.col("crossing_threshold").alias("threshold"), "n")


@query("b10_scale_lanes", sql_with("det cfg lines", """
SELECT camera_id, line_id, CAST(trunc(x1 * (1280.0e0 / fw)) AS INT) AS x1, CAST(trunc(y1 * (720.0e0 / fh)) AS INT) AS y1,
  CAST(trunc(x2 * (1280.0e0 / fw)) AS INT) AS x2, CAST(trunc(y2 * (720.0e0 / fh)) AS INT) AS y2, type, n
FROM lines JOIN cfg USING (camera_id) JOIN (SELECT camera_id, count(*) AS n FROM det GROUP BY 1) USING (camera_id)"""))
def _(spark, sf):
    n = d.detections(spark, sf).groupBy("camera_id").agg(F.count("*").alias("n"))
    cfg = config.scale_config(d.camera_config(spark), 1280, 720)
    lines = cfg.select("camera_id", F.posexplode("lane_lines").alias("line_id", "ln")).select("camera_id", "line_id", "ln.*")
    return lines.join(n, "camera_id")


@query("b11_segment_distance", sql_with("sided", """
SELECT camera_id, frame_number, det_id, line_id, round(distance, 6) AS distance FROM sided"""))
def _(spark, sf):
    return _line_rows(spark, sf).select(*ID, "line_id", r6("distance").alias("distance"))


@query("b12_line_side", sql_with("sided", "SELECT camera_id, frame_number, det_id, line_id, side FROM sided"))
def _(spark, sf):
    return _line_rows(spark, sf).select(*ID, "line_id", "side")


def _line_rows(spark, sf):
    cfg = _scaled(spark).select("camera_id", "lane_lines", "crossing_threshold")
    return lanes.line_distances(config.with_config(_boxes(spark, sf), cfg))


@query("b13_solid_lines", sql_with("sided", """
SELECT camera_id, line_id, type = 'solid' AS solid, count(*) AS n FROM sided GROUP BY ALL"""))
def _(spark, sf):
    return _line_rows(spark, sf).groupBy("camera_id", "line_id", "solid").agg(F.count("*").alias("n"))


@query("b14_head_inside_person", sql_with("heads persons", f"""
SELECT h.camera_id, h.frame_number, h.det_id, {head_in('h', 'p')} AS inside
FROM heads h JOIN persons p ON h.camera_id = p.camera_id AND h.frame_number = p.frame_number AND p.det_id = h.det_id - 2"""))
def _(spark, sf):
    boxes = _boxes(spark, sf)
    head = boxes.where("class_id = 7").select(*ID, *(F.col(c).alias("h_" + c) for c in "xywh"))
    person = boxes.where("class_id = 0").select("camera_id", "frame_number", (F.col("det_id") + 2).alias("det_id"),
                                                *(F.col(c).alias("p_" + c) for c in "xywh"))
    return head.join(person, list(ID)).select(*ID, g.head_in_person(g.box("h_"), g.box("p_")).alias("inside"))


@query("b15_violation_confidence", sql_with("det", """
SELECT camera_id, frame_number, det_id, round(least(0.99e0, greatest(0.1e0,
  conf * 0.25e0 + (1 - conf) * 0.25e0 + (conf * 1.4e0 - 0.4e0) * 0.5e0)), 6) AS confidence FROM det"""))
def _(spark, sf):
    conf = F.col("conf")
    mixed = g.violation_confidence(conf, 1 - conf, conf * F.lit(1.4) - F.lit(0.4))
    return d.detections(spark, sf).select(*ID, r6(mixed).alias("confidence"))


@query("b16_boosted_confidence", sql_with("det", """
SELECT camera_id, frame_number, det_id,
  round(CASE WHEN class_id = 3 THEN least(0.99e0, conf + 0.1e0) ELSE conf END, 6) AS confidence FROM det"""))
def _(spark, sf):
    out = g.boosted(F.col("conf"), F.col("class_id") == 3)
    return d.detections(spark, sf).select(*ID, r6(out).alias("confidence"))


@query("b17_past_stop_line", sql_with("cl cfgs", """
SELECT c.camera_id, frame_number, det_id,
  CASE direction WHEN 'above' THEN y + h < stop_y ELSE y + h > stop_y END AS past FROM cl c JOIN cfgs USING (camera_id)"""))
def _(spark, sf):
    boxes = config.with_config(_boxes(spark, sf), _scaled(spark).select("camera_id", "stop_y", "direction"))
    past = g.past_stop_line(g.box().bottom, F.col("stop_y"), F.col("direction"))
    return boxes.select(*ID, past.alias("past"))


@query("b18_class_names", sql_with("det", """
SELECT class_id, CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck'
  ELSE 'vehicle' END AS road_name,
  CASE class_id WHEN 0 THEN 'person' WHEN 1 THEN 'bicycle' WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 4 THEN 'bus'
  WHEN 5 THEN 'truck' WHEN 6 THEN 'with_helmet' WHEN 7 THEN 'without_helmet' ELSE 'vehicle' END AS helmet_name,
  count(*) AS n FROM det GROUP BY ALL"""))
def _(spark, sf):
    c = F.col("class_id")
    return (d.detections(spark, sf).groupBy("class_id").agg(F.count("*").alias("n"))
            .select("class_id", g.class_name(c).alias("road_name"), g.class_name(c, g.HELMET_CLASSES).alias("helmet_name"), "n"))


@query("b19_decode_model_output", """
SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INT) AS class_id, round(CAST(list_max(s) AS DOUBLE), 6) AS conf,
  CAST(trunc(CAST(trunc(abs(embedding[1]) * 1920::FLOAT) AS INT) - CAST(trunc(abs(embedding[3]) * 1920::FLOAT) AS INT) / 2.0e0) AS INT) AS x,
  CAST(trunc(CAST(trunc(abs(embedding[2]) * 1080::FLOAT) AS INT) - CAST(trunc(abs(embedding[4]) * 1080::FLOAT) AS INT) / 2.0e0) AS INT) AS y,
  CAST(trunc(abs(embedding[3]) * 1920::FLOAT) AS INT) AS w, CAST(trunc(abs(embedding[4]) * 1080::FLOAT) AS INT) AS h
FROM (SELECT vec_id, embedding, embedding[6:64] AS s FROM embeddings) t WHERE list_max(s) >= 0.05""")
def _(spark, sf):
    whole = F.transform("embedding", lambda v, i: F.when(i < 4, F.abs(v)).otherwise(v))
    cols = g.decode_head(F.col("vec"), d.FRAME_W, d.FRAME_H, 59)  # all that follow the box and objectness
    raw = d.table(spark, sf, "embeddings").select("vec_id", whole.alias("vec"))
    out = raw.select("vec_id", *(c.alias(n) for n, c in cols.items()))
    return out.where(F.col("conf") >= F.lit(0.05)).withColumn("conf", r6("conf"))


@query("b20_bbox_struct", sql_with("det", """
SELECT camera_id, frame_number, det_id, CASE WHEN det_id % 3 <> 0 THEN x END AS bx, CASE WHEN det_id % 3 <> 0 THEN h END AS bh
FROM det"""))
def _(spark, sf):
    arr = F.when(F.col("det_id") % 3 == 0, F.array("x", "y", "w")).otherwise(F.array("x", "y", "w", "h"))
    return d.detections(spark, sf).withColumn("b", g.bbox_struct(arr)).select(
        *ID, F.col("b.x").alias("bx"), F.col("b.h").alias("bh"))


@query("b21_center_of_corners", sql_with("cl", """
SELECT camera_id, frame_number, det_id, (x + (x + w)) / 2.0e0 AS cx, (y + (y + h)) / 2.0e0 AS cy FROM cl"""))
def _(spark, sf):
    cx, cy = g.corner_center(*g.corners(g.box()))
    return _boxes(spark, sf).select(*ID, cx.alias("cx"), cy.alias("cy"))


@query("b22_resize_plan", """
SELECT page_id, CASE WHEN hh > 720 THEN CAST(round_even(ww * (720.0e0 / hh), 0) AS BIGINT) ELSE ww END AS out_w,
  CASE WHEN hh > 720 THEN 720 ELSE hh END AS out_h
FROM (SELECT page_id, 640 + (page_id * 37) % 3200 AS ww, 360 + (page_id * 53) % 1800 AS hh FROM pages) t""")
def _(spark, sf):
    p = d.table(spark, sf, "pages").select("page_id", (640 + (F.col("page_id") * 37) % 3200).alias("ww"),
                                           (360 + (F.col("page_id") * 53) % 1800).alias("hh"))
    w, h = g.resize_plan(F.col("ww"), F.col("hh"))
    return p.select("page_id", w.alias("out_w"), h.alias("out_h"))


@query("b23_side_names", sql_with("sided", """
SELECT camera_id, line_id, CASE side WHEN -1 THEN 'left' ELSE 'right' END AS side, count(*) AS n FROM sided GROUP BY ALL"""))
def _(spark, sf):
    return _line_rows(spark, sf).groupBy("camera_id", "line_id", g.side_name(F.col("side")).alias("side")).agg(
        F.count("*").alias("n"))


# ---------------------------------------------------------------- filters


@query("c01_class_set", sql_with("det", """
SELECT class_id, count(*) AS n, CAST(sum(x) AS BIGINT) AS sx FROM det WHERE class_id IN (2, 3, 5, 7) GROUP BY 1"""))
def _(spark, sf):
    return select.of_classes(d.detections(spark, sf), g.ROAD_VEHICLES).groupBy("class_id").agg(
        F.count("*").alias("n"), F.sum("x").alias("sx"))


@query("c02_confidence_threshold", sql_with("det", """
SELECT class_id, count(*) AS n FROM det WHERE class_id IN (0, 1, 3) AND conf >= 0.5e0 GROUP BY 1"""))
def _(spark, sf):
    return select.of_classes(d.detections(spark, sf), (0, 1, 3), 0.5).groupBy("class_id").agg(F.count("*").alias("n"))


@query("c03_zone_filter", sql_with("zoned", "SELECT camera_id, frame_number, det_id FROM zoned WHERE class_id IN (2, 3, 5)"))
def _(spark, sf):
    cfg, edges = config.flat_zone(_scaled(spark).select("camera_id", "zone"))
    boxes = config.with_config(select.of_classes(_boxes(spark, sf), (2, 3, 5)), cfg)
    return select.in_detection_zone(boxes, edges).select(*ID)


@query("c05_camera_gates", sql_with("viol cfg lines", """
SELECT camera_id, count(*) AS n, camera_id IN (SELECT camera_id FROM lines) AS has_lanes
FROM viol WHERE camera_id IN (SELECT camera_id FROM cfg) GROUP BY camera_id"""))
def _(spark, sf):
    cfg = d.camera_config(spark)
    known = config.configured(d.violations(spark, sf), cfg).groupBy("camera_id").agg(F.count("*").alias("n"))
    with_lanes = config.lane_configured(known, cfg).select("camera_id", F.lit(True).alias("has_lanes"))
    return known.join(with_lanes, "camera_id", "left").withColumn("has_lanes", F.coalesce("has_lanes", F.lit(False)))


@query("c06_optional_filters", sql_with("viol", """
SELECT violation_id, camera_id, vehicle_type FROM viol WHERE camera_id = 'cam3' AND vehicle_type = 'car'"""))
def _(spark, sf):
    rows = select.matching(d.violations(spark, sf), camera_id="cam3", vehicle_type="car", violation_type=None)
    return rows.select("violation_id", "camera_id", "vehicle_type")


@query("c07_time_windows", sql_with("viol", """
SELECT violation_id, detected_at > m - INTERVAL 24 HOURS AS last_day, detected_at >= m - INTERVAL 1 HOUR AS last_hour,
  detected_at > m - INTERVAL 15 MINUTES AS last_quarter, CAST(detected_at AS DATE) = CAST(m AS DATE) AS today
FROM viol, (SELECT max(ts) AS m FROM events) t"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    as_of = d.newest(v)
    return v.select("violation_id", select.since("detected_at", as_of, "24 HOURS").alias("last_day"),
                    select.since("detected_at", as_of, "1 HOUR", inclusive=True).alias("last_hour"),
                    select.since("detected_at", as_of, "15 MINUTES").alias("last_quarter"),
                    select.same_day("detected_at", as_of).alias("today"))


@query("c08_point_lookup", sql_with("viol", "SELECT * EXCLUDE (props) FROM viol WHERE violation_id = 777"))
def _(spark, sf):
    from kerbwatch.plans import reports

    return reports.by_id(d.violations(spark, sf), 777).drop("props")


@query("c09_frame_sampling", sql_with("det", """
SELECT camera_id, count(*) AS n, count(DISTINCT frame_number) AS frames FROM det WHERE frame_number % 3 = 0 GROUP BY 1"""))
def _(spark, sf):
    return select.every_nth(d.detections(spark, sf), 25.0, 8.0).groupBy("camera_id").agg(
        F.count("*").alias("n"), F.count_distinct("frame_number").alias("frames"))


@query("c10_red_frames", sql_with("light", "SELECT camera_id, frame_number FROM light WHERE light_state = 'RED'"))
def _(spark, sf):
    return d.frame_light(spark, sf).where("light_state = 'RED'").select("camera_id", "frame_number")


@query("c11_unprocessed_frames", sql_with("det", """
SELECT camera_id, frame_number, count(*) AS detection_count FROM det WHERE frame_number % 4 = 1 GROUP BY ALL"""))
def _(spark, sf):
    frames = d.detections(spark, sf).groupBy("camera_id", "frame_number").agg(F.count("*").alias("detection_count"))
    return select.unprocessed(frames.withColumn("processed", F.col("frame_number") % 4 != 1)).drop("processed")


# ---------------------------------------------------------------- scalar functions


@query("h03_feed_type", sql_with("viol", """
SELECT violation_type AS raw_type, CASE WHEN upper(violation_type) LIKE '%RED%' THEN 'RED_LIGHT' ELSE 'HELMET' END AS feed,
  CASE WHEN upper(violation_type) LIKE '%RED%' THEN 'RED_LIGHT' WHEN upper(violation_type) LIKE '%LANE%' THEN 'LANE'
  ELSE 'HELMET' END AS feed_with_lane, count(*) AS n FROM viol GROUP BY ALL"""))
def _(spark, sf):
    t = F.col("violation_type")
    return d.violations(spark, sf).groupBy(t.alias("raw_type"), fields.feed_type(t).alias("feed"),
                                           fields.feed_type(t, keep_lane=True).alias("feed_with_lane")).agg(F.count("*").alias("n"))


@query("h04_iso_timestamps", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE date_trunc('second', ts) END AS at
FROM events""")
def _(spark, sf):
    e = d.table(spark, sf, "events")
    text = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("")))
    at = fields.iso_timestamp(text, F.lit("2000-01-01 00:00:00"))
    return e.select("event_id", at.cast("timestamp_ntz").alias("at"))


@query("h06_json_metrics", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.F1') AS f1 FROM events""")
def _(spark, sf):
    e = d.table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                    F.get_json_object("props", "$.F1").alias("f1"))


@query("h07_json_encode", """
SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","size":[1920,1080]}' AS metadata FROM events""")
def _(spark, sf):
    packed = F.to_json(F.struct("event_id", "event_type", F.array(F.lit(1920), F.lit(1080)).alias("size")))
    return d.table(spark, sf, "events").select("event_id", packed.alias("metadata"))


@query("h08_array_access", sql_with("det", """
SELECT camera_id, frame_number, det_id, CASE WHEN det_id % 2 = 0 THEN y END AS second, 4 - (det_id % 2) * 3 AS n,
  CASE WHEN det_id % 2 = 0 THEN h ELSE x END AS last FROM det"""))
def _(spark, sf):
    arr = F.when(F.col("det_id") % 2 == 0, F.array("x", "y", "w", "h")).otherwise(F.array("x"))
    return d.detections(spark, sf).withColumn("a", arr).select(
        *ID, F.try_element_at("a", F.lit(2)).alias("second"), F.size("a").cast("bigint").alias("n"),
        F.try_element_at("a", F.lit(-1)).alias("last"))


@query("h09_map_operations", """
SELECT user_id, coalesce(max(n) FILTER (event_type = 'error'), 0) AS errors, count(*) AS n_keys,
  string_agg(event_type, ',' ORDER BY event_type) AS key_list, CAST(sum(n) AS BIGINT) AS total
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) t GROUP BY user_id""")
def _(spark, sf):
    counts = d.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return maps.select(
        "user_id", fields.map_get(F.col("m"), "error", 0).alias("errors"), F.size("m").cast("bigint").alias("n_keys"),
        F.array_join(F.array_sort(F.map_keys("m")), ",").alias("key_list"),
        F.aggregate(F.map_values("m"), F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"))


@query("h10_path_functions", r"""
SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem,
  split_part(url, '/', -2) AS parent,
  CASE WHEN url <> '' THEN 'http://h/violations/' || CASE WHEN page_id % 2 = 0 THEN 'redlight/' ELSE '' END || split_part(url, '/', -1) END AS evidence
FROM pages""")
def _(spark, sf):
    url = F.col("url")
    kind = F.when(F.col("page_id") % 2 == 0, "RED_LIGHT").otherwise("HELMET")
    return d.table(spark, sf, "pages").select(
        "page_id", fields.base_name(url).alias("base"), fields.stem(url).alias("stem"), fields.parent_name(url).alias("parent"),
        fields.evidence_url("http://h", url, kind).alias("evidence"))


@query("h11_evidence_names", """
SELECT event_id, 'lane_cam' || user_id || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '.jpg' AS name,
  'redlight_' || lpad(CAST(event_id AS VARCHAR), 6, '0') || '_id' || user_id || '.jpg' AS numbered FROM events""")
def _(spark, sf):
    e = d.table(spark, sf, "events")
    cam = F.concat(F.lit("cam"), F.col("user_id").cast("string"))
    return e.select("event_id", fields.evidence_name("lane", cam, F.col("ts"), F.md5(F.col("event_id").cast("string"))).alias("name"),
                    fields.numbered_evidence_name("redlight", F.col("event_id"), F.col("user_id")).alias("numbered"))


@query("h12_math", sql_with("det", """
SELECT camera_id, frame_number, det_id, round(sqrt(CAST(x * x + y * y AS DOUBLE)), 6) AS dist, least(x, y) AS low, greatest(x, y) AS high,
  CAST(trunc(x * 0.37e0) AS INT) AS cut, round(w * h / 777.0e0, 2) AS area FROM det"""))
def _(spark, sf):
    x, y = F.col("x"), F.col("y")
    return d.detections(spark, sf).select(
        *ID, r6(F.sqrt((x * x + y * y).cast("double"))).alias("dist"), F.least(x, y).alias("low"), F.greatest(x, y).alias("high"),
        (x * F.lit(0.37)).cast("int").alias("cut"), F.round(F.col("w") * F.col("h") / F.lit(777.0), 2).alias("area"))


@query("h13_percent", sql_with("viol", """
SELECT violation_id, round(coalesce(CASE WHEN violation_id % 9 <> 0 THEN confidence END, 0) * 100, 1) AS pct FROM viol"""))
def _(spark, sf):
    conf = F.when(F.col("violation_id") % 9 != 0, F.col("confidence"))
    return d.violations(spark, sf).select("violation_id", fields.percent(conf).alias("pct"))


@query("h14_dates", """
SELECT event_id, date_trunc('hour', ts) AS hour, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(ts AS DATE) AS d,
  ts - INTERVAL 15 MINUTES AS earlier FROM events""")
def _(spark, sf):
    return d.table(spark, sf, "events").select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), F.to_date("ts").alias("d"),
        (F.col("ts") - F.expr("INTERVAL 15 MINUTES")).alias("earlier"))


@query("b24_b25_candidate_defaults", sql_with("heads persons bikes", f"""
SELECT h.camera_id, h.frame_number, h.det_id, coalesce(p.x, h.x) AS bx, round(coalesce(p.conf, 0.6e0), 6) AS person_conf,
  round(CASE WHEN {feet_in('p', 'v')} OR {iou('p', 'v')} >= 0.15e0 THEN v.conf ELSE 0.3e0 END, 6) AS vehicle_conf,
  CASE WHEN {feet_in('p', 'v')} OR {iou('p', 'v')} >= 0.15e0 THEN 'direct_no_helmet' ELSE 'head_only_detection' END AS method
FROM heads h
LEFT JOIN persons p ON h.camera_id = p.camera_id AND h.frame_number = p.frame_number AND p.det_id = h.det_id - 2 AND {head_in('h', 'p')}
LEFT JOIN bikes v ON h.camera_id = v.camera_id AND h.frame_number = v.frame_number AND v.det_id = h.det_id - 1"""))
def _(spark, sf):
    from kerbwatch.operators import helmet

    boxes = _boxes(spark, sf)

    def shifted(classes, by, p):
        return boxes.where(F.col("class_id").isin(*classes)).select(
            "camera_id", "frame_number", (F.col("det_id") + by).alias("det_id"),
            *(F.col(c).alias(f"{p}_{c}") for c in ("x", "y", "w", "h", "conf")))

    rows = (boxes.where("class_id = 7").select(*ID, *(F.col(c).alias("h_" + c) for c in "xywh"))
            .join(shifted([0], 2, "p"), list(ID), "left").join(shifted([1, 3], 1, "v"), list(ID), "left"))
    inside = F.coalesce(g.head_in_person(g.box("h_"), g.box("p_")), F.lit(False))
    rows = rows.withColumns({f"p_{c}": F.when(inside, F.col(f"p_{c}")) for c in ("x", "y", "w", "h", "conf")})
    mounted = F.coalesce(g.touches(g.box("p_"), g.box("v_")), F.lit(False))
    return rows.select(*ID, F.coalesce("p_x", "h_x").alias("bx"), r6(F.coalesce("p_conf", F.lit(helmet.HEAD_ONLY))).alias("person_conf"),
                       r6(F.when(mounted, F.col("v_conf")).otherwise(F.lit(helmet.OFF_VEHICLE))).alias("vehicle_conf"),
                       helmet.direct_method(mounted).alias("method"))
