"""Queries for reports, pages, feeds, sources and sinks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kerbwatch import schemas
from kerbwatch.functions import fields
from kerbwatch.operators import scoring
from kerbwatch.plans import derived as d
from kerbwatch.plans import reports
from kerbwatch.plans.oracle import sql_with
from kerbwatch.plans.registry import query, r6
from kerbwatch.session import work_path
from kerbwatch.sources import config, frames, sinks

_NOW = ", m AS (SELECT max(detected_at) AS as_of FROM viol)"


def _with_now(views: str, body: str) -> str:
    """``body`` with ``m.as_of`` = the newest detection."""
    head, tail = sql_with(views, "@").split("@")
    return head.rstrip() + _NOW + "\n" + body.strip() + tail


# ---------------------------------------------------------------- views and statistics


@query("d02_recent_violations", _with_now("viol cams", """
SELECT violation_id, v.camera_id, c.name AS camera_name, violation_type, vehicle_type, confidence, detected_at,
  'violations/' || violation_id || '.jpg' AS image_path
FROM viol v LEFT JOIN cams c USING (camera_id), m WHERE detected_at > as_of - INTERVAL 24 HOURS"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    v = v.withColumn("image_path", F.concat(F.lit("violations/"), F.col("violation_id").cast("string"), F.lit(".jpg")))
    return reports.recent_violations(v, d.cameras(spark, sf), d.newest(v))


@query("d03_e07_camera_stats", _with_now("viol cams", """
SELECT c.camera_id, c.name AS camera_name, location, count(violation_id) AS total_violations_24h,
  count(DISTINCT date_trunc('hour', detected_at)) AS active_hours
FROM cams c LEFT JOIN (SELECT viol.* FROM viol, m WHERE detected_at > as_of - INTERVAL 24 HOURS) v USING (camera_id)
WHERE c.is_active GROUP BY ALL"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    return reports.camera_violation_stats(v, d.cameras(spark, sf), d.newest(v))


@query("d14_orphans", sql_with("viol cams", """
SELECT camera_id, count(*) AS rows FROM viol WHERE camera_id NOT IN (SELECT camera_id FROM cams) GROUP BY 1"""))
def _(spark, sf):
    return reports.orphans(d.violations(spark, sf), d.cameras(spark, sf), "camera_id")


_REFERENCES = """
WITH frames AS (SELECT o_orderkey AS frame_id, concat('cam', CAST(o_custkey % 27 AS VARCHAR)) AS camera_id FROM orders),
cams AS (SELECT concat('cam', CAST(n_nationkey AS VARCHAR)) AS camera_id FROM nation),
viol AS (SELECT event_id, event_id // 2 AS frame_id FROM events),
registry AS (SELECT concat('model', CAST(p_partkey AS VARCHAR)) AS model_name FROM part WHERE p_size <> 7),
history AS (SELECT concat('model', CAST(l_partkey AS VARCHAR)) AS model_name FROM lineitem)
SELECT 'frames.camera_id' AS reference, CAST(camera_id AS VARCHAR) AS value, count(*) AS rows FROM frames WHERE camera_id NOT IN (SELECT camera_id FROM cams) GROUP BY ALL
UNION ALL SELECT 'violations.frame_id', CAST(frame_id AS VARCHAR), count(*) FROM viol WHERE frame_id NOT IN (SELECT frame_id FROM frames) GROUP BY ALL
UNION ALL SELECT 'history.model_name', model_name, count(*) FROM history WHERE model_name NOT IN (SELECT model_name FROM registry) GROUP BY ALL"""


@query("d14_broken_references", _REFERENCES)
def _(spark, sf):
    shots = d.table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame_id"), F.concat(F.lit("cam"), (F.col("o_custkey") % 27).cast("string")).alias("camera_id"))
    hits = d.table(spark, sf, "events").select(F.expr("event_id div 2").alias("frame_id"))
    registry = d.table(spark, sf, "part").where("p_size <> 7").select(F.concat(F.lit("model"), F.col("p_partkey").cast("string")).alias("model_name"))
    history = d.table(spark, sf, "lineitem").select(F.concat(F.lit("model"), F.col("l_partkey").cast("string")).alias("model_name"))
    return reports.broken_references({
        "frames.camera_id": (shots, d.cameras(spark, sf), "camera_id"), "violations.frame_id": (hits, shots, "frame_id"),
        "history.model_name": (history, registry, "model_name")})


@query("e01_e04_window_counts", _with_now("viol", """
SELECT count(*) AS total, count(*) FILTER (CAST(detected_at AS DATE) = CAST(as_of AS DATE)) AS today,
  count(*) FILTER (detected_at >= as_of - INTERVAL 1 HOUR) AS last_hour,
  count(*) FILTER (detected_at > as_of - INTERVAL 15 MINUTES) AS last_15_minutes FROM viol, m"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    return reports.window_counts(v, d.newest(v))


@query("e02_count_by_camera", sql_with("viol", "SELECT camera_id, count(*) AS count FROM viol GROUP BY 1"))
def _(spark, sf):
    return reports.count_by(d.violations(spark, sf), "camera_id")


@query("e03_count_by_vehicle", sql_with("viol", "SELECT vehicle_type, count(*) AS count FROM viol GROUP BY 1"))
def _(spark, sf):
    return reports.count_by(d.violations(spark, sf), "vehicle_type")


@query("e05_hourly_trend", _with_now("viol", """
SELECT date_trunc('hour', detected_at) AS hour, violation_type, count(*) AS count FROM viol, m
WHERE detected_at > as_of - INTERVAL 24 HOURS GROUP BY ALL"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    return reports.hourly_trend(v, d.newest(v)).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("e06_daily_summary", sql_with("viol", """
SELECT camera_id, CAST(date_trunc('day', detected_at) AS TIMESTAMP) AS day, violation_type, count(*) AS count FROM viol GROUP BY ALL"""))
def _(spark, sf):
    return reports.daily_summary(d.violations(spark, sf)).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("e08_hourly_summary", sql_with("viol", """
SELECT camera_id, date_trunc('hour', detected_at) AS hour_bucket, 'vehicle' AS kind, coalesce(vehicle_type, 'unknown') AS value, count(*) AS n
FROM viol GROUP BY ALL
UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'violation', violation_type, count(*) FROM viol GROUP BY ALL
UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'total', NULL, count(*) FROM viol GROUP BY ALL"""))
def _(spark, sf):
    return _long(reports.hourly_summary(d.violations(spark, sf)))


def _long(summary):
    """Summary rows with their maps spread out, for comparing across engines."""
    def pairs(kind, column):
        return F.transform(F.map_entries(column), lambda e: F.struct(
            F.lit(kind).alias("kind"), e["key"].alias("value"), e["value"].alias("n")))

    total = F.array(F.struct(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("value"),
                             F.col("total_violations").alias("n")))
    items = F.concat(pairs("vehicle", "vehicle_breakdown"), pairs("violation", "violation_breakdown"), total)
    return summary.select("camera_id", F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"), F.inline(items))


@query("e08_summary_with_frames", sql_with("viol", """
SELECT camera_id, hour_bucket, coalesce(v, 0) AS total_violations, coalesce(f, 0) AS total_frames, coalesce(dc, 0) AS total_detections FROM
 (SELECT camera_id, date_trunc('hour', detected_at) AS hour_bucket, count(*) AS v FROM viol WHERE violation_id % 3 = 0 GROUP BY ALL) a
 FULL JOIN (SELECT camera_id, date_trunc('hour', detected_at) AS hour_bucket, count(*) AS f, CAST(sum(track_id % 7) AS BIGINT) AS dc
            FROM viol WHERE violation_id % 3 <> 0 GROUP BY ALL) b USING (camera_id, hour_bucket)"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    seen = v.where("violation_id % 3 <> 0").select("camera_id", F.col("detected_at").alias("captured_at"),
                                                   (F.col("track_id") % 7).alias("detection_count"))
    out = reports.hourly_summary(v.where("violation_id % 3 = 0"), seen)
    return out.select("camera_id", F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"), "total_violations",
                      "total_frames", "total_detections")


_SOURCES = {"helmet": "violation_type = 'no_helmet'", "redlight": "violation_type = 'RED_LIGHT'"}


@query("e09_e16_combined_stats", _with_now("viol", "SELECT " + ", ".join(
    f"count(*) FILTER ({cond} AND {test}) AS {name}" for prefix, cond in
    [("", "violation_type IN ('no_helmet', 'RED_LIGHT')")] + [(k + "_", v) for k, v in _SOURCES.items()]
    for name, test in [(prefix + "total", "true"), (prefix + "today", "CAST(detected_at AS DATE) = CAST(as_of AS DATE)"),
                       (prefix + "last_hour", "detected_at >= as_of - INTERVAL 1 HOUR")]) + " FROM viol, m"))
def _(spark, sf):
    v = d.violations(spark, sf)
    return reports.combined_stats({k: v.where(c) for k, c in _SOURCES.items()}, d.newest(v))


@query("e14_stream_stats", sql_with("det", """
SELECT camera_id, count(*) AS frames_seen, count(*) FILTER (frame_number % 2 = 0) AS frames_sent,
  round(max(ts_sec) - min(ts_sec), 6) AS elapsed, round(count(*) FILTER (frame_number % 2 = 0) / (max(ts_sec) - min(ts_sec)), 6) AS avg_fps
FROM (SELECT DISTINCT camera_id, frame_number, ts_sec FROM det) f GROUP BY 1"""))
def _(spark, sf):
    f = d.detections(spark, sf).select("camera_id", "frame_number", "ts_sec").distinct()
    out = reports.stream_stats(f, F.col("frame_number") % 2 == 0)
    return out.withColumns({"elapsed": r6("elapsed"), "avg_fps": r6("avg_fps")})


@query("e15_active_cameras", sql_with("viol", """
SELECT camera_id, max(detected_at) AS detected_at, arg_max(violation_id, detected_at) AS violation_id FROM viol GROUP BY 1"""))
def _(spark, sf):
    v = d.violations(spark, sf).select("camera_id", "detected_at", "violation_id")
    return reports.latest_frames(v, ("detected_at", "violation_id"))


@query("h06_model_performance", """
SELECT 'model_' || event_id AS model_name, ts AS trained_at, event_id % 2 = 0 AS is_production, json_extract_string(props, '$.k') AS accuracy,
  NULL::VARCHAR AS f1_score, ts AS created_at FROM events""")
def _(spark, sf):
    e = d.table(spark, sf, "events")
    registry = e.select(F.concat(F.lit("model_"), F.col("event_id").cast("string")).alias("model_name"), F.col("ts").alias("timestamp"),
                        F.replace("props", F.lit('"k"'), F.lit('"Accuracy"')).alias("metrics"),
                        (F.col("event_id") % 2 == 0).alias("is_production"), F.col("ts").alias("created_at"))
    return reports.model_performance(registry)


# ---------------------------------------------------------------- pages and feeds


@query("g01_page", sql_with("viol", """
SELECT violation_id, camera_id, detected_at FROM viol WHERE camera_id = 'cam7' ORDER BY detected_at DESC, violation_id LIMIT 25 OFFSET 50"""))
def _(spark, sf):
    return reports.page(d.violations(spark, sf), 50, 25, camera_id="cam7").select("violation_id", "camera_id", "detected_at")


@query("g01_page_total", sql_with("viol", "SELECT count(*) AS total FROM viol WHERE camera_id = 'cam7'"))
def _(spark, sf):
    return reports.page_total(d.violations(spark, sf), camera_id="cam7")


@query("g02_newest", sql_with("viol", """
SELECT violation_id, detected_at FROM viol WHERE violation_type = 'no_helmet' ORDER BY detected_at DESC, violation_id LIMIT 100"""))
def _(spark, sf):
    return reports.newest(d.violations(spark, sf).where("violation_type = 'no_helmet'")).select("violation_id", "detected_at")


@query("h01_tagged_feed", sql_with("viol", """
SELECT violation_id, CASE violation_type WHEN 'RED_LIGHT' THEN 'RED_LIGHT' WHEN 'lane_violation' THEN 'LANE' ELSE 'HELMET' END AS violation_type
FROM viol WHERE violation_type IN ('no_helmet', 'RED_LIGHT', 'lane_violation')"""))
def _(spark, sf):
    v = d.violations(spark, sf)

    def of(t):
        return v.where(F.col("violation_type") == t)

    return reports.tagged_feed(of("no_helmet").drop("value"), of("RED_LIGHT"), of("lane_violation")).select("violation_id", "violation_type")


@query("d11_g03_merged_feed", sql_with("viol", """
SELECT violation_id, detected_at, image_base64 FROM (
  SELECT violation_id, detected_at, 'live' AS image_base64 FROM viol WHERE violation_id % 5 = 0
  UNION ALL SELECT violation_id, detected_at, CASE WHEN violation_id % 10 = 1 THEN 'live' END FROM viol WHERE violation_id % 5 <> 0) u
ORDER BY detected_at DESC, violation_id LIMIT 50"""))
def _(spark, sf):
    v = d.violations(spark, sf).select("violation_id", "detected_at")
    stored = v.where("violation_id % 5 <> 0")
    live = v.where("violation_id % 5 = 0 OR violation_id % 10 = 1").withColumn("image_base64", F.lit("live"))
    return reports.merged_feed(live, stored)


# ---------------------------------------------------------------- sources


@query("a02_decoded_frames", """
SELECT CASE WHEN event_id % 10 <> 0 THEN 'cam' || user_id END AS camera_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS image_path,
  count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    good, _ = frames.decode(_raw_messages(spark, sf), schemas.FRAME_REF)
    return good.groupBy("camera_id", "image_path").agg(F.count("*").alias("n"))


@query("a02_rejected_frames", "SELECT event_id FROM events WHERE event_id % 10 = 0")
def _(spark, sf):
    return frames.decode(_raw_messages(spark, sf), schemas.FRAME_REF)[1].select("event_id")


def _raw_messages(spark, sf):
    e = d.table(spark, sf, "events")
    body = F.to_json(F.struct(F.concat(F.lit("cam"), F.col("user_id").cast("string")).alias("camera_id"),
                              F.col("ts").cast("string").alias("timestamp"), F.col("event_type").alias("image_path")))
    return e.select("event_id", F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken "), body)).otherwise(body).alias("value"))


@query("a10_a11_file_inventory", r"""
SELECT stem AS id, base AS filename, url AS path, round(page_id * 4321 / 1048576.0e0, 2) AS size_mb, stem AS camera_id, split_part(url, '/', -2) AS parent
FROM (SELECT *, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem FROM pages) p""")
def _(spark, sf):
    p = d.table(spark, sf, "pages").select(F.col("url").alias("path"), (F.col("page_id") * 4321).alias("length"))
    return frames.inventory(p).withColumn("parent", fields.parent_name(F.col("path")))


@query("g07_sorted_inventory", r"""
SELECT regexp_replace(base, '(.)\.[^.]*$', '\1') AS id, base AS filename, url AS path
FROM (SELECT *, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages) p ORDER BY base, url""")
def _(spark, sf):
    p = d.table(spark, sf, "pages").select(F.col("url").alias("path"), F.length("url").alias("length"))
    return frames.sorted_inventory(p).select("id", "filename", "path")


@query("a12_config_in_use", sql_with("viol cfg lines zone", """
SELECT c.camera_id, stop_y, direction, (SELECT count(*) FROM lines l WHERE l.camera_id = c.camera_id) AS n_lines,
  (SELECT count(*) FROM zone z WHERE z.camera_id = c.camera_id) AS corners, count(violation_id) AS n
FROM cfg c LEFT JOIN viol v USING (camera_id) GROUP BY ALL"""))
def _(spark, sf):
    n = d.violations(spark, sf).groupBy("camera_id").agg(F.count("*").alias("n"))
    return d.camera_config(spark).join(n, "camera_id", "left").select(
        "camera_id", "stop_y", "direction", F.size("lane_lines").cast("bigint").alias("n_lines"),
        F.size("zone").cast("bigint").alias("corners"), F.coalesce("n", F.lit(0)).alias("n"))


@query("a13_put_camera", sql_with("cfg det", """
SELECT camera_id, stop_y, direction FROM cfg WHERE camera_id NOT IN (SELECT camera_id FROM det WHERE camera_id <> 'cam2')
UNION ALL SELECT camera_id, max(y), 'above' FROM det WHERE camera_id <> 'cam2' GROUP BY 1"""))
def _(spark, sf):
    lowest = d.detections(spark, sf).where("camera_id <> 'cam2'").groupBy("camera_id").agg(
        F.max("y").alias("stop_y"), F.lit("above").alias("direction"))
    return config.put_camera(d.camera_config(spark), lowest).select("camera_id", "stop_y", "direction")


@query("a14_frame_payload", """
SELECT page_id, CASE page_id % 4 WHEN 1 THEN 'from frame' ELSE url END AS body FROM pages WHERE page_id % 4 <> 3""")
def _(spark, sf):
    kind, packed = F.col("page_id") % 4, F.base64(F.col("url").cast("binary"))
    frame = F.when(kind == 1, F.base64(F.lit("from frame").cast("binary"))).when(kind == 2, "##")
    image = F.when(kind == 3, "?not base64?").when(kind == 1, "").otherwise(packed)
    rows = d.table(spark, sf, "pages").select("page_id", image.alias("image_base64"), frame.alias("frame"))
    return frames.frames_with_image(rows).select("page_id", F.col("image").cast("string").alias("body"))


@query("h05_message_violations", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE event_type END AS violation_type, 'unknown' AS vehicle_type,
  CASE WHEN event_id % 2 = 0 THEN round(value, 6) ELSE 0.0 END AS confidence, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS DOUBLE) ELSE 0.0 END AS position_x,
  CASE WHEN event_id % 5 > 1 THEN CAST(user_id AS DOUBLE) ELSE 0.0 END AS position_y FROM events WHERE event_id % 11 <> 0""")
def _(spark, sf):
    e = d.table(spark, sf, "events")
    i, x, y = F.col("event_id"), F.col("event_id").cast("double"), F.col("user_id").cast("double")
    place = F.when(i % 5 == 0, F.array().cast("array<double>")).when(i % 5 == 1, F.array(x)).otherwise(F.array(x, y))
    item = F.struct(F.when(i % 3 != 0, F.col("event_type")).alias("type"), F.when(i % 2 == 0, F.col("value")).alias("confidence"),
                    place.alias("position"))
    listed = F.to_json(F.when(i % 11 == 0, F.array().cast("array<struct<type:string,confidence:double,position:array<double>>>")).otherwise(F.array(item)))
    # half of the messages carry the list as a quoted string, as a producer that encodes twice does
    quoted = F.concat(F.lit('"'), F.replace(listed, F.lit('"'), F.lit('\\"')), F.lit('"'))
    m = e.select(i.cast("string").alias("camera_id"), F.col("ts").cast("string").alias("timestamp"), F.lit(None).cast("string").alias("image_path"),
                 F.when(i % 4 < 2, quoted).otherwise(listed).alias("violations"))
    out = frames.messages_to_violations(m)
    return out.select(F.col("camera_id").cast("bigint").alias("event_id"), "violation_type", "vehicle_type", r6("confidence").alias("confidence"),
                      "position_x", "position_y")


# ---------------------------------------------------------------- sinks


@query("a07_insert_new", sql_with("viol", """
SELECT violation_id % 4000 + 1000 AS id, arg_min(violation_id, detected_at) AS first_id FROM viol GROUP BY 1
HAVING id NOT IN (SELECT violation_id FROM viol WHERE violation_id < 1500)"""))
def _(spark, sf):
    v = d.violations(spark, sf).select((F.col("violation_id") % 4000 + 1000).alias("id"), F.col("violation_id").alias("first_id"), "detected_at")
    stored = d.violations(spark, sf).where("violation_id < 1500").select(F.col("violation_id").alias("id"))
    return sinks.new_rows(v, stored, "id", ("detected_at",)).select("id", "first_id")


@query("a07_insert_by_day", sql_with("viol", """
SELECT violation_id // 2 AS violation_id, date_trunc('day', min(detected_at)) AS day, count(*) AS rows FROM (
  SELECT violation_id, detected_at, row_number() OVER (PARTITION BY violation_id // 2, CAST(detected_at AS DATE) ORDER BY violation_id) AS n FROM viol) v
WHERE n = 1 GROUP BY violation_id // 2, CAST(detected_at AS DATE)"""))
def _(spark, sf):
    # three overlapping deliveries; two events of one day share an id, and an id of another day is another violation
    v = d.violations(spark, sf).select(F.expr("violation_id div 2").alias("id"), "violation_id", "detected_at")
    v = v.withColumn("key", F.concat_ws("|", "id", F.to_date("detected_at")))
    path = work_path(spark, "by-day")
    for part in ("violation_id % 3 < 2", "violation_id % 3 > 0", "true"):
        sinks.insert_by_day(v.where(part), path, "key", ("violation_id",), "detected_at")
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("id").alias("violation_id"), F.date_trunc("day", "day").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("rows"))


def _two_halves(spark, sf):
    v = d.violations(spark, sf)
    return reports.hourly_summary(v.where("violation_id % 2 = 0")), reports.hourly_summary(v.where("violation_id % 2 = 1"))


@query("a08_summary_sum", sql_with("viol", """
SELECT camera_id, date_trunc('hour', detected_at) AS hour_bucket, 'vehicle' AS kind, coalesce(vehicle_type, 'unknown') AS value, count(*) AS n
FROM viol GROUP BY ALL
UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'violation', violation_type, count(*) FROM viol GROUP BY ALL
UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'total', NULL, count(*) FROM viol GROUP BY ALL"""))
def _(spark, sf):
    return _long(sinks.merge_summary(*_two_halves(spark, sf), mode="sum"))


@query("a08_summary_replace", sql_with("viol", """
SELECT camera_id, hour_bucket, kind, value, arg_max(n, half) AS n FROM (
  SELECT camera_id, date_trunc('hour', detected_at) AS hour_bucket, 'vehicle' AS kind, coalesce(vehicle_type, 'unknown') AS value, violation_id % 2 AS half, count(*) AS n
  FROM viol GROUP BY ALL
  UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'violation', violation_type, violation_id % 2, count(*) FROM viol GROUP BY ALL) p GROUP BY ALL
UNION ALL SELECT camera_id, date_trunc('hour', detected_at), 'total', NULL, count(*) FROM viol GROUP BY ALL"""))
def _(spark, sf):
    return _long(sinks.merge_summary(*_two_halves(spark, sf), mode="replace"))


@query("a09_seed_cameras", sql_with("viol cams", """
SELECT camera_id, name FROM cams UNION ALL SELECT camera_id, 'seeded' FROM (SELECT DISTINCT camera_id FROM viol) v
WHERE camera_id NOT IN (SELECT camera_id FROM cams)"""))
def _(spark, sf):
    rows = d.violations(spark, sf).select("camera_id").distinct().withColumn("name", F.lit("seeded"))
    return sinks.seed(d.cameras(spark, sf), rows).select("camera_id", "name")


@query("h15_defaults", sql_with("viol", """
SELECT violation_id, coalesce(vehicle_type, 'unknown') AS vehicle_type, TIMESTAMP '2024-02-01 00:00:00' AS created_at, true AS is_active FROM viol"""))
def _(spark, sf):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    rows = d.violations(spark, sf).select("violation_id", "vehicle_type")
    return sinks.with_defaults(rows, vehicle_type="unknown", created_at=now, is_active=True)


@query("h15_updated_rows", """
SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'changed' ELSE event_type END AS event_type,
  CASE WHEN event_id % 10 = 3 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS updated_at FROM events""")
def _(spark, sf):
    e = d.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").alias("updated_at"))
    changes = e.where("event_id % 10 = 3").select("event_id", F.lit("changed").alias("event_type"))
    return sinks.update_rows(e, changes, "event_id", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


# ---------------------------------------------------------------- scoring


@query("j01_batch_scoring", """
SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INT) AS best, round(list_max(s), 4) AS score FROM (
  SELECT vec_id, [list_sum(list_transform(embedding[1:16], lambda v: CAST(v AS DOUBLE))), list_sum(list_transform(embedding[17:32], lambda v: CAST(v AS DOUBLE))),
    list_sum(list_transform(embedding[33:48], lambda v: CAST(v AS DOUBLE))), list_sum(list_transform(embedding[49:64], lambda v: CAST(v AS DOUBLE)))] AS s FROM embeddings) t""")
def _(spark, sf):
    def loader():
        return np.repeat(np.eye(4), 16, axis=0)

    def score(weights, batch):
        x = np.stack([np.asarray(v, dtype="float64") for v in batch["embedding"]]) @ weights
        return pd.DataFrame({"best": x.argmax(axis=1).astype("int32"), "score": x.max(axis=1)})

    rows = d.table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = scoring.score_batches(rows, loader, score, "best int, score double")
    return out.select("vec_id", "best", F.round("score", 4).alias("score"))
