"""From what the rules report to stored records and topic messages, and back.

Each rule has its own record builder; all give the columns of ``schemas.VIOLATIONS``, one table for the three kinds.
Ids follow from camera, track, frame and type, so a replayed batch gives the same record. Messages are made from
records and read back with the schema of their kind; what does not fit it is returned apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbwatch import schemas
from kerbwatch.functions import fields
from kerbwatch.functions import geometry as g
from kerbwatch.operators import helmet
from kerbwatch.sources import config, frames, sinks

# What each rule calls its violations, and the folder its evidence is named after.
HELMET, RED_LIGHT, LANE = "no_helmet", "RED_LIGHT", "lane_violation"
PREFIX = {HELMET: "helmet", RED_LIGHT: "redlight", LANE: "lane"}
MESSAGES = {HELMET: schemas.HELMET_MESSAGE, RED_LIGHT: schemas.RED_LIGHT_MESSAGE, LANE: schemas.LANE_MESSAGE}

_BOX = ("x", "y", "w", "h")


def _table_rows(rows: DataFrame) -> DataFrame:
    """``rows`` in the columns of the violations table; those a rule does not set are null."""
    fields_ = T._parse_datatype_string(schemas.VIOLATIONS).fields
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields_))


def event_time(seconds: Column | str = "ts_sec") -> Column:
    """Seconds as a timestamp, to the microsecond."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_micros(F.round(seconds * 1e6).cast("bigint"))


def _records(found: DataFrame, kind: str, metadata: Column, folder: str, created_at: Column | None) -> DataFrame:
    """``found`` (camera_id, track_id, frame_number, ts_sec, box, rule columns) as rows of the violations table."""
    rows = found.withColumns({
        "violation_id": fields.violation_key(F.col("camera_id"), F.col("track_id"), F.col("frame_number"), F.lit(kind)),
        "timestamp": event_time(), "metadata": F.to_json(metadata), **{f"bbox_{c}": F.col(c) for c in _BOX}})
    rows = sinks.violation_defaults(rows, kind, F.col("timestamp") if created_at is None else created_at)
    name = fields.evidence_name(PREFIX[kind], F.col("camera_id"), F.col("timestamp"), F.col("violation_id"))
    rows = rows.withColumn("image_path", F.concat(F.lit(folder.rstrip("/") + "/"), name))
    return _table_rows(rows)


def _frame_size(width: int, height: int) -> Column:
    return F.array(F.lit(width), F.lit(height)).alias("frame_size")


def helmet_records(found: DataFrame, dets: DataFrame, width: int, height: int, folder: str = "violations",
                   created_at: Column | None = None) -> DataFrame:
    """Records of ``helmet.helmet_violations``; the frame's class counts go with them."""
    counts = helmet.class_counts(dets)
    rows = found.select("camera_id", "frame_number", "ts_sec", "track_id", "box.*", "confidence", "method")
    rows = rows.join(counts, ["camera_id", "frame_number"], "left")
    metadata = F.struct(F.col("method").alias("detection_method"), _frame_size(width, height),
                        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts.columns if c.endswith("_detected")))
    return _records(rows, HELMET, metadata, folder, created_at)


def red_light_records(found: DataFrame, cfg: DataFrame, width: int, height: int, folder: str = "violations/redlight",
                      created_at: Column | None = None) -> DataFrame:
    """Records of the red-light rule; ``cfg`` is the scaled camera configuration it ran with."""
    rows = config.with_own_config(found, cfg.select("camera_id", "stop_y", "direction"))
    rows = rows.withColumns({"traffic_light_state": F.lit("RED"), "confidence": F.lit(0.9)})
    metadata = F.struct(F.coalesce("stop_y", F.lit(config.STOP_Y)).alias("stop_line_y"),
                        F.coalesce("direction", F.lit("below")).alias("violation_direction"), _frame_size(width, height))
    return _records(rows, RED_LIGHT, metadata, folder, created_at)


def lane_records(found: DataFrame, cfg: DataFrame, width: int, height: int, folder: str = "violations/lane",
                 created_at: Column | None = None) -> DataFrame:
    """Records of the lane rule with the type of the crossed line, where it was crossed and how far from it."""
    known = config.with_config(found, cfg.select("camera_id", "lane_lines"))
    line = F.get("lane_lines", F.col("line_id"))
    px, py = g.bottom_center(g.box())
    ends = (line.getField(c) for c in ("x1", "y1", "x2", "y2"))
    rows = known.withColumns({"crossed_line_type": F.coalesce(line.getField("type"), F.lit("solid")), "_px": px.cast("double"),
                              "_py": py.cast("double"), "_away": g.segment_distance(px, py, *ends)})
    metadata = F.struct(F.array("_px", "_py").alias("violation_position"), F.col("_away").alias("distance_to_line"),
                        _frame_size(width, height))
    return _records(rows, LANE, metadata, folder, created_at)


# ---------------------------------------------------------------- messages


def messages(records: DataFrame, kind: str, images: DataFrame | None = None) -> DataFrame:
    """One ``value`` (JSON) for each record of ``kind``, as its topic carries it, keyed by camera.

    ``images`` (camera_id, frame_number, image) puts the picture in; without it the field is left out.
    """
    rows = records.where(F.col("violation_type") == kind)
    if images is not None:
        shown = images.select("camera_id", "frame_number", F.base64("image").alias("image_base64"))
        rows = rows.join(shown, ["camera_id", "frame_number"], "left")
    else:
        rows = rows.withColumn("image_base64", F.lit(None).cast("string"))
    meta = F.from_json("metadata", _metadata_schema(kind))
    box = [F.col(f"bbox_{c}").alias(c) for c in _BOX]
    parts = {
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "bounding_box": F.array(*box) if kind == LANE else F.struct(*box),
        "metadata": meta, "detection_method": F.get_json_object("metadata", "$.detection_method")}
    names = [f.name for f in T._parse_datatype_string(MESSAGES[kind]).fields]
    return rows.select(F.col("camera_id").alias("key"),
                       F.to_json(F.struct(*(parts.get(n, F.col(n)).alias(n) for n in names))).alias("value"))


def _metadata_schema(kind: str) -> T.StructType:
    return T._parse_datatype_string(MESSAGES[kind])["metadata"].dataType


def read_messages(topic: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Messages of one kind as typed rows, and those that are no JSON of that kind or lack an id, camera or time."""
    parsed, malformed = frames.decode(topic, MESSAGES[kind])
    needed = [F.col(c) for c in ("violation_id", "camera_id", "timestamp")]
    whole = needed[0].isNotNull() & needed[1].isNotNull() & F.try_to_timestamp(needed[2]).isNotNull()
    text = F.from_json(F.col("value").cast("string"), MESSAGES[kind])
    lacking = (text.getField("violation_id").isNull() | text.getField("camera_id").isNull()
               | F.try_to_timestamp(text.getField("timestamp")).isNull())
    return parsed.where(whole), malformed.unionByName(topic.where(lacking)).distinct()


def from_messages(topic: DataFrame, kind: str, received_at: Column | None = None) -> DataFrame:
    """Rows of the violations table from messages of one kind; ``received_at`` is when they arrived (default: their time)."""
    good, _ = read_messages(topic, kind)
    box = F.col("bounding_box")
    boxes = [F.get(box, F.lit(i)) if kind == LANE else box.getField(c) for i, c in enumerate(_BOX)]
    time = F.try_to_timestamp("timestamp")
    meta = F.col("metadata")
    if kind == HELMET:
        meta = F.struct(F.col("detection_method"), "metadata.*")
    rows = good.withColumns({"metadata": F.to_json(meta), "timestamp": time, **{f"bbox_{c}": b for c, b in zip(_BOX, boxes)}})
    rows = sinks.violation_defaults(rows, kind, F.col("timestamp") if received_at is None else received_at)
    return _table_rows(rows)
