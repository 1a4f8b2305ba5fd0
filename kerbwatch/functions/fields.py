"""Small column helpers for messages, names, times and display values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbwatch import schemas


# ---------------------------------------------------------------- names and paths


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), r"(.)\.[^.]*$", "$1")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r".(\.[^.]*)$", 1)


def parent_name(path: Column) -> Column:
    """Name of the folder a file sits in (second element from the right)."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def evidence_url(base: str, image_path: Column, violation_type: Column) -> Column:
    """Public address of an evidence image; red-light images live in their own folder."""
    folder = F.when(violation_type == "RED_LIGHT", "redlight/").otherwise("")
    return F.when(F.coalesce(image_path, F.lit("")) != "",
                  F.concat(F.lit(base + "/violations/"), folder, F.element_at(F.split(image_path, "/"), -1)))


def evidence_name(kind: str, camera_id: Column, ts: Column, violation_id: Column) -> Column:
    """``kind_camera_yyyyMMdd_HHmmss_id8.jpg``"""
    return F.concat(F.lit(kind + "_"), camera_id, F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"),
                    F.lit("_"), F.substring(violation_id, 1, 8), F.lit(".jpg"))


def numbered_evidence_name(kind: str, frame_number: Column, track_id: Column) -> Column:
    """``kind_000123_id4.jpg``: the zero-padded variant used by file runs."""
    return F.concat(F.lit(kind + "_"), F.lpad(frame_number.cast("string"), 6, "0"),
                    F.lit("_id"), track_id.cast("string"), F.lit(".jpg"))


def violation_key(camera_id: Column, track_id: Column, frame_number: Column, violation_type: Column) -> Column:
    """Deterministic id, so that a retried task or a replayed batch yields the same violation."""
    raw = F.concat_ws("|", camera_id, track_id.cast("string"), frame_number.cast("string"), violation_type)
    digest = F.md5(raw)
    return F.concat_ws("-", *(F.substring(digest, start, n) for start, n in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


# ---------------------------------------------------------------- times


def iso_timestamp(text: Column, fallback: Column) -> Column:
    """ISO text (``Z`` allowed) to a timestamp; unreadable text takes the fallback."""
    return F.coalesce(F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")), fallback.cast("timestamp"))


# ---------------------------------------------------------------- labels and display


def feed_type(violation_type: Column, from_red_light_feed: Column | None = None, keep_lane: bool = False) -> Column:
    """Dashboard type: anything mentioning RED (or read from the red-light feed) is RED_LIGHT."""
    upper = F.upper(F.coalesce(violation_type, F.lit("")))
    flag = F.lit(False) if from_red_light_feed is None else F.coalesce(from_red_light_feed, F.lit(False))
    out = F.when(upper.contains("RED") | flag, "RED_LIGHT")
    if keep_lane:
        out = out.when(upper.contains("LANE"), "LANE")
    return out.otherwise("HELMET")


def percent(confidence: Column) -> Column:
    return F.round(F.coalesce(confidence, F.lit(0.0)) * 100, 1)


# ---------------------------------------------------------------- messages


def violation_items(payload: Column) -> Column:
    """Violations of one message, which arrive as JSON text or as JSON text inside JSON."""
    inner = F.when(F.startswith(F.ltrim(payload), F.lit('"')), F.from_json(F.concat(F.lit('{"v":'), payload, F.lit("}")), "v string").getField("v"))
    return F.from_json(F.coalesce(inner, payload), schemas.VIOLATION_ITEMS)


def frame_payload(image_base64: Column, frame: Column) -> Column:
    """Image bytes from either key; absent or undecodable payloads become null."""
    text = F.coalesce(F.nullif(image_base64, F.lit("")), F.nullif(frame, F.lit("")))
    return F.try_to_binary(text, F.lit("base64"))


def map_get(values: Column, key: Column | str, default) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    return F.coalesce(F.try_element_at(values, key), F.lit(default))
