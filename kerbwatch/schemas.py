"""Explicit schemas of every message and table the library reads or writes."""

from __future__ import annotations

# ---------------------------------------------------------------- streams

FRAME_REF = "camera_id string, timestamp string, image_path string, filename string"

VIDEO_FRAME = (
    "camera_id string, frame_number bigint, timestamp string, image_base64 string, frame string, "
    "width int, height int"
)

DETECTION_ITEMS = (
    "array<struct<class_id:int,class_name:string,confidence:float,bbox:array<float>,"
    "center:array<float>,state:string>>"
)

VIOLATION_ITEMS = (
    "array<struct<type:string,vehicle:string,confidence:double,position:array<double>,"
    "traffic_light_state:string>>"
)

VIOLATION_BATCH = "camera_id string, timestamp string, image_path string, violations string"

# One row per detected box: the input of all rules.
DETECTIONS = (
    "camera_id string, frame_number bigint, ts_sec double, det_id bigint, class_id int, "
    "x int, y int, w int, h int, conf double"
)

# ---------------------------------------------------------------- violations

_BOX = "struct<x:int,y:int,w:int,h:int>"

HELMET_MESSAGE = (
    "violation_id string, timestamp string, camera_id string, violation_type string, image_path string, "
    f"image_base64 string, bounding_box {_BOX}, track_id bigint, frame_number bigint, confidence double, "
    "detection_method string, metadata struct<frame_size:array<int>,persons_detected:int,"
    "vehicles_detected:int,helmets_detected:int,no_helmets_detected:int>"
)

RED_LIGHT_MESSAGE = (
    "violation_id string, timestamp string, camera_id string, vehicle_type string, traffic_light_state string, "
    f"violation_type string, image_path string, image_base64 string, bounding_box {_BOX}, track_id bigint, "
    "frame_number bigint, confidence double, "
    "metadata struct<stop_line_y:int,violation_direction:string,frame_size:array<int>>"
)

LANE_MESSAGE = (
    "violation_id string, timestamp string, camera_id string, vehicle_type string, violation_type string, "
    "crossed_line_type string, line_id int, from_side string, to_side string, image_path string, "
    "image_base64 string, bounding_box array<int>, track_id bigint, "
    "metadata struct<violation_position:array<double>,distance_to_line:double,frame_size:array<int>>"
)

# Superset of the three typed violation tables; columns a rule does not set stay null.
VIOLATIONS = (
    "violation_id string, timestamp timestamp, camera_id string, track_id bigint, frame_number bigint, "
    "violation_type string, vehicle_type string, traffic_light_state string, crossed_line_type string, "
    "line_id int, from_side string, to_side string, confidence double, bbox_x int, bbox_y int, bbox_w int, "
    "bbox_h int, image_path string, metadata string, created_at timestamp"
)

# ---------------------------------------------------------------- dimensions and summaries

CAMERAS = (
    "camera_id string, name string, location string, api_id string, is_active boolean, "
    "created_at timestamp, updated_at timestamp"
)

CAMERA_FRAMES = (
    "id bigint, camera_id string, image_path string, captured_at timestamp, processed boolean, detection_count int"
)

TRAFFIC_VIOLATIONS = (
    "id bigint, camera_id string, frame_id bigint, violation_type string, vehicle_type string, confidence double, "
    "position_x double, position_y double, bbox_x1 double, bbox_y1 double, bbox_x2 double, bbox_y2 double, "
    "image_path string, detected_at timestamp, created_at timestamp"
)

DETECTION_SUMMARY = (
    "camera_id string, hour_bucket timestamp, total_frames bigint, total_detections bigint, "
    "total_violations bigint, vehicle_breakdown map<string,bigint>, violation_breakdown map<string,bigint>, "
    "updated_at timestamp"
)

MODEL_REGISTRY = (
    "model_name string, timestamp timestamp, metrics string, is_production boolean, created_at timestamp, "
    "updated_at timestamp"
)

TRAINING_HISTORY = (
    "model_name string, training_started_at timestamp, training_completed_at timestamp, "
    "training_duration_minutes int, num_samples int, epochs int, learning_rate double, batch_size int, "
    "final_metrics string, status string, error_message string"
)

# ---------------------------------------------------------------- camera configuration

STOP_LINE = "struct<y:int,tolerance:int,violation_direction:string>"
LIGHT_REGION = "struct<x1:int,y1:int,x2:int,y2:int>"
HSV_RANGES = (
    "struct<red_lower1:array<int>,red_upper1:array<int>,red_lower2:array<int>,red_upper2:array<int>,"
    "green_lower:array<int>,green_upper:array<int>,yellow_lower:array<int>,yellow_upper:array<int>>"
)
LANE_LINES = "array<struct<x1:int,y1:int,x2:int,y2:int,type:string>>"

# Stop line and light region exist in two encodings, so both stay text until normalised.
CAMERA_ENTRY = (
    "frame_width int, frame_height int, stop_line string, traffic_light_roi string, "
    f"detection_zone array<array<int>>, color_detection {HSV_RANGES}, lane_lines {LANE_LINES}, "
    "lane_crossing_threshold int"
)
