"""Records and messages: ids, defaults, round trip through a topic, messages that do not fit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbwatch import schemas
from kerbwatch.operators import records
from kerbwatch.sources import config

LINES = '"lane_lines": [{"x1": 100, "y1": 0, "x2": 100, "y2": 400, "type": "solid"}, {"x1": 0, "y1": 0, "x2": 0, "y2": 9}]'
CONFIG = '{"default": {%s}, "a": {"stop_line": {"y": 250, "violation_direction": "above"}, %s}}' % (LINES, LINES)


@pytest.fixture(scope="module")
def found(spark):
    """One record of each kind (two for the lane rule, one of them by the default camera)."""
    cfg = config.config_from_text(spark, CONFIG)
    red = spark.createDataFrame([("a", 4, 7, 90, 1.5, "car", 10, 20, 30, 40)], "camera_id string, track_id bigint, frame_number bigint, det_id bigint, "
                                "ts_sec double, vehicle_type string, x int, y int, w int, h int")
    lane = spark.createDataFrame([("a", 4, 7, 90, 1.5, "car", 80, 20, 30, 40, 0, "left", "right"), ("zz", None, 8, 91, 2.25, "bus", -5, 0, 8, 9, 1, "right", "left")],
                                 "camera_id string, track_id bigint, frame_number bigint, det_id bigint, ts_sec double, vehicle_type string, x int, y int, "
                                 "w int, h int, line_id int, from_side string, to_side string")
    bare = spark.createDataFrame([("a", 7, 1.5, 4, (10, 20, 30, 40), 0.75, "direct_no_helmet")], "camera_id string, frame_number bigint, ts_sec double, "
                                 "track_id bigint, box struct<x:int,y:int,w:int,h:int>, confidence double, method string")
    dets = spark.createDataFrame([("a", 7, 0), ("a", 7, 0), ("a", 7, 7), ("a", 8, 0)], "camera_id string, frame_number bigint, class_id int")
    return {records.RED_LIGHT: records.red_light_records(red, cfg, 640, 480), records.LANE: records.lane_records(lane, cfg, 640, 480),
            records.HELMET: records.helmet_records(bare, dets, 640, 480)}


def test_records(spark, found):
    wanted = spark.createDataFrame([], schemas.VIOLATIONS).columns
    rows = {k: v.orderBy("camera_id").collect() for k, v in found.items()}
    assert all(v.columns == wanted for v in found.values())
    red, lane, bare = rows[records.RED_LIGHT][0], rows[records.LANE][0], rows[records.HELMET][0]
    assert red.timestamp == red.created_at == dt.datetime(1970, 1, 1, 0, 0, 1, 500000) and red.confidence == 0.9 and red.bbox_w == 30
    assert red.image_path == f"violations/redlight/redlight_a_19700101_000001_{red.violation_id[:8]}.jpg"
    assert '"stop_line_y":250' in red.metadata and '"above"' in red.metadata and red.traffic_light_state == "RED"
    assert (lane.crossed_line_type, lane.from_side, lane.confidence) == ("solid", "left", None) and '"distance_to_line":5.0' in lane.metadata
    assert rows[records.LANE][1].crossed_line_type == "solid" and rows[records.LANE][1].track_id is None  # type left out; default camera
    assert '"persons_detected":2' in bare.metadata and '"no_helmets_detected":1' in bare.metadata and bare.violation_type == "no_helmet"
    assert len({red.violation_id, lane.violation_id, bare.violation_id}) == 3
    assert red.violation_id == found[records.RED_LIGHT].first().violation_id


@pytest.mark.parametrize("kind", [records.RED_LIGHT, records.LANE, records.HELMET])
def test_round_trip(spark, found, kind):
    topic = records.messages(found[kind], kind)
    back = records.from_messages(topic, kind)
    skip = ["frame_number"] if kind == records.LANE else []  # the lane message has no frame number
    a, b = (sorted(df.drop(*skip, "metadata").collect(), key=str) for df in (found[kind], back))
    assert a == b and a
    wrong = spark.createDataFrame([(None, '{"violation_id": "x"}'), (None, "no json"), (None, None), (None, '{"violation_id":"x","camera_id":"a","timestamp":"soon"}')],
                                  "key string, value string")
    good, bad = records.read_messages(topic.unionByName(wrong), kind)
    assert good.count() == len(a) and {r.value for r in bad.collect()} == {r.value for r in wrong.collect()}
    assert records.messages(found[kind].where("false"), kind).count() == 0


def test_picture_in_message(spark, found):
    images = spark.createDataFrame([("a", 7, bytearray(b"jpg"))], "camera_id string, frame_number bigint, image binary")
    topic = records.messages(found[records.HELMET], records.HELMET, images)
    assert records.read_messages(topic, records.HELMET)[0].select(F.unbase64("image_base64")).first()[0] == b"jpg"
