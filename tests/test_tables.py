"""Sources, sinks, configuration, reports and the bucketed ordered functions."""

import base64
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbwatch.operators import prefix, scoring
from kerbwatch.plans import derived, reports
from kerbwatch.sources import config, frames, sinks


# ---------------------------------------------------------------- bucketed ordered functions


@pytest.fixture(scope="module")
def keyed(spark):
    """One key holds most rows, one key is null."""
    rows = [("hot" if i % 5 else (None if i % 2 else "cold"), i * 3 + i % 2, i, i % 4 if i % 3 else None) for i in range(400)]
    return spark.createDataFrame(rows, "k string, t bigint, id bigint, v int")


@pytest.mark.parametrize("width", [1.0, 37.0, 1e6])
def test_bucketed_equals_window(keyed, width):
    w = Window.partitionBy("k").orderBy("t", "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = keyed.withColumns({"p": F.lag("v").over(w), "l": F.last("v", True).over(before), "s": F.sum(F.coalesce("v", F.lit(0))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)), "n": F.row_number().over(w)})
    got = prefix.with_previous(keyed, ["k"], ["t", "id"], {"p": "v"}, width)
    got = prefix.with_last_value(got, ["k"], ["t", "id"], {"l": F.col("v")}, width)
    got = prefix.with_running_sum(got, ["k"], ["t", "id"], "s", F.coalesce("v", F.lit(0)), width)
    got = prefix.with_running_sum(got, ["k"], ["t", "id"], "n", F.lit(1), width)
    columns = ["k", "t", "id", "v", "p", "l", "s", "n"]
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, map(tuple, want.select(*columns).collect())))


def test_split_hot(keyed):
    usual, hot = prefix.split_hot(keyed, ["k"], 100)
    assert usual.count() + hot.count() == 400 and {r.k for r in hot.select("k").distinct().collect()} == {"hot"}
    assert prefix.split_hot(keyed, ["k"], 1000)[1] is None


# ---------------------------------------------------------------- configuration


def test_config_encodings(spark):
    cfg = config.config_from_text(spark, """{"_comment": "text", "old": {"stop_line": [[200, 120], [500, 130]],
        "traffic_light_roi": [410, 60, 470, 95], "no_parking_zone": [[0, 300]]},
        "new": {"stop_line": {"y": 9}, "lane_lines": [{"x1": 4}]}, "bare": {"frame_width": 10}}""")
    rows = {r.camera_id: r for r in cfg.collect()}
    assert set(rows) == {"old", "new", "bare"}
    assert (rows["old"].stop_y, rows["old"].tolerance, rows["old"].direction, rows["old"].light_x2) == (120, 30, "below", 470)
    assert (rows["new"].stop_y, rows["new"].lane_lines[0].type, rows["new"].lane_lines[0].y2) == (9, "solid", 0)
    assert (rows["bare"].stop_y, rows["bare"].light_x1, rows["bare"].frame_height) == (None, None, 1080)


def test_config_files(spark, tmp_path):
    good = tmp_path / "roi.json"
    good.write_text(derived.CAMERA_CONFIG)
    assert config.load_config(spark, str(tmp_path / "none.json"), str(good)).count() == 4
    assert config.load_config(spark, str(tmp_path / "none.json")).count() == 0


def test_config_lookup(spark):
    cfg = derived.camera_config(spark)
    df = spark.createDataFrame([("cam1",), ("elsewhere",), (None,)], "camera_id string")
    got = config.with_config(df, cfg.select("camera_id", "stop_y")).collect()
    assert sorted((r.camera_id or "", r.stop_y) for r in got) == [("", 640), ("cam1", 700), ("elsewhere", 640)]
    assert [r.camera_id for r in config.configured(df, cfg).collect()] == ["cam1"]
    half = config.scale_config(cfg, 640, 360).where("camera_id = 'cam3'").first()
    assert (half.stop_y, half.zone[0]) == (210, [210, 350])  # 421 and 701 halved, rounded down


# ---------------------------------------------------------------- sinks


def test_insert_by_day(spark, tmp_path):
    path = str(tmp_path / "by-day")
    rows = [("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2024, 1, 2, 5)), ("a", dt.datetime(2024, 1, 1, 4)), ("n", None)]
    batch = spark.createDataFrame(rows, "violation_id string, timestamp timestamp")
    sinks.insert_by_day(batch, path)
    sinks.insert_by_day(batch, path)
    sinks.insert_by_day(spark.createDataFrame([("c", dt.datetime(2024, 1, 2, 9)), ("b", dt.datetime(2024, 1, 2, 9))], batch.schema), path)
    got = spark.read.parquet(path).collect()
    assert sorted((r.violation_id, str(r.timestamp)) for r in got) == [("a", "2024-01-01 04:00:00"), ("b", "2024-01-02 05:00:00"),
                                                                       ("c", "2024-01-02 09:00:00"), ("n", "None")]
    plan = sinks.new_on_days(batch.where("violation_id = 'b'"), path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(day" in plan.replace("isnotnull(day", "(day") and "2024-01-02" in plan


def test_insert_new(spark, tmp_path):
    path = str(tmp_path / "violations")
    batch = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], "violation_id string, timestamp int")
    sinks.insert_new(batch, path)
    sinks.insert_new(batch, path)
    sinks.insert_new(spark.createDataFrame([("b", 0), ("c", 3)], batch.schema), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 0), ("b", 2), ("c", 3)]


def test_upsert_summary(spark, tmp_path):
    path = str(tmp_path / "summary")
    schema = "camera_id string, hour_bucket timestamp, total_violations bigint, vehicle_breakdown map<string,bigint>, violation_breakdown map<string,bigint>"

    def row(day, n, car):
        return ("cam", dt.datetime(2024, 1, day, 5), n, {"car": car}, {})

    sinks.upsert_summary(spark.createDataFrame([row(1, 2, 2), row(2, 1, 1)], schema), path)

    def second_day():
        return sorted(f for f in spark.read.parquet(path).inputFiles() if "day=2024-01-02" in f)

    untouched = second_day()
    sinks.upsert_summary(spark.createDataFrame([row(1, 3, 3)], schema), path)
    got = {r.hour_bucket.day: r for r in spark.read.parquet(path).collect()}
    assert (got[1].total_violations, got[1].vehicle_breakdown, got[2].total_violations) == (5, {"car": 5}, 1)
    assert second_day() == untouched
    sinks.upsert_summary(spark.createDataFrame([row(1, 1, 4)], schema), path, mode="replace")
    got = spark.read.parquet(path).where("day = '2024-01-01'").first()
    assert (got.total_violations, got.vehicle_breakdown) == (6, {"car": 4})


# ---------------------------------------------------------------- sources


def test_images_and_videos(spark, tmp_path):
    for name in ("cam_a/2.jpg", "cam_a/1.png", "cam_b/x/3.jpeg", "cam_b/skip.txt", "clip.mp4", "deep/clip.avi"):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"0" * 524288)
    assert [(r.camera_id, r.filename) for r in frames.image_files(spark, str(tmp_path)).collect()] == [
        ("cam_a", "1.png"), ("cam_a", "2.jpg"), ("x", "3.jpeg")]
    assert [(r.id, r.filename, r.size_mb) for r in frames.video_files(spark, str(tmp_path)).collect()] == [("clip", "clip.mp4", 0.5)]
    plan = frames.listing(spark, str(tmp_path), frames.IMAGES)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_messages(spark):
    rows = [("c", "2024-01-01T00:00:00Z", "p", '[{"type": "t", "vehicle": "car", "confidence": 0.5, "position": [1.5, 2]}]'),
            ("c", "2024-01-01T00:00:00", "p", '"[{\\"type\\": \\"t2\\"}]"'), (None, None, None, "[]"), ("c", "x", "p", "garbage")]
    got = frames.messages_to_violations(spark.createDataFrame(rows, frames.BATCH_SCHEMA)).orderBy("violation_type").collect()
    assert [(r.violation_type, r.vehicle_type, r.confidence, r.position_x, r.position_y) for r in got if r.violation_type != "unknown"] == [
        ("t", "car", 0.5, 1.5, 2.0), ("t2", "unknown", 0.0, 0.0, 0.0)]
    assert got[0].detected_at == dt.datetime(2024, 1, 1)


def test_frame_payload(spark):
    good = base64.b64encode(b"img").decode()
    rows = [(1, good, None), (2, "", good), (3, "*bad*", None), (4, None, None)]
    got = frames.frames_with_image(spark.createDataFrame(rows, "n int, image_base64 string, frame string")).collect()
    assert sorted((r.n, bytes(r.image)) for r in got) == [(1, b"img"), (2, b"img")]


# ---------------------------------------------------------------- reports and scoring


def test_pages(spark, sf, monkeypatch):
    v = derived.violations(spark, sf)
    near = [r.violation_id for r in reports.page(v, 333, 40).collect()]
    monkeypatch.setattr(reports, "NEAR_PAGES", 10)
    assert [r.violation_id for r in reports.page(v, 333, 40).collect()] == near
    assert reports.page(v, 10_000_000, 40).count() == 0
    for bad in ({"skip": -1}, {"limit": 0}, {"limit": 101}):
        with pytest.raises(ValueError):
            reports.page(v, **bad)


def test_quiet_cameras_stay(spark):
    cams = spark.createDataFrame([("a", "A", "x", True), ("b", "B", "x", True), ("c", "C", "x", False)],
                                 "camera_id string, name string, location string, is_active boolean")
    now = dt.datetime(2024, 1, 2)
    v = spark.createDataFrame([(1, "a", now), (2, "c", now), (3, "a", dt.datetime(2023, 1, 1))],
                              "violation_id int, camera_id string, detected_at timestamp")
    got = {r.camera_id: (r.total_violations_24h, r.active_hours) for r in reports.camera_violation_stats(v, cams, now).collect()}
    assert got == {"a": (1, 1), "b": (0, 0)}


def test_scoring_isolates_bad_rows(spark):
    def score(model, batch):
        if (batch["id"] == 3).any():
            raise ValueError("unreadable")
        return batch.assign(found=[[model, int(i)] for i in batch["id"]])[["found"]]

    got = {r.id: r for r in scoring.score_batches(spark.range(6), lambda: 7, score, "found array<int>").collect()}
    assert got[2].found == [7, 2] and got[2].score_error is None
    assert got[3].found == [] and "unreadable" in got[3].score_error
