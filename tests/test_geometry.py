"""Edge cases of the column expressions."""

import pytest
from pyspark.sql import functions as F

from kerbwatch.functions import fields
from kerbwatch.functions import geometry as g
from kerbwatch.operators import lanes, light
from tests import folds


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit_box(*values):
    return g.Box(*(F.lit(v) for v in values))


@pytest.mark.parametrize("box, want", [
    ((-10, 5, 30, 30), (0, 5, 30, 30)), ((90, 90, 30, 30), (90, 90, 10, 10)), ((120, 0, 5, 5), (120, 0, 0, 5)),
    ((None, 5, 30, 30), (None, 5, 30, 30))])
def test_clamp(spark, box, want):
    b = g.Box(*(F.lit(v).cast("int") for v in box))
    assert tuple(value(spark, F.struct(*(c.alias(n) for n, c in zip("xywh", g.clamp(b, 100, 100)))))) == want


def test_iou(spark, boxes):
    a = lit_box(0, 0, 10, 10)
    assert value(spark, g.iou(a, a)) == pytest.approx(1)
    assert value(spark, g.iou(a, lit_box(20, 20, 5, 5))) == 0
    assert value(spark, g.iou(a, g.Box(*(F.lit(None).cast("int"),) * 4))) is None
    pair = boxes.limit(200).select(*(F.col(c).alias("a_" + c) for c in "xywh"), (F.col("x") + 7).alias("b_x"),
                                   (F.col("y") - 3).alias("b_y"), (F.col("h")).alias("b_w"), F.col("w").alias("b_h"))
    for r in pair.select("*", g.iou(g.box("a_"), g.box("b_")).alias("ab"), g.iou(g.box("b_"), g.box("a_")).alias("ba")).collect():
        assert r.ab == r.ba and 0 <= r.ab <= 1
        assert r.ab == pytest.approx(folds.overlap(tuple(r)[:4], tuple(r)[4:8]))


def test_zone(spark):
    def inside(px, py, points):
        zone = F.from_json(F.lit(str([list(p) for p in points])), "array<array<int>>")
        return value(spark, g.in_zone(F.lit(px), F.lit(py), zone))

    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    assert inside(5.0, 5.0, square) and not inside(15.0, 5.0, square)
    assert inside(99.0, 99.0, square[:2]) and inside(99.0, 99.0, [])
    assert not inside(5.0, 0.0, square) and inside(5.0, 10.0, square)  # lower edge outside, upper edge inside
    assert value(spark, g.in_zone(F.lit(1.0), F.lit(1.0), F.lit(None).cast("array<array<int>>")))


def test_lines(spark):
    assert value(spark, g.segment_distance(3, 4, 0, 0, 0, 0)) == 5
    assert value(spark, g.segment_distance(-3, 4, 0, 0, 10, 0)) == 5
    assert value(spark, g.line_side(5, 5, 0, 0, 10, 10)) == 0
    assert [value(spark, g.line_side(x, 5, 0, 0, 0, 10)) for x in (-1, 1)] == [1, -1]
    assert value(spark, lanes.lane_of(F.array(F.struct(*(F.lit(v).alias(n) for n, v in
                 zip(("x1", "y1", "x2", "y2"), (0, 0, 0, 9))))), F.lit(1), F.lit(1))) == -1


def test_head_region(spark):
    assert value(spark, g.head_region(lit_box(0, 0, 5, 1), 0.4).h) == 1
    assert value(spark, g.head_region(lit_box(0, 0, 5, 99), 0.4).h) == 39


@pytest.mark.parametrize("counts, want", [((60, 60, 51), "YELLOW"), ((60, 10, 0), "RED"), ((50, 0, 0), "UNKNOWN"),
                                          ((10, 80, 60), "GREEN"), ((70, 70, 50), "UNKNOWN")])
def test_colour(spark, counts, want):
    assert value(spark, light.colour_state(*map(F.lit, counts))) == want


def test_pixel_ranges_and_region(spark):
    rows = [(1, 5, 200, 200, 10, 10)] * 51 + [(1, 170, 200, 200, 90, 10)] * 60 + [(1, 60, 200, 200, 20, 20)] * 70
    df = spark.createDataFrame(rows, "image_id int, h int, s int, v int, px int, py int")
    assert light.state_from_pixels(df).first().light_state == "RED"
    region = df.withColumns({"light_x1": F.lit(0), "light_y1": F.lit(0), "light_x2": F.lit(90), "light_y2": F.lit(50)})
    assert light.state_from_pixels(light.in_light_region(region)).first().light_state == "GREEN"
    own = F.from_json(F.lit('{"red_lower1": [50, 0, 0], "red_upper1": [70, 255, 255]}'),
                      "red_lower1 array<int>, red_upper1 array<int>, red_lower2 array<int>, red_upper2 array<int>, "
                      "green_lower array<int>, green_upper array<int>, yellow_lower array<int>, yellow_upper array<int>")
    assert light.state_from_pixels(df.withColumn("own", own), ranges=F.col("own")).first().red_pixels == 130


def test_names(spark):
    path = F.lit("/data/cam_a/clip.final.mp4")
    got = value(spark, F.struct(fields.base_name(path), fields.stem(path), fields.extension(path), fields.parent_name(path)))
    assert tuple(got) == ("clip.final.mp4", "clip.final", ".mp4", "cam_a")
    key = fields.violation_key(F.lit("a"), F.lit(1), F.lit(2), F.lit("t"))
    assert len(value(spark, key)) == 36 and value(spark, key) == value(spark, key)
    assert value(spark, fields.evidence_url("http://h", F.lit(""), F.lit("HELMET"))) is None


def test_resize(spark):
    assert value(spark, g.resize_plan(F.lit(1920), F.lit(1080))[0]) == 1280
    assert value(spark, g.resize_plan(F.lit(640), F.lit(480))[1]) == 480
