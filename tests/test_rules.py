"""Ordered rules: chunked Spark runs against sequential folds, whatever the chunk length."""

import math
import random
from collections import defaultdict
from itertools import groupby

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbwatch.operators import dedup, fold, helmet, lanes, relate, rules, tracking, transitions
from kerbwatch.sources import config
from tests import folds

CHUNKS = [{}, {"chunk_seconds": 9.0, "warm_seconds": 0.0}, {"chunk_seconds": 7.0, "warm_seconds": 1.5}]
COLUMNS = "camera_id string, frame_number bigint, ts_sec double, det_id bigint, class_id int, x int, y int, w int, h int, conf double"


def traffic(seed, frames=45, per_frame=6, classes=(2, 3, 5), step=0.4, spread=500):
    """Slow random movers; dense enough that tracks compete, repeat and cross chunk borders."""
    rnd = random.Random(seed)
    rows, ident = [], 0
    for camera in ("a", "b"):
        spots = [[rnd.randrange(spread), rnd.randrange(spread)] for _ in range(per_frame)]
        now = 0.0
        for n in range(frames):
            now = round(now + (step if rnd.random() < 0.9 else 5 * step), 3)
            for s in spots:
                s[0], s[1] = s[0] + rnd.randrange(-40, 41), s[1] + rnd.randrange(-40, 41)
                if rnd.random() < 0.85:
                    rows.append((camera, n, now, ident, rnd.choice(classes), s[0], s[1], rnd.choice((20, 60)),
                                 rnd.choice((30, 90)), round(rnd.uniform(0.3, 0.95), 3)))
                    ident += 1
    return rows


def by_frame(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[3]))
    for camera, mine in groupby(rows, key=lambda r: r[0]):
        yield camera, [(n, list(f)) for n, f in groupby(mine, key=lambda r: r[1])]


def box(r):
    return r[5:9]


@pytest.mark.parametrize("chunks", CHUNKS)
def test_tracks(spark, chunks):
    rows = traffic(1)
    want = {}
    for _, frames in by_frame(rows):
        tracks = folds.Tracks(100, 2.0)
        for _, f in frames:
            for r, number in zip(f, tracks.see([folds.centre(box(r)) for r in f], f[0][2])):
                want[r[3]] = number
    got = {r.det_id: r.track_id for r in tracking.track(spark.createDataFrame(rows, COLUMNS), **chunks).collect()}
    assert got == want


def test_two_boxes_one_track(spark):
    rows = [("a", 0, 0.0, 0, 2, 0, 0, 10, 10, 0.9), ("a", 1, 0.5, 1, 2, 3, 0, 10, 10, 0.9), ("a", 1, 0.5, 2, 2, 1, 0, 10, 10, 0.9)]
    got = {r.det_id: r.track_id for r in tracking.track(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == {0: 1, 1: 1, 2: 2}


@pytest.mark.parametrize("pause, same", [(2.0, True), (2.01, False)])
def test_track_lifetime(spark, pause, same):
    rows = [("a", 0, 0.0, 0, 2, 0, 0, 10, 10, 0.9), ("a", 1, pause, 1, 2, 0, 0, 10, 10, 0.9)]
    numbers = [r.track_id for r in tracking.track(spark.createDataFrame(rows, COLUMNS)).orderBy("det_id").collect()]
    assert (numbers[0] == numbers[1]) is same


@pytest.mark.parametrize("chunk", [900.0, 50.0, 0.3])
def test_frame_counter_that_starts_again(spark, chunk):
    rows = [("a", 4 + i, i / 4, i, 2, 10, 10, 20, 20, 0.9) for i in range(4)]
    rows += [("a", i, 100 + i / 4, 4 + i, 2, 10, 10, 20, 20, 0.9) for i in range(4)]
    got = tracking.track(spark.createDataFrame(rows, COLUMNS), chunk_seconds=chunk, warm_seconds=min(chunk, 3.0))
    assert [r.track_id for r in got.orderBy("det_id").collect()] == [1] * 4 + [2] * 4


@pytest.mark.parametrize("width", [None, 1.0, 7.5, 1e6])
def test_cooldown(spark, width):
    rnd = random.Random(2)
    rows = [(c, k, round(i * 0.3 + rnd.random() * 0.01, 3), i) for i in range(120) for c, k in [("a", rnd.randrange(2))]]
    want = set()
    for key in (0, 1):
        want |= {(key, t) for t in folds.cooldown([r[2] for r in rows if r[1] == key], 3.0)}
    df = spark.createDataFrame(rows, "camera_id string, track_id bigint, ts_sec double, det_id bigint")
    got = [(r.track_id, r.ts_sec) for r in dedup.cooldown(df, width=width).collect()]
    assert set(got) == want and len(got) == len(want)
    for key in (0, 1):
        times = sorted(t for k, t in got if k == key)
        assert all(b - a >= 3.0 for a, b in zip(times, times[1:]))


def test_cooldown_of_long_and_odd_keys(spark):
    rnd = random.Random(8)
    schema = "camera_id string, track_id bigint, ts_sec double, det_id bigint, _at string"
    rows = [("a", 1, 1.7e9 + i * 0.1, i, "x") for i in range(4000)]  # steps that floats cannot hold
    rows += [("b", None, round(rnd.expovariate(1 / 3.0), 6), 5000 + i, "x") for i in range(300)] + [(None, 2, 5.0, 7000 + i, "x") for i in range(4)]
    rows += [("a", 1, None, 9000, "x"), ("c", 1, 4.0, 9001, "x")]
    want = []
    for key in {r[:2] for r in rows}:
        mine = sorted((t, i) for c, k, t, i, _ in rows if (c, k) == key and t is not None)
        times = folds.cooldown([t for t, _ in mine], 3.0)
        want += [(*key, t, min(i for u, i in mine if u == t)) for t in times]
    df = spark.createDataFrame(rows, schema)
    got = dedup.cooldown(df.drop("_at"), width=60.0).select("camera_id", "track_id", "ts_sec", "det_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert dedup.cooldown(df.where("false")).count() == 0
    assert dedup.cooldown(df, seconds=0.0).count() == len(rows) - 1


def test_cooldown_limit(spark):
    df = spark.createDataFrame([("a", 1, t, i) for i, t in enumerate((0.0, 2.9, 3.0))],
                               "camera_id string, track_id bigint, ts_sec double, det_id bigint")
    assert sorted(r.ts_sec for r in dedup.cooldown(df).collect()) == [0.0, 3.0]


@pytest.mark.parametrize("chunks", CHUNKS)
def test_repeats(spark, chunks):
    rows = traffic(3, frames=40)
    want = set()
    for _, frames in by_frame(rows):
        seen = folds.Seen()
        for _, f in frames:
            for r in f:
                if not seen.again(r[3] % 5, folds.centre(box(r)), r[2]):
                    seen.keep(r[3] % 5, folds.centre(box(r)), r[2])
                    want.add(r[3])
    df = tracking.with_centroid(spark.createDataFrame(rows, COLUMNS)).withColumn("track_id", F.col("det_id") % 5)
    assert {r.det_id for r in dedup.without_repeats(df, **chunks).collect()} == want


@pytest.mark.parametrize("later, x, kept", [(3.0, 0, True), (2.9, 49.9, False), (2.9, 50.0, True)])
def test_repeat_limits(spark, later, x, kept):
    df = spark.createDataFrame([("a", 0.0, 0, 1, 0.0, 0.0), ("a", later, 1, 2, float(x), 0.0)],
                               "camera_id string, ts_sec double, det_id bigint, track_id bigint, cx double, cy double")
    for out in (dedup.without_repeats(df), dedup.first_of_cluster(df)):
        assert (1 in {r.det_id for r in out.collect()}) is kept


@pytest.mark.parametrize("seed", range(60))
def test_transitions_of_random_chunks(seed):
    rnd = random.Random(seed)
    letters = [rnd.choice(["LRlr0", "LR", "-", "Ll0"]) for _ in range(rnd.randrange(1, 6))]
    rows, index = [], 0
    for _ in range(rnd.randrange(1, 40)):
        index += 1 if rnd.random() < 0.9 else 2
        rows.append((index, "".join(rnd.choice(x) for x in letters)))
    memory, last, want = None, None, []
    for i, sides in rows:
        memory, crossed = rules.cross(memory if last is not None and i == last + 1 else None, sides)
        last, want = i, want + ([(i, *crossed)] if crossed else [])
    cuts = sorted({0, len(rows), *(rnd.randrange(len(rows)) for _ in range(rnd.randrange(6)))})
    memory, last, got = None, None, []
    for a, b in zip(cuts, cuts[1:]):
        table, found = transitions.Table(), []
        for i, sides in rows[a:b]:
            found += [(n, (i, *crossed)) for n, crossed in table.sight(i, sides)]
        goes_on = last is not None and table.first == last + 1
        memory, path = transitions.chosen(table.branches(), memory if goes_on else None)
        last = table.last
        got += [c for n, c in found if n is None or n in path]
    assert got == want


LINES = [(100, 0, 120, 500, "solid"), (200, 0, 200, 500, "dashed"), (130, 0, 150, 500, "solid"), (300, 100, 300, 100, "solid")]


def lane_config(spark):
    text = ('{"default": {"lane_lines": [' + ",".join(
        '{"x1": %d, "y1": %d, "x2": %d, "y2": %d, "type": "%s"}' % ln for ln in LINES) + '], "lane_crossing_threshold": 40}}')
    return config.config_from_text(spark, text)


@pytest.mark.parametrize("chunk_seconds", [900.0, 12.0, 0.5])
def test_crossings_on_tracks(spark, chunk_seconds):
    rows = traffic(4, frames=50, spread=300)
    want = set()
    for camera, frames in by_frame(rows):
        checker = folds.Lanes(LINES, 40)
        for n, f in frames:
            seen = {r[3] % 4: folds.feet(box(r)) for r in f}
            want |= {(camera, n, *hit[:2]) for hit in checker.frame(list(seen.items()))}
    last = {}
    for r in sorted(rows, key=lambda r: r[3]):
        last[(r[0], r[1], r[3] % 4)] = r
    df = spark.createDataFrame(list(last.values()), COLUMNS).withColumn("track_id", F.col("det_id") % 4)
    lettered = lanes.with_lane_sides(df, lane_config(spark))
    got = lanes.checked_crossings(lettered, chunk_seconds=chunk_seconds).collect()
    assert want and {(r.camera_id, r.frame_number, r.track_id, r.line_id) for r in got} == want


@pytest.mark.parametrize("chunks", CHUNKS)
def test_lane_rule_from_detections(spark, chunks):
    rows = traffic(5, frames=60, spread=300)
    # some frames show no vehicle at all and make every track forget its sides
    rows = [(*r[:4], 0 if r[1] % 9 == 4 else r[4], *r[5:]) for r in rows]
    want = set()
    for camera, frames in by_frame(rows):
        tracks, checker, last = folds.Tracks(100, 2.0), folds.Lanes(LINES, 40), {}
        for n, f in frames:
            cars = [r for r in f if r[4] in (2, 3, 5) and r[9] >= 0.4]
            numbers = tracks.see([folds.centre(box(r)) for r in cars], f[0][2])
            for hit in checker.frame([(k, folds.feet(box(r))) for k, r in zip(numbers, cars)]):
                if f[0][2] - last.get(hit[0], -1e9) >= 3.0:
                    last[hit[0]] = f[0][2]
                    want.add((camera, n, *hit[:2]))
    got = lanes.lane_violations(spark.createDataFrame(rows, COLUMNS), lane_config(spark), **chunks).collect()
    assert want and {(r.camera_id, r.frame_number, r.track_id, r.line_id) for r in got} == want


def crowd(seed, frames=18):
    """Persons, two-wheelers and heads piled on each other; some boxes repeat exactly."""
    rows = traffic(seed, frames, per_frame=14, classes=(0, 0, 1, 3, 6, 7), spread=160)
    return rows + [(*r[:3], r[3] + 100_000, *r[4:9], 0.5) for r in rows if r[3] % 7 == 0]


def frame_groups(f):
    def of(*classes):
        return [(r[3], tuple(box(r)), r[9]) for r in f if r[4] in classes]

    return {"persons": of(0), "vehicles": of(1, 3), "helmets": of(6), "heads": of(7)}


@pytest.mark.parametrize("max_boxes", [1024, 8])
def test_exact_assignments(spark, max_boxes):
    rows = crowd(6)
    heads, riders, kept = set(), set(), set()
    for camera, frames in by_frame(rows):
        for n, f in frames:
            groups = frame_groups(f)
            heads |= {(camera, n, h[0], p[0] if p else None) for h, p in folds.heads_of(groups["heads"], groups["persons"])}
            riders |= {(camera, n, p[0], v[0]) for p, v in folds.riders_of(groups["persons"], groups["vehicles"])}
            kept |= {(camera, n, b[0]) for b in folds.strongest([(r[3], box(r), r[9]) for r in f if r[9] > 0.5])}
    df = spark.createDataFrame(rows, COLUMNS)
    person, vehicle, head = df.where("class_id = 0"), df.where("class_id IN (1, 3)"), df.where("class_id = 7")
    got = relate.assign_heads(head, person, max_boxes=max_boxes).collect()
    assert {(r.camera_id, r.frame_number, r.head_det_id, r.person_det_id) for r in got} == heads
    got = relate.assign_riders(person, vehicle, max_boxes=max_boxes).collect()
    assert {(r.camera_id, r.frame_number, r.person_det_id, r.vehicle_det_id) for r in got} == riders
    assert len(got) == len({(r.camera_id, r.frame_number, r.person_det_id) for r in got})
    got = relate.suppress_overlaps(df, max_boxes=max_boxes).collect()
    assert {(r.camera_id, r.frame_number, r.det_id) for r in got} == kept


@pytest.mark.parametrize("options", [*CHUNKS, {"max_boxes": 8}])
def test_helmet_rule(spark, options):
    rows = crowd(7)
    want = set()
    for camera, frames in by_frame(rows):
        tracks, seen = folds.Tracks(80, 1.0), folds.Seen()
        for n, f in frames:
            for track, b, confidence, method in folds.helmet_frame(frame_groups(f), tracks, seen, f[0][2]):
                want.add((camera, n, track, b, round(confidence, 6), method))
    got = helmet.helmet_violations(spark.createDataFrame(rows, COLUMNS), **options).collect()
    assert {(r.camera_id, r.frame_number, r.track_id, tuple(r.box), round(r.confidence, 6), r.method) for r in got} == want
    assert {"direct_no_helmet", "fallback_no_helmet"} <= {w[-1] for w in want}


def test_four_persons_one_motorcycle(spark):
    rows = [("a", 0, 0.0, i, 0, 100 + i, 100, 40, 90, 0.9) for i in range(4)] + [("a", 0, 0.0, 9, 3, 95, 150, 60, 60, 0.9)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert relate.assign_riders(df.where("class_id = 0"), df.where("class_id = 3")).count() == 3
    assert relate.top_riders(df.where("class_id = 0"), df.where("class_id = 3")).count() == 3


def test_red_light_modes(spark):
    """A vehicle already past the line is reported when the light turns red, unless a transition is required."""
    from kerbwatch.operators import redlight

    rows = [("a", n, float(n), n, 2, 0, 500, 50, 50, 0.9) for n in range(4)]
    cfg = config.config_from_text(spark, '{"a": {"stop_line": {"y": 400}}}')
    light = spark.createDataFrame([("a", n, "GREEN" if n < 2 else "RED") for n in range(4)],
                                  "camera_id string, frame_number bigint, light_state string")
    df = spark.createDataFrame(rows, COLUMNS)
    assert [r.frame_number for r in redlight.red_light_violations(df, cfg, light).collect()] == [2]
    assert redlight.red_light_violations(df, cfg, light, require_transition=True).count() == 0
    on_track = redlight.red_light_inputs(df.withColumn("track_id", F.lit(1)), cfg, light)
    assert [r.frame_number for r in redlight.first_red_crossings(on_track).collect()] == [2]
    assert redlight.first_transitions(on_track).count() == 0


def test_rule_memory_round_trip():
    rule = rules.LaneWatch()
    for n, x in enumerate((90, 95, 118)):
        rule.begin_frame(float(n))
        rule.row(float(n), float(x), 10.0, "L-l0", "car")
    other = rules.LaneWatch()
    other.restore(rule.dump(2.0))
    assert other.dump(2.0) == rule.dump(2.0)
    counts = defaultdict(int)
    for r in (rule, other):
        r.begin_frame(3.0)
        counts[r.row(3.0, 125.0, 10.0, "R-l0", "car")] += 1
    assert list(counts.values()) == [2]


def test_kept_columns_stay_in_arrow(spark):
    """The rule runner passes kept columns on as they came, bytes that are no text included."""
    memory = T._parse_datatype_string(fold._MEMORY)
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("_kind", T.IntegerType()), ("_chunk", T.LongType()), ("camera_id", T.StringType()), ("name", T.StringType()), ("kept", T.BooleanType()),
        ("_t0", T.DoubleType()), ("_entry", memory), ("_exit", memory), ("_new", T.LongType()))])
    names = pa.array([b"a", b"b", b"\xff"], pa.binary()).view(pa.string())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["x"] * 3), pa.array([0] * 3), pa.array([False] * 3), pa.nulls(3), pa.array([0.0, 1.0, 5.0]), pa.array([1, 2, 3]), names],
        names=["camera_id", "_chunk", "_warm", "_given", "_now", "_o0", "_p0"])
    rows, ends = fold._scan(rules.Cooldown(3.0), 1, 1, 1, schema)(iter([batch]))
    assert rows.column("name").cast(pa.binary()).to_pylist() == [b"a", b"\xff"] and rows.column("kept").to_pylist() == [True, True]
    assert ends.select(["_kind", "_chunk", "camera_id", "name", "_t0", "_new"]).to_pylist() == [
        {"_kind": 1, "_chunk": 0, "camera_id": "x", "name": None, "_t0": 0.0, "_new": 0}]


def test_first_come_with_and_without_conflicts(spark):
    """Frames that need no walk and frames that do give what a walk gives; items without an id are never taken."""
    rng = random.Random(3)
    rows = [("c", f, rng.choice([None, *range(6)]) if f % 5 == 0 else rng.randrange(6), rng.randrange(3) / 2, rng.choice([None, *range(7)]))
            for f in range(60) for _ in range(rng.randrange(1, 6))]
    rows += [("c", 100 + f, k, 0.0, k) for f in range(5) for k in range(4)]
    df = spark.createDataFrame(rows, "camera_id string, frame_number bigint, taker bigint, wish double, taken bigint")
    for capacity in (1, 3):
        want = []
        for frame in {r[1] for r in rows}:
            used, last, n = [], -1, 0
            for r in sorted((r for r in rows if r[1] == frame), key=lambda r: tuple((v is not None, v or 0) for v in r[2:])):
                n = n if r[2] is not None and r[2] == last else 0
                if n < capacity and r[4] is not None and r[4] not in used:
                    used.append(r[4])
                    n += 1
                    want.append(r)
                last = r[2]
        got = [(r.camera_id, r.frame_number, r.taker, r.wish, r.taken) for r in relate._first_come(df, capacity).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_heads_are_matched_once(spark, boxes):
    """The candidates of the helmet rule read the matched heads several times; the matching is planned for the riders only."""
    plan = helmet.candidates(boxes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1


def test_nearest_and_repeats_by_the_plain_formula():
    rng = random.Random(5)
    tracker, repeats = rules.Tracker(100.0, 2.0), rules.Repeats(3.0, 50.0)
    live, recent, ids = [], [], 0
    for i in range(1500):
        now, cx, cy = i // 3 * 0.25, rng.randrange(0, 500, 25) * 1.0, rng.randrange(0, 300, 25) * 1.0
        if i % 3 == 0:
            tracker.begin_frame(now)
            live, taken = [s for s in live if now - s[2] <= 2.0], set()
        free = [(math.sqrt((cx - s[0]) ** 2 + (cy - s[1]) ** 2), n) for n, s in enumerate(live) if s[3] not in taken]
        best = min(free, default=(math.inf, None))
        if best[0] > 100.0:
            ids += 1
            live.append([cx, cy, now, ids])
            best = best[0], len(live) - 1
        slot = live[best[1]]
        slot[:3] = cx, cy, now
        taken.add(slot[3])
        assert tracker.row(now, cx, cy)[0] == slot[3]
        recent = [r for r in recent if now - r[0] < 3.0]
        repeated = any(r[1] == slot[3] or math.sqrt((cx - r[2]) ** 2 + (cy - r[3]) ** 2) < 50.0 for r in recent)
        assert (repeats.row(now, slot[3], cx, cy) is None) == repeated
        if not repeated:
            recent.append([now, slot[3], cx, cy])
