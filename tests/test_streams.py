"""Streaming rules with disorder, late rows and state eviction."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from kerbwatch.operators import rules
from kerbwatch.plans import derived, q_streams
from kerbwatch.sources import config
from kerbwatch.streaming import jobs, stateful

SCHEMA = "camera_id string, track_id bigint, ts timestamp, ts_sec double, det_id bigint"
START = dt.datetime(2024, 1, 1)


def feed(spark, folder, batches):
    """One file per micro-batch; rows are (track, second, id)."""
    for i, rows in enumerate(batches):
        data = [("a", k, START + dt.timedelta(seconds=s), float(s + 1704067200), n) for k, s, n in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in-{i:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def drained(stream, folder):
    query = jobs.append_to(stream, "parquet", f"{folder}/ckpt", f"{folder}/out").trigger(availableNow=True).start()
    jobs.drain([query])
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out").collect()


def test_disorder_and_late_rows(spark, tmp_path):
    source = feed(spark, str(tmp_path / "src"), [
        [(1, 1, 1), (1, 4, 3)], [(1, 2, 2), (1, 20, 5)], [(1, 3, 9), (1, 40, 6)], [(2, 100, 7)], [(2, 200, 8)]])
    out = drained(jobs.rule_stream(source, rules.Cooldown(3.0), ["camera_id", "track_id"], ["ts_sec", "det_id"], ["det_id"],
                                   delay=10.0, forget="30 seconds"), str(tmp_path))
    assert sorted(r.det_id for r in out if not r.is_late and r.track_id == 1) == [1, 3, 5, 6]
    assert [r.det_id for r in out if r.is_late] == [9]


def test_state_is_evicted(spark, tmp_path):
    source = feed(spark, str(tmp_path / "src"), [[(k, 1, k) for k in range(20)], [(50, 500, 50)], [(51, 1000, 51)], [(52, 1500, 52)]])
    stream = jobs.rule_stream(source, rules.Cooldown(3.0), ["camera_id", "track_id"], ["ts_sec", "det_id"], ["det_id"],
                              delay=0.0, forget="30 seconds")
    query = jobs.append_to(stream, "parquet", str(tmp_path / "ckpt"), str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) >= 20 and kept[-1] <= 3


def test_newest_rows_survive_replay(spark, tmp_path):
    write = jobs.keep_newest(str(tmp_path), 3, "ts_sec", "det_id")
    for n, ids in enumerate(([1, 5, 2], [9, 3], [4])):
        batch = spark.createDataFrame([(i, float(i)) for i in ids], "det_id int, ts_sec double")
        write(batch, n)
        write(batch, n)
    assert sorted(r.det_id for r in spark.read.parquet(f"{tmp_path}/version=2").collect()) == [4, 5, 9]


def test_stop_line_job(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(
        ['{"camera_id": "cam2", "timestamp": "t", "image_path": "red"}', '{"camera_id": "cam2", "timestamp": "t", "image_path": "green"}',
         '{"camera_id": "unknown", "timestamp": "t", "image_path": "red"}', "broken"]))
    stream = spark.readStream.text(str(src))

    def detect(df):
        state = F.when(F.col("image_path") == "red", "RED").otherwise("GREEN")

        def item(name, y, colour):
            return F.struct(F.lit(2).alias("class_id"), F.lit(name).alias("class_name"), F.lit(0.5).cast("float").alias("confidence"),
                            F.array(F.lit(1.0), F.lit(y)).alias("center"), colour.alias("state"))

        return df.withColumn("detections", F.array(item("car", 600.0, F.lit("UNKNOWN")), item("car", 100.0, F.lit("UNKNOWN")),
                                                   item("traffic light", 0.0, state)))

    out = drained(jobs.stop_line_job(stream, derived.camera_config(spark), detect), str(tmp_path))
    assert len(out) == 1 and '"type":"stop_line_crossing"' in out[0].value and '"position":[1.0,600.0]' in out[0].value
    assert config.configured(spark.createDataFrame([("unknown",)], "camera_id string"), derived.camera_config(spark)).count() == 0


def test_separate_consumers(spark, tmp_path):
    feed(spark, str(tmp_path / "src"), [[(1, 1, 1), (2, 2, 2)]])

    def source():
        return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "src"))

    def start(name, df):
        return jobs.append_to(df, "parquet", str(tmp_path / f"{name}-ckpt"), str(tmp_path / name)).trigger(availableNow=True).start()

    jobs.drain(jobs.separate_consumers(source, {"one": lambda df: df.where("track_id = 1"), "all": lambda df: df}, start))
    assert spark.read.parquet(str(tmp_path / "one")).count() == 1 and spark.read.parquet(str(tmp_path / "all")).count() == 2


class Slot:
    """A state variable that counts how often it is asked."""

    def __init__(self, calls):
        self.value, self.calls = None, calls

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    put = update

    def clear(self):
        self.update(None)


def test_state_calls_do_not_grow_with_frames():
    rule = rules.Tracker()
    step = stateful.FrameByFrame(rule, ["ts_sec", "frame_number", "det_id", *rule.inputs], ["frame_number", "det_id"], ["det_id"],
                                 ["track_id", "is_new"], ["camera_id", "det_id", "track_id", "is_new", "is_late"])
    calls = []
    step.slots, step.meta = Slot(calls), Slot(calls)

    def frames(first, n):
        return [{"_ts_sec": [float(i)] * 2, "_frame_number": [i, i], "_det_id": [2 * i, 2 * i + 1], "_cx": [0.0, 500.0], "_cy": [0.0, 0.0]}
                for i in reversed(range(first, first + n))]

    out = list(step.handleInputRows(("a",), iter(frames(0, 1000)), None))
    few = len(calls)
    out += step.handleInputRows(("a",), iter(frames(1000, 10)), None)
    assert few <= 6 and len(calls) <= 12
    assert [tuple(r)[1:] for r in out] == [(i, 1 + i % 2, i < 2, False) for i in range(2020)]
    assert [tuple(r)[1:] for r in step.handleInputRows(("a",), iter(frames(1000, 1)), None)] == [(2000, None, None, True), (2001, None, None, True)]


def test_frames_over_several_batches_and_rows_without_a_time(spark, tmp_path):
    schema = "camera_id string, ts timestamp, ts_sec double, frame_number bigint, det_id bigint, cx double, cy double"

    def box(camera, i, det, cx):
        return camera, START + dt.timedelta(seconds=i), float(i), i, det, cx, 0.0

    parts = [[box("a", 1, 2, 300.0), box("a", 1, 1, 0.0), box("b", 1, 3, 0.0)], [box("a", 2, 4, 310.0), ("a", None, None, 2, 9, 0.0, 0.0)],
             [box("a", 2, 5, 10.0), box("b", 3, 6, 20.0)], [box("a", 500, 7, 0.0), box("b", 500, 8, 0.0)], [box("a", 5000, 10, 0.0)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "src" / f"in-{i}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "src"))
    stream = stateful.rule_stream(source, rules.Tracker(), ["camera_id"], ["frame_number", "det_id"], ["det_id"], delay="100 seconds")
    assert sorted(map(tuple, drained(stream, str(tmp_path)))) == [
        ("a", 1, 1, True, False), ("a", 2, 2, True, False), ("a", 4, 2, False, False), ("a", 5, 1, False, False), ("a", 7, 3, True, False),
        ("a", 9, None, None, True), ("b", 3, 1, True, False), ("b", 6, 1, False, False), ("b", 8, 2, True, False)]


def boxes_at(camera, seconds, size=2):
    """``size`` boxes a frame, one frame for each of ``seconds``, moving on and meeting others."""
    return [(camera, START + dt.timedelta(seconds=s), float(s), int(s * 5), 10 * i + k, (37.0 * i) % 400 + 90.0 * k, float(60 * k))
            for i, s in enumerate(seconds) for k in range(size)]


def box_stream(spark, folder, batches):
    schema = "camera_id string, ts timestamp, ts_sec double, frame_number bigint, det_id bigint, cx double, cy double"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in-{i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def one_pass(rule, rows):
    rule.load([])
    out, frame = [], None
    for camera, _, now, number, det, cx, cy in sorted(rows, key=lambda r: (r[2], r[3], r[4])):
        if (now, number) != frame:
            frame = now, number
            rule.begin_frame(now)
        out.append((camera, det, *rule.row(now, cx, cy)))
    return out


def test_a_camera_is_judged_in_several_tasks(spark, tmp_path):
    class Where(rules.Tracker):
        outputs = "track_id bigint, is_new boolean, task int"

        def row(self, now, cx, cy):
            from pyspark import TaskContext

            return *super().row(now, cx, cy), TaskContext.get().partitionId()

    rows = boxes_at("a", [1000 * i + k / 5 for i in range(40) for k in range(5)])
    source = box_stream(spark, str(tmp_path / "src"), [rows, [("a", START + dt.timedelta(days=2), 172800.0, 0, 9, 0.0, 0.0)]])
    out = drained(stateful.rule_stream(source, Where(), ["camera_id"], ["frame_number", "det_id"], ["det_id"]), str(tmp_path))
    assert len({r.task for r in out}) > 1
    assert sorted((r.camera_id, r.det_id, r.track_id, r.is_new) for r in out if not r.is_late) == sorted(one_pass(rules.Tracker(), rows))


def test_chunks_that_hang_together_equal_one_pass(spark, tmp_path):
    """No pause at the chunk borders, several chunks and pieces a micro-batch, borders of micro-batches within a chunk."""
    rows = boxes_at("a", [k / 2 for k in range(200)], 3)
    other = boxes_at("b", [k / 2 for k in range(200) if k % 40 < 30])
    batches = [[r for r in rows + other if lo <= r[2] < lo + 37] for lo in (0, 37, 74)]
    batches.append([(c, START + dt.timedelta(days=1), 86400.0, 0, -1, None, None) for c in "ab"])
    want = sorted(one_pass(rules.Tracker(), rows) + one_pass(rules.Tracker(), other))
    source = box_stream(spark, str(tmp_path / "src"), batches)
    for warm in (0.0, 4.0):
        stream = stateful.rule_stream(source, rules.Tracker(), ["camera_id"], ["frame_number", "det_id"], ["det_id"],
                                      chunk_seconds=10.0, warm_seconds=warm)
        out = drained(stream, str(tmp_path / f"warm-{warm}"))
        assert not any(r.is_late for r in out)
        assert sorted((r.camera_id, r.det_id, r.track_id, r.is_new) for r in out) == want


def test_pieces_taken_and_judged_again(monkeypatch):
    """What the walk over pieces gives equals one pass, from any memory, and late rows of a piece come back."""
    from pyspark.sql import types as T

    monkeypatch.setattr(stateful, "PIECE_ROWS", 10)
    columns = ["ts_sec", "frame_number", "det_id", "cx", "cy"]
    names = ["camera_id", "_t0", "_rows", "_given", "_links"]
    outputs = T.StructType([T.StructField("track_id", T.LongType()), T.StructField("is_new", T.BooleanType())])
    rows = boxes_at("a", [k / 2 for k in range(120)], 3)
    kinds = [pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    frame = pa.list_(pa.struct(list(zip(columns, kinds))))

    def frames(chosen, chunk, warm=False):
        times = sorted({r[2] for r in chosen})
        return [("a", chunk, warm, t, int(t * 1e6), [dict(zip(columns, r[2:])) for r in chosen if r[2] == t]) for t in reversed(times)]

    def batch(found):
        types = [pa.string(), pa.int64(), pa.bool_(), pa.float64(), pa.int64(), frame]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)],
                                          names=["camera_id", "_chunk", "_warm", "_at", "_moment", "_frame"])

    def steps(kind):
        return kind(rules.Tracker(), columns, ["frame_number", "det_id"], ["det_id"], ["track_id", "is_new"], names)

    judge = stateful._judge_chunks(steps(stateful.FrameByFrame), ["camera_id"], outputs)
    walk, opened = steps(stateful.PieceByPiece), stateful._open_pieces(steps(stateful.FrameByFrame), ["camera_id"])
    walk.slots, walk.meta = Slot([]), Slot([])

    def run(found):
        pieces = [p for b in judge(iter([batch(found)])) for p in b.to_pylist()]
        walked = [dict(zip(names, r)) for r in walk.handleInputRows(("a",), iter(reversed(pieces)), None)]
        shape = pa.schema([("camera_id", pa.string()), ("_t0", pa.float64()), ("_rows", pa.binary()), ("_given", pa.int64()), ("_links", pa.list_(pa.int64()))])
        out = [r for b in opened(iter([pa.RecordBatch.from_pylist(walked, shape)])) for r in b.to_pylist()]
        return pieces, walked, out

    split = [[r for r in rows if r[2] < 20.25], [r for r in rows if 20.25 < r[2] < 40.25], [r for r in rows if r[2] > 40.25]]
    warm = [r for r in rows if 10.25 < r[2] < 20.25]
    pieces, walked, out = run(frames(split[0], 0) + frames(warm, 1, True) + frames(split[1], 1))
    assert len(pieces) > 5 and any(w["_links"] for w in walked)
    assert sum(w["_rows"] == p["_rows"] for w, p in zip(walked, sorted(pieces, key=lambda p: p["_t0"]))) > len(pieces) // 2
    # without a warm-up, and with rows that were judged before
    pieces, walked, more = run(frames(split[1][-6:] + split[2], 2))
    assert [r["det_id"] for r in more if r["is_late"]] == [r[4] for r in split[1][-6:]]
    got = [(r["camera_id"], r["det_id"], r["track_id"], r["is_new"]) for r in out + more if not r["is_late"]]
    assert sorted(got) == sorted(one_pass(rules.Tracker(), rows))


def test_dealing_micro_batches_takes_one_pass(spark):
    """Every row once and in order of time; the number of jobs does not grow with the number of micro-batches."""
    jobs_of, rows = {}, spark.range(0, 3000).selectExpr("'c' AS camera_id", "CAST(id * 7 % 3000 AS double) AS ts_sec", "id AS det_id")
    for n in (4, 24):
        spark.sparkContext.setJobGroup(f"deal-{n}", "")
        stream = q_streams._in_batches(rows, "deal", n)
        jobs_of[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"deal-{n}"))
        spark.sparkContext.setJobGroup("rest", "")
        seen = []
        query = stream.writeStream.foreachBatch(lambda df, _: seen.append(sorted(r.ts_sec for r in df.collect()))).trigger(availableNow=True).start()
        query.awaitTermination()
        assert [t for part in seen for t in part] == [*map(float, range(3000)), 2999.0 + 3600.0] and len(seen) == n + 1
    assert jobs_of[4] == jobs_of[24]
