"""Streaming queries, drained over the given tables and compared with their batch meaning."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta
from time import sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbwatch import schemas
from kerbwatch.functions import geometry as g
from kerbwatch.operators import helmet, redlight, rules, tracking
from kerbwatch.plans import derived as d
from kerbwatch.plans.oracle import sql_with
from kerbwatch.plans.q_relations import HELMETS, REPEATS, TRACKS
from kerbwatch.plans.registry import query
from kerbwatch.session import materialise, work_path
from kerbwatch.sources import config, frames
from kerbwatch.streaming import books, jobs, stateful


def _violation_columns(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("violation_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("cam"), (F.col("user_id") % 30).cast("string")).alias("camera_id"), F.col("user_id").alias("track_id"),
        F.when(kind == "click", "no_helmet").when(kind == "view", "RED_LIGHT").when(kind == "purchase", "lane_violation")
        .when(kind == "signup", "stop_line_crossing").otherwise("red_light_running").alias("violation_type"))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream, with the violation columns derived from it."""
    schema = d.table(spark, sf, "events").schema
    return _violation_columns(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


def _drained(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    out = work_path(spark, label)
    writer = jobs.append_to(stream, "parquet", work_path(spark, f"{label}-ckpt"), out)
    jobs.drain([writer.trigger(availableNow=True).start()])
    return spark.read.schema(stream.schema).parquet(out)


@query("i09_hourly_stream", sql_with("viol", """
SELECT date_trunc('hour', detected_at) AS hour_bucket, camera_id, violation_type, count(*) AS count FROM viol
WHERE date_trunc('hour', detected_at) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES GROUP BY ALL"""))
def _(spark, sf):
    out = _drained(jobs.hourly_counts(_event_stream(spark, sf)), "hourly")
    return out.withColumn("hour_bucket", F.col("hour_bucket").cast("timestamp_ntz"))


@query("f08_session_stream", sql_with("viol", """
SELECT camera_id, track_id, count(*) AS sightings, min(detected_at) AS first_seen, max(detected_at) AS last_seen FROM (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 43200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY camera_id, track_id ORDER BY detected_at) AS n
  FROM (SELECT *, epoch_us(detected_at) - lag(epoch_us(detected_at)) OVER (PARTITION BY camera_id, track_id ORDER BY detected_at) AS gap FROM viol) a) b
GROUP BY camera_id, track_id, n
HAVING max(detected_at) + INTERVAL 12 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES"""))
def _(spark, sf):
    out = _drained(jobs.track_sessions(_event_stream(spark, sf), "12 hours", delay="10 minutes"), "sessions")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query("a07_first_arrivals_stream", "SELECT DISTINCT event_id // 3 AS violation_id FROM events")
def _(spark, sf):
    stream = _event_stream(spark, sf).withColumn("violation_id", F.expr("violation_id div 3"))
    return _drained(jobs.first_arrivals(stream, delay="60 days").select("violation_id"), "arrivals")


def _event_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The violations of the events table as a stream of several micro-batches, in order of time."""
    rows = _violation_columns(d.table(spark, sf, "events"))
    stored = materialise(rows.repartitionByRange(8, "ts").sortWithinPartitions("ts"), "event-batches")
    folder = stored.inputFiles()[0].rsplit("/", 1)[0]
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _book(spark: SparkSession, sf: str, label: str, make) -> str:
    path = work_path(spark, label)
    jobs.drain([jobs.micro_batches(_event_batches(spark, sf), make(path), work_path(spark, f"{label}-ckpt"), None)])
    return path


_TYPES = "violation_id bigint, ts timestamp, camera_id string, track_id bigint, violation_type string"


@query("i11_hourly_with_late_rows", sql_with("viol", """
SELECT date_trunc('hour', detected_at) AS hour_bucket, camera_id, violation_type, count(*) AS count FROM viol GROUP BY ALL"""))
def _(spark, sf):
    # closed hours, open ones and late rows together are all rows, whatever order the files come in
    path = _book(spark, sf, "hourly-book", books.hourly)
    schema = "hour_bucket timestamp, camera_id string, violation_type string, count bigint"
    late = books.booked(spark, path, _TYPES, "late").select(F.date_trunc("hour", "ts").alias("hour_bucket"), "camera_id", "violation_type",
                                                            F.lit(1).cast("bigint").alias("count"))
    rows = books.booked(spark, path, schema).unionByName(books.booked(spark, path, schema, "open")).unionByName(late)
    return rows.groupBy(F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"), "camera_id", "violation_type").agg(F.sum("count").alias("count"))


@query("i11_sessions_with_late_rows", sql_with("viol", "SELECT camera_id, track_id, count(*) AS sightings FROM viol GROUP BY ALL"))
def _(spark, sf):
    path = _book(spark, sf, "session-book", lambda p: books.sessions(p, timedelta(hours=12)))
    schema = "camera_id string, track_id bigint, first_seen timestamp, last_seen timestamp, sightings bigint"
    late = books.booked(spark, path, _TYPES, "late").select("camera_id", "track_id", F.lit(1).cast("bigint").alias("sightings"))
    rows = books.booked(spark, path, schema).unionByName(books.booked(spark, path, schema, "open"))
    return rows.select(*late.columns).unionByName(late).groupBy("camera_id", "track_id").agg(F.sum("sightings").alias("sightings"))


@query("i11_arrivals_with_late_rows", sql_with("viol", "SELECT DISTINCT violation_id // 3 AS violation_id FROM viol"))
def _(spark, sf):
    path = work_path(spark, "arrival-book")
    # three events share an id; their times lie apart, so some repeats come when the id is forgotten
    stream = _event_batches(spark, sf).withColumn("violation_id", F.expr("violation_id div 3"))
    jobs.drain([jobs.micro_batches(stream, books.arrivals(path), work_path(spark, "arrival-ckpt"), None)])
    both = books.booked(spark, path, _TYPES).unionByName(books.booked(spark, path, _TYPES, "late"))
    return both.select("violation_id").distinct()


@query("a05_buffered_inserts", sql_with("viol", "SELECT violation_id, camera_id, violation_type FROM viol"))
def _(spark, sf):
    path = _book(spark, sf, "insert-book", books.buffered)
    rows = books.booked(spark, path, _TYPES).unionByName(books.booked(spark, path, _TYPES, "open"))
    return rows.select("violation_id", "camera_id", "violation_type")


@query("a01_decoded_stream", sql_with("viol", """
SELECT 'camera-' || camera_id AS camera_id, strftime(detected_at, '%Y-%m-%dT%H:%M:%S') AS timestamp, violation_id || '.jpg' AS filename FROM viol"""))
def _(spark, sf):
    v = d.violations(spark, sf)
    ref = F.struct(F.concat(F.lit("camera-"), "camera_id").alias("camera_id"), F.date_format("detected_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                   F.concat(F.col("violation_id").cast("string"), F.lit(".jpg")).alias("filename"))
    topic = materialise(v.select(F.to_json(ref).alias("value")), "topic")
    folder = topic.inputFiles()[0].rsplit("/", 1)[0]
    source = frames.message_stream(spark, "parquet", "value string", folder)
    good, _ = frames.decode(source, schemas.FRAME_REF)
    return _drained(good, "decoded").select("camera_id", "timestamp", "filename")


@query("a03_message_stream", sql_with("viol", """
SELECT '{"violation_id":' || violation_id || ',"camera_id":"' || camera_id || '"}' AS value FROM viol"""))
def _(spark, sf):
    return _drained(jobs.to_messages(_event_stream(spark, sf).select("violation_id", "camera_id")), "messages")


@query("a04_fan_out_stream", sql_with("viol", """
SELECT violation_id, 'helmet' AS consumer FROM viol WHERE violation_type = 'no_helmet'
UNION ALL SELECT violation_id, 'redlight' FROM viol WHERE violation_type = 'RED_LIGHT'
UNION ALL SELECT violation_id, 'lane' FROM viol WHERE violation_type = 'lane_violation'"""))
def _(spark, sf):
    out = work_path(spark, "fan-out")
    kinds = {"helmet": "no_helmet", "redlight": "RED_LIGHT", "lane": "lane_violation"}

    def only(kind):
        return lambda df: df.where(F.col("violation_type") == kind)

    write = jobs.fan_out({name: only(kind) for name, kind in kinds.items()}, jobs.batch_parquet(out))
    jobs.drain([jobs.micro_batches(_event_stream(spark, sf), write, work_path(spark, "fan-out-ckpt"), None)])
    parts = [spark.read.parquet(f"{out}/{name}").select("violation_id", F.lit(name).alias("consumer")) for name in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a05_a06_insert_stream", sql_with("viol", "SELECT violation_id, camera_id, violation_type FROM viol"))
def _(spark, sf):
    out = work_path(spark, "inserted")
    write = jobs.insert_new_batches(out, order=("ts",))
    jobs.drain([jobs.micro_batches(_event_stream(spark, sf), write, work_path(spark, "inserted-ckpt"), None)])
    return spark.read.parquet(out).select("violation_id", "camera_id", "violation_type")


@query("i10_live_feed_stream", sql_with("viol", """
SELECT violation_id, camera_id FROM viol ORDER BY detected_at DESC, violation_id LIMIT 100"""))
def _(spark, sf):
    out = work_path(spark, "feed")
    write = jobs.keep_newest(out, 100, "ts")
    jobs.drain([jobs.micro_batches(_event_stream(spark, sf), write, work_path(spark, "feed-ckpt"), None)])
    newest = spark.read.parquet(out).agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{out}/version={newest}").select("violation_id", "camera_id")


def _as_stream(df: DataFrame, label: str) -> DataFrame:
    """A derived table written once and read back as a file stream."""
    spark = df.sparkSession
    stored = materialise(df, label)
    folder = stored.inputFiles()[0].rsplit("/", 1)[0]
    return spark.readStream.schema(df.schema).parquet(folder)


@query("i03_cooldown_stream", sql_with("viol", """
, v AS (SELECT *, epoch_us(detected_at) AS us FROM viol),
kept(camera_id, track_id, us) AS (
  SELECT camera_id, track_id, min(us) FROM v GROUP BY ALL
  UNION ALL
  SELECT k.camera_id, k.track_id, (SELECT min(v.us) FROM v WHERE v.camera_id = k.camera_id AND v.track_id = k.track_id
                                     AND v.us >= k.us + 43200000000) FROM kept k WHERE k.us IS NOT NULL)
SELECT v.camera_id, v.track_id, v.violation_id FROM kept JOIN v USING (camera_id, track_id, us)""", recursive=True).replace(")\n,", "),", 1))
def _(spark, sf):
    stream = _event_stream(spark, sf).withColumn("ts_sec", F.unix_micros("ts") / F.lit(1e6))
    out = jobs.rule_stream(stream, rules.Cooldown(43200.0), ["camera_id", "track_id"], ["ts_sec", "violation_id"], ["violation_id"])
    return _drained(out, "cooldown").select("camera_id", "track_id", "violation_id")


#: Micro-batches of a derived stream: at least so many, and more where they would hold more rows.
BATCHES, BATCH_ROWS = 4, 2_000_000
#: Row groups of their files, so that a micro-batch is read in several tasks.
BLOCK_BYTES = 8 << 20


def _moment():
    """The derived seconds as event time, counted from a day of our own: a watermark starts at the epoch."""
    return F.timestamp_micros(F.round(F.col("ts_sec") * 1e6).cast("bigint") + F.lit(1_700_000_000_000_000))


def _in_batches(df: DataFrame, label: str, n: int = BATCHES) -> DataFrame:
    """A derived table as a stream of micro-batches in order of time, ``n`` or more, and a last one with a tick of each camera an
    hour later, which moves the watermark past all frames. The table is dealt to its micro-batches in one pass."""
    spark = df.sparkSession
    path, dealt = work_path(spark, label), work_path(spark, f"{label}-dealt")
    rows = materialise(df.withColumn("ts", _moment()), label)
    low, high, size = rows.agg(F.min("ts_sec"), F.max("ts_sec"), F.count("*")).first()
    n = max(n, math.ceil(size / BATCH_ROWS))
    slot = F.least(F.floor((F.col("ts_sec") - low) / ((high - low) / n)), F.lit(n - 1))
    # a micro-batch is one file, read in several tasks
    by_slot = rows.withColumn("_slot", slot.cast("int")).repartition(n, "_slot").write.partitionBy("_slot")
    by_slot.option("maxRecordsPerFile", 0).option("parquet.block.size", BLOCK_BYTES).parquet(dealt)
    ticks = rows.select("camera_id").distinct().select("camera_id", F.lit(high + 3600.0).alias("ts_sec"))
    ticks = ticks.withColumn("ts", _moment())
    last = work_path(spark, f"{label}-ticks")
    rows.limit(0).unionByName(ticks, allowMissingColumns=True).coalesce(1).write.parquet(last)
    _copied_in_order(spark, [*(f"{dealt}/_slot={i}" for i in range(n)), last], path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _copied_in_order(spark: SparkSession, folders: Sequence[str], path: str) -> None:
    """The files of ``folders``, as far as there are any, in one folder and each later than the one before: a file stream
    takes them in the order in which they were written."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    newest = -1
    for i, folder in enumerate(folders):
        if not fs.exists(hadoop.Path(folder)):
            continue
        for k, found in enumerate(fs.globStatus(hadoop.Path(folder, "*.parquet"))):
            file = hadoop.Path(target, f"part-{i:06d}-{k:06d}.parquet")
            while True:
                hadoop.FileUtil.copy(fs, found.getPath(), fs, file, False, True, conf)
                written = fs.getFileStatus(file).getModificationTime()
                if written > newest:
                    break
                sleep(0.01)
            newest = written


@query("i01_tracks_stream", TRACKS + "\nSELECT camera_id, frame_number, det_id, track_id, is_new FROM tracks")
def _(spark, sf):
    rows = tracking.with_centroid(d.boxes(spark, sf).where("class_id IN (2, 3, 5)"))
    out = stateful.rule_stream(_in_batches(rows, "vehicles"), rules.Tracker(), ["camera_id"], tracking.ORDER, ["frame_number", "det_id"])
    return _drained(out, "tracks").where("NOT is_late").drop("is_late")


@query("i04_repeats_stream", REPEATS + "\nSELECT camera_id, ts_sec, det_id FROM kept_rows")
def _(spark, sf):
    heads = tracking.with_centroid(d.boxes(spark, sf).where("class_id = 7")).withColumn("track_id", F.col("det_id"))
    out = stateful.rule_stream(_in_batches(heads, "heads"), rules.Repeats(), ["camera_id"], ["ts_sec", "det_id"], ["ts_sec", "det_id"])
    return _drained(out, "repeats").where("NOT is_late").select("camera_id", "ts_sec", "det_id")


@query("i08_stop_line_stream", sql_with("cl light cfgs", """
SELECT c.camera_id, count(*) AS n, CAST(sum(frame_number) AS BIGINT) AS frames
FROM cl c JOIN light l USING (camera_id, frame_number) JOIN cfgs ON cfgs.camera_id = c.camera_id
WHERE class_id IN (2, 3, 5) AND light_state = 'RED' AND y + h / 2.0e0 > stop_y GROUP BY 1"""))
def _(spark, sf):
    boxes = d.boxes(spark, sf).where("class_id IN (2, 3, 5)")
    item = F.struct(F.col("class_id").alias("class_id"), g.class_name(F.col("class_id")).alias("class_name"),
                    F.col("conf").cast("float").alias("confidence"), F.array(*g.centroid(g.box())).alias("center"),
                    F.lit("UNKNOWN").alias("state"))
    lamp = F.struct(F.lit(9).alias("class_id"), F.lit("traffic light").alias("class_name"), F.lit(1.0).cast("float").alias("confidence"),
                    F.array(F.lit(0.0), F.lit(0.0)).alias("center"), F.col("light_state").alias("state"))
    per_frame = (boxes.groupBy("camera_id", "frame_number").agg(F.collect_list(item).alias("found"))
                 .join(d.frame_light(spark, sf), ["camera_id", "frame_number"])
                 .select("camera_id", "frame_number", F.concat("found", F.array(lamp)).alias("detections")))
    cfg = materialise(config.scale_config(d.camera_config(spark), d.FRAME_W, d.FRAME_H), "cfg")
    out = _drained(redlight.stop_line_violations(_as_stream(per_frame, "frames"), cfg).select(
        "camera_id", "frame_number", F.size("violations").alias("n")), "stop-line")
    return out.groupBy("camera_id").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("frame_number")).alias("frames"))


@query("i05_helmet_stream", HELMETS + "\nSELECT camera_id, frame_number, ts_sec, track_id, method FROM bare")
def _(spark, sf):
    found = helmet.ordered_candidates(d.boxes(spark, sf)).select(
        "camera_id", *helmet.ORDER, "ts_sec", "method", *(c for c in rules.HelmetWatch.inputs if c not in helmet.ORDER))
    out = stateful.rule_stream(_in_batches(found, "candidates"), rules.HelmetWatch(), ["camera_id"], helmet.ORDER,
                               ["frame_number", "ts_sec", "method"])
    return _drained(out, "helmet").where("violation AND NOT is_late").select("camera_id", "frame_number", "ts_sec", "track_id", "method")
