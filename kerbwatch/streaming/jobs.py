"""Streaming counterparts: the same rules and reports over unbounded input."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kerbwatch import schemas
from kerbwatch.operators import redlight
from kerbwatch.operators.fold import Rule
from kerbwatch.session import ship_package
from kerbwatch.sources import config, frames, sinks

FLUSH_SECONDS = 5


# ---------------------------------------------------------------- ordered rules


def _step(rule: Rule, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], time: str,
          outputs: list[str], delay: float | None):
    """State function: restore the rule, run the rows that are due in order, store the rule again."""
    columns = list(dict.fromkeys([time, *order, *keep, *rule.inputs]))

    def plain(value):
        if value is None or (isinstance(value, float) and pd.isna(value)):
            return None
        return value.item() if hasattr(value, "item") else value

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory, waiting, done, newest = state.get if state.exists else (None, None, None, None)
        held = [tuple(r) for r in json.loads(waiting)] if waiting else []
        late = []
        for pdf in batches:
            for values in zip(*(pdf[c] for c in columns)):
                row = tuple(plain(v) for v in values)
                newest = row[0] if newest is None else max(newest, row[0])
                (late if done is not None and row[0] <= done else held).append(row)
        if delay is None:
            due, held = held, []
        else:
            horizon = max(state.getCurrentWatermarkMs() / 1000.0, (newest or 0.0) - delay)
            due, held = [r for r in held if r[0] <= horizon], [r for r in held if r[0] > horizon]
        at = {c: i for i, c in enumerate(columns)}
        # nulls first, as in the batch sort
        due.sort(key=lambda r: tuple((r[at[c]] is not None, 0 if r[at[c]] is None else r[at[c]]) for c in (time, *order)))
        rule.restore(memory)
        found, frame = [], None
        for r in due:
            done = r[0]
            if (done, r[at[order[0]]]) != frame:
                frame = (done, r[at[order[0]]])
                rule.begin_frame(done)
            result = rule.row(done, *(r[at[c]] for c in rule.inputs))
            if result is not None:
                found.append((*key, *(r[at[c]] for c in keep), *result, False))
        found += [(*key, *(r[at[c]] for c in keep), *([None] * len(outputs)), True) for r in late]
        idle = done is not None and not held and rule.next_id == 1
        if delay is not None and idle and state.getCurrentWatermarkMs() / 1000.0 > done + rule.memory:
            state.remove()  # nothing this key remembers can matter any more
        else:
            state.update((rule.dump(done) if done is not None else None, json.dumps(held), done, newest))
            if delay is not None and (held or (idle and rule.memory != float("inf"))):
                wake = min(r[0] for r in held) if held else done + rule.memory
                state.setTimeoutTimestamp(max(int(wake * 1000), state.getCurrentWatermarkMs()) + 1)
        if found:
            yield pd.DataFrame(found, columns=[*keys, *keep, *outputs, "is_late"], dtype=object)

    return step


def rule_stream(stream: DataFrame, rule: Rule, keys: Sequence[str], order: Sequence[str], keep: Sequence[str],
                time: str = "ts_sec", event_time: str = "ts", delay: float | None = None,
                forget: str = "1 hour") -> DataFrame:
    """Run an ordered rule over a stream, one state per key.

    With ``delay`` (seconds) a row waits until its key has moved on that far, so rows may arrive out of
    order; rows older than what was already judged come out with ``is_late`` set, for a side table. The
    watermark ``forget`` behind the newest row of all keys releases waiting rows of silent keys and
    evicts state that can no longer matter; still older rows are dropped and counted by Spark. Without
    ``delay`` each micro-batch is taken to be complete and later than the one before.
    """
    ship_package(stream.sparkSession)
    fields = T._parse_datatype_string(rule.outputs).fields
    schema = T.StructType([*(T.StructField(c, stream.schema[c].dataType) for c in (*keys, *keep)), *fields,
                           T.StructField("is_late", T.BooleanType())])
    timeout = GroupStateTimeout.NoTimeout
    if delay is not None:
        stream = stream.withWatermark(event_time, forget)
        timeout = GroupStateTimeout.EventTimeTimeout
    step = _step(rule, list(keys), list(order), list(keep), time, [f.name for f in fields], delay)
    return stream.groupBy(*keys).applyInPandasWithState(
        step, schema, "memory string, waiting string, done double, newest double", "append", timeout)


# ---------------------------------------------------------------- reports on streams


def hourly_counts(stream: DataFrame, event_time: str = "ts", delay: str = "10 minutes",
                  by: Sequence[str] = ("camera_id", "violation_type")) -> DataFrame:
    """Hourly tumbling counts; an hour comes out once the watermark has passed its end."""
    hour = F.window(event_time, "1 hour")
    return (stream.withWatermark(event_time, delay).groupBy(hour.alias("w"), *by).agg(F.count("*").alias("count"))
            .select(F.col("w.start").alias("hour_bucket"), *by, "count"))


def track_sessions(stream: DataFrame, ttl: str = "2 seconds", event_time: str = "ts", delay: str = "10 seconds",
                   by: Sequence[str] = ("camera_id", "track_id")) -> DataFrame:
    """Track lifetimes as session windows: sightings closer than ``ttl`` belong together."""
    session = F.session_window(event_time, ttl)
    return (stream.withWatermark(event_time, delay).groupBy(session.alias("w"), *by)
            .agg(F.count("*").alias("sightings"), F.min(event_time).alias("first_seen"),
                 F.max(event_time).alias("last_seen")).drop("w"))


def first_arrivals(stream: DataFrame, key: str = "violation_id", event_time: str = "ts",
                   delay: str = "10 minutes") -> DataFrame:
    """Each id once, as long as repeats arrive within the delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


# ---------------------------------------------------------------- sinks


def to_messages(df: DataFrame, key: Column | None = None) -> DataFrame:
    """One JSON ``value`` per row, as a topic expects it."""
    columns = [F.to_json(F.struct("*")).alias("value")]
    return df.select(*([key.cast("string").alias("key")] if key is not None else []), *columns)


def append_to(df: DataFrame, fmt: str, checkpoint: str, path: str | None = None, **options) -> DataStreamWriter:
    """Append writer with its own checkpoint; the caller picks the trigger and starts it."""
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint).options(**options)
    return writer.option("path", path) if path else writer


def micro_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  seconds: int | None = FLUSH_SECONDS) -> StreamingQuery:
    """Collected inserts: one ``write`` per trigger interval (``None`` = drain what is there and stop).

    The source option ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger`` bounds the rows of one flush.
    """
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def fan_out(outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
            write: Callable[[str, DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function feeding one batch to several independent detectors.

    The batch is read once and kept for the duration of the writes.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, transform in outputs.items():
                write(name, transform(batch), batch_id)
        finally:
            batch.unpersist()

    return run


def separate_consumers(source: Callable[[], DataFrame], outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
                       start: Callable[[str, DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """One query, and so one set of offsets, per detector."""
    return [start(name, transform(source())) for name, transform in outputs.items()]


def batch_parquet(path: str) -> Callable[[str, DataFrame, int], None]:
    """Writer for ``fan_out``: one folder per output and batch, overwritten on replay."""
    def write(name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(path, name, f"batch={batch_id}"))

    return write


def insert_new_batches(path: str, key: str = "violation_id",
                       order: Sequence[str] = ("timestamp",)) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` insert that ignores stored ids, so replays add nothing."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        sinks.insert_new(batch, path, key, order)

    return write


def keep_newest(path: str, n: int = 100, ts: str = "detected_at",
                key: str = "violation_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` maintenance of the newest ``n`` rows.

    Every batch writes its own small version, built from the version before it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id > 0:
            rows = rows.unionByName(batch.sparkSession.read.schema(batch.schema)
                                    .parquet(os.path.join(path, f"version={batch_id - 1}")))
        top = rows.orderBy(F.desc(ts), key).limit(n).coalesce(1)
        top.write.mode("overwrite").parquet(os.path.join(path, f"version={batch_id}"))

    return write


# ---------------------------------------------------------------- the frame-level job


def stop_line_job(messages: DataFrame, cfg: DataFrame, detect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Frame references in, violation messages out.

    ``detect`` adds the ``detections`` array (see ``operators.scoring``). Cameras without a stop line are
    dropped before it, because model calls are what costs.
    """
    good, _ = frames.decode(messages, schemas.FRAME_REF)
    gated = config.configured(good, cfg.where(F.col("stop_y").isNotNull()))
    found = redlight.stop_line_violations(detect(gated), cfg)
    return to_messages(found.select("camera_id", "timestamp", "image_path", "violations"))


def drain(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()
