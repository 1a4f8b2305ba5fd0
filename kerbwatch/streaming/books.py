"""Micro-batch reports that account for every row: counted, still open, or late in a table of its own.

Spark drops rows behind the watermark. Here each micro-batch is booked instead: a small ledger entry keeps the newest
event time seen, what is open is a version of its own, and whatever belongs to a closed window goes to the late
table. A batch writes only folders named after its number, from those of the batch before, so a replayed batch
writes the same again and a broken one is simply repeated. Batches are numbered without gaps, as ``foreachBatch`` does.
Versions are not removed here: give the folder an expiry rule.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Writer = Callable[[DataFrame, int], None]
_LEDGER = "newest timestamp, rows_in bigint, rows_late bigint, rows_open bigint"


class Book:
    """Folders of one report: ``ledger``, ``open``, ``closed`` and ``late``, one sub-folder for each batch."""

    def __init__(self, path: str):
        self.path = path

    def folder(self, part: str, batch_id: int) -> str:
        return os.path.join(self.path, part, f"batch={batch_id}")

    def write(self, part: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.folder(part, batch_id))

    def version(self, spark: SparkSession, part: str, batch_id: int, schema) -> DataFrame:
        """What batch ``batch_id`` left in ``part``; nothing before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.folder(part, batch_id))

    def newest(self, spark: SparkSession, batch_id: int) -> datetime | None:
        row = self.version(spark, "ledger", batch_id, _LEDGER).first()
        return row["newest"] if row else None

    def enter(self, spark: SparkSession, batch_id: int, newest: datetime | None, rows_in: int, late: int, left: int) -> None:
        self.write("ledger", batch_id, spark.createDataFrame([(newest, rows_in, late, left)], _LEDGER))

    def all(self, spark: SparkSession, part: str, schema) -> DataFrame:
        """Every row of ``part``; the batch number is a partition column and left out."""
        return spark.read.schema(schema).option("basePath", os.path.join(self.path, part)).parquet(os.path.join(self.path, part)).drop("batch")


def _mark(newest: datetime | None, delay: timedelta) -> Column:
    """Event time before which windows are closed."""
    return F.lit(datetime(1, 1, 1) if newest is None else newest - delay).cast("timestamp")


def _later(a: datetime | None, b: datetime | None) -> datetime | None:
    return max((x for x in (a, b) if x is not None), default=None)


def _booked(book: Book, time: str, delay: timedelta, late: Callable[[DataFrame, Column], Column],
            merge: Callable[[DataFrame, DataFrame], DataFrame], closes: Callable[[Column], Column], open_schema: str) -> Writer:
    """``foreachBatch`` function of a report: ``merge`` adds fresh rows to what is open, ``closes`` says what is done.

    Rows without an event time are late: no window can hold them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = book.newest(spark, batch_id - 1)
            mark = _mark(before, delay)
            behind = F.coalesce(late(batch, mark), F.lit(True))
            facts = batch.agg(F.max(time).alias("newest"), F.count("*").alias("n"), F.count_if(behind).alias("late")).first()
            newest = _later(before, facts["newest"])
            book.write("late", batch_id, batch.where(behind))
            held = merge(book.version(spark, "open", batch_id - 1, open_schema), batch.where(~behind)).persist()
            try:
                done = closes(_mark(newest, delay))
                book.write("closed", batch_id, held.where(done))
                book.write("open", batch_id, held.where(~done))
                book.enter(spark, batch_id, newest, facts["n"], facts["late"], held.where(~done).count())
            finally:
                held.unpersist()
        finally:
            batch.unpersist()

    return write


def hourly(path: str, by: Sequence[str] = ("camera_id", "violation_type"), time: str = "ts",
           delay: timedelta = timedelta(minutes=10)) -> Writer:
    """Counts per hour and ``by``. An hour comes out once its end lies ``delay`` behind the newest row; what arrives
    for it afterwards is late."""
    by = list(by)
    schema = ", ".join(["hour_bucket timestamp", *(f"{c} string" for c in by), "count bigint"])
    end = F.date_trunc("hour", time) + F.expr("INTERVAL 1 HOUR")

    def merge(held: DataFrame, fresh: DataFrame) -> DataFrame:
        new = fresh.groupBy(F.date_trunc("hour", time).alias("hour_bucket"), *by).agg(F.count("*").alias("count"))
        return held.unionByName(new).groupBy("hour_bucket", *by).agg(F.sum("count").alias("count"))

    return _booked(Book(path), time, delay, lambda _, mark: end <= mark, merge,
                   lambda mark: F.col("hour_bucket") + F.expr("INTERVAL 1 HOUR") <= mark, schema)


def sessions(path: str, ttl: timedelta, keys: str = "camera_id string, track_id bigint", time: str = "ts",
             delay: timedelta = timedelta(minutes=10)) -> Writer:
    """Lifetimes per key (first_seen, last_seen, sightings): sightings closer than ``ttl`` belong together.

    A row older than ``delay`` behind the newest one is late, and a lifetime is closed when no other row can join it.
    """
    names = [c.split()[0] for c in keys.split(",")]
    schema = f"{keys}, first_seen timestamp, last_seen timestamp, sightings bigint"
    gap = F.make_dt_interval(secs=F.lit(ttl.total_seconds()))

    def merge(held: DataFrame, fresh: DataFrame) -> DataFrame:
        new = fresh.groupBy(*names, time).agg(F.count("*").alias("sightings"))
        new = new.select(*names, F.col(time).alias("first_seen"), F.col(time).alias("last_seen"), "sightings")
        order = Window.partitionBy(*names).orderBy("first_seen", "last_seen")
        reached = F.max("last_seen").over(order.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.coalesce((F.col("first_seen") >= reached + gap).cast("int"), F.lit(1))
        parts = held.unionByName(new).withColumn("_opens", opens).withColumn("_n", F.sum("_opens").over(order))
        return parts.groupBy(*names, "_n").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
                                               F.sum("sightings").alias("sightings")).drop("_n")

    return _booked(Book(path), time, delay, lambda _, mark: F.col(time) < mark, merge, lambda mark: F.col("last_seen") + gap <= mark, schema)


def arrivals(path: str, key: str = "violation_id", kind: str = "bigint", time: str = "ts", delay: timedelta = timedelta(minutes=10)) -> Writer:
    """The first row of every key, at once; a key is forgotten ``delay`` behind the newest row, and older rows are late.

    ``closed`` holds the arrivals; repeats are counted nowhere. Of rows with one key and time, the first in all columns.
    """
    book = Book(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = book.newest(spark, batch_id - 1)
            behind = F.coalesce(F.col(time) < _mark(before, delay), F.lit(True))
            facts = batch.agg(F.max(time).alias("newest"), F.count("*").alias("n"), F.count_if(behind).alias("late")).first()
            newest = _later(before, facts["newest"])
            known = book.version(spark, "open", batch_id - 1, f"{key} {kind}, seen timestamp")
            row = F.struct(F.col(time), *(c for c in batch.columns if c != time))
            first = batch.where(~behind).groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_row")).select("_key", "_row.*")
            new = first.join(known.select(F.col(key).alias("_known")), F.col("_key").eqNullSafe(F.col("_known")), "left_anti")
            book.write("late", batch_id, batch.where(behind))
            book.write("closed", batch_id, new.select(*batch.columns))
            held = known.unionByName(new.select(key, F.col(time).alias("seen"))).where(F.col("seen") >= _mark(newest, delay))
            book.write("open", batch_id, held)
            left = book.version(spark, "open", batch_id, held.schema).count()
            book.enter(spark, batch_id, newest, facts["n"], facts["late"], left)
        finally:
            batch.unpersist()

    return write


def buffered(path: str, rows: int = 10, wait: timedelta = timedelta(seconds=5), time: str = "ts") -> Writer:
    """Collected inserts: waiting rows are flushed together once there are ``rows`` of them or the oldest has waited.

    What waits is carried from batch to batch; ``closed`` holds one flush for each batch that made one.
    """
    book = Book(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = book.version(spark, "open", batch_id - 1, batch.schema).unionByName(batch).persist()
        try:
            facts = held.agg(F.count("*").alias("n"), F.min(time).alias("oldest"), F.max(time).alias("newest")).first()
            waited = facts["oldest"] is not None and facts["newest"] - facts["oldest"] >= wait
            flush = facts["n"] >= rows or waited
            book.write("closed", batch_id, held if flush else held.limit(0))
            book.write("open", batch_id, held.limit(0) if flush else held)
            book.enter(spark, batch_id, _later(book.newest(spark, batch_id - 1), facts["newest"]), facts["n"], 0, 0 if flush else facts["n"])
        finally:
            held.unpersist()

    return write


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the newest booked batch."""
    ledger = spark.read.option("basePath", os.path.join(path, "ledger")).parquet(os.path.join(path, "ledger"))
    return ledger.agg(F.max("batch")).first()[0]


def booked(spark: SparkSession, path: str, schema, part: str = "closed") -> DataFrame:
    """All rows of one part; for ``open`` only the newest version counts."""
    book = Book(path)
    return book.version(spark, "open", last_batch(spark, path), schema) if part == "open" else book.all(spark, part, schema)
