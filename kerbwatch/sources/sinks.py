"""Writers: append, insert-if-new, merge of hourly summaries, defaults."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.operators.dedup import first_rows
from kerbwatch.session import materialise


def new_rows(batch: DataFrame, target: DataFrame | None, key: str = "violation_id",
             order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Rows to append so that the first row per key wins and stored keys stay untouched."""
    fresh = first_rows(batch, [key], order)
    return fresh if target is None else fresh.join(target.select(key), key, "left_anti")


def insert_new(batch: DataFrame, path: str, key: str = "violation_id", order: Sequence[str] = ("timestamp",),
               partition_by: Sequence[str] = ()) -> None:
    """Append unseen rows to a parquet table. Running the same batch again adds nothing."""
    spark = batch.sparkSession
    try:
        target = spark.read.parquet(path)
    except Exception as error:  # the table does not exist yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        target = None
    new_rows(batch, target, key, order).write.mode("append").partitionBy(*partition_by).parquet(path)


#: Days of one batch that become a partition filter; a batch over more days compares with the whole table.
MAX_DAYS = 1000


def new_on_days(batch: DataFrame, path: str, key: str = "violation_id", order: Sequence[str] = ("timestamp",),
                time: str = "timestamp") -> DataFrame:
    """Rows of ``batch`` to append to a table partitioned by ``day`` whose ids each belong to one day.

    That holds for ids made from what happened when (``fields.violation_key``). Equal ids are looked for on the batch's own
    days only, which reach the scan as partition filters, so the cost follows the batch and not the table.
    """
    spark = batch.sparkSession
    rows = materialise(first_rows(batch, [key], order).withColumn("day", F.to_date(time)), "insert")
    found = [r[0] for r in rows.select("day").distinct().limit(MAX_DAYS + 1).collect()]
    try:
        stored = spark.read.schema(rows.schema).parquet(path)
    except AnalysisException as error:  # the table does not exist yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return rows
    if len(found) <= MAX_DAYS:
        days = [x for x in found if x is not None]
        stored = stored.where(F.col("day").isin(days) | F.col("day").isNull() if None in found else F.col("day").isin(days))
    return rows.join(stored.select(key), key, "left_anti")


def insert_by_day(batch: DataFrame, path: str, key: str = "violation_id", order: Sequence[str] = ("timestamp",),
                  time: str = "timestamp") -> None:
    """Append unseen rows to a parquet table partitioned by day; the same batch again adds nothing."""
    new_on_days(batch, path, key, order, time).write.mode("append").partitionBy("day").parquet(path)


def jdbc_append(url: str, table: str, properties: dict[str, str] | None = None,
                batch_rows: int = 1000) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function appending to a database table; each task commits or rolls back its rows."""
    options = {"batchsize": str(batch_rows), **(properties or {})}

    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.jdbc(url, table, mode="append", properties=options)

    return write


def seed(existing: DataFrame, rows: DataFrame, key: str = "camera_id") -> DataFrame:
    """Dimension rows added only where their key is missing."""
    return existing.unionByName(rows.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


# ---------------------------------------------------------------- hourly summary


def _merge_maps(old: Column, new: Column, mode: str) -> Column:
    empty = F.create_map().cast("map<string,bigint>")
    old, new = F.coalesce(old, empty), F.coalesce(new, empty)
    if mode == "sum":
        return F.map_zip_with(old, new, lambda _k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    if mode == "replace":
        return F.map_zip_with(old, new, lambda _k, a, b: F.coalesce(b, a))
    raise ValueError("mode is 'sum' or 'replace'")


def merge_summary(old: DataFrame, new: DataFrame, mode: str = "sum", now: Column | None = None) -> DataFrame:
    """Summary rows after an upsert: totals add, breakdowns add or are replaced key by key.

    ``replace`` is what a JSON merge does; ``sum`` keeps the counts right.
    """
    key = ["camera_id", "hour_bucket"]
    stamp = F.current_timestamp() if now is None else now
    o = old.select(*key, *(F.col(c).alias(f"o_{c}") for c in old.columns if c not in key), F.lit(True).alias("_old"))
    n = new.select(*key, *(F.col(c).alias(f"n_{c}") for c in new.columns if c not in key), F.lit(True).alias("_new"))
    both = o.join(n, key, "full")

    def side(name: str, df: DataFrame, prefix: str) -> Column:
        return F.col(prefix + name) if name in df.columns else F.lit(None)

    totals = [(F.coalesce(side(c, old, "o_").cast("bigint"), F.lit(0).cast("bigint"))
               + F.coalesce(side(c, new, "n_").cast("bigint"), F.lit(0).cast("bigint"))).alias(c)
              for c in ("total_frames", "total_detections", "total_violations")]
    maps = [_merge_maps(side(c, old, "o_").cast("map<string,bigint>"), side(c, new, "n_").cast("map<string,bigint>"),
                        mode).alias(c) for c in ("vehicle_breakdown", "violation_breakdown")]
    kept = side("updated_at", old, "o_").cast("timestamp")
    return both.select(*key, *totals, *maps, F.when(F.col("_new"), stamp).otherwise(kept).alias("updated_at"))


def upsert_summary(new: DataFrame, path: str, mode: str = "sum") -> None:
    """Merge into a parquet table partitioned by day, rewriting only the days that ``new`` touches."""
    spark = new.sparkSession
    new = materialise(new.withColumn("day", F.to_date("hour_bucket")), "summary-new")
    try:
        stored = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = None
    if stored is None:
        merged = merge_summary(new.drop("day").limit(0), new.drop("day"), mode)
    else:
        old = stored.join(new.select("day").distinct(), "day", "left_semi")
        merged = merge_summary(old.drop("day"), new.drop("day"), mode)
    # staged first: a table cannot be read and overwritten by one job
    staged = materialise(merged.withColumn("day", F.to_date("hour_bucket")), "summary-merged")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


# ---------------------------------------------------------------- defaults


def with_defaults(rows: DataFrame, **defaults) -> DataFrame:
    """Fill missing columns and nulls, e.g. ``violation_type='RED_LIGHT', is_active=True``."""
    for name, value in defaults.items():
        value = value if isinstance(value, Column) else F.lit(value)
        rows = rows.withColumn(name, F.coalesce(F.col(name), value) if name in rows.columns else value)
    return rows


def violation_defaults(rows: DataFrame, violation_type: str, now: Column | None = None) -> DataFrame:
    return with_defaults(rows, violation_type=violation_type, created_at=F.current_timestamp() if now is None else now)


def update_rows(table: DataFrame, changes: DataFrame, key: str, now: Column | None = None) -> DataFrame:
    """Apply changed values and stamp ``updated_at`` on exactly the changed rows."""
    stamp = F.current_timestamp() if now is None else now
    values = [c for c in changes.columns if c != key]
    c = changes.select(key, *(F.col(v).alias(f"_n_{v}") for v in values), F.lit(True).alias("_hit"))
    out = table.join(c, key, "left")
    for v in values:
        out = out.withColumn(v, F.when(F.col("_hit"), F.col(f"_n_{v}")).otherwise(F.col(v)))
    out = out.withColumn("updated_at", F.when(F.col("_hit"), stamp).otherwise(F.col("updated_at")))
    return out.select(*table.columns)
