"""Ordered per-key functions that do not need a whole key in one task.

A plain ``OVER (PARTITION BY key ORDER BY t)`` sorts every key in one task, which fails when one
camera holds a third of all rows. Here a key is cut into order buckets. Each bucket is scanned on
its own, one pre-aggregated row per bucket carries what later buckets need, and only those few rows
are windowed per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.session import materialise

_BUCKET = "_bucket"


def split_hot(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with at most ``limit`` rows, and those of larger keys (None when there are none)."""
    hot = df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)
    if not hot.take(1):
        return df, None
    hot = materialise(hot, "hot-keys")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    renamed = hot.select(*(F.col(k).alias(f"_k_{k}") for k in keys))
    return df.join(renamed, same, "left_anti"), df.join(renamed, same, "left_semi")


def bucketed(df: DataFrame, order: str, width: float) -> DataFrame:
    return df.withColumn(_BUCKET, F.floor(F.col(order) / F.lit(width)).cast("bigint"))


def _led_by(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Put a bucket's carry in front of it as one extra row (``_real`` = 0).

    The window then finds it like any earlier row. Joining it back instead would shuffle and sort all
    rows a second time.
    """
    return rows.withColumn("_real", F.lit(1)).unionByName(carry.withColumn("_real", F.lit(0)), allowMissingColumns=True)


def _inside(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, _BUCKET).orderBy("_real", *order)


def _across(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(_BUCKET)


def _rank(order: Sequence[str]) -> Column:
    """Order as one value; a single column stays plain, so that it aggregates in a hash table."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _real_rows(df: DataFrame, *scratch: str) -> DataFrame:
    return df.where(F.col("_real") == 1).drop("_real", _BUCKET, *scratch)


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str | Column],
                  width: float) -> DataFrame:
    """Add, per key, the values of the previous row in ``order``; bucketing is on ``order[0]``.

    ``values`` maps new column names to expressions over the row.
    """
    packed = F.struct(*(F.col(v).alias(n) if isinstance(v, str) else v.alias(n) for n, v in values.items()))
    rows = bucketed(df, order[0], width).withColumn("_row", packed)
    last = rows.groupBy(*keys, _BUCKET).agg(F.max_by("_row", _rank(order)).alias("_last"))
    carry = last.select(*keys, _BUCKET, F.lag("_last").over(_across(keys)).alias("_row")).where("_row IS NOT NULL")
    out = _led_by(rows, carry).withColumn("_prev", F.lag("_row").over(_inside(keys, order)))
    return _real_rows(out.withColumns({n: F.col("_prev").getField(n) for n in values}), "_row", "_prev")


def with_last_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column],
                    width: float) -> DataFrame:
    """Add the newest non-null value of each expression over the strictly earlier rows of the key."""
    names = {n: f"_v_{n}" for n in values}
    rows = bucketed(df, order[0], width).withColumns({names[n]: v for n, v in values.items()})
    last = rows.groupBy(*keys, _BUCKET).agg(*(
        F.max_by(v, F.when(F.col(v).isNotNull(), _rank(order))).alias(v) for v in names.values()))
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, _BUCKET, *(F.last(v, ignorenulls=True).over(before).alias(v) for v in names.values()))
    earlier = _inside(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    out = _led_by(rows, carry).withColumns({n: F.last(v, ignorenulls=True).over(earlier) for n, v in names.items()})
    return _real_rows(out, *names.values())


def with_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column,
                     width: float) -> DataFrame:
    """Add the running total of ``value`` up to and including the row; with ``lit(1)`` it numbers rows."""
    rows = bucketed(df, order[0], width).withColumn("_v", value.cast("bigint"))
    total = rows.groupBy(*keys, _BUCKET).agg(F.sum("_v").alias("_t"))
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carry = total.select(*keys, _BUCKET, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_v"))
    upto = _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return _real_rows(_led_by(rows, carry).withColumn(name, F.sum("_v").over(upto)), "_v")
