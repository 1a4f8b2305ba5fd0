"""Cooldown and near-duplicate suppression of reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.operators import fold, pointers, rules
from kerbwatch.session import materialise


def cooldown(reports: DataFrame, seconds: float = rules.COOLDOWN, keys: Sequence[str] = ("camera_id", "track_id"),
             order: Sequence[str] = ("ts_sec", "det_id"), time: str = "ts_sec", width: float | None = None) -> DataFrame:
    """Reports at least ``seconds`` after the last *kept* report of their key (order columns and keys).

    Of reports of one moment the first in ``order`` counts. Reports without a time take no part. ``width`` is the length of
    an order bucket (default: 300 times ``seconds``); the result does not depend on it.
    """
    keys, kept = list(keys), [c for c in order if c not in keys]
    timed = reports.where(F.col(time).isNotNull()).withColumn("_at", F.col(time).cast("double"))
    if seconds <= 0:
        return timed.select(*keys, *kept)
    first = F.min(F.struct(*kept)).alias("_row")
    moments = materialise(timed.groupBy(*keys, "_at").agg(first), "moments")
    chain = pointers.kept_moments(moments.select(*keys, "_at"), keys, seconds, 300 * seconds if width is None else width)
    return pointers.same_keys(moments, chain, [*keys, "_at"], "left_semi").select(*keys, "_row.*")


def without_repeats(reports: DataFrame, seconds: float = rules.REPEAT_SECONDS,
                    distance: float = rules.REPEAT_DISTANCE, order: Sequence[str] = ("ts_sec", "det_id"),
                    **chunks) -> DataFrame:
    """Exact suppression per camera: compares with kept reports only. Needs track_id, cx, cy."""
    return fold.run_rule(reports, rules.Repeats(seconds, distance), ["camera_id"], order,
                         [*order, "track_id"] if "track_id" not in order else list(order), **chunks).drop("kept")


def first_of_cluster(reports: DataFrame, seconds: float = rules.REPEAT_SECONDS,
                     distance: float = rules.REPEAT_DISTANCE) -> DataFrame:
    """Reports with no earlier report at all within ``seconds`` and ``distance`` (one-step form).

    An anti-join on camera, time bucket and grid cell. The cell is twice the distance wide, so an earlier
    report reaches at most four cells and two buckets; equal places and times are merged beforehand.
    """
    size = 2.0 * distance
    now = reports.withColumns({
        "_tb": F.floor(F.col("ts_sec") / seconds), "_gx": F.floor(F.col("cx") / size),
        "_gy": F.floor(F.col("cy") / size)})
    before = reports.groupBy(F.col("camera_id").alias("_cam"), F.col("ts_sec").alias("_ts"), F.col("cx").alias("_cx"),
                             F.col("cy").alias("_cy")).agg(F.min("det_id").alias("_id"))

    def reach(name, step, width):
        c = F.col(name)
        return F.explode(F.sequence(F.floor((c - step) / width), F.floor((c + step) / width)))

    before = (before.withColumn("_tb2", F.explode(F.sequence(F.floor(F.col("_ts") / seconds),
                                                            F.floor((F.col("_ts") + seconds) / seconds))))
              .withColumn("_gx2", reach("_cx", distance, size)).withColumn("_gy2", reach("_cy", distance, size)))
    dx, dy = F.col("cx") - F.col("_cx"), F.col("cy") - F.col("_cy")
    earlier = (F.col("_ts") < F.col("ts_sec")) | ((F.col("_ts") == F.col("ts_sec")) & (F.col("_id") < F.col("det_id")))
    close = [F.col("camera_id") == F.col("_cam"), F.col("_tb") == F.col("_tb2"), F.col("_gx") == F.col("_gx2"),
             F.col("_gy") == F.col("_gy2"), earlier, F.col("ts_sec") - F.col("_ts") < F.lit(seconds),
             F.sqrt(dx * dx + dy * dy) < F.lit(distance)]
    return now.join(before, close, "left_anti").drop("_tb", "_gx", "_gy")


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key. Partial aggregation on the whole row: a key repeated often is merged early."""
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.first(F.lit(1))
    return df.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*df.columns)


