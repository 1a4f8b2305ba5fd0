"""Detection filters that run before any shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.functions import geometry as g
from kerbwatch.sources import config


def of_classes(dets: DataFrame, classes: Iterable[int], min_conf: float | None = None) -> DataFrame:
    """Class set and confidence threshold; both reach the parquet scan."""
    out = dets.where(F.col("class_id").isin(*classes))
    return out if min_conf is None else out.where(F.col("conf") >= F.lit(float(min_conf)))


def in_detection_zone(dets: DataFrame, edges: Sequence[str]) -> DataFrame:
    """Box centre inside the camera's zone (needs the columns and edge names of ``config.flat_zone``)."""
    parts = [[f"{e}_{p}" for p in config.EDGE_PARTS] for e in edges]
    inside = g.in_flat_zone(*g.centroid(g.box()), [tuple(map(F.col, p)) for p in parts], F.col("corners"))
    return dets.where(inside).drop("corners", *(c for p in parts for c in p))


def every_nth(frames: DataFrame, source_fps: float, target_fps: float) -> DataFrame:
    """Thin a frame table to the target rate: keep frame numbers divisible by the skip."""
    skip = max(1, int(source_fps / target_fps))
    return frames.where(F.col("frame_number") % skip == 0)


def matching(df: DataFrame, **wanted) -> DataFrame:
    """AND of the given equality filters; ``None`` means no filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def since(ts: Column | str, as_of, interval: str, inclusive: bool = False) -> Column:
    """``ts`` within ``interval`` before ``as_of`` (``None`` = now)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    start = _moment(as_of) - F.expr(f"INTERVAL {interval}")
    return ts >= start if inclusive else ts > start


def same_day(ts: Column | str, as_of) -> Column:
    return F.to_date(ts) == F.to_date(_moment(as_of))


def _moment(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def unprocessed(frames: DataFrame) -> DataFrame:
    return frames.where(~F.coalesce("processed", F.lit(False)))
