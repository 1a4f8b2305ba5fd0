"""Cut points in space and time: parts of a camera's rows that cannot influence each other.

A rule that only looks ``ttl`` seconds back and ``reach`` pixels around has nothing to carry over a pause longer than
``ttl`` in a whole camera, nor between boxes with an empty strip wider than ``reach`` between them. Rows are laid on a
grid of such steps, and the occupied cells, merged before any shuffle, are cut along time, x, y and time again:
wherever an empty step lies between two occupied ones, a new piece begins. Pieces run apart, with the result of one run over
all of them, so a rule needs no memory across a cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.operators.pointers import same_keys
from kerbwatch.session import materialise

#: Cells are a little wider than the limits, so rounding cannot bring pieces together.
MARGIN = 1.001
AXES = ("_slot", "_gx", "_gy", "_slot")


def _split(cells: DataFrame, group: Sequence[str], axis: str, name: str) -> DataFrame:
    """``cells`` with the number of their part along ``axis``, counted within ``group``: a window over distinct steps."""
    along = Window.partitionBy(*group).orderBy(axis)
    opens = (F.col(axis) - F.lag(axis).over(along) > 1).cast("int")
    steps = cells.select(*group, axis).distinct().withColumn("_opens", F.coalesce(opens, F.lit(0)))
    parts = steps.select(*group, axis, F.sum("_opens").over(along).alias(name))
    return same_keys(cells, parts, [*group, axis], "inner")


def with_piece(rows: DataFrame, keys: Sequence[str], reach: float, ttl: float, time: str = "ts_sec", x: str = "cx",
               y: str = "cy") -> DataFrame:
    """``rows`` with ``_piece``: rows of different pieces of a key are further than ``reach`` or ``ttl`` apart, or both
    pieces have no chain of rows between them that is nearer. Rows need a time and a place."""
    keys, grid = list(keys), ("_slot", "_gx", "_gy")
    sizes = {"_slot": (time, ttl * MARGIN), "_gx": (x, reach * MARGIN), "_gy": (y, reach * MARGIN)}
    placed = rows.withColumns({n: F.floor(F.col(c) / F.lit(size)).cast("bigint") for n, (c, size) in sizes.items()})
    cells = materialise(placed.select(*keys, *grid).distinct(), "occupied-cells")
    parts: list[str] = []
    for n, axis in enumerate(AXES):
        cells = _split(cells, [*keys, *parts], axis, f"_part{n}")
        parts.append(f"_part{n}")
        if n == 1:
            cells = materialise(cells, "cells")  # every cut reads its cells twice
    # two pieces under one hash are run as one, which changes nothing but the deal
    named = cells.select(*keys, *grid, F.xxhash64(*parts).alias("_piece"))
    return same_keys(placed, named, [*keys, *grid], "inner").drop(*grid)
