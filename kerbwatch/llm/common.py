"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbwatch.session import materialise, ship_package, work_path

__all__ = ["documents", "held_out", "look_up", "map_rows", "materialise", "raw", "table", "work_path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def raw(text: Column | str) -> Column:
    """A text as its UTF-8 bytes, so that Python sees exactly what is stored."""
    return (F.col(text) if isinstance(text, str) else text).cast("binary")


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves this remainder."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus == remainder


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple | None]], schema: str, rows: int = 512) -> DataFrame:
    """Rows to rows through ``make()``, which builds one function per task; None drops a row.

    Results leave a task every ``rows`` rows, whatever the size of the batches that come in.
    """
    ship_package(df.sparkSession)
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        out: list[tuple] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                piece = batch.slice(lo, rows)
                out = [r for values in zip(*(c.to_pylist() for c in piece.columns)) if (r := row(*values)) is not None]
                if out:
                    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), target)]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    return df.mapInArrow(body, schema)


#: Rows that a broadcast of heavy groups may have, whatever the size of the input.
HEAVY = 10_000


def look_up(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group (inner join on ``keys``), without a hot key in one task.

    ``size`` counts a group's rows and ``total`` all rows, so at most ``HEAVY`` groups are larger than ``total / HEAVY``:
    these are broadcast, and the rest, where no group is larger than that share, is joined by shuffle.
    """
    share = total // HEAVY
    heavy, usual = groups.where(F.col(size) > share), groups.where(F.col(size) <= share)
    if share == 0:
        return rows.join(groups, keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(heavy), keys).unionByName(rest.join(usual, keys))
