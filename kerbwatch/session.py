"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a dimension may have before it stops being broadcast by hint.
BROADCAST_ROWS = 50_000


def build_session(name: str = "kerbwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # recording the call site of every column expression makes wide plans slow to build
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where every task sees the same disk, may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    return os.path.join(work_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = work_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, wherever the driver was started."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # not when the package itself was shipped as an archive
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        archive = shutil.make_archive(os.path.join(folder, "kerbwatch"), "zip", os.path.dirname(here), "kerbwatch")
        spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger table keeps the planner's own choice."""
    probe = df.select(F.lit(1).alias("one")).limit(max_rows + 1).count()
    return F.broadcast(df) if probe <= max_rows else df
