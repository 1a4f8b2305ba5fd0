"""Readers: message streams, image folders, video inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbwatch import schemas
from kerbwatch.functions import fields

IMAGES = "*.{jpg,jpeg,png}"
VIDEOS = "*.{mp4,avi,mkv,mov}"


def message_stream(spark: SparkSession, fmt: str = "kafka", schema: str | None = None, path: str | None = None,
                   **options) -> DataFrame:
    """Streaming source by format. Topics start at the newest message unless told otherwise."""
    if fmt == "kafka":
        options.setdefault("startingOffsets", "latest")
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode(messages: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and the rejected raw ones. Malformed text yields a row of nulls in the former."""
    text = F.col(column).cast("string")
    parsed = messages.select(F.from_json(text, schema).alias("data")).select("data.*")
    # an optional corrupt-record field tells malformed text from a message that only lacks fields
    flagged = messages.withColumn("_data", F.from_json(text, f"{schema}, _corrupt string",
                                                       {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_data").isNull() | F.col("_data._corrupt").isNotNull()
    return parsed, flagged.where(bad).drop("_data")


def frames_with_image(frames: DataFrame) -> DataFrame:
    """Frames whose payload can be decoded, as binary."""
    image = fields.frame_payload(F.col("image_base64"), F.col("frame"))
    return frames.withColumn("image", image).drop("image_base64", "frame").where(F.col("image").isNotNull())


def listing(spark: SparkSession, folder: str, pattern: str, recursive: bool = True) -> DataFrame:
    """File metadata only: the content column is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
            .option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime"))


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """All images below a folder; the camera is the parent folder's name."""
    files = listing(spark, folder, IMAGES)
    return files.select(fields.parent_name(F.col("path")).alias("camera_id"), F.col("path").alias("image_path"),
                        fields.base_name(F.col("path")).alias("filename")).orderBy("image_path")


def inventory(files: DataFrame) -> DataFrame:
    """Inventory rows from (path, length)."""
    path: Column = F.col("path")
    name = fields.stem(path)
    return files.select(name.alias("id"), fields.base_name(path).alias("filename"), "path",
                        F.round(F.col("length") / F.lit(1048576.0), 2).alias("size_mb"), name.alias("camera_id"))


def sorted_inventory(files: DataFrame) -> DataFrame:
    """Inventory by file name; equal names by path."""
    return inventory(files).orderBy("filename", "path")


def video_files(spark: SparkSession, folder: str) -> DataFrame:
    return sorted_inventory(listing(spark, folder, VIDEOS, recursive=False))


def messages_to_violations(messages: DataFrame) -> DataFrame:
    """Rows for the violations table from batch messages, with the defaults of missing fields."""
    m = messages.select(
        F.coalesce("camera_id", F.lit("unknown")).alias("camera_id"),
        fields.iso_timestamp(F.col("timestamp"), F.current_timestamp()).alias("detected_at"),
        F.coalesce("image_path", F.lit("")).alias("image_path"),
        F.explode(fields.violation_items(F.col("violations"))).alias("v"))

    def axis(i: int) -> Column:
        return F.coalesce(F.try_element_at("v.position", F.lit(i)), F.lit(0.0))

    return m.select("camera_id", F.coalesce("v.type", F.lit("unknown")).alias("violation_type"),
                    F.coalesce("v.vehicle", F.lit("unknown")).alias("vehicle_type"),
                    F.coalesce("v.confidence", F.lit(0.0)).alias("confidence"),
                    axis(1).alias("position_x"), axis(2).alias("position_y"), "image_path", "detected_at")


BATCH_SCHEMA = schemas.VIOLATION_BATCH
