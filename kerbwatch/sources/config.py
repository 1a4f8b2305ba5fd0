"""Per-camera geometry: loading, lookup with a default, scaling and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kerbwatch import schemas
from kerbwatch.session import broadcast_checked

# What a missing entry means.
BASE_WIDTH, BASE_HEIGHT = 1920, 1080
STOP_Y, TOLERANCE, DIRECTION = 400, 30, "below"
CROSSING_THRESHOLD = 30
REGION_EDGE = 100


def parse_config(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text (camera -> settings) to one row per camera.

    Both stop-line encodings are accepted: an object with ``y``, or two points whose first gives the
    height; likewise the light region as an object or as ``[x1, y1, x2, y2]``. Entries that are not
    objects (comments) are dropped.
    """
    entries = raw.select(F.explode(F.from_json(column, "map<string,string>")).alias("camera_id", "body"))
    entries = entries.where(F.startswith(F.ltrim("body"), F.lit("{")))
    e = entries.select("camera_id", F.from_json("body", schemas.CAMERA_ENTRY).alias("e")).select("camera_id", "e.*")

    is_list = F.startswith(F.ltrim("stop_line"), F.lit("["))
    line = F.from_json("stop_line", schemas.STOP_LINE)
    points = F.when(is_list, F.from_json("stop_line", "array<array<int>>"))
    region_list = F.startswith(F.ltrim("traffic_light_roi"), F.lit("["))
    region = F.from_json("traffic_light_roi", schemas.LIGHT_REGION)
    flat = F.when(region_list, F.from_json("traffic_light_roi", "array<int>"))

    def edge(i: int, name: str, default: int) -> Column:
        value = F.coalesce(F.get(flat, F.lit(i)), F.when(~region_list, region.getField(name)))
        return F.when(F.col("traffic_light_roi").isNotNull(), F.coalesce(value, F.lit(default)))

    has_line = F.col("stop_line").isNotNull()
    return e.select(
        "camera_id",
        F.coalesce("frame_width", F.lit(BASE_WIDTH)).alias("frame_width"),
        F.coalesce("frame_height", F.lit(BASE_HEIGHT)).alias("frame_height"),
        F.when(has_line, F.coalesce(F.get(F.get(points, F.lit(0)), F.lit(1)), F.when(~is_list, line.getField("y")),
                                    F.lit(STOP_Y))).alias("stop_y"),
        F.when(has_line, F.coalesce(F.when(~is_list, line.getField("tolerance")), F.lit(TOLERANCE))).alias("tolerance"),
        F.when(has_line, F.coalesce(F.when(~is_list, line.getField("violation_direction")), F.lit(DIRECTION)))
        .alias("direction"),
        edge(0, "x1", 0).alias("light_x1"),
        edge(1, "y1", 0).alias("light_y1"),
        edge(2, "x2", REGION_EDGE).alias("light_x2"),
        edge(3, "y2", REGION_EDGE).alias("light_y2"),
        F.coalesce("detection_zone", F.array().cast("array<array<int>>")).alias("zone"),
        "color_detection",
        F.coalesce(F.transform("lane_lines", _line_defaults), F.array().cast(schemas.LANE_LINES)).alias("lane_lines"),
        F.coalesce("lane_crossing_threshold", F.lit(CROSSING_THRESHOLD)).alias("crossing_threshold"),
    )


def _line_defaults(line: Column) -> Column:
    ends = [F.coalesce(line.getField(n), F.lit(0)).alias(n) for n in ("x1", "y1", "x2", "y2")]
    return F.struct(*ends, F.coalesce(line.getField("type"), F.lit("solid")).alias("type"))


def config_from_text(spark: SparkSession, text: str) -> DataFrame:
    return parse_config(spark.range(1).select(F.lit(text).alias("value")))


def load_config(spark: SparkSession, path: str | None = None, fallback: str | None = None) -> DataFrame:
    """First readable file wins; with none the configuration is empty."""
    for candidate in (path, fallback):
        if not candidate:
            continue
        try:
            return parse_config(spark.read.text(candidate, wholetext=True))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    return config_from_text(spark, "{}")


def scale_config(cfg: DataFrame, width: Column | int, height: Column | int) -> DataFrame:
    """Fit the geometry to the real frame size; every coordinate is truncated towards zero.

    Applied to the configuration, before it is joined, the work is done once per camera.
    """
    width = F.lit(width) if isinstance(width, int) else width
    height = F.lit(height) if isinstance(height, int) else height
    fx = width.cast("double") / F.col("frame_width")
    fy = height.cast("double") / F.col("frame_height")

    def on_x(value: Column) -> Column:
        return (value * fx).cast("int")

    def on_y(value: Column) -> Column:
        return (value * fy).cast("int")

    def line(ln: Column) -> Column:
        return F.struct(
            on_x(ln.getField("x1")).alias("x1"), on_y(ln.getField("y1")).alias("y1"),
            on_x(ln.getField("x2")).alias("x2"), on_y(ln.getField("y2")).alias("y2"),
            ln.getField("type").alias("type"),
        )

    return cfg.withColumns({
        "stop_y": on_y(F.col("stop_y")),
        "light_x1": on_x(F.col("light_x1")), "light_y1": on_y(F.col("light_y1")),
        "light_x2": on_x(F.col("light_x2")), "light_y2": on_y(F.col("light_y2")),
        "zone": F.transform("zone", lambda p: F.array(on_x(F.get(p, F.lit(0))), on_y(F.get(p, F.lit(1))))),
        "lane_lines": F.transform("lane_lines", line),
    })


def with_config(df: DataFrame, cfg: DataFrame, default_key: str = "default") -> DataFrame:
    """Attach each row's camera settings; cameras without an entry take the default one.

    Two left equi-joins against the (size-checked) configuration: the first only asks whether the
    camera is known, the second fetches the settings under the resulting key.
    """
    known = broadcast_checked(cfg.select(F.col("camera_id").alias("_known")))
    settings = broadcast_checked(cfg.withColumnRenamed("camera_id", "_key"))
    key = F.coalesce(F.col("_known"), F.lit(default_key))
    return (df.join(known, F.col("camera_id") == F.col("_known"), "left")
            .withColumn("_want", key).drop("_known")
            .join(settings, F.col("_want") == F.col("_key"), "left")
            .drop("_want", "_key"))


def with_own_config(df: DataFrame, cfg: DataFrame) -> DataFrame:
    """Camera gate and lookup in one: rows of cameras without an entry are dropped."""
    return df.join(broadcast_checked(cfg), "camera_id")


def configured(df: DataFrame, cfg: DataFrame) -> DataFrame:
    """Keep rows of cameras that have an entry (the red-light gate)."""
    return df.join(broadcast_checked(cfg.select("camera_id")), "camera_id", "left_semi")


def lane_configured(df: DataFrame, cfg: DataFrame, default_key: str = "default") -> DataFrame:
    """Keep rows of cameras whose settings (own or default) have lane lines."""
    lines = cfg.select("camera_id", "lane_lines")
    return with_config(df, lines, default_key).where(F.size("lane_lines") > 0).drop("lane_lines")


def most_lines(cfg: DataFrame) -> int:
    return cfg.agg(F.coalesce(F.max(F.size("lane_lines")), F.lit(0))).first()[0]


EDGE_PARTS = ("x1", "y1", "dx", "dy", "low", "high", "reach")
LINE_PARTS = ("x1", "y1", "dx", "dy", "len2", "type")


def flat_zone(cfg: DataFrame) -> tuple[DataFrame, list[str]]:
    """Zone edges as columns (start, extent, height range, right end) plus ``corners``; and the edge names.

    Done on the configuration side of the join: rows meet a few plain attributes instead of arrays, which
    keeps the generated code of the test small enough to be compiled.
    """
    n = cfg.agg(F.coalesce(F.max(F.size("zone")), F.lit(0))).first()[0]
    names, columns = [f"edge{i}" for i in range(n)], {"corners": F.size("zone")}
    for i, name in enumerate(names):
        nxt = F.when(F.lit(i + 1) >= F.size("zone"), F.lit(0)).otherwise(F.lit(i + 1))
        ends = [F.get(F.when(F.lit(i) < F.size("zone"), F.get("zone", at)), F.lit(axis)).cast("double")
                for at in (F.lit(i), nxt) for axis in (0, 1)]
        x1, y1, x2, y2 = ends
        parts = (x1, y1, x2 - x1, y2 - y1, F.least(y1, y2), F.greatest(y1, y2), F.greatest(x1, x2))
        columns.update({f"{name}_{p}": c for p, c in zip(EDGE_PARTS, parts)})
    return cfg.withColumns(columns).drop("zone"), names


def flat_lines(cfg: DataFrame) -> tuple[DataFrame, list[str]]:
    """Lane lines as columns (start, extent, squared length, type) plus ``n_lines``; and the line names."""
    names, columns = [f"line{i}" for i in range(most_lines(cfg))], {"n_lines": F.size("lane_lines")}
    for i, name in enumerate(names):
        line = F.get("lane_lines", F.lit(i))
        x1, y1, x2, y2 = (line.getField(p).cast("double") for p in ("x1", "y1", "x2", "y2"))
        dx, dy = x2 - x1, y2 - y1
        parts = (x1, y1, dx, dy, dx * dx + dy * dy, line.getField("type"))
        columns.update({f"{name}_{p}": c for p, c in zip(LINE_PARTS, parts)})
    return cfg.withColumns(columns).drop("lane_lines"), names


def put_camera(cfg: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace or add whole camera entries."""
    kept = cfg.join(rows.select("camera_id"), "camera_id", "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)
