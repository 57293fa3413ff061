"""Sinks (SNK10-SNK17): Parquet by scene, CSV, JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raster(df: DataFrame, path: str, mode: str = "append") -> None:
    """Pixel columns in ranges of scene and row, in order (SNK10, SNK11, SNK17): a scene is a run of row groups that a filter on scene_id finds by their bounds, and a large one has several tasks."""
    df.repartitionByRange("scene_id", "row").sortWithinPartitions("scene_id", "row", "col").write.mode(mode).parquet(path)


def csv_once(df: DataFrame, path: str) -> None:
    """CSV with a header; nothing happens if the path has one (SNK12)."""
    df.write.mode("ignore").option("header", "true").csv(path)


def matches_csv(df: DataFrame, path: str) -> None:
    """Matches with their list of missions as text; ValueError afterwards if there are none (SNK13)."""
    out = df.withColumn("covered_by", F.concat_ws(",", "covered_by"))
    out.write.mode("overwrite").option("header", "true").csv(path)
    if df.limit(1).isEmpty():
        raise ValueError("no cast has imagery")


def messages(scenes: DataFrame, path: str) -> None:
    """New-scene messages as JSON lines in the form that the stream reads (SNK15)."""
    body = F.to_json(F.struct("scene_id", "sensor", F.col("acquisition_date").cast("string").alias("acquisition_date")))
    data = F.struct(F.base64(body.cast("binary")).alias("data"), F.md5(body).alias("messageId"))
    scenes.select(data.alias("message"), F.lit("scenes").alias("subscription")).write.mode("append").json(path)


def previews(stretched: DataFrame, path: str) -> None:
    """The 8-bit table that a preview image is drawn from (SNK14); encoding images is left to other tools."""
    stretched.write.mode("overwrite").parquet(path)
