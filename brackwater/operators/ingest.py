"""Ingest as replay of append-only logs, and record validation (SNK1-SNK9, P12).

A row store would update in place; here every event is a row, and the current state is a grouped
replay of the log, which needs one shuffle by key and no merge.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import wkt_points
from ..functions.sensors import KNOWN_SENSORS
from ..functions.text import date_from_name, mission_from_path, scene_id_from_path


@dataclass(frozen=True)
class StudyArea:
    """Bounds that records must lie in."""

    min_lon: float = -77.5
    max_lon: float = -74.5
    min_lat: float = 37.5
    max_lat: float = 40.0


def replay_scenes(log: DataFrame, order: str = "seq") -> DataFrame:
    """Current scenes of a log of upserts (SNK1).

    The first insert sets place, date, sensor, bands and crs; the last one files, hash and ingest time;
    the version grows by one at every hash that differs from the one before (a null on either side doesn't count).
    """
    w = Window.partitionBy("scene_id").orderBy(order)
    before = F.lag("file_hash").over(w)
    changed = log.withColumn("_changed", F.coalesce((before != F.col("file_hash")).cast("int"), F.lit(0)))
    first = ("sensor", "acquisition_date", "band_count", "crs", "minx", "miny", "maxx", "maxy")
    last = ("file_locations", "file_hash", "ingest_timestamp")
    kept = [F.min_by(c, order).alias(c) for c in first if c in log.columns] + [F.max_by(c, order).alias(c) for c in last if c in log.columns]
    return changed.groupBy("scene_id").agg(*kept, F.lit("active").alias("status"), (F.sum("_changed") + 1).alias("version_no"))


def insert_new(batch: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a batch whose key is new, the first of each key (SNK2, SNK4, SNK6)."""
    first = batch.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
    return first.join(existing.select(key), key, "left_anti")


def depth_rows(casts: DataFrame) -> DataFrame:
    """Levels of casts that hold arrays depths, salinities and temperatures (or null): a row each, one per cast and level (SNK3, R1)."""
    missing = F.transform("depths", lambda _: F.lit(None).cast("double"))
    rows = casts.select("cast_id", F.arrays_zip("depths", "salinities", F.coalesce("temperatures", missing).alias("temperatures")).alias("levels"))
    rows = rows.select("cast_id", F.posexplode("levels").alias("level", "v"))
    named = [F.col(f"v.{n}").alias(a) for n, a in (("depths", "depth_m"), ("salinities", "salinity"), ("temperatures", "temperature"))]
    return rows.select("cast_id", "level", *named).dropDuplicates(["cast_id", "level"])


def replay_runs(log: DataFrame, order: str = "seq") -> DataFrame:
    """Current runs of a log of (product_id, base_scene_id, task, parameters, status, at, output_paths, error_message) events (SNK4, SNK5).

    The first event registers the run; each later one overwrites status, outputs and error, nulls included,
    and sets completed_at if the status is complete or failed, else clears it.
    """
    event = F.struct(F.col(order), "status", "at", "output_paths", "error_message")
    states = log.groupBy("product_id").agg(
        F.min_by("base_scene_id", order).alias("base_scene_id"), F.min_by("task", order).alias("task"),
        F.min_by("parameters", order).alias("parameters"), F.min_by("at", order).alias("started_at"), F.max(event).alias("e"),
    )
    done = F.when(F.col("e.status").isin("complete", "failed"), F.col("e.at"))
    return states.select("product_id", "base_scene_id", "task", "parameters", "started_at", F.col("e.status").alias("status"), done.alias("completed_at"), F.col("e.output_paths").alias("output_paths"), F.col("e.error_message").alias("error_message"))


def reconcile(scenes: DataFrame, listing: DataFrame) -> DataFrame:
    """Scenes with status 'missing' where no file location is in the listing (column path) (SNK7)."""
    places = scenes.select("scene_id", F.explode("file_locations").alias("path"))
    found = places.join(listing.select("path").distinct(), "path", "left_semi").select("scene_id").distinct().withColumn("_found", F.lit(True))
    status = F.when((F.col("status") == "active") & F.col("_found").isNull(), "missing").otherwise(F.col("status"))
    return scenes.join(found, "scene_id", "left").withColumn("status", status).drop("_found")


def scenes_of_files(files: DataFrame) -> DataFrame:
    """Scene, mission and date of mosaic files (columns path and, for content hashes, content) (SNK8, A18). Names that don't parse are skipped."""
    rows = files.select("path", scene_id_from_path(F.col("path")).alias("scene_id"), mission_from_path(F.col("path")).alias("sensor"), date_from_name(F.col("path")).alias("acquisition_date"),
                        *[F.md5("content").alias("file_hash")] * ("content" in files.columns))
    return rows.where("scene_id is not null and sensor is not null and acquisition_date is not null")


def violations(area: StudyArea = StudyArea(), today: dt.date | None = None, wkt: str = "location") -> Column:
    """array<string> of the rules that a scene record breaks (P12); empty if none.

    Longitudes and latitudes of the footprint must lie in the study area; the sensor is known in any case.
    """
    day = F.lit(today) if today else F.current_date()
    points = wkt_points(F.col(wkt))
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(F.col("scene_id").rlike(r"\d{8}|\d{4}-\d{2}-\d{2}"), F.lit(False)), "scene_id"),
            F.when(F.coalesce(F.col("acquisition_date") > day, F.lit(True)), "acquisition_date"),
            F.when(F.coalesce(F.col("band_count") <= 0, F.lit(True)), "band_count"),
            F.when(F.coalesce(F.size("file_locations") <= 0, F.lit(True)), "file_locations"),
            F.when(~F.coalesce(F.lower("sensor").isin(*KNOWN_SENSORS), F.lit(False)), "sensor"),
            F.when(F.exists(points, lambda p: ~p["x"].between(area.min_lon, area.max_lon)), "longitude"),
            F.when(F.exists(points, lambda p: ~p["y"].between(area.min_lat, area.max_lat)), "latitude"),
        )
    )
