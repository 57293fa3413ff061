"""Stages that chain operators, and the registries of tasks and models.

A stage takes and returns frames; every scene is a group of rows, so there is no loop over files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DownloadConfig, SalinityConfig, TrendConfig
from ..functions.bands import classify_salinity, ndwi_mask, reflectance
from ..functions.sensors import BANDS, MISSIONS
from ..functions.text import processed_blob
from ..sources.readers import aoi_centroid
from ..sources.shared import written
from .metrics import image_qa
from .select import match_casts, pick_for_points, work_list
from .trend import trend_heatmap

Stage = Callable[[DataFrame], DataFrame]

#: Passing scenes beyond which pixels are shuffled to hashed scenes.
MANY = 250_000


def passing_scenes(pixels: DataFrame, scene: str = "scene_id") -> DataFrame:
    """Pixels of the scenes that pass the image checks.

    The scenes are written first, so no task holds their sums beside its pixels. Few of them are left to Spark's size check;
    of many, a task hashes its own, and pixels stream past instead of being sorted.
    """
    good = written(image_qa(pixels, scene, BANDS).where("passes").select(scene), "passing")
    return pixels.join(good.hint("shuffle_hash") if good.count() > MANY else good, scene, "left_semi")


def water_masks(pixels: DataFrame, threshold: float = 0.0) -> DataFrame:
    """scene_id, row, col and mask of the scenes that pass the checks."""
    return passing_scenes(pixels).select("scene_id", "row", "col", ndwi_mask(F.col("green"), F.col("nir"), F.col("sensor"), threshold).alias("mask"))


def stage_counts(pixels: DataFrame, results: DataFrame) -> DataFrame:
    """total, processed and skipped scenes."""
    done = results.select("scene_id").distinct().withColumn("_done", F.lit(1))
    return pixels.select("scene_id").distinct().join(done, "scene_id", "left").agg(F.count("*").alias("total"), F.count("_done").alias("processed"), (F.count("*") - F.count("_done")).alias("skipped"))


def salinity_maps(pixels: DataFrame, config: SalinityConfig = SalinityConfig()) -> DataFrame:
    """Scores and classes of the scenes that pass the checks, from digital numbers."""
    scaled = passing_scenes(pixels).withColumns({b: reflectance(F.col(b), F.col("sensor")) for b in BANDS})
    return classify_salinity(scaled, config.water_threshold, config.proxy_scale, config.proxy_threshold, config.chlorophyll_reference)


def download_plan(spark, config: DownloadConfig, meta: DataFrame) -> DataFrame:
    """The work list with the scene picked for each entry."""
    if config.geometry:
        lat, lon = aoi_centroid(spark, config.geometry)
        lats, lons = [lat], [lon]
    else:
        lats, lons = ([x] if isinstance(x, (int, float)) else list(x) for x in (config.latitude, config.longitude))
    work = work_list(spark, list(config.mission), lats, lons, str(config.start_date), str(config.end_date), config.step_days)
    points = work.withColumnRenamed("mission", "sensor").withColumn("point_id", F.xxhash64("sensor", "lat", "lon", "date"))
    return pick_for_points(points, meta, config.buffer_km, config.days_before, config.days_after, config.cloud_filter, config.samples)


def output_paths(results: DataFrame, task: str, name: str) -> DataFrame:
    """scene_id and the path that its product goes to."""
    return results.select("scene_id").distinct().withColumn("path", processed_blob(F.col("scene_id"), F.lit(task), F.lit(name)))


def workflow(pixels: DataFrame, casts: DataFrame, meta: DataFrame, masks: DataFrame, salinity: SalinityConfig = SalinityConfig(), trend: TrendConfig = TrendConfig()) -> dict[str, DataFrame]:
    """All stages after the download, by name (C17)."""
    return {
        "matches": match_casts(casts, meta, buffer_m=salinity.cluster_buffer_m),
        "salinity": salinity_maps(pixels, salinity),
        "masks": water_masks(pixels),
        "trend": trend_heatmap(masks, ["row", "col"], trend.class_value, trend.alpha),
    }


#: Tasks by name, as runs and events name them.
TASKS: dict[str, Stage] = {"water_mask": water_masks}
#: Pixel models by name (U2). Neural ones plug in through predict_scenes.
MODELS: dict[str, Stage] = {"salinity_heuristic": classify_salinity}


def register_task(name: str, stage: Stage) -> None:
    TASKS[name] = stage


def model(name: str) -> Stage:
    """ValueError for an unknown model."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; known: {sorted(MODELS)}")
    return MODELS[name]


def predict_scenes(pixels: DataFrame, predict: Callable, schema: str, columns: list[str]) -> DataFrame:
    """Predictions of any model over batches of pixels (B23, U4, U6): predict maps a pandas frame of the columns to one of the schema."""

    def batches(frames: Iterator) -> Iterator:
        for frame in frames:
            yield predict(frame)

    return pixels.select(*columns).mapInPandas(batches, schema)


def channel_ids(sensor_order: tuple[str, ...] = tuple(m.slug for m in MISSIONS)) -> dict[str, list[int]]:
    """Channel numbers of each mission's bands, missions one after another."""
    return {slug: [i * len(BANDS) + k for k in range(len(BANDS))] for i, slug in enumerate(sensor_order)}


def channels_of(sensor: Column) -> Column:
    """channel_ids() of a sensor column; null for an unknown sensor."""
    ids = channel_ids()
    return F.coalesce(*[F.when(sensor == slug, F.array(*[F.lit(i) for i in own])) for slug, own in ids.items()])
