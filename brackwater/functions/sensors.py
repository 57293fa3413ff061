"""The sensor dimension: missions, their collections, bands, scale and lifetime."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")


@dataclass(frozen=True)
class Mission:
    slug: str
    mission_id: int
    dataset_id: int
    collection: str
    scale_m: int
    start: dt.date
    end: dt.date | None
    gain: float
    offset: float
    native_bands: tuple[str, ...]
    cloud_field: str


# Public facts of the three missions.
MISSIONS = (
    Mission("sentinel-2", 0, 2, "COPERNICUS/S2_SR_HARMONIZED", 10, dt.date(2015, 6, 23), None, 0.0001, 0.0, ("B2", "B3", "B4", "B8", "B11", "B12"), "CLOUDY_PIXEL_PERCENTAGE"),
    Mission("landsat-5", 1, 0, "LANDSAT/LT05/C02/T1_L2", 30, dt.date(1984, 3, 1), dt.date(2013, 1, 1), 0.0000275, -0.2, ("SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"), "CLOUD_COVER"),
    Mission("landsat-7", 2, 1, "LANDSAT/LE07/C02/T1_L2", 30, dt.date(1999, 4, 15), dt.date(2022, 3, 31), 0.0000275, -0.2, ("SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"), "CLOUD_COVER"),
)
#: Sensors that records may name, more than there are missions.
KNOWN_SENSORS = ("sentinel-2", "landsat-5", "landsat-7", "landsat-8", "landsat-9")


def mission(key: str | int) -> Mission:
    """By slug or mission id; ValueError for an unknown one."""
    for m in MISSIONS:
        if key in (m.slug, m.mission_id):
            return m
    raise ValueError(f"unknown mission {key!r}; known: {[m.slug for m in MISSIONS]}")


def sensor_table(spark: SparkSession) -> DataFrame:
    rows = [(m.slug, m.mission_id, m.dataset_id, m.collection, m.scale_m, m.start, m.end, m.gain, m.offset, list(m.native_bands), m.cloud_field) for m in MISSIONS]
    schema = "sensor string, mission_id int, dataset_id int, collection string, scale_m int, valid_from date, valid_to date, gain double, offset double, native_bands array<string>, cloud_field string"
    return spark.createDataFrame(rows, schema)


def by_sensor(sensor: Column, attribute: str) -> Column:
    """A mission attribute as a literal map lookup; null for an unknown sensor."""
    pairs = [F.lit(x) for m in MISSIONS for x in (m.slug, getattr(m, attribute))]
    return F.try_element_at(F.create_map(*pairs), sensor)


def in_lifetime(sensor: Column, date: Column) -> Column:
    """Whether the mission flew on the date, both ends included; false for an unknown sensor."""
    flew = [(sensor == m.slug) & (date >= F.lit(m.start)) & (date <= F.lit(m.end) if m.end else F.lit(True)) for m in MISSIONS]
    return F.coalesce(reduce(lambda a, b: a | b, flew), F.lit(False))
