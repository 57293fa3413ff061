"""Catalog queries over scenes, casts and runs.

Filters are plain comparisons of columns, so they reach the Parquet scan. Postgres' order of nulls is kept:
descending puts nulls first.
"""

from __future__ import annotations

import datetime as dt
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import MOST_CURVED, Box, box_around, boxes_meet, geodesic_to_box, km_to_box, nearest_in_box, with_geodesic
from ..functions.text import contains_json
from ..sources.shared import written
from .cells import PAIRS, levels_down_to, met_in_cells

Date = dt.date | str


def anchor_box(bbox: Box | str | None, lat: float | None, lon: float | None, radius_km: float | None) -> Box:
    """The box of a spatial request: bbox, also as 'a,b,c,d', wins over a point with a radius; ValueError for neither (P10)."""
    if bbox:
        parts = [float(x) for x in bbox.split(",")] if isinstance(bbox, str) else [float(x) for x in bbox]
        if len(parts) != 4:
            raise ValueError("bbox needs four numbers: minx,miny,maxx,maxy")
        return tuple(parts)
    if lat is None or lon is None or radius_km is None:
        raise ValueError("give bbox, or lat, lon and radius_km")
    return box_around(lat, lon, radius_km)


def _all(conditions: list[Column | None]) -> Column:
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def scenes_in_box(scenes: DataFrame, bbox: Box) -> DataFrame:
    """Active scenes that meet a box."""
    return scenes.where((F.col("status") == "active") & boxes_meet(bbox))


def find_scenes(
    scenes: DataFrame, bbox: Box | str | None = None, lat: float | None = None, lon: float | None = None, radius_km: float | None = None,
    sensor: str | None = None, date_from: Date | None = None, date_to: Date | None = None, status: str | None = "active",
) -> DataFrame:
    """Scenes by place and optional filters, newest first (P2). Empty filters don't filter; dates are inclusive."""
    day = F.col("acquisition_date")
    found = scenes.where(
        _all([
            boxes_meet(anchor_box(bbox, lat, lon, radius_km)),
            F.col("sensor") == sensor if sensor else None,
            day >= F.lit(date_from).cast("date") if date_from else None,
            day <= F.lit(date_to).cast("date") if date_to else None,
            F.col("status") == status if status else None,
        ])
    )
    return found.orderBy(F.desc_nulls_first("acquisition_date"), "scene_id")


def find_casts(
    casts: DataFrame, bbox: Box | str | None = None, lat: float | None = None, lon: float | None = None, radius_km: float | None = None,
    date_from: Date | None = None, date_to: Date | None = None, min_salinity: float | None = None, max_salinity: float | None = None,
) -> DataFrame:
    """Casts by place and optional filters, newest first (P4). 0 is a bound; None is none."""
    box, day, salinity = anchor_box(bbox, lat, lon, radius_km), F.col("sample_date"), F.col("surface_salinity")
    found = casts.where(
        _all([
            F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]),
            day >= F.lit(date_from).cast("date") if date_from else None,
            day <= F.lit(date_to).cast("date") if date_to else None,
            salinity >= min_salinity if min_salinity is not None else None,
            salinity <= max_salinity if max_salinity is not None else None,
        ])
    )
    return found.orderBy(F.desc_nulls_first("sample_date"), "cast_id")


def by_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """The row of a key, or none (P5)."""
    return table.where(F.col(key) == value).limit(1)


def exists(scenes: DataFrame, scene_id: str) -> bool:
    """Whether an active scene has this id."""
    return not scenes.where((F.col("scene_id") == scene_id) & (F.col("status") == "active")).limit(1).isEmpty()


def scene_products(products: DataFrame, scene_id: str) -> DataFrame:
    """Runs of a scene, latest start first."""
    return products.where(F.col("base_scene_id") == scene_id).orderBy(F.desc_nulls_first("started_at"), "product_id")


def depth_profile(levels: DataFrame, cast: str) -> DataFrame:
    """Levels of a cast from the surface down."""
    return levels.where(F.col("cast_id") == cast).orderBy("depth_m")


def find_runs(products: DataFrame, task: str | None = None, status: str | None = None) -> DataFrame:
    """Runs by optional task and status, latest start first."""
    found = products.where(_all([F.col("task") == task if task else None, F.col("status") == status if status else None]))
    return found.orderBy(F.desc_nulls_first("started_at"), "product_id")


def scenes_with_products(scenes: DataFrame, products: DataFrame) -> DataFrame:
    """Scenes with their runs."""
    return scenes.join(products, scenes.scene_id == products.base_scene_id)


def _km(place: list[Column], radius_km: float, ellipsoid: bool) -> Column:
    """Distance of a point to a box, null beyond the radius. Along the ellipsoid, the sphere only sets aside what is too far by its proved bound."""
    sphere = km_to_box(*place)
    if not ellipsoid:
        return F.when(sphere <= radius_km, sphere)
    exact = F.when(_may_reach(sphere, radius_km), geodesic_to_box(*place))
    return F.when(exact <= radius_km, exact)


def _may_reach(sphere: Column, radius_km: float) -> Column:
    """Whether a distance along the ellipsoid can be within the radius, by the one on the sphere."""
    return sphere <= radius_km / MOST_CURVED * (1 + 1e-9)


#: Values that one list may hold, about.
LIST = 4_096
#: Hashes by which rows are counted to find long groups.
HASHES = 1 << 20


def _listed(rows: DataFrame, keys: list[str], value: str, kind: str, most: int = LIST) -> DataFrame:
    """keys and <value>s: one row for the rows of equal keys, with the list of their values, nulls included; several rows where they are many.

    Counts by a hash of the keys say where; a short group that shares its hash with a long one is dealt like it, which does no harm.
    Rows are shuffled as they are, once.
    """
    hashed = F.pmod(F.xxhash64(*keys), F.lit(HASHES))
    crowded = rows.groupBy(hashed.alias("_hash")).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    crowded = written(crowded.select("_hash", F.ceil(F.col("_n") / most).alias("_parts")), "crowded")
    on = keys
    if not crowded.isEmpty():
        rows = rows.withColumn("_hash", hashed).join(crowded, "_hash", "left").withColumn("_part", F.pmod(F.xxhash64(value), F.coalesce("_parts", F.lit(1))))
        on = [*keys, "_part"]
    dealt = rows.select(*on, value).repartition(*on)
    values = F.collect_list(value)  # without nulls
    nulls = F.array_repeat(F.lit(None).cast(rows.schema[value].dataType), (F.count("*") - F.size(values)).cast("int"))
    return written(dealt.groupBy(*on).agg(F.concat(values, nulls).alias(f"{value}s")).drop("_part"), kind)


def scenes_near_casts(
    scenes: DataFrame, casts: DataFrame, radius_km: float = 50.0, days: int = 30, cell_deg: float = 1.0, ellipsoid: bool = True, pairs: int = PAIRS, digits: int | None = None, most: int = LIST,
) -> DataFrame:
    """Active scenes within a distance, along the ellipsoid or a sphere, and so many days of each cast.

    Scenes go to every grid cell and month their box, grown by the radius, and their date, widened by the
    days, touch; casts go to their own. The equi-join on cell and month replaces a nested loop, and both
    sides shuffle by it; the exact distance and dates decide what is left. A cast has one cell and month,
    so a pair comes up once. A cell and month with more than so many pairs, as on a coast that everybody samples,
    is split (operators.cells). Casts of one place and date are one row with the list of their ids, of `most` or so, and so are scenes of one
    box and date: a place and a box are compared once, and the lists that met are paired where they met. So what is shuffled or written
    grows with casts and scenes, not with the pairs, which are the result and may grow with the product of both.
    digits rounds distances, before the lists are paired.
    Returns cast_id, scene_id, sensor, acquisition_date, distance_km.
    """
    reach_y = radius_km / 110.0
    farthest = F.least(F.greatest(F.abs("miny"), F.abs("maxy")) + reach_y, F.lit(89.0))
    reach_x = F.lit(radius_km / 110.0) / F.cos(F.radians(farthest))
    cast, box = ["lon", "lat"], ["minx", "miny", "maxx", "maxy"]

    def month(day: Column) -> Column:
        return F.year(day) * 12 + F.month(day)

    active = scenes.where(F.col("status") == "active")
    spread = _listed(active, ["acquisition_date", "sensor", *box], "scene_id", "boxes", most)
    spread = spread.withColumn("cm", F.explode(F.sequence(month(F.date_sub("acquisition_date", days)), month(F.date_add("acquisition_date", days)))))
    own = _listed(casts, ["sample_date", *cast], "cast_id", "places", most).withColumn("cm", month(F.col("sample_date")))
    extent = (F.col("minx") - reach_x, F.col("miny") - reach_y, F.col("maxx") + reach_x, F.col("maxy") + reach_y)
    met = met_in_cells(own, spread, ["cm"], (F.col("lon"), F.col("lat")), extent, cell_deg, levels_down_to(cell_deg, radius_km / 110.0), pairs)
    near = met.where(F.abs(F.date_diff("acquisition_date", "sample_date")) <= days)
    ends = [F.col(c) for c in (*cast, *box)]
    if ellipsoid:
        near = near.where(_may_reach(km_to_box(*ends), radius_km)).select("cast_ids", "scene_ids", "sensor", "acquisition_date", *cast, *box)
        near = with_geodesic(near, "distance_km", *ends[:2], *nearest_in_box(*ends)).where(F.col("distance_km") <= radius_km)
    else:
        near = near.withColumn("distance_km", _km(ends, radius_km, ellipsoid)).where(F.col("distance_km").isNotNull())
    distance = F.col("distance_km") if digits is None else F.round("distance_km", digits).alias("distance_km")
    found = near.select("cast_ids", "scene_ids", "sensor", "acquisition_date", distance)
    return found.withColumn("cast_id", F.explode("cast_ids")).select("cast_id", F.explode("scene_ids").alias("scene_id"), "sensor", "acquisition_date", "distance_km")


def scenes_near_cast(scenes: DataFrame, casts: DataFrame, cast: str, radius_km: float = 50.0, days: int = 30, ellipsoid: bool = True) -> DataFrame:
    """J1 for one cast, by date. The cast is looked up first, so that its box and dates are constants that reach the scan of scenes."""
    out = ("scene_id", "sensor", "acquisition_date", "minx", "miny", "maxx", "maxy")
    row = casts.where(F.col("cast_id") == cast).select("sample_date", "lon", "lat").first()
    if row is None or None in tuple(row):  # Row.__contains__ asks for names
        return scenes.where(F.lit(False)).select(F.lit(cast).alias("cast_id"), *out[:3], F.lit(0.0).alias("distance_km"))
    reach = radius_km / 110.0
    wide = reach / max(math.cos(math.radians(min(abs(row["lat"]) + reach, 89.0))), 0.01)
    box = (row["lon"] - wide, row["lat"] - reach, row["lon"] + wide, row["lat"] + reach)
    dates = F.col("acquisition_date").between(row["sample_date"] - dt.timedelta(days), row["sample_date"] + dt.timedelta(days))
    near = scenes.where((F.col("status") == "active") & dates & boxes_meet(box))
    distance = _km([F.lit(row["lon"]), F.lit(row["lat"]), *[F.col(c) for c in out[3:]]], radius_km, ellipsoid)
    found = near.select(F.lit(cast).alias("cast_id"), *out[:3], distance.alias("distance_km")).where(F.col("distance_km").isNotNull())
    return found.orderBy("acquisition_date", "scene_id")


def unprocessed_scenes(scenes: DataFrame, products: DataFrame, task: str, parameters: dict | None = None) -> DataFrame:
    """Active scenes without a complete run of a task whose parameters contain the given ones."""
    done = products.where((F.col("task") == task) & (F.col("status") == "complete") & contains_json(F.col("parameters"), parameters or {}))
    active = scenes.where(F.col("status") == "active")
    return active.join(done.select(F.col("base_scene_id").alias("scene_id")), "scene_id", "left_anti")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent (J11). A null key is no reference."""
    keys = parent.select(F.col(parent_key).alias("_key"))
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_key"), "left_anti")


def repeated_keys(table: DataFrame, key: str) -> DataFrame:
    """Keys that are not unique, with their counts."""
    return table.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
