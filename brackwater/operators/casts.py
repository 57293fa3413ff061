"""In-situ casts: profiles with level arrays, and their surface values (SRC7, SRC8, W3, W7, A14, R2, S8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cast_id, iso_date

#: Places in a profile's record of its numbers: year, month, day, latitude, longitude.
INFO = {"year": 1, "month": 2, "day": 3, "lat": 4, "lon": 5}


def _info(name: str) -> Column:
    return F.get("info", F.lit(INFO[name]))


def truth_from_profiles(profiles: DataFrame, depth: float = 1.0, limit: int | None = None) -> DataFrame:
    """Surface salinity of profiles (source_file, prof_idx, info, depth, salinity, temperature as arrays).

    The first level no deeper than `depth` counts; profiles without one, or with NaN or no salinity there, are left
    out. limit takes the first profiles of each file. Returns cast_id, salinity, latitude, longitude, date (text,
    null for year 0 or less), max_depth (NaN ignored) and source_file.
    """
    rows = profiles if limit is None else profiles.where(F.col("prof_idx") < limit)
    level = F.array_position(F.transform("depth", lambda x: F.coalesce(x <= depth, F.lit(False)) & ~F.isnan(x)), F.lit(True))
    surface = F.get("salinity", (level - 1).cast("int"))
    deepest = F.array_max(F.filter("depth", lambda x: ~F.isnan(x)))
    stem = F.regexp_replace("source_file", r"\.[^.]*$", "")
    out = rows.select(
        cast_id(stem, F.col("prof_idx")).alias("cast_id"), F.when(level > 0, surface).alias("salinity"), _info("lat").alias("latitude"), _info("lon").alias("longitude"),
        iso_date(_info("year"), _info("month"), _info("day")).alias("date"), deepest.alias("max_depth"), "source_file",
    )
    return out.where(F.col("salinity").isNotNull() & ~F.isnan("salinity"))


def profile_levels(profiles: DataFrame) -> DataFrame:
    """A row per level of profiles, with its place from 0."""
    stem = F.regexp_replace("source_file", r"\.[^.]*$", "")
    zipped = profiles.select(cast_id(stem, F.col("prof_idx")).alias("cast_id"), F.posexplode(F.arrays_zip("depth", "salinity", "temperature")).alias("level", "v"))
    return zipped.select("cast_id", "level", F.col("v.depth").alias("depth_m"), F.col("v.salinity").alias("salinity"), F.col("v.temperature").alias("temperature"))


def surface_levels(levels: DataFrame, keys: list[str], depth: float = 1.0) -> DataFrame:
    """keys, surface_salinity (of the first level no deeper than depth) and max_depth, from level rows; keys without such a level are left out. Of levels with one number the shallowest counts, then the one with the least salinity."""
    shallow = F.col("depth_m") <= depth
    out = levels.groupBy(*keys).agg(
        F.min_by("salinity", F.when(shallow, F.struct("level", "depth_m", F.col("salinity").isNull().alias("without"), "salinity"))).alias("surface_salinity"),
        F.max(F.when(~F.isnan("depth_m"), F.col("depth_m"))).alias("max_depth"), F.bool_or(shallow).alias("_any"),
    )
    return out.where("_any").drop("_any")
