"""Sources (SRC1-SRC16): Parquet tables, files by name, casts, CSV, GeoJSON, listings and TOML."""

from __future__ import annotations

import tomllib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schemas of the domain tables on disk.
SCHEMAS = {
    "scenes": "scene_id string, sensor string, acquisition_date date, band_count int, crs string, status string, file_locations array<string>, ingest_timestamp timestamp, version_no bigint, file_hash string, minx double, miny double, maxx double, maxy double",
    "casts": "cast_id string, sample_date date, surface_salinity double, max_depth double, source_file string, ingested_at timestamp, lon double, lat double",
    "levels": "cast_id string, level int, depth_m double, salinity double, temperature double",
    "task_types": "task string, description string",
    "runs": "product_id string, base_scene_id string, task string, status string, started_at timestamp, completed_at timestamp, output_paths array<string>, error_message string, parameters string",
    "pixels": "scene_id string, row int, col int, blue float, green float, red float, nir float, swir1 float, swir2 float",
    "profiles": "source_file string, prof_idx int, info array<double>, depth array<double>, salinity array<double>, temperature array<double>",
    "truth": "salinity double, latitude double, longitude double, date string, source_file string",
}
#: Name parts that mark a mosaic as something else, by stage.
EXCLUDED = {"masks": ("mask",), "salinity": ("salinity", "mask"), "training": ("aligned_cdl_", "mask", "salinity")}


def table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A domain table at a path (SRC1, SRC2, SRC7)."""
    return spark.read.schema(SCHEMAS[kind]).parquet(path)


def files(spark: SparkSession, root: str, pattern: str = "*_multiband.tif", without: tuple[str, ...] = (), content: bool = False) -> DataFrame:
    """Files below a folder whose name fits a pattern and holds none of the words, in order of paths (SRC5). Contents are read only if asked for."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    for word in without:
        found = found.where(~name.contains(word))
    return found.select("path", "modificationTime", "length", *["content"] * content).orderBy("path")


def masks(spark: SparkSession, root: str, name_contains: list[str]) -> DataFrame:
    """Mask files whose name holds any of the words, in any case (SRC6)."""
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    wanted = reduce(lambda a, b: a | b, [name.contains(w.lower()) for w in name_contains], F.lit(False))
    return files(spark, root, "*.tif").where(wanted)


def center_window(pixels: DataFrame, height: int, width: int, size: int) -> DataFrame:
    """Pixels of the centred window: bounds on row and col, which reach the scan (SRC3)."""
    top, left = (height - size) // 2, (width - size) // 2
    return pixels.where(F.col("row").between(top, top + size - 1) & F.col("col").between(left, left + size - 1))


def truth(spark: SparkSession, path: str) -> DataFrame:
    """Salinity truth as CSV; rows with any null are dropped (SRC8)."""
    return spark.read.option("header", "true").schema(SCHEMAS["truth"]).csv(path).dropna("any")


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """Cast profiles as Parquet; unreadable files are skipped (SRC7)."""
    return spark.read.option("ignoreCorruptFiles", "true").schema(SCHEMAS["profiles"]).parquet(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Names in a text file, one a line; blank lines and those from '#' are skipped (SRC14)."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(line.alias("name"))


def rings_of_geojson(rows: DataFrame, text: str = "value") -> DataFrame:
    """rows with a GeoJSON's text to its polygons' rings: the other columns, feature, part, hole (0 for the outer ring, from 1 for its holes) and ring as array<array<double>>."""
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("geometry", geometry)]))), T.StructField("geometry", geometry), *geometry.fields])
    keys = [c for c in rows.columns if c != text]
    read = rows.select(*keys, F.from_json(text, schema).alias("j"))
    one = F.array(F.struct(F.coalesce("j.geometry", F.struct("j.type", "j.coordinates")).alias("geometry")))
    features = read.select(*keys, F.posexplode(F.coalesce("j.features", one)).alias("feature", "f")).select(*keys, "feature", "f.geometry.*")
    single = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    parts = F.when(F.col("type") == "Polygon", single).otherwise(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    return features.select(*keys, "feature", F.posexplode(parts).alias("part", "p")).select(*keys, "feature", "part", F.posexplode("p").alias("hole", "ring"))


def geojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """The rings of a GeoJSON file."""
    return rings_of_geojson(spark.read.text(path, wholetext=True))


def geojson_polygons(spark: SparkSession, path: str) -> DataFrame:
    """A GeoJSON's features: feature and rings, holes and parts included, as operators.polygons takes them. Features without polygons are left out."""
    places = F.transform("ring", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    rows = geojson_rings(spark, path).select("feature", F.struct("part", "hole", places.alias("ring")).alias("r"))
    return rows.groupBy("feature").agg(F.sort_array(F.collect_list("r")).alias("r")).select("feature", F.transform("r", lambda r: r["ring"]).alias("rings"))


def _shoelace(ring: Column) -> tuple[Column, Column, Column]:
    """Twice the signed area, and the sums of x and y weighted by it."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))

    def total(f) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + f(F.get(p["a"], F.lit(0)), F.get(p["a"], F.lit(1)), F.get(p["b"], F.lit(0)), F.get(p["b"], F.lit(1))))

    def cross(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
        return x1 * y2 - x2 * y1

    return total(cross), total(lambda x1, y1, x2, y2: (x1 + x2) * cross(x1, y1, x2, y2)), total(lambda x1, y1, x2, y2: (y1 + y2) * cross(x1, y1, x2, y2))


def shape_summary(rings: DataFrame, *keys: str) -> DataFrame:
    """keys, lat and lon of the area-weighted centre of the polygons, less their holes, and their bounds minx, miny, maxx, maxy (SRC13, G9, A15). Polygons must not overlap; without area there is no centre."""
    area, x, y = _shoelace(F.col("ring"))
    side = F.signum(area) * F.when(F.col("hole") == 0, 1).otherwise(-1)

    def edge(of, place: int) -> Column:
        return of(F.transform("ring", lambda p: F.get(p, F.lit(place))))

    each = rings.select(*keys, (area * side).alias("a"), (x * side).alias("x"), (y * side).alias("y"), *[edge(f, i).alias(n) for f, i, n in ((F.array_min, 0, "x0"), (F.array_min, 1, "y0"), (F.array_max, 0, "x1"), (F.array_max, 1, "y1"))])
    sums = each.groupBy(*keys).agg(F.sum("a").alias("a"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.min("x0").alias("minx"), F.min("y0").alias("miny"), F.max("x1").alias("maxx"), F.max("y1").alias("maxy"))
    size = F.when(F.col("a") != 0, 3 * F.col("a"))
    return sums.select(*keys, (F.col("y") / size).alias("lat"), (F.col("x") / size).alias("lon"), "minx", "miny", "maxx", "maxy")


def aoi_centroid(spark: SparkSession, path: str) -> tuple[float, float]:
    """(lat, lon) of the area-weighted centre of a GeoJSON's polygons, less their holes (SRC13, G9)."""
    found = shape_summary(geojson_rings(spark, path)).first()
    if found["lat"] is None:
        raise ValueError(f"no polygon in {path}")
    return found["lat"], found["lon"]


def aoi_bounds(spark: SparkSession, path: str) -> tuple[float, float, float, float]:
    """minx, miny, maxx, maxy of a GeoJSON's polygons."""
    return tuple(shape_summary(geojson_rings(spark, path)).first()[2:])


def coast_segments(spark: SparkSession, path: str, bounds: tuple[float, float, float, float], margin_deg: float = 10 / 111) -> DataFrame:
    """Coastline segments (x1, y1, x2, y2) that meet bounds grown by a margin; ValueError without any (SRC12)."""
    x0, y0, x1, y1 = bounds[0] - margin_deg, bounds[1] - margin_deg, bounds[2] + margin_deg, bounds[3] + margin_deg
    met = spark.read.parquet(path).where(
        (F.greatest("x1", "x2") >= x0) & (F.least("x1", "x2") <= x1) & (F.greatest("y1", "y2") >= y0) & (F.least("y1", "y2") <= y1)
    )
    if met.limit(1).isEmpty():
        raise ValueError("no coastline within the bounds")
    return met


def labels_of_year(labels: DataFrame, year: int, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Label pixels (year, x, y, label) of a year within a box (SRC10, SRC11, C12, C14)."""
    return labels.where((F.col("year") == year) & F.col("x").between(bbox[0], bbox[2]) & F.col("y").between(bbox[1], bbox[3]))


def months_between(start: Column, end: Column) -> Column:
    """Dates a month apart, from start up to end (SRC16)."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 month"))


def months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The months from start to end (SRC16)."""
    return spark.range(1).select(F.explode(months_between(F.lit(start), F.lit(end))).alias("month"))


def toml(path: str) -> dict:
    """A TOML file (SRC15)."""
    with open(path, "rb") as f:
        return tomllib.load(f)
