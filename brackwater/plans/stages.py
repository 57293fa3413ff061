"""Whole stages, sources and sinks: what they yield over the domain tables, next to plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sensors
from ..functions import text as s
from ..operators import catalog, ingest, metrics, stages
from ..operators import select as op
from ..sources import readers, shared, writers
from ..sources import tables as t
from ..streaming import events
from . import catalog as areas
from . import raster, selection, streams, trends
from .registry import query

def _scenes(spark: SparkSession, d: str) -> DataFrame:
    """Pixels whose scenes fail the checks in several ways: a seventh has zeros in all bands, others lack values."""
    px = raster.gappy(t.pixels(spark, d)).withColumnRenamed("scene", "scene_id")
    return px.withColumns({b: F.when(F.col("scene_id") % 7 != 0, F.col(b)).otherwise(0.0) for b in raster.BANDS})


ZEROED = f"""{raster.GAPPY}, zeroed as (select scene, sensor, row, col, year, {", ".join(f"case when scene % 7 <> 0 then {b} else 0 end as {b}" for b in raster.BANDS)} from gappy)"""
OVER_ZEROED = raster.CHECKED.replace("from gappy", "from zeroed")


@query(f"with {ZEROED}, {OVER_ZEROED} select scene as scene_id, row, col, {raster.MASK.replace('from pixels', 'from zeroed where scene in (select scene from good)')}", "pixels")
def water_masks(spark, d):
    """Masks of all scenes that pass the image checks."""
    return stages.water_masks(_scenes(spark, d))


@query(f"with {ZEROED}, {OVER_ZEROED} select count(distinct scene) as total, (select count(*) from good) as processed, count(distinct scene) - (select count(*) from good) as skipped from zeroed", "pixels")
def stage_counts(spark, d):
    px = _scenes(spark, d)
    return stages.stage_counts(px, stages.water_masks(px))


@query(
    f"with {ZEROED}, {OVER_ZEROED}, passed as (select * from zeroed where scene in (select scene from good)), {raster.SCALED.replace('from pixels', 'from passed')}, {raster.INDICES}, {raster.SCORED}, {raster.CLASSED} "
    "select scene as scene_id, salinity_class, count(*) as n, round(avg(score), 6) as mean_score from classed group by scene, salinity_class",
    "pixels",
)
def salinity_maps(spark, d):
    """The salinity stage over all scenes, summed up by scene and class."""
    found = stages.salinity_maps(t.spread(_scenes(spark, d)))
    return found.groupBy("scene_id", "salinity_class").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("select scene_id, concat_ws('/', 'imagery/processed', scene_id, 'water_mask', 'mask.tif') as path from scenes", "scenes")
def output_paths(spark, d):
    return stages.output_paths(t.scenes(spark, d), "water_mask", "mask.tif")


@query(f"with recursive {selection.COVERED} select k.point_id, k.cluster_key, string_agg(h.sensor, ',' order by h.place) as covered_by from keyed k join hits h using (cluster_key) group by all", "casts", "meta")
def match_casts(spark, d):
    found = op.match_casts(selection._points(spark, d), t.scene_meta(spark, d), buffer_m=2000.0)
    return found.select("point_id", "cluster_key", F.concat_ws(",", "covered_by").alias("covered_by"))


@query(
    f"""with {trends.FRACTIONS}, {trends.SERIES}, {trends.SLOPES}, {trends.KENDALL} select pval < 0.05 as significant, count(*) as pixels, count(slope) as with_slope, round(sum(case when gaps = 0 and high > low then slope else 0 end), 4) as slopes
    from (select k.*, case when gaps = 0 and high > low then s.slope end as slope from tested k left join slopes s using (pixel)) group by pval < 0.05""",
    "masks",
)
def trend_heatmap(spark, d):
    """The trend stage, summed up by significance."""
    out = stages.trend_heatmap(t.masks(spark, d), ["pixel"])
    return out.groupBy("significant").agg(F.count("*").alias("pixels"), F.count("slope").alias("with_slope"), F.round(F.sum(F.coalesce("slope", F.lit(0.0))), 4).alias("slopes"))


@query("select scene, bool_or(nir = 0) as has_nan from pixels where row between 0 and 99 and col between 0 and 99 and row between 30 and 69 and col between 30 and 69 group by scene", "pixels")
def center_has_nan(spark, d):
    """Scenes with missing values in the centred window; zero near infrared stands for missing."""
    px = t.pixels(spark, d).withColumn("value", F.when(F.col("nir") != 0, F.col("nir")))
    return metrics.center_has_nan(px, 100, window=40)


@query("select scene_id from scenes order by scene_id limit 200", "scenes")
def first_images(spark, d):
    """The 200 scenes that class weights are counted on (the limit is the operator's)."""
    return metrics.first_images(t.scenes(spark, d).select("scene_id"), "scene_id")


@query("select scene, row, col, case when red >= green and red >= nir then 0 when green >= nir then 1 else 2 end as predicted from pixels", "pixels")
def predict_scenes(spark, d):
    """A model over batches of pixels: the band with the largest number."""

    def largest(frame):
        out = frame[["scene", "row", "col"]].copy()
        out["predicted"] = frame[["red", "green", "nir"]].to_numpy().argmax(axis=1)
        return out

    return stages.predict_scenes(t.pixels(spark, d), largest, "scene bigint, row int, col int, predicted int", ["scene", "row", "col", "red", "green", "nir"])


@query("select sensor, unnest(range(6))::int + 6 * case sensor when 'sentinel-2' then 0 when 'landsat-5' then 1 else 2 end as channel, count(*) as n from scenes group by sensor", "scenes")
def channel_ids(spark, d):
    """How many scenes fill each channel."""
    each = t.scenes(spark, d).groupBy("sensor").agg(F.count("*").alias("n"))
    return each.select("sensor", F.explode(stages.channels_of(F.col("sensor"))).alias("channel"), "n")


@query(
    """select sensor, mission_id, scale_m, count(*) as scenes, count(*) filter (where acquisition_date between a and z) as in_life from scenes
    join (values ('sentinel-2', 0, 10, date '2015-06-23', date '2099-12-31'), ('landsat-5', 1, 30, date '1984-03-01', date '2013-01-01'), ('landsat-7', 2, 30, date '1999-04-15', date '2022-03-31')) m(sensor, mission_id, scale_m, a, z) using (sensor)
    group by all""",
    "scenes",
)
def sensor_table(spark, d):
    """Scenes of each mission, and those within its life."""
    found = t.scenes(spark, d).join(sensors.sensor_table(spark), "sensor")
    alive = F.col("acquisition_date").between(F.col("valid_from"), F.coalesce("valid_to", F.lit("2099-12-31").cast("date")))
    return found.groupBy("sensor", "mission_id", "scale_m").agg(F.count("*").alias("scenes"), F.count(F.when(alive, 1)).alias("in_life"))


@query("select scene_key, case sensor when 'sentinel-2' then 10 else 30 end as scale_m, case sensor when 'sentinel-2' then 'CLOUDY_PIXEL_PERCENTAGE' else 'CLOUD_COVER' end as cloud_field from scenes", "scenes")
def sensor_lookup(spark, d):
    sensor = F.col("sensor")
    return t.scenes(spark, d).select("scene_key", sensors.by_sensor(sensor, "scale_m").alias("scale_m"), sensors.by_sensor(sensor, "cloud_field").alias("cloud_field"))


@query(
    "select sensor, unnest(generate_series(date_trunc('month', min(acquisition_date))::timestamp, date_trunc('month', max(acquisition_date))::timestamp, interval 1 month))::date as month from scenes group by sensor",
    "scenes",
)
def months(spark, d):
    """The months from each sensor's first scene to its last."""
    ends = t.scenes(spark, d).groupBy("sensor").agg(F.trunc(F.min("acquisition_date"), "month").alias("a"), F.trunc(F.max("acquisition_date"), "month").alias("z"))
    return ends.select("sensor", F.explode(readers.months_between(F.col("a"), F.col("z"))).alias("month"))


@query("select count(*) as scenes, sum((scene_id in (select scene_id from scenes where status = 'active'))::int)::bigint as there from scenes", "scenes")
def scene_exists(spark, d):
    """Whether scenes exist as active ones, asked for the whole table at once."""
    sc = t.scenes(spark, d)
    active = sc.where("status = 'active'").select("scene_id", F.lit(1).alias("there"))
    one = sc.where("status = 'active'").first()
    assert one is None or catalog.exists(sc, one["scene_id"])
    return sc.select("scene_id").join(active, "scene_id", "left").agg(F.count("*").alias("scenes"), F.coalesce(F.sum("there"), F.lit(0)).alias("there"))


# Sources and sinks by way of the shared folder


@query("select cast_id, round(surface_salinity, 9) as salinity, lat, lon from casts where surface_salinity is not null and point_id % 5 <> 0", "casts")
def truth_csv(spark, d):
    """Truth written as CSV and read again; rows with a missing number are left out by the reader."""
    path = shared.shared_path(spark, "truth")
    date = F.when(F.col("point_id") % 5 != 0, F.col("sample_date").cast("string"))
    rows = t.casts(spark, d).select(F.round("surface_salinity", 9).alias("salinity"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), date.alias("date"), F.col("cast_id").alias("source_file"))
    writers.csv_once(rows, path)
    writers.csv_once(rows.limit(0), path)  # a second write changes nothing
    return readers.truth(spark, path).select(F.col("source_file").alias("cast_id"), "salinity", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


@query("select scene, count(*) as pixels, sum(green)::bigint as green from pixels group by scene", "pixels")
def raster_round_trip(spark, d):
    """Pixels of all scenes through the raster sink and source."""
    path = shared.shared_path(spark, "raster")
    bands = [F.col(b).cast("float") for b in raster.BANDS]
    writers.raster(t.pixels(spark, d).select(F.col("scene").cast("string").alias("scene_id"), "row", "col", *bands), path)
    read = readers.table(spark, path, "pixels")
    return read.groupBy(F.col("scene_id").cast("long").alias("scene")).agg(F.count("*").alias("pixels"), F.sum("green").cast("long").alias("green"))


@query("select scene_id || '.tif' as name from scenes where scene_key % 3 <> 0", "scenes")
def listing(spark, d):
    """A text file of names with blank lines and comments."""
    path = shared.shared_path(spark, "listing")
    line = F.when(F.col("scene_key") % 3 != 0, F.concat(F.lit("  "), "scene_id", F.lit(".tif "))).when(F.col("scene_key") % 2 == 0, F.concat(F.lit("# "), "scene_id")).otherwise("")
    t.scenes(spark, d).select(line.alias("value")).write.text(path)
    return readers.listing(spark, path)


RING_SIDES = ", ".join(f"({i}, {a[0]}::double, {a[1]}::double, {z[0]}::double, {z[1]}::double)" for i, ring in enumerate((areas.RING, areas.HOLE)) for a, z in zip(ring, ring[1:], strict=False))


@query(
    f"""with {areas.AREAS}, turned as (select area_id, hole, ax + a * size as x1, ay + b * size as y1, ax + c * size as x2, ay + d * size as y2 from areas, (values {RING_SIDES}) v(hole, a, b, c, d)),
    rings as (select area_id, hole, sum(x1 * y2 - x2 * y1) as area, sum((x1 + x2) * (x1 * y2 - x2 * y1)) as sx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) as sy, min(x1) as x0, min(y1) as y0, max(x1) as x9, max(y1) as y9 from turned group by all),
    signed as (select *, sign(area) * case hole when 0 then 1 else -1 end as side from rings)
    select area_id, round(sum(sy * side) / (3 * sum(area * side)), 5) as lat, round(sum(sx * side) / (3 * sum(area * side)), 5) as lon, round(min(x0), 6) as minx, round(min(y0), 6) as miny, round(max(x9), 6) as maxx, round(max(y9), 6) as maxy
    from signed group by area_id""",
    "casts",
)
def aoi_shape(spark, d):
    """Centres and bounds of areas with holes, from GeoJSON."""
    c = t.casts(spark, d).where("point_id % 10 = 3")
    size = F.lit(0.03125) + (F.col("point_id") % 7) * F.lit(0.015625)
    rings = [F.array(*[F.array(F.col("lon") + a * size, F.col("lat") + b * size) for a, b in ring]) for ring in (areas.RING, areas.HOLE)]
    text = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(*rings).alias("coordinates")))
    found = readers.shape_summary(readers.rings_of_geojson(c.select(F.col("point_id").alias("area_id"), text.alias("value"))), "area_id")
    return found.select("area_id", *[F.round(n, 5).alias(n) for n in ("lat", "lon")], *[F.round(n, 6).alias(n) for n in ("minx", "miny", "maxx", "maxy")])


@query("select scene_id, sensor, acquisition_date from scenes where scene_key % 11 <> 0 and sensor <> 'sentinel-2'", "scenes")
def scenes_of_files(spark, d):
    """Scenes by the names of their files; names that don't parse are left out."""
    head = F.when(F.col("scene_key") % 11 == 0, F.lit("unknown_")).otherwise(F.concat("sensor", F.lit("_")))
    files = t.scenes(spark, d).select(F.concat(F.lit("mosaics/"), "sensor", F.lit("/"), head, "scene_id", F.lit("_multiband.tif")).alias("path"))
    return ingest.scenes_of_files(files).select("scene_id", "sensor", "acquisition_date")


@query(f"with {streams.CODED}, runs as (select distinct scene_id, task from coded, (values ('water_mask'), ('trend')) t(task) where sensor <> 'zeppelin') select md5(scene_id || ':' || task || ':{{}}') as product_id, scene_id, task, status, 1::bigint as n from runs, (values ('complete'), ('not_started')) s(status)")
def incremental_runs(spark, d):
    """The run log of a drained stream, replayed twice: runs that are complete are not run again."""
    path = shared.shared_path(spark, "runs")
    tasks = {name: (lambda df: df.withColumn("status", F.lit("complete"))) for name in ("water_mask", "trend")}
    for turn in ("first", "again"):
        events.run_incremental(streams._envelopes(streams._stream(spark, d)), tasks, f"{path}/log", f"{path}/state-{turn}").awaitTermination()
    return spark.read.parquet(f"{path}/log").groupBy("product_id", "scene_id", "task", "status").agg(F.count("*").alias("n"))


@query("select scene_key, year(acquisition_date)::int as year, case when strftime(acquisition_date, '%m') in ('06', '07', '08') then strftime(acquisition_date, '%Y-%m') end as summer from scenes", "scenes")
def periods(spark, d):
    day = F.col("acquisition_date")
    return t.scenes(spark, d).select("scene_key", F.year(day).alias("year"), F.when(F.month(day).isin(6, 7, 8), s.period(day)).alias("summer"))
