"""Log replay, validation, names and casts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text as s
from ..operators import casts as op_casts
from ..operators import ingest as op
from ..sources import tables as t
from .registry import query

LOG = """log as (select s.scene_id, s.sensor, s.acquisition_date, l_linenumber * 100000000000 + l_partkey * 100000 + l_suppkey as seq, case when l_partkey % 7 = 0 then null else md5((l_partkey % 3)::varchar) end as file_hash
    from lineitem join scenes s on s.scene_key = l_orderkey)"""


def _log(spark, d):
    li = t.read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("scene_key"), (F.col("l_linenumber") * F.lit(100_000_000_000) + F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("seq"),
        F.when(F.col("l_partkey") % 7 != 0, F.md5((F.col("l_partkey") % 3).cast("string"))).alias("file_hash"),
    )
    return li.join(t.scenes(spark, d).select("scene_key", "scene_id", "sensor", "acquisition_date"), "scene_key")


@query(
    f"""with {LOG}, w as (select *, lag(file_hash) over (partition by scene_id order by seq) as before from log)
    select scene_id, any_value(sensor) as sensor, any_value(acquisition_date) as acquisition_date, last(file_hash order by seq) as file_hash, 'active' as status,
    1 + (count(*) filter (where before <> file_hash))::bigint as version_no from w group by scene_id""",
    "scenes",
)
def scene_upsert_replay(spark, d):
    return op.replay_scenes(_log(spark, d)).select("scene_id", "sensor", "acquisition_date", "file_hash", "status", "version_no")


RUN_LOG = "select 'R' || (event_id % 500)::varchar as product_id, event_id as seq, case event_id % 4 when 0 then 'not_started' when 1 then 'running' when 2 then 'complete' else 'failed' end as status, ts as at, case when event_type = 'error' then props end as error_message from events"


@query(f"select product_id, arg_max(status, seq) as status, count(*) filter (where false) + arg_max(seq, seq) as last_seq, last(error_message order by seq) as error_message from ({RUN_LOG}) group by product_id")
def run_log_latest(spark, d):
    return op.replay_runs(run_log(spark, d)).select("product_id", "status", F.col("output_paths").alias("last_seq"), "error_message")


def run_log(spark, d):
    e, key = t.read(spark, d, "events"), F.col("event_id")
    return e.select(
        F.concat(F.lit("R"), (key % 500).cast("string")).alias("product_id"), key.alias("seq"), t.pick(F.pmod(key, F.lit(4)), "not_started", "running", "complete", "failed").alias("status"),
        F.col("ts").alias("at"), F.lit("x").alias("base_scene_id"), F.lit("water_mask").alias("task"), F.lit("{}").alias("parameters"), key.alias("output_paths"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )


@query(
    "select cast_id, point_id from (select cast_id, point_id, row_number() over (partition by cast_id order by point_id) as k from (select cast_id, point_id from casts union all select 'CAST_' || lpad((point_id % 50)::varchar, 8, '0'), point_id + 1000000 from casts)) where k = 1 and cast_id not in (select cast_id from casts where point_id % 2 = 0)",
    "casts",
)
def cast_insert_ignore(spark, d):
    c = t.casts(spark, d).select("cast_id", "point_id")
    again = c.select(F.concat(F.lit("CAST_"), F.lpad((F.col("point_id") % 50).cast("string"), 8, "0")).alias("cast_id"), (F.col("point_id") + 1_000_000).alias("point_id"))
    return op.insert_new(c.union(again), c.where("point_id % 2 = 0"), "cast_id", "point_id").select("cast_id", "point_id")


@query("select scene_id, case when status = 'active' and scene_key % 5 = 0 then 'missing' else status end as status from scenes", "scenes")
def reconcile_missing(spark, d):
    found = t.scenes(spark, d)
    listing = found.where("scene_key % 5 <> 0").select(F.explode("file_locations").alias("path"))
    return op.reconcile(found, listing).select("scene_id", "status")


PATHS = "paths as (select 'mosaics/' || sensor || '/' || case when scene_key % 11 = 0 then 'unknown_' else sensor || '_' end || scene_id || '_multiband.tif' as path from scenes)"


def _paths(spark, d):
    head = F.when(F.col("scene_key") % 11 == 0, F.lit("unknown_")).otherwise(F.concat("sensor", F.lit("_")))
    return t.scenes(spark, d).select(F.concat(F.lit("mosaics/"), "sensor", F.lit("/"), head, "scene_id", F.lit("_multiband.tif")).alias("path"))


@query(f"with {PATHS} select path, nullif(regexp_extract(path, '/(?:sentinel-2|landsat-5|landsat-7)_([^/]+)_multiband\\.tif$', 1), '') as scene_id from paths", "scenes")
def scene_id_parse(spark, d):
    return _paths(spark, d).select("path", s.scene_id_from_path(F.col("path")).alias("scene_id"))


@query(f"with {PATHS} select path, regexp_extract(path, '(sentinel-2|landsat-5|landsat-7)', 1) as mission, case regexp_extract(path, '(sentinel-2|landsat-5|landsat-7)', 1) when 'landsat-5' then 0 when 'landsat-7' then 1 else 2 end as dataset_id from paths", "scenes")
def mission_parse(spark, d):
    got = _paths(spark, d).select("path", s.mission_from_path(F.col("path")).alias("mission"))
    return got.withColumn("dataset_id", s.dataset_id(F.col("mission")))


NAMES = """names as (select scene_key, case when scene_key % 11 = 0 then 'unknown_' || scene_id when sensor = 'sentinel-2' and scene_key % 2 = 0 then 'sentinel-2_' || strftime(acquisition_date, '%Y%m%d') || 'T154911_tile'
    when sensor = 'sentinel-2' then 'sentinel-2_' || scene_id else sensor || '_' || scene_id end as name from scenes)"""


@query(
    f"""with {NAMES} select scene_key, case when name like 'sentinel%' then try_strptime(regexp_extract(name, '(\\d{{8}})T\\d{{6}}', 1), '%Y%m%d')::date else try_strptime(split_part(name, '_', 4), '%Y%m%d')::date end as day from names""",
    "scenes",
)
def filename_date(spark, d):
    """Names of all missions, Sentinel's with and without a time, and names of no mission."""
    day, key = F.date_format("acquisition_date", "yyyyMMdd"), F.col("scene_key")
    sentinel = F.when(key % 2 == 0, F.concat(F.lit("sentinel-2_"), day, F.lit("T154911_tile"))).otherwise(F.concat(F.lit("sentinel-2_"), "scene_id"))
    name = F.when(key % 11 == 0, F.concat(F.lit("unknown_"), "scene_id")).when(F.col("sensor") == "sentinel-2", sentinel).otherwise(F.concat_ws("_", "sensor", "scene_id"))
    return t.scenes(spark, d).select("scene_key", s.date_from_name(F.concat(F.lit("mosaics/"), name, F.lit("_multiband.tif"))).alias("day"))


@query("select event_id, md5('S' || event_id::varchar || ':water_mask:' || props) as product_id from events")
def product_id(spark, d):
    parameters = s.json_of_map(F.from_json("props", "map<string,string>"))
    numbers = F.regexp_replace(parameters, r'"(\d+)"', "$1")
    return t.read(spark, d, "events").select("event_id", s.product_id_column(F.concat(F.lit("S"), F.col("event_id").cast("string")), F.lit("water_mask"), numbers).alias("product_id"))


@query(
    """select scene_id, concat_ws(',', case when not regexp_matches(scene_id, '\\d{8}') then 'scene_id' end, case when acquisition_date > date '2000-01-01' then 'acquisition_date' end,
    case when minx < -77.5 or maxx > -74.5 then 'longitude' end, case when miny < 37.5 or maxy > 40.0 then 'latitude' end) as broken from scenes""",
    "scenes",
)
def record_validation(spark, d):
    from ..functions.geo import box_wkt

    rows = t.spread(t.scenes(spark, d)).withColumn("location", box_wkt(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")]))
    return rows.select("scene_id", F.concat_ws(",", op.violations(today=dt.date(2000, 1, 1))).alias("broken"))


@query(
    """select cast_id, profile, round(first(salinity order by level, depth_m, salinity), 6) as surface_salinity, max(max_depth) as max_depth from
    (select *, max(depth_m) over (partition by cast_id, profile) as max_depth from levels) where depth_m <= 1.0 group by cast_id, profile""",
    "levels",
)
def surface_salinity(spark, d):
    out = op_casts.surface_levels(t.levels(spark, d), ["cast_id", "profile"])
    return out.select("cast_id", "profile", F.round("surface_salinity", 6).alias("surface_salinity"), "max_depth")


@query("select cast_id, profile, count(*) as levels, count(temperature) as temperatures, round(avg(salinity), 6) as mean_salinity from levels group by cast_id, profile", "levels")
def profile_summary(spark, d):
    lv = t.levels(spark, d)
    return lv.groupBy("cast_id", "profile").agg(F.count("*").alias("levels"), F.count("temperature").alias("temperatures"), F.round(F.avg("salinity"), 6).alias("mean_salinity"))
