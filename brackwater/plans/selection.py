"""Scene selection, matching of casts, grids and geometry."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.sensors import MISSIONS, in_lifetime
from ..operators import select as op
from ..sources import tables as t
from .registry import query

SLUGS = [m.slug for m in MISSIONS]
LIFETIMES = "lives(sensor, place, a, z) as (values ('sentinel-2', 0, date '2015-06-23', null::date), ('landsat-5', 1, date '1984-03-01', date '2013-01-01'), ('landsat-7', 2, date '1999-04-15', date '2022-03-31'))"
MEETS = "m.minx <= p.lon + r and m.maxx >= p.lon - r and m.miny <= p.lat + r and m.maxy >= p.lat - r"


def _points(spark, d):
    return t.casts(spark, d).select("point_id", "lat", "lon", F.col("sample_date").alias("date"), F.col("surface_salinity").alias("salinity"))


POINTS = "points as (select point_id, lat, lon, sample_date as date from casts)"


@query("select scene_id, date, cloud from meta where sensor = 'landsat-5' and maxx >= -76.5 and minx <= -75.5 and maxy >= 38 and miny <= 39 and date >= date '1996-01-01' and date < date '1999-01-01' and cloud <= 30", "meta")
def scene_filter(spark, d):
    return op.scene_filter(t.scene_meta(spark, d), "landsat-5", (-76.5, 38.0, -75.5, 39.0), "1996-01-01", "1999-01-01", 30.0).select("scene_id", "date", "cloud")


@query(
    """select sensor, month, scene_id, cloud, rank from (select *, (row_number() over (partition by sensor, month order by cloud, time_ms desc, scene_id))::int as rank
    from (select *, strftime(date, '%Y-%m') as month from meta)) where rank <= 3""",
    "meta",
)
def best_scene_topk(spark, d):
    meta = t.scene_meta(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    return op.best_scenes(meta, ["sensor", "month"], 3).select("sensor", "month", "scene_id", "cloud", "rank")


@query(
    f"""with {POINTS}, asked as (select point_id, lat, lon, date, 'landsat-5' as sensor from points), j as (select p.point_id, m.scene_id, m.cloud,
    row_number() over (partition by p.point_id order by cloud, time_ms desc, scene_id) as k from (select *, 1.0::double / 111.0::double as r from asked) p join meta m
    on m.sensor = p.sensor and {MEETS} and m.date between p.date - 20 and p.date + 20 where cloud <= 60)
    select a.point_id, j.scene_id, j.cloud from asked a left join (select * from j where k = 1) j using (point_id)""",
    "casts", "meta",
)
def scenes_for_points(spark, d):
    asked = _points(spark, d).drop("salinity").withColumn("sensor", F.lit("landsat-5"))
    return op.pick_for_points(asked, t.scene_meta(spark, d), 1.0, 20, 20, 60.0).select("point_id", "scene_id", "cloud")


# Links of the points' buffers, closed by recursion; the smallest point names the cluster.
CLUSTERS = f"""{POINTS}, xy as (select point_id, radians(lon) * 6378137.0::double as x, ln(tan(3.141592653589793::double / 4 + radians(lat) / 2)) * 6378137.0::double as y from points),
    links as (select a.point_id as a, b.point_id as b from xy a join xy b on pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 4000.0::double * 4000.0::double),
    reach as (select point_id as a, point_id as b from points union select r.a, l.b from reach r join links l on r.b = l.a),
    clustered as (select a as point_id, min(b) as cluster from reach group by a)"""


@query(f"with recursive {CLUSTERS} select point_id, cluster from clustered", "casts")
def spatial_clusters(spark, d):
    return op.spatial_clusters(_points(spark, d), 2000.0).select("point_id", "cluster")


COVERED = f"""{CLUSTERS}, keyed as (select p.*, c.cluster::varchar || '_' || strftime(date, '%Y-%m') as cluster_key from points p join clustered c using (point_id)),
    reps as (select cluster_key, arg_min(lat, point_id) as lat, arg_min(lon, point_id) as lon, arg_min(date, point_id) as date from keyed group by cluster_key),
    {LIFETIMES},
    hits as (select distinct p.cluster_key, l.place, l.sensor from (select *, 10.0::double / 111.0::double as r from reps) p join lives l on p.date >= l.a and (l.z is null or p.date <= l.z)
        join meta m on m.sensor = l.sensor and {MEETS} and m.date between p.date - 7 and p.date + 7)"""


def _covered(spark, d):
    clustered = op.cluster_keys(_points(spark, d), 2000.0)
    return op.coverage(clustered, t.scene_meta(spark, d), SLUGS)


@query(f"with recursive {COVERED} select k.point_id, k.cluster_key, coalesce(string_agg(h.sensor, ',' order by h.place), '') as covered_by from keyed k left join hits h using (cluster_key) group by all", "casts", "meta")
def mission_coverage(spark, d):
    return _covered(spark, d).select("point_id", "cluster_key", F.concat_ws(",", "covered_by").alias("covered_by"))


@query(
    f"""with recursive {COVERED}, asked as (select k.*, h.sensor, 1.0::double / 111.0::double as r from keyed k join hits h using (cluster_key)),
    found as (select p.point_id, p.cluster_key, p.sensor, m.scene_id, row_number() over (partition by p.point_id, p.sensor order by cloud, time_ms desc, scene_id) as k
        from asked p join meta m on m.sensor = p.sensor and {MEETS} and m.date between p.date - 7 and p.date + 7 where cloud <= 80),
    first as (select sensor, cluster_key, arg_min(scene_id, point_id) as scene_id from found where k = 1 group by all)
    select a.point_id, a.cluster_key, a.sensor, f.scene_id from asked a join first f using (sensor, cluster_key)""",
    "casts", "meta",
)
def cluster_dedup(spark, d):
    found = op.cluster_downloads(_covered(spark, d), t.scene_meta(spark, d), buffer_km=1.0, max_cloud=80.0)
    return found.select("point_id", "cluster_key", "sensor", "scene_id")


@query(
    """select mission, lat, lon, unnest(generate_series(timestamp '2018-06-01', timestamp '2018-08-01', to_days(step)))::date as date
    from (values ('sentinel-2', 7), ('landsat-7', 16)) m(mission, step), casts""",
    "casts",
)
def download_worklist(spark, d):
    """What to look for around every cast."""
    return op.work_for_places(t.casts(spark, d), ["sentinel-2", "landsat-7"], "2018-06-01", "2018-08-01", 16)


@query(
    """select scene_id, i, j, round(minx + j * (maxx - minx) / 3, 9) as minx, round(miny + i * (maxy - miny) / 3, 9) as miny, round(minx + (j + 1) * (maxx - minx) / 3, 9) as maxx, round(miny + (i + 1) * (maxy - miny) / 3, 9) as maxy
    from scenes, (select unnest(range(3))::int as i), (select unnest(range(3))::int as j) where sensor = 'sentinel-2'""",
    "scenes",
)
def tile_grid(spark, d):
    boxes = t.scenes(spark, d).where("sensor = 'sentinel-2'").select("scene_id", "minx", "miny", "maxx", "maxy")
    return op.tile_grid(boxes, 3).select("scene_id", "i", "j", *[F.round(c, 9).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query(
    """with s as (select scene_id, sensor, trunc((1 + scene_key % 40) * 0.01::double * 111000.0::double / case when sensor = 'sentinel-2' then 10 else 30 end)::bigint as px from scenes)
    select scene_id, px * px * 6 * 2 as bytes, case when sensor <> 'sentinel-2' then 1 when px * px * 12 > 100000000 then 3 when px * px * 12 > 30000000 then 2 else 1 end as tiles from s""",
    "scenes",
)
def size_estimate(spark, d):
    side = (F.pmod("scene_key", F.lit(40)) + 1) * F.lit(0.01)
    scale = F.when(F.col("sensor") == "sentinel-2", 10).otherwise(30)
    size, tiles = geo.tile_choice(side, side, scale, F.lit(6), F.col("sensor"))
    return t.scenes(spark, d).select("scene_id", size.alias("bytes"), tiles.alias("tiles"))


COVERAGES = "coverages(name) as (values ('NLCD_mrlc_2001_Land_Cover_L48'), ('NLCD_mrlc_2004_Land_Cover_L48'), ('NLCD_mrlc_2011_Land_Cover_L48'), ('NLCD_mrlc_2011_Land_Cover_Change_L48'), ('NLCD_mrlc_x_Land_Cover_L48'), ('ANLCD_mrlc_1999_Land_Cover_L48'))"


@query(
    f"""with {COVERAGES}, ok as (select name, try_cast(split_part(name, '_', 3) as int) as year from coverages where name like '%NLCD%' and name like '%Land\\_Cover%' escape '\\' and name like '%L48%'
    and name not like '%Land\\_Cover\\_Change%' escape '\\' and name not like '%ANLCD%'), wanted as (select distinct year(o_orderdate)::int as wanted from orders)
    select wanted, year from (select wanted, year, row_number() over (partition by wanted order by abs(year - wanted), name) as k from wanted, ok where year is not null) where k = 1"""
)
def nlcd_nearest_year(spark, d):
    names = ["NLCD_mrlc_2001_Land_Cover_L48", "NLCD_mrlc_2004_Land_Cover_L48", "NLCD_mrlc_2011_Land_Cover_L48", "NLCD_mrlc_2011_Land_Cover_Change_L48", "NLCD_mrlc_x_Land_Cover_L48", "ANLCD_mrlc_1999_Land_Cover_L48"]
    listed = op.coverage_names(spark.createDataFrame([(n,) for n in names], "name string")).withColumn("position", F.col("name"))
    wanted = t.read(spark, d, "orders").select(F.year("o_orderdate").alias("wanted")).distinct()
    return op.nearest_year(listed, wanted).select("wanted", "year")


@query(
    """select scene_id, acquisition_date >= case sensor when 'sentinel-2' then date '2015-06-23' when 'landsat-5' then date '1984-03-01' else date '1999-04-15' end
    and acquisition_date <= case sensor when 'sentinel-2' then date '9999-01-01' when 'landsat-5' then date '2013-01-01' else date '2022-03-31' end as flew from scenes""",
    "scenes",
)
def mission_lifetime(spark, d):
    return t.scenes(spark, d).select("scene_id", in_lifetime(F.col("sensor"), F.col("acquisition_date")).alias("flew"))


@query("select cast_id, round(lon - 10.0::double / 111.0::double, 9) as minx, round(lat - 10.0::double / 111.0::double, 9) as miny, round(lon + 10.0::double / 111.0::double, 9) as maxx, round(lat + 10.0::double / 111.0::double, 9) as maxy from casts", "casts")
def geo_bbox(spark, d):
    box = geo.box_around(F.col("lat"), F.col("lon"), 10.0)
    return t.casts(spark, d).select("cast_id", *[F.round(c, 9).alias(n) for c, n in zip(box, ("minx", "miny", "maxx", "maxy"), strict=True)])


@query(
    """select cast_id, round(2 * 6371.0088::double * asin(sqrt(least(1.0::double, pow(sin(radians(38.5::double - lat) / 2), 2) + cos(radians(lat)) * cos(radians(38.5::double)) * pow(sin(radians(-76.0::double - lon) / 2), 2)))), 4) as km from casts""",
    "casts",
)
def haversine(spark, d):
    km = geo.haversine_km(F.col("lon"), F.col("lat"), F.lit(-76.0), F.lit(38.5))
    return t.casts(spark, d).select("cast_id", F.round(km, 4).alias("km"))


@query("select cast_id, (floor((lon + 180) / 6) + 1)::int as zone, 'EPSG:' || (32601 + floor((lon + 180) / 6)::int)::varchar as epsg from casts", "casts")
def utm_zone(spark, d):
    return t.casts(spark, d).select("cast_id", geo.utm_zone(F.col("lon")).alias("zone"), geo.utm_epsg(F.col("lon")).alias("epsg"))


@query(
    """with s as (select minx as x1, miny as y1, maxx as x2, maxy as y2 from scenes),
    d as (select point_id, lon, lat, x1, y1, x2, y2, least(greatest(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0.0::double), 1.0::double) as t from casts, s),
    m as (select point_id, min(sqrt(pow(lon - (x1 + t * (x2 - x1)), 2) + pow(lat - (y1 + t * (y2 - y1)), 2))) as distance from d group by point_id)
    select point_id, round(distance, 6) as distance from m where distance <= 0.02""",
    "scenes", "casts",
)
def coastal_band(spark, d):
    segments = t.scenes(spark, d).select(F.col("minx").alias("x1"), F.col("miny").alias("y1"), F.col("maxx").alias("x2"), F.col("maxy").alias("y2"))
    return op.near_coast(_points(spark, d), segments, 0.02).select("point_id", F.round("distance", 6).alias("distance"))


@query(
    """with p as (select point_id, floor((lon - -77.5::double) / 0.25::double)::bigint as gx, floor((lat - 37.5::double) / 0.25::double)::bigint as gy from casts),
    g as (select (l_partkey % 12)::bigint as gx, (l_suppkey % 11)::bigint as gy, max(l_partkey % 256)::int as label from lineitem group by 1, 2)
    select point_id, label from p left join g using (gx, gy)""",
    "casts",
)
def label_alignment(spark, d):
    grid = t.read(spark, d, "lineitem").groupBy((F.col("l_partkey") % 12).alias("gx"), (F.col("l_suppkey") % 11).alias("gy")).agg(F.max(F.col("l_partkey") % 256).cast("int").alias("label"))
    points = _points(spark, d).select("point_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return op.align_labels(points, grid, -77.5, 37.5, 0.25).select("point_id", "label")


@query("select row, col, first(green order by scene, green) as value from pixels where nir <> 0 group by row, col", "pixels")
def tile_stitch(spark, d):
    """Every scene is a tile; its pixels without near infrared are no data."""
    value = F.when(F.col("nir") != 0, F.col("green"))
    return op.stitch(t.pixels(spark, d).select(F.col("scene").alias("tile"), "row", "col", value.alias("value"))).select("row", "col", "value")


def _utm_sql(source: str, lon: str, lat: str, x: str, y: str, zone: int = 18) -> str:
    """SELECT of a source's columns and its places as x, y of a UTM zone."""
    e = math.sqrt(geo.FLATTENING * (2 - geo.FLATTENING))
    alpha, radius = geo.utm_series()["alpha"], geo.utm_radius()
    east = " + ".join(f"{c!r}::double * cos({2 * j} * _up) * sinh({2 * j} * _along)" for j, c in enumerate(alpha, 1))
    north = " + ".join(f"{c!r}::double * sin({2 * j} * _up) * cosh({2 * j} * _along)" for j, c in enumerate(alpha, 1))
    angles = f"select *, radians({lon} - ({zone * 6 - 183})) as _angle, sinh(atanh(sin(radians({lat}))) - {e!r}::double * atanh({e!r}::double * sin(radians({lat})))) as _t from {source}"
    sphere = f"select *, atan2(_t, cos(_angle)) as _up, atanh(sin(_angle) / sqrt(1 + _t * _t)) as _along from ({angles})"
    return f"select * exclude (_angle, _t, _up, _along), 500000 + {radius!r}::double * (_along + {east}) as {x}, {radius!r}::double * (_up + {north}) as {y} from ({sphere})"


@query(f"select cast_id, round(x, 4) as x, round(y, 4) as y, round(lon, 9) as lon, round(lat, 9) as lat from ({_utm_sql('casts', 'lon', 'lat', 'x', 'y')})", "casts")
def utm_round_trip(spark, d):
    """Easting and northing, and the degrees that they give back."""
    x, y = geo.utm(F.col("lon"), F.col("lat"), 18)
    placed = t.casts(spark, d).select("cast_id", x.alias("x"), y.alias("y"))
    lon, lat = geo.unutm(F.col("x"), F.col("y"), 18)
    return placed.select("cast_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query(
    f"""with u as ({_utm_sql("casts", "lon", "lat", "x", "y")}), p as (select point_id, floor((x - 280000) / 20000)::bigint as gx, floor((y - 4150000) / 20000)::bigint as gy from u),
    g as (select (l_partkey % 12)::bigint as gx, (l_suppkey % 11)::bigint as gy, max(l_partkey % 256)::int as label from lineitem group by 1, 2)
    select point_id, label from p left join g using (gx, gy)""",
    "casts",
)
def label_alignment_utm(spark, d):
    """Places in degrees take the label of a grid in metres."""
    grid = t.read(spark, d, "lineitem").groupBy((F.col("l_partkey") % 12).alias("gx"), (F.col("l_suppkey") % 11).alias("gy")).agg(F.max(F.col("l_partkey") % 256).cast("int").alias("label"))
    x, y = geo.utm(F.col("lon"), F.col("lat"), 18)
    return op.align_labels(_points(spark, d).select("point_id", x.alias("x"), y.alias("y")), grid, 280000.0, 4150000.0, 20000.0).select("point_id", "label")


@query(
    f"""with v as (select scene_key // 8 as line, scene_key as seq, minx + 0.003::double as lon, miny + 0.004::double as lat from scenes), u as ({_utm_sql("v", "lon", "lat", "x1", "y1")}),
    s as (select line, seq, lon, lat, x1, y1, lead(x1) over w as x2, lead(y1) over w as y2, lead(lon) over w as lon2, lead(lat) over w as lat2 from u window w as (partition by line order by seq)),
    whole as (select line, min(seq) as a, max(seq) as z, min(least(lon, lon2)) as minx, min(least(lat, lat2)) as miny, max(greatest(lon, lon2)) as maxx, max(greatest(lat, lat2)) as maxy from s where x2 is not null group by line),
    seg as (select s.*, seq = a as open1, seq = z as open2 from s join whole using (line) where x2 is not null and maxx >= -76.8 - 10 / 111.0::double and minx <= -76.1 + 10 / 111.0::double and maxy >= 38.1 - 10 / 111.0::double and miny <= 38.9 + 10 / 111.0::double),
    c as ({_utm_sql("casts", "lon", "lat", "x", "y")}),
    d as (select point_id, x, y, x1, y1, x2, y2, open1, open2, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as t from c, seg where c.lon between -76.8 and -76.1 and c.lat between 38.1 and 38.9),
    m as (select point_id, sqrt(pow(x - (x1 + least(greatest(t, 0.0::double), 1.0::double) * (x2 - x1)), 2) + pow(y - (y1 + least(greatest(t, 0.0::double), 1.0::double) * (y2 - y1)), 2)) as distance from d where (t >= 0 or not open1) and (t <= 1 or not open2))
    select point_id, round(min(distance), 3) as distance from m where distance <= 700 group by point_id""",
    "scenes", "casts",
)
def coastal_strip(spark, d):
    """Casts in a flat-capped band of 700 m around lines through the corners of scenes, clipped to a box."""
    w = Window.partitionBy("line").orderBy("seq")
    v = t.scenes(spark, d).select(F.floor(F.col("scene_key") / 8).alias("line"), F.col("scene_key").alias("seq"), (F.col("minx") + 0.003).alias("lon1"), (F.col("miny") + 0.004).alias("lat1"))
    lines = v.withColumn("lon2", F.lead("lon1").over(w)).withColumn("lat2", F.lead("lat1").over(w)).where("lon2 is not null")
    return op.in_coastal_band(_points(spark, d), lines, (-76.8, 38.1, -76.1, 38.9), 0.7).select("point_id", F.round("distance", 3).alias("distance"))
