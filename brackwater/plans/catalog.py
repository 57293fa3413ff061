"""Catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as op
from ..operators import polygons as poly
from ..sources import tables as t
from .registry import query

SCENE = ("scene_id", "sensor", "acquisition_date", "status")
SCENE_SQL = "scene_id, sensor, acquisition_date, status"
BOX = (-76.6, 38.4, -75.9, 39.1)
MEETS = "maxx >= -76.6 and minx <= -75.9 and maxy >= 38.4 and miny <= 39.1"
# Distance of a cast to the nearest point of a scene's box, as in functions.geo.
NEAR_X, NEAR_Y = "least(greatest(c.lon, s.minx), s.maxx)", "least(greatest(c.lat, s.miny), s.maxy)"
HAVERSINE = f"""2 * 6371.0088::double * asin(sqrt(least(1.0::double, pow(sin(radians({NEAR_Y} - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians({NEAR_Y})) * pow(sin(radians({NEAR_X} - c.lon) / 2), 2))))"""


@query(f"select {SCENE_SQL} from scenes where status = 'active' and {MEETS}", "scenes")
def scenes_bbox(spark, d):
    return op.scenes_in_box(t.scenes(spark, d), BOX).select(*SCENE)


@query(
    f"""select {SCENE_SQL} from scenes where maxx >= -76.0 - 40.0::double / 111.0::double and minx <= -76.0 + 40.0::double / 111.0::double
    and maxy >= 38.5 - 40.0::double / 111.0::double and miny <= 38.5 + 40.0::double / 111.0::double
    and sensor = 'landsat-7' and acquisition_date between date '1996-01-01' and date '1999-12-31' and status = 'active'""",
    "scenes",
)
def scenes_radius_filters(spark, d):
    return op.find_scenes(t.scenes(spark, d), lat=38.5, lon=-76.0, radius_km=40.0, sensor="landsat-7", date_from="1996-01-01", date_to="1999-12-31").select(*SCENE)


@query(f"select {SCENE_SQL} from scenes where scene_id = (select min(scene_id) from scenes where scene_key = 7)", "scenes")
def scene_lookup(spark, d):
    found = t.scenes(spark, d)
    key = found.where("scene_key = 7").agg(F.min("scene_id")).first()[0]
    return op.by_key(found, "scene_id", key).select(*SCENE)


@query("select product_id, task, status from runs where base_scene_id = (select min(scene_id) from scenes where scene_key = 12)", "runs")
def scene_products(spark, d):
    key = t.scenes(spark, d).where("scene_key = 12").agg(F.min("scene_id")).first()[0]
    return op.scene_products(t.runs(spark, d), key).select("product_id", "task", "status")


@query("select s.scene_id, s.sensor, r.product_id, r.task, r.status from scenes s join runs r on s.scene_id = r.base_scene_id", "runs")
def scenes_with_products(spark, d):
    s, r = t.scenes(spark, d).select("scene_id", "sensor"), t.runs(spark, d).select("base_scene_id", "product_id", "task", "status")
    return op.scenes_with_products(s, r).select("scene_id", "sensor", "product_id", "task", "status")


@query(
    """select cast_id, sample_date, round(surface_salinity, 6) as surface_salinity from casts where lon between -76.5 and -75.5 and lat between 38.0 and 39.0
    and sample_date between date '1996-01-01' and date '2000-12-31' and surface_salinity >= 0 and surface_salinity <= 20""",
    "casts",
)
def profiles_filter(spark, d):
    found = op.find_casts(t.casts(spark, d), bbox="-76.5,38.0,-75.5,39.0", date_from="1996-01-01", date_to="2000-12-31", min_salinity=0.0, max_salinity=20.0)
    return found.select("cast_id", "sample_date", F.round("surface_salinity", 6).alias("surface_salinity"))


@query("select profile, level, depth_m, round(salinity, 6) as salinity from levels where cast_id = 'CAST_00000007'", "levels")
def depth_profile(spark, d):
    return op.depth_profile(t.levels(spark, d), "CAST_00000007").select("profile", "level", "depth_m", F.round("salinity", 6).alias("salinity"))


@query("select product_id, base_scene_id, task, status from runs where task = 'water_mask' and status = 'complete'", "runs")
def runs_filter(spark, d):
    return op.find_runs(t.runs(spark, d), task="water_mask", status="complete").select("product_id", "base_scene_id", "task", "status")


@query(
    f"""select scene_id, sensor, acquisition_date, round({HAVERSINE}, 4) as distance_km from scenes s, casts c where c.cast_id = 'CAST_00000042' and status = 'active'
    and abs(acquisition_date - sample_date) <= 30 and {HAVERSINE} <= 50""",
    "scenes", "casts",
)
def imagery_near_cast(spark, d):
    found = op.scenes_near_cast(t.scenes(spark, d), t.casts(spark, d), "CAST_00000042", ellipsoid=False)
    return found.select("scene_id", "sensor", "acquisition_date", F.round("distance_km", 4).alias("distance_km"))


@query(
    f"""select c.cast_id, s.scene_id, round({HAVERSINE}, 4) as distance_km from casts c join scenes s on s.acquisition_date between c.sample_date - 5 and c.sample_date + 5
    where s.status = 'active' and {HAVERSINE} <= 20""",
    "scenes", "casts",
)
def imagery_near_all_casts(spark, d):
    found = op.scenes_near_casts(t.scenes(spark, d), t.casts(spark, d), radius_km=20.0, days=5, ellipsoid=False, digits=4)
    return found.select("cast_id", "scene_id", "distance_km")


@query(
    """select scene_id, sensor from scenes s where status = 'active' and not exists (select 1 from runs r where r.base_scene_id = s.scene_id and task = 'water_mask'
    and r.status = 'complete')""",
    "runs",
)
def unprocessed_scenes(spark, d):
    return op.unprocessed_scenes(t.scenes(spark, d), t.runs(spark, d), "water_mask").select("scene_id", "sensor")


@query(
    """select scene_id, sensor from scenes s where status = 'active' and not exists (select 1 from runs r where r.base_scene_id = s.scene_id and task = 'water_mask'
    and r.status = 'complete' and json_extract_string(parameters, '$.k') = '47')""",
    "runs",
)
def unprocessed_scenes_parameters(spark, d):
    return op.unprocessed_scenes(t.scenes(spark, d), t.runs(spark, d), "water_mask", {"k": 47}).select("scene_id", "sensor")


@query("select distinct cast_id from levels l where not exists (select 1 from casts c where c.cast_id = l.cast_id and c.point_id % 3 <> 0)", "levels", "casts")
def fk_violations(spark, d):
    return op.orphans(t.levels(spark, d), "cast_id", t.casts(spark, d).where("point_id % 3 <> 0"), "cast_id").select("cast_id").distinct()


@query("select profile as key, count(*) as n from levels group by profile having count(*) > 1", "levels")
def repeated_keys(spark, d):
    return op.repeated_keys(t.levels(spark, d), "profile").withColumnRenamed("profile", "key")


def _geodesic_sql(rounds: int = 8) -> str:
    """Tables that end in arrived (km): the distance along the ellipsoid from lon, lat to nx, ny of the table near, by the same iteration."""
    f, a = "(1 / 298.257223563::double)", "6378.137::double"
    b = f"({a} * (1 - {f}))"
    keys = "cast_id, scene_id, lon, lat, nx, ny, u1, u2, l"
    parts = [f"r0 as (select *, l as lam from (select *, atan((1 - {f}) * tan(radians(lat))) as u1, atan((1 - {f}) * tan(radians(ny))) as u2, radians(nx - lon) as l from near))"]
    for k in range(rounds + 1):
        parts += [
            f"""p{k} as (select *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) as ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) as cs,
            cos(u1) * cos(u2) * sin(lam) as m from r{k})""",
            f"q{k} as (select *, atan2(ss, cs) as sigma, 1 - sa * sa as ca from (select *, case when ss > 0 then m / ss else 0 end as sa from p{k}))",
            f"w{k} as (select *, case when ca > 1e-15 then cs - 2 * sin(u1) * sin(u2) / ca else 0 end as cm, {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) as c, ca * ({a} * {a} - {b} * {b}) / ({b} * {b}) as sq from q{k})",
        ]
        if k < rounds:
            parts.append(f"r{k + 1} as (select {keys}, l + (1 - c) * {f} * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1))) as lam from w{k})")
    parts.append(
        f"""arrived as (select *, {b} * big * (sigma - small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) as km
        from (select *, 1 + sq / 16384 * (4096 + sq * (-768 + sq * (320 - 175 * sq))) as big, sq / 1024 * (256 + sq * (-128 + sq * (74 - 47 * sq))) as small from w{rounds}))"""
    )
    return ", ".join(parts)


@query(
    f"""with near as (select c.cast_id, s.scene_id, c.lon, c.lat, {NEAR_X} as nx, {NEAR_Y} as ny from casts c join scenes s on s.acquisition_date between c.sample_date - 5 and c.sample_date + 5
    where s.status = 'active' and {HAVERSINE} <= 20.2), {_geodesic_sql()} select cast_id, scene_id, round(km, 4) as distance_km from arrived where km <= 20""",
    "scenes", "casts",
)
def imagery_near_all_casts_ellipsoid(spark, d):
    """Distances along the ellipsoid."""
    found = op.scenes_near_casts(t.scenes(spark, d), t.casts(spark, d), radius_km=20.0, days=5, digits=4)
    return found.select("cast_id", "scene_id", "distance_km")


#: Rings around a place, in steps of the polygon's size: a shape with a notch, and a hole in it.
RING = ((0.0, -1.0), (1.0, -1.0), (1.0, 1.0), (0.25, 0.125), (-0.5, 1.0), (-1.0, -0.375), (0.0, -1.0))
HOLE = ((0.25, -0.625), (0.625, -0.625), (0.625, -0.25), (0.25, -0.25), (0.25, -0.625))
SIDES = [(a, z) for ring in (RING, HOLE) for a, z in zip(ring, ring[1:], strict=False)]
AREAS = f"""areas as (select point_id as area_id, lon as ax, lat as ay, 0.03125::double + (point_id % 7) * 0.015625::double as size from casts where point_id % 10 = 3),
    sides as (select area_id, ax + a * size as x1, ay + b * size as y1, ax + c * size as x2, ay + d * size as y2 from areas, (values {", ".join(f"({a[0]}::double, {a[1]}::double, {z[0]}::double, {z[1]}::double)" for a, z in SIDES)}) v(a, b, c, d)),
    spans as (select area_id, list({{x1: x1, y1: y1, x2: x2, y2: y2}}) as sides, min(x1) as x0, max(x1) as x9, min(y1) as y0, max(y1) as y9 from sides group by area_id)"""
CROSSED = "len(list_filter(sides, lambda s: (s.y1 > {y}) <> (s.y2 > {y}) and {x} < s.x1 + (s.x2 - s.x1) * ({y} - s.y1) / (s.y2 - s.y1))) % 2 = 1"
TOUCHED = """len(list_filter(sides, lambda s: (s.x2 - s.x1) * ({y} - s.y1) = (s.y2 - s.y1) * ({x} - s.x1) and {x} between least(s.x1, s.x2) and greatest(s.x1, s.x2)
    and {y} between least(s.y1, s.y2) and greatest(s.y1, s.y2))) > 0"""
INSIDE = f"({CROSSED} or {TOUCHED})"


def _areas(spark, d):
    """Polygons with holes as WKT around every tenth cast."""
    c = t.casts(spark, d).where("point_id % 10 = 3")
    size = F.lit(0.03125) + (F.col("point_id") % 7) * F.lit(0.015625)
    rings = [F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", (F.col("lon") + a * size).cast("string"), (F.col("lat") + b * size).cast("string")) for a, b in ring]), F.lit(")")) for ring in (RING, HOLE)]
    return c.select(F.col("point_id").alias("area_id"), poly.polygon_rings(F.concat(F.lit("POLYGON("), F.concat_ws(", ", *rings), F.lit(")"))).alias("rings"))


@query(
    f"""with {AREAS} select cast_id, area_id from casts c join spans p on lon between x0 and x9 and lat between y0 and y9 where {INSIDE.format(x="lon", y="lat")}""",
    "casts",
)
def casts_in_polygons(spark, d):
    """Casts within polygons with notches and holes."""
    return poly.points_in_polygons(t.casts(spark, d).select("cast_id", "lon", "lat"), _areas(spark, d), "cast_id", "area_id").select("cast_id", "area_id")


@query(
    f"""with {AREAS} select scene_id, area_id from scenes b join spans p on maxx >= x0 and minx <= x9 and maxy >= y0 and miny <= y9
    where b.status = 'active' and b.acquisition_date < date '1996-01-01' and ({INSIDE.format(x="minx", y="miny")}
    or len(list_filter(sides, lambda s: least(s.x1, s.x2) <= maxx and greatest(s.x1, s.x2) >= minx and least(s.y1, s.y2) <= maxy and greatest(s.y1, s.y2) >= miny
        and least({", ".join(f"(s.x2 - s.x1) * ({y} - s.y1) - (s.y2 - s.y1) * ({x} - s.x1)" for x in ("minx", "maxx") for y in ("miny", "maxy"))}) <= 0
        and greatest({", ".join(f"(s.x2 - s.x1) * ({y} - s.y1) - (s.y2 - s.y1) * ({x} - s.x1)" for x in ("minx", "maxx") for y in ("miny", "maxy"))}) >= 0)) > 0)""",
    "casts", "scenes",
)
def scenes_meeting_polygons(spark, d):
    """Active scenes before 1996 whose footprint meets a polygon."""
    found = t.scenes(spark, d).where("status = 'active' and acquisition_date < date'1996-01-01'").select("scene_id", "minx", "miny", "maxx", "maxy")
    return poly.boxes_meeting_polygons(found, _areas(spark, d), "scene_id", "area_id").select("scene_id", "area_id")


SHORE = ((-77.0, 38.0), (-75.75, 38.25), (-75.5, 39.5), (-76.25, 38.75), (-77.0, 39.25))
SHORE_SQL = ", ".join(f"{{x1: {a[0]}::double, y1: {a[1]}::double, x2: {z[0]}::double, y2: {z[1]}::double}}" for a, z in zip(SHORE, SHORE[1:] + SHORE[:1], strict=True))


@query(
    f"""with spans as (select [{SHORE_SQL}] as sides) select {SCENE_SQL} from scenes, spans where status = 'active' and ({INSIDE.format(x="minx", y="miny")}
    or len(list_filter(sides, lambda s: least(s.x1, s.x2) <= maxx and greatest(s.x1, s.x2) >= minx and least(s.y1, s.y2) <= maxy and greatest(s.y1, s.y2) >= miny
        and least({", ".join(f"(s.x2 - s.x1) * ({y} - s.y1) - (s.y2 - s.y1) * ({x} - s.x1)" for x in ("minx", "maxx") for y in ("miny", "maxy"))}) <= 0
        and greatest({", ".join(f"(s.x2 - s.x1) * ({y} - s.y1) - (s.y2 - s.y1) * ({x} - s.x1)" for x in ("minx", "maxx") for y in ("miny", "maxy"))}) >= 0)) > 0)""",
    "scenes",
)
def scenes_polygon(spark, d):
    """Active scenes that meet a drawn area."""
    wkt = "POLYGON((" + ", ".join(f"{x} {y}" for x, y in (*SHORE, SHORE[0])) + "))"
    return poly.scenes_in_polygon(t.scenes(spark, d), wkt).select(*SCENE)
