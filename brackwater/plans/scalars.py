"""Scalar functions, index algebra and small relational operators, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands as b
from ..functions import geo
from ..functions import text as s
from ..operators import casts as op_casts
from ..operators import ingest as op_ingest
from ..operators import outlines
from ..operators import select as op
from ..sources import tables as t
from ..sources.shared import written
from .registry import query

ALIAS_PATHS = "paths as (select scene_id, case scene_key % 4 when 0 then 'Sentinel2/x_' when 1 then 'lt05/s2_' when 2 then 'a/LE07_' else 'b/other_' end || scene_id || '.tif' as path from scenes)"


@query(
    f"""with {ALIAS_PATHS}, split as (select scene_id, path, lower(split_part(path, '/', 1)) as parent, lower(replace(split_part(path, '/', 2), '.tif', '')) as stem from paths)
    select scene_id, case when regexp_matches(parent, 'sentinel-2|sentinel2|s2') then 'sentinel-2' when regexp_matches(parent, 'landsat-5|landsat5|lt05') then 'landsat-5' when regexp_matches(parent, 'landsat-7|landsat7|le07') then 'landsat-7'
    when regexp_matches(stem, 'sentinel-2|sentinel2|s2') then 'sentinel-2' when regexp_matches(stem, 'landsat-5|landsat5|lt05') then 'landsat-5' when regexp_matches(stem, 'landsat-7|landsat7|le07') then 'landsat-7'
    else split_part(stem, '_', 1) end as mission from split""",
    "scenes",
)
def mission_alias(spark, d):
    sc = t.scenes(spark, d)
    head = t.pick(F.pmod("scene_key", F.lit(4)), "Sentinel2/x_", "lt05/s2_", "a/LE07_", "b/other_")
    return sc.select("scene_id", s.mission_from_alias(F.concat(head, "scene_id", F.lit(".tif"))).alias("mission"))


@query(
    """select scene_key, case when year(day) between 1900 and 2100 then day end as day from (select scene_key, try_strptime(regexp_extract(name, '(\\d{8})', 1), '%Y%m%d')::date as day
    from (select scene_key, 'm_' || case when scene_key % 5 = 0 then '20001301' else strftime(acquisition_date, '%Y%m%d') end || '_19990101' as name from scenes))""",
    "scenes",
)
def first_date(spark, d):
    name = F.concat(F.lit("m_"), F.when(F.col("scene_key") % 5 == 0, "20001301").otherwise(F.date_format("acquisition_date", "yyyyMMdd")), F.lit("_19990101"))
    return t.scenes(spark, d).select("scene_key", s.first_date(name).alias("day"))


@query(
    """select scene_id, concat_ws('/', 'imagery/raw', scene_id, sensor, scene_id || '.tif') as raw, concat_ws('/', 'imagery/processed', scene_id, 'water_mask', 'mask.tif') as processed,
    case when scene_key % 2 = 0 then scene_id || '/a.tif' end as name from scenes""",
    "scenes",
)
def blob_paths(spark, d):
    uri = F.concat(F.when(F.col("scene_key") % 2 == 0, "gs://one/").otherwise("gs://other/"), "scene_id", F.lit("/a.tif"))
    name = F.concat("scene_id", F.lit(".tif"))
    return t.scenes(spark, d).select("scene_id", s.raw_blob(F.col("scene_id"), F.col("sensor"), name).alias("raw"), s.processed_blob(F.col("scene_id"), F.lit("water_mask"), F.lit("mask.tif")).alias("processed"), s.blob_name(uri, "one").alias("name"))


@query(
    """select scene_id, (maxx - minx) as width, array_to_string(list_filter([trim(x) for x in string_split(' ' || sensor || ' , ,' || status, ',')], lambda x: x <> ''), '|') as items,
    regexp_replace(sensor || '_' || scene_id, '^(sentinel-2|landsat-5|landsat-7|landsat-8)_', '') as bare from scenes""",
    "scenes",
)
def text_lists(spark, d):
    items = s.comma_list(F.concat(F.lit(" "), "sensor", F.lit(" , ,"), "status"))
    return t.scenes(spark, d).select("scene_id", (F.col("maxx") - F.col("minx")).alias("width"), F.concat_ws("|", items).alias("items"), s.strip_mission_prefix(F.concat_ws("_", "sensor", "scene_id")).alias("bare"))


@query("select scene_key, minx + 0 as x0, maxy + 0 as y1, 4 as corners, scene_key % 2 = 0 as boxed from scenes", "scenes")
def wkt_round_trip(spark, d):
    """Boxes written as WKT and read again, and 'a,b,c,d' boxes of which every second lacks a number."""
    wkt = geo.box_wkt(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")])
    text = F.concat_ws(",", "minx", "miny", "maxx", F.when(F.col("scene_key") % 2 == 0, F.col("maxy").cast("string")))
    read = t.spread(t.scenes(spark, d)).select("scene_key", geo.wkt_points(wkt).alias("points"), s.parse_box(text).isNotNull().alias("boxed"))
    corners = F.size(F.array_distinct("points"))
    return read.select("scene_key", F.array_min("points.x").alias("x0"), F.array_max("points.y").alias("y1"), corners.alias("corners"), "boxed")


@query(
    """select cast_id, sample_date - 7 as first, sample_date + 7 as last, strftime(sample_date, '%Y-%m') as month, strftime(sample_date, '%Y') as year,
    case when point_id % 4 <> 0 then printf('%04d-%02d-%02d', 1990 + point_id % 40, point_id % 13, point_id % 32) end as iso, len(generate_series(sample_date::timestamp, sample_date::timestamp + interval 30 day, interval 7 day))::int as steps,
    (epoch_ms(date '1970-01-01' + (point_id % 20000)::int)::bigint // 86400000)::int as epoch_day from casts""",
    "casts",
)
def date_functions(spark, d):
    first, last = s.date_window(F.col("sample_date"), 7, 7)
    key = F.col("point_id")
    year = F.when(key % 4 != 0, 1990 + key % 40).otherwise(0)
    day = s.date_of_millis(F.pmod(key, F.lit(20000)) * 86_400_000 + 3_600_000)
    steps = F.size(s.days_between(F.col("sample_date"), F.date_add("sample_date", 30), 7))
    return t.casts(spark, d).select("cast_id", first.alias("first"), last.alias("last"), s.period(F.col("sample_date")).alias("month"), s.period(F.col("sample_date"), "Y").alias("year"),
                                    s.iso_date(year, key % 13, key % 32).alias("iso"), steps.alias("steps"), F.date_diff(day, F.lit("1970-01-01").cast("date")).alias("epoch_day"))


@query("select cast_id, round(radians(lon) * 6378137.0::double, 2) as x, round(ln(tan(3.141592653589793::double / 4 + radians(lat) / 2)) * 6378137.0::double, 2) as y, round(lon, 9) as lon, round(lat, 9) as lat from casts", "casts")
def mercator_round_trip(spark, d):
    x, y = geo.mercator(F.col("lon"), F.col("lat"))
    c = t.casts(spark, d).select("cast_id", x.alias("mx"), y.alias("my"))
    lon, lat = geo.unmercator(F.col("mx"), F.col("my"))
    return c.select("cast_id", F.round("mx", 2).alias("x"), F.round("my", 2).alias("y"), F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query(
    """select scene, row, col, year, col as turned_row, 99 - row as turned_col, 99 - col as flipped, (case when (row - 50) % 38 < 0 then (row - 50) % 38 + 38 else (row - 50) % 38 end) as folded,
    green = 0 and nir = 0 as empty, case when nir > 10000 then 255 else 0 end as shown, (case when red >= green and red >= blue then 0 when green >= blue then 1 else 2 end) as best from pixels""",
    "pixels",
)
def index_algebra(spark, d):
    row, col = F.col("row"), F.col("col")
    tr, tc = b.rotate90(row, col, 100)
    px = t.pixels(spark, d)
    folded = F.pmod(row - 50, F.lit(38))
    same = F.when(b.reflect_index(row - 50, 20) == F.when(folded < 20, folded).otherwise(38 - folded), folded)
    return px.select("scene", "row", "col", "year", tr.alias("turned_row"), tc.alias("turned_col"), b.flip(col, 100).alias("flipped"), same.alias("folded"), b.no_data(F.col("green"), F.col("nir")).alias("empty"),
                     b.preview(b.binarise(F.col("nir") > 10000, True)).alias("shown"), b.argmax(F.array("red", "green", "blue")).alias("best"))


@query("select scene, row, col, year, round(case when top > 255 then red / 65535.0::double when top > 1 then red / 255.0::double else red end, 9) as scaled from (select *, max(red) over (partition by scene) as top from pixels)", "pixels")
def unit_scale(spark, d):
    px = t.pixels(spark, d)
    top = px.groupBy("scene").agg(F.max("red").alias("top"))
    return px.join(top, "scene").select("scene", "row", "col", "year", F.round(b.unit_scale(F.col("red"), F.col("top")), 9).alias("scaled"))


@query("select scene_id || '.tif' as image, 'aligned_cdl_' || scene_id || '.tif' as mask from scenes where scene_key % 3 = 0", "scenes")
def label_pairs(spark, d):
    sc = t.scenes(spark, d)
    names = sc.select(F.concat("scene_id", F.lit(".tif")).alias("name")).union(sc.where("scene_key % 3 = 0").select(F.concat(F.lit("aligned_cdl_"), "scene_id", F.lit(".tif"))))
    return op.pair_labels(names)


PROFILES = """lv as (select l_orderkey as k, list(struct_pack(d := l_quantity / 10.0::double, s := l_extendedprice / 3000.0::double) order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as v from lineitem group by l_orderkey)"""


@query(
    f"""with {PROFILES} select 'F_' || lpad(k::varchar, 6, '0') as cast_id, round(list_filter(v, lambda x: x.d <= 1)[1].s, 6) as salinity, printf('%04d-%02d-%02d', 2000 + k % 20, k % 12 + 1, k % 28 + 1) as date,
    list_max([x.d for x in v]) as max_depth from lv where len(list_filter(v, lambda x: x.d <= 1)) > 0""",
)
def profile_truth(spark, d):
    li = t.read(spark, d, "lineitem")
    lv = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    rows = li.groupBy(F.col("l_orderkey").alias("prof_idx")).agg(F.array_sort(F.collect_list(lv)).alias("v"))
    key = F.col("prof_idx")
    info = F.array(F.lit(0.0), *[x.cast("double") for x in (2000 + key % 20, key % 12 + 1, key % 28 + 1)], F.lit(38.5), F.lit(-76.0))
    profiles = rows.select(F.lit("F.nc").alias("source_file"), "prof_idx", info.alias("info"), F.transform("v", lambda x: x["l_quantity"] / 10.0).alias("depth"), F.transform("v", lambda x: x["l_extendedprice"] / 3000.0).alias("salinity"), F.transform("v", lambda x: F.lit(None).cast("double")).alias("temperature"))
    return op_casts.truth_from_profiles(profiles).select("cast_id", F.round("salinity", 6).alias("salinity"), "date", "max_depth")


@query("select cast_id, level, depth_m, case when cast_id < 'CAST_00000050' then depth_m + 10 end as temperature from (select cast_id, unnest([0.5::double, 1.0::double, max_depth + 1.0::double]) as depth_m, unnest([0, 1, 2])::int as level from casts)", "casts")
def depth_rows(spark, d):
    c = t.casts(spark, d).select("cast_id", F.array(F.lit(0.5), F.lit(1.0), F.col("max_depth") + 1).alias("depths"))
    c = c.withColumn("salinities", F.transform("depths", lambda x: x * 2)).withColumn("temperatures", F.when(F.col("cast_id") < "CAST_00000050", F.transform("depths", lambda x: x + 10)))
    return op_ingest.depth_rows(c).select("cast_id", "level", "depth_m", "temperature")


@query(None)
def raster_regions(spark, d):
    """All pixels of the raster. Recursive SQL lists every pair of pixels of a region, so a test compares regions with a plain flood fill instead."""
    px = t.pixels(spark, d).groupBy("row", "col").agg((F.max("green") > 9000).cast("int").alias("value"))
    return op.regions(px).select("row", "col", "value", "region")


#: Bits say which of the four pixels around a corner have a value. One or three of them make a corner, two across a corner make two;
#: a quarter of ones, less threes, and twice those across is the Euler number of the pixels joined by their sides.
QUADS = """px as (select row, col, (max(green) > 9000)::int as value from pixels group by row, col),
    quads as (select value, x, y, sum(bit) as bits from (select value, unnest([col, col + 1, col, col + 1]) as x, unnest([row, row, row + 1, row + 1]) as y, unnest([8, 4, 2, 1]) as bit from px) group by value, x, y),
    kinds as (select value, count(*) filter (where bits in (1, 2, 4, 8)) as ones, count(*) filter (where bits in (7, 11, 13, 14)) as threes, count(*) filter (where bits in (6, 9)) as across from quads group by value),
    sides as (select p.value, count(*) filter (where q.value is distinct from p.value) as perimeter from (select row, col, value, unnest([0, 0, 1, -1]) as dr, unnest([1, -1, 0, 0]) as dc from px) p
        left join px q on q.row = p.row + p.dr and q.col = p.col + p.dc group by p.value)"""


@query(
    f"""with {QUADS} select value, (ones - threes + 2 * across) // 4 as euler, ones + threes + 2 * across as corners, perimeter,
    (select count(*) from px where px.value = kinds.value) as area from kinds join sides using (value)""",
    "pixels",
)
def region_outlines(spark, d):
    px = t.pixels(spark, d).groupBy("row", "col").agg((F.max("green") > 9000).cast("int").alias("value"))
    labelled = written(op.regions(px))
    values = labelled.select("region", "value").distinct()
    corners = written(outlines.ring_corners(labelled))
    # Rings are simple, so holes that meet at a corner are two; the Euler number has them as one.
    twice = corners.groupBy("region", "x", "y").agg(F.count("*").alias("n")).groupBy("region").agg(F.sum(F.col("n") - 1).alias("touching"))
    signed = F.sum(F.when(F.col("hole"), -1).otherwise(1)).alias("outer_less_holes")
    found = outlines.rings(corners).groupBy("region").agg(signed, *[F.sum(n).alias(n) for n in ("corners", "perimeter", "area")])
    whole = found.join(twice, "region").join(values, "region").withColumn("euler", F.col("outer_less_holes") + F.col("touching"))
    return whole.groupBy("value").agg(*[F.sum(n).alias(n) for n in ("euler", "corners", "perimeter", "area")])


@query("select event_id, user_id from events where json_extract_string(props, '$.k')::int < 50 and user_id % 5 = 3 and event_type in ('view', 'click')")
def json_containment(spark, d):
    """Events whose nested properties hold a list's values, a key with a dot and a null."""
    e = t.read(spark, d, "events")
    low = F.get_json_object("props", "$.k").cast("int") < 50
    body = F.concat(
        F.lit('{"seen": [{"type": "'), F.when(F.col("event_type").isin("view", "click"), "look").otherwise("act"), F.lit('", "low": '), low.cast("string"), F.lit("}, "),
        (F.col("user_id") % 5).cast("string"), F.lit('], "by.user": {"id": '), F.col("user_id").cast("string"), F.lit(', "gone": null}}'),
    )
    asked = {"seen": [3, {"type": "look", "low": True}], "by.user": {"gone": None}}
    return e.withColumn("body", body).where(s.contains_json(F.col("body"), asked)).select("event_id", "user_id")
