"""Choosing scenes, grouping casts, and work lists."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, Box, boxes_meet, mercator, segment_distance, utm
from ..functions.sensors import MISSIONS, in_lifetime, mission
from ..functions.text import period
from ..sources.shared import written
from .cells import levels_down_to, met_in_cells
from .graph import connected


def scene_filter(meta: DataFrame, sensor: str, bbox: Box, start: str, end: str, max_cloud: float | None = None) -> DataFrame:
    """Scene metadata of a mission by place, date (end excluded) and cloud; a bound of 0 or None doesn't filter (P3, SRC9)."""
    found = meta.where((F.col("sensor") == sensor) & boxes_meet(bbox) & (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
    return found.where(F.col("cloud") <= max_cloud) if max_cloud else found


def best_scenes(meta: DataFrame, by: list[str], samples: int = 1, key: str = "scene_id") -> DataFrame:
    """The least cloudy scenes of each group, then the newest, then the smallest key, with their rank."""
    order = Window.partitionBy(*by).orderBy("cloud", F.desc("time_ms"), key)
    return meta.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= samples)


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


#: What of a point decides which scenes are found for it.
PLACE = ["sensor", "lat", "lon", "date"]


def _scenes_for_places(points: DataFrame, meta: DataFrame, buffer_km: float, days_before: int, days_after: int) -> DataFrame:
    """scenes_for_points() for the distinct places, dates and sensors of points, without point_id."""
    reach = buffer_km / KM_PER_DEGREE
    p = written(points.select(*PLACE).distinct(), "places")
    p = p.withColumn("cm", F.explode(F.sequence(month_number(F.date_sub("date", days_before)), month_number(F.date_add("date", days_after)))))
    s = meta.withColumn("cm", month_number(F.col("date"))).withColumnRenamed("date", "scene_date")
    slack = reach + 1e-9  # rounding may not part what just touches
    extent = (F.col("minx") - slack, F.col("miny") - slack, F.col("maxx") + slack, F.col("maxy") + slack)
    met = met_in_cells(p, s, ["sensor", "cm"], (F.col("lon"), F.col("lat")), extent, 1.0, levels_down_to(1.0, max(reach, 0.05)))
    near = (F.col("minx") <= F.col("lon") + reach) & (F.col("maxx") >= F.col("lon") - reach) & (F.col("miny") <= F.col("lat") + reach) & (F.col("maxy") >= F.col("lat") - reach)
    dates = F.col("scene_date").between(F.date_sub("date", days_before), F.date_add("date", days_after))
    return met.where(near & dates).drop("cm")


def scenes_for_points(points: DataFrame, meta: DataFrame, buffer_km: float, days_before: int, days_after: int, max_cloud: float | None = None) -> DataFrame:
    """Scenes whose footprint meets the box around a point and whose date lies in the window of its date.

    points: point_id, lat, lon, date, sensor. The join is on sensor, cell and month; boxes and dates decide what is
    left. A point lies in one cell, so a pair comes up once; crowded cells are split (operators.cells). Points of the same
    place, date and sensor are looked up once.
    """
    kept = meta.where(F.col("cloud") <= max_cloud) if max_cloud else meta
    return points.select("point_id", *PLACE).join(_scenes_for_places(points, kept, buffer_km, days_before, days_after), PLACE)


def _best_for_points(points: DataFrame, meta: DataFrame, buffer_km: float, days_before: int, days_after: int, max_cloud: float | None = None, samples: int = 1) -> DataFrame:
    """point_id and sensor with the best scenes (scene_id, cloud, scene_date, rank) of scenes_for_points().

    Of scenes with the same box, date and sensor only the best are looked at, as the same points meet them.
    """
    kept = meta.where(F.col("cloud") <= max_cloud) if max_cloud else meta
    kept = best_scenes(kept, ["sensor", "date", "minx", "miny", "maxx", "maxy"], samples).select("scene_id", "sensor", "date", "cloud", "time_ms", "minx", "miny", "maxx", "maxy")
    found = best_scenes(_scenes_for_places(points, written(kept, "kept"), buffer_km, days_before, days_after), PLACE, samples).drop("rank")
    # A point_id that comes up at several places has the best of all of them.
    return best_scenes(points.select("point_id", *PLACE).join(found, PLACE), ["point_id", "sensor"], samples).select("point_id", "sensor", "scene_id", "cloud", "scene_date", "rank")


def pick_for_points(points: DataFrame, meta: DataFrame, buffer_km: float = 1.0, days_before: int = 7, days_after: int = 7, max_cloud: float | None = 30.0, samples: int = 1) -> DataFrame:
    """points with the scenes picked for them; points without a scene stay, with nulls."""
    picked = _best_for_points(points, meta, buffer_km, days_before, days_after, max_cloud, samples)
    return points.join(picked, ["point_id", "sensor"], "left")


def nearest_year(labels: DataFrame, wanted: DataFrame, year: str = "year", order: str = "position") -> DataFrame:
    """For each wanted year (column wanted) the label row of the nearest year, the first listed of equals.

    The first label of every year, of which there are as many as years, makes one list in order of years; a wanted year
    looks at the last entry up to it and the first one after it.
    """
    first = labels.groupBy(year).agg(F.min_by(F.struct(*labels.columns), F.struct(order)).alias("l"), F.min(order).alias("o"))
    listed = first.agg(F.array_sort(F.collect_list(F.struct(F.col(year).alias("y"), "o", "l"))).alias("_all"))
    upto = F.try_element_at(F.filter("_all", lambda x: x["y"] <= F.col("wanted")), F.lit(-1))
    after = F.get(F.filter("_all", lambda x: x["y"] > F.col("wanted")), F.lit(0))
    found = wanted.select("wanted").distinct().join(F.broadcast(listed)).select("wanted", F.when(F.size("_all") > 0, F.col("_all")).alias("_all"))
    found = found.where("_all is not null").select("wanted", F.array_compact(F.array(upto, after)).alias("two"))
    best = F.array_min(F.transform("two", lambda x: F.struct(F.abs(x["y"] - F.col("wanted")).alias("gap"), x["o"].alias("o"), x["y"].alias("y"), x["l"].alias("l"))))
    return found.select("wanted", best.alias("b")).select("wanted", *[F.col(f"b.l.{c}").alias(c) for c in labels.columns])


def coverage_names(names: DataFrame) -> DataFrame:
    """name and year of land-cover coverages: of the lower 48 states, no change products; year is the third token."""
    n = F.col("name")
    ok = n.contains("NLCD") & n.contains("Land_Cover") & n.contains("L48") & ~n.contains("Land_Cover_Change") & ~n.contains("ANLCD")
    year = F.split_part(n, F.lit("_"), F.lit(3)).try_cast("int")
    return names.where(ok).withColumn("year", year).where("year is not null")


def work_list(spark, missions: list[str], lats: list[float], lons: list[float], start: str, end: str, step: int) -> DataFrame:
    """mission, lat, lon, date of a download: places are zipped, missions and dates crossed; Sentinel-2 steps by 7 days."""
    if len(lats) != len(lons):
        raise ValueError("as many latitudes as longitudes are needed")
    return work_for_places(spark.createDataFrame(list(zip(lats, lons, strict=True)), "lat double, lon double"), missions, start, end, step)


def work_for_places(places: DataFrame, missions: list[str], start: str, end: str, step: int) -> DataFrame:
    """mission, lat, lon, date for every row of a table of places."""
    steps = [F.struct(F.lit(mission(m).slug).alias("mission"), F.lit(7 if m == "sentinel-2" else step).alias("step")) for m in missions]
    each = places.select("lat", "lon", F.explode(F.array(*steps)).alias("m")).select("lat", "lon", "m.*")
    dates = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.make_dt_interval(days="step"))
    return each.select("mission", "lat", "lon", F.explode(dates).alias("date"))


def tile_grid(boxes: DataFrame, tiles: int) -> DataFrame:
    """boxes in tiles x tiles parts, rows of tiles from the lower left."""
    out = boxes.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    w, h = (F.col("maxx") - F.col("minx")) / tiles, (F.col("maxy") - F.col("miny")) / tiles
    return out.select(
        *[c for c in boxes.columns if c not in ("minx", "miny", "maxx", "maxy")], "i", "j",
        (F.col("minx") + F.col("j") * w).alias("minx"), (F.col("miny") + F.col("i") * h).alias("miny"),
        (F.col("minx") + (F.col("j") + 1) * w).alias("maxx"), (F.col("miny") + (F.col("i") + 1) * h).alias("maxy"),
    )


def spatial_clusters(points: DataFrame, buffer_m: float, key: str = "point_id") -> DataFrame:
    """points with cluster: the smallest key of the group whose buffers touch, directly or over others.

    Two points link at web-mercator distance up to twice the buffer. Points of a cell whose diagonal is that
    distance are linked by nature, so cells, not points, are the nodes, and only cells at most two apart are compared.
    """
    reach = 2.0 * buffer_m
    side = reach / math.sqrt(2.0)
    x, y = mercator(F.col("lon"), F.col("lat"))
    placed = points.select(key, x.alias("x"), y.alias("y")).withColumn("cx", F.floor(F.col("x") / side)).withColumn("cy", F.floor(F.col("y") / side))
    cells = placed.groupBy("cx", "cy").agg(F.min(key).alias("node"))
    distinct = placed.select("cx", "cy", "x", "y").distinct()
    offsets = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(0, 3) for dy in range(-2, 3) if dx or dy > 0]))
    shifted = distinct.withColumn("o", offsets).select("x", "y", F.col("cx").alias("ax"), F.col("cy").alias("ay"), (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"))
    other = distinct.select("cx", "cy", F.col("x").alias("bx"), F.col("y").alias("by"))
    close = shifted.join(other, ["cx", "cy"]).where(F.pow(F.col("x") - F.col("bx"), 2) + F.pow(F.col("y") - F.col("by"), 2) <= reach * reach)
    links = close.select("ax", "ay", "cx", "cy").distinct()
    links = links.join(cells.select("cx", "cy", F.col("node").alias("b")), ["cx", "cy"]).join(cells.select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("node").alias("a")), ["ax", "ay"])
    found = connected(cells.select("node"), links.select("a", "b"))
    by_cell = cells.join(found, "node").select("cx", "cy", F.col("component").alias("cluster"))
    return points.join(placed.join(by_cell, ["cx", "cy"]).select(key, "cluster"), key)


def cluster_keys(points: DataFrame, buffer_m: float, granularity: str = "M", key: str = "point_id") -> DataFrame:
    """points with cluster_key '<cluster>_<period>' (A10)."""
    return spatial_clusters(points, buffer_m, key).withColumn("cluster_key", F.concat_ws("_", F.col("cluster").cast("string"), period(F.col("date"), granularity)))


def coverage(clustered: DataFrame, meta: DataFrame, missions: list[str], buffer_km: float = 10.0, days_before: int = 7, days_after: int = 7, key: str = "point_id") -> DataFrame:
    """clustered with covered_by: the missions, in their given order, with a scene around the first point of the row's cluster."""
    rep = clustered.groupBy("cluster_key").agg(F.min_by(F.struct("lat", "lon", "date"), key).alias("r"))
    asked = rep.select(F.col("cluster_key").alias("point_id"), "r.*", F.posexplode(F.array(*[F.lit(m) for m in missions])).alias("place", "sensor"))
    asked = asked.where(in_lifetime(F.col("sensor"), F.col("date")))
    asked = written(asked, "asked")
    hit = _scenes_for_places(asked, meta, buffer_km, days_before, days_after).select(*PLACE).distinct()
    lists = asked.join(hit, PLACE).groupBy("point_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sensor"))), lambda s: s["sensor"]).alias("covered_by"))
    out = clustered.join(lists.withColumnRenamed("point_id", "cluster_key"), "cluster_key", "left")
    return out.withColumn("covered_by", F.coalesce("covered_by", F.array().cast("array<string>")))


def cluster_downloads(covered: DataFrame, meta: DataFrame, buffer_km: float = 0.1, max_cloud: float = 20.0, days: int = 7, key: str = "point_id") -> DataFrame:
    """One scene per mission and cluster, found for the cluster's first point that has one; all its rows share it."""
    asked = covered.where(F.size("covered_by") > 0).select(key, "cluster_key", "lat", "lon", "date", F.explode("covered_by").alias("sensor"))
    asked = written(asked, "asked")
    found = _best_for_points(asked.withColumn("point_id", F.col(key)), meta, buffer_km, days, days, max_cloud)
    own = asked.join(found.select(F.col("point_id").alias(key), "sensor", "scene_id"), [key, "sensor"])
    first = own.groupBy("sensor", "cluster_key").agg(F.min_by("scene_id", key).alias("scene_id"))
    return asked.select(key, "cluster_key", "sensor").join(first, ["sensor", "cluster_key"])


def match_casts(casts: DataFrame, meta: DataFrame, missions: list[str] | None = None, buffer_m: float = 10_000.0) -> DataFrame:
    """Casts (point_id, lat, lon, date, salinity) with the missions that cover them; those without any are left out."""
    missions = missions or [m.slug for m in MISSIONS]
    return coverage(cluster_keys(casts, buffer_m), meta, missions).where(F.size("covered_by") > 0)


def align_labels(pixels: DataFrame, labels: DataFrame, x0: float, y0: float, cell: float) -> DataFrame:
    """pixels (x, y of centres) with the label of the grid cell they lie in; labels by (gx, gy) of a grid from (x0, y0) upward."""
    placed = pixels.withColumn("gx", F.floor((F.col("x") - x0) / cell)).withColumn("gy", F.floor((F.col("y") - y0) / cell))
    return placed.join(labels.select("gx", "gy", "label"), ["gx", "gy"], "left")


def stitch(tiles: DataFrame) -> DataFrame:
    """One value per cell of overlapping tiles (tile, row, col, value): the first tile with a value wins, and within it the least value."""
    return tiles.where("value is not null").groupBy("row", "col").agg(F.min_by("value", F.struct("tile", "value")).alias("value"))


def pair_labels(files: DataFrame) -> DataFrame:
    """mosaic and label file names (column name) paired: aligned_cdl_<name> belongs to <name>."""
    mask = files.where(F.col("name").startswith("aligned_cdl_")).select(F.col("name").alias("mask"), F.regexp_replace("name", "^aligned_cdl_", "").alias("name"))
    return files.where(~F.col("name").startswith("aligned_cdl_")).join(mask, "name").select(F.col("name").alias("image"), "mask")


def near_coast(points: DataFrame, segments: DataFrame, buffer_deg: float, cell_deg: float = 0.1) -> DataFrame:
    """points (point_id, lon, lat) with their least distance in degrees to segments (x1, y1, x2, y2), where at most buffer_deg (G8, SRC12).

    Places and segments that come up more than once are compared once. Segments go to the cells that their box, grown by
    the buffer, meets; places to their own; crowded cells are split (operators.cells).
    """
    places, lines = written(points.select("lon", "lat").distinct(), "places"), written(segments.select("x1", "y1", "x2", "y2").distinct(), "segments")
    near = _least_distance(places, lines, ("lon", "lat"), buffer_deg, cell_deg).where(F.col("distance") <= buffer_deg).groupBy("lon", "lat").agg(F.min("distance").alias("distance"))
    return points.select("point_id", "lon", "lat").join(near, ["lon", "lat"]).groupBy("point_id").agg(F.min("distance").alias("distance"))


def _least_distance(places: DataFrame, lines: DataFrame, place: tuple[str, str], reach: float, side: float) -> DataFrame:
    """Places and lines (x1, y1, x2, y2) that a cell brings together, with their distance: all pairs within reach and some more."""
    x, y = (F.col(c) for c in place)
    slack = reach + side * 1e-9  # rounding may not part what is just within reach
    extent = (F.least("x1", "x2") - slack, F.least("y1", "y2") - slack, F.greatest("x1", "x2") + slack, F.greatest("y1", "y2") + slack)
    met = met_in_cells(places, lines, [], (x, y), extent, side, levels_down_to(side, reach))
    return met.withColumn("distance", segment_distance(x, y, *[F.col(c) for c in ("x1", "y1", "x2", "y2")]))


def in_coastal_band(points: DataFrame, segments: DataFrame, box: Box, buffer_km: float = 2.0, offshore_km: float | None = None, cell_m: float = 5000.0) -> DataFrame:
    """point_id and distance in metres of the points (point_id, lon, lat) in the band around coast lines, clipped to a box.

    segments: line, seq and lon1, lat1, lon2, lat2, in order along their line. Distances are in the UTM zone of the box's
    western side. Lines count whose own box meets the box grown by ten kilometres at 111 a degree; none of them: no rows.
    Caps are flat: what lies beyond the open end of a line is outside, bends and closed lines are round.
    The band has one width on both sides; with offshore_km, that is its width to the right of a segment's direction and buffer_km
    that to its left, and by a bend a point may count for either segment. Segments without a line are dropped, points without a place are outside.
    """
    zone = int((box[0] + 180.0) // 6.0) + 1
    inland, offshore = buffer_km * 1000.0, (buffer_km if offshore_km is None else offshore_km) * 1000.0
    reach, margin = max(inland, offshore), 10.0 / KM_PER_DEGREE
    low, high = F.struct(F.min_by("lon1", "seq").alias("x"), F.min_by("lat1", "seq").alias("y")), F.struct(F.max_by("lon2", "seq").alias("x"), F.max_by("lat2", "seq").alias("y"))
    lines = segments.groupBy("line").agg(
        F.min("seq").alias("_first"), F.max("seq").alias("_last"), (low == high).alias("_closed"),
        F.min(F.least("lon1", "lon2")).alias("minx"), F.min(F.least("lat1", "lat2")).alias("miny"),
        F.max(F.greatest("lon1", "lon2")).alias("maxx"), F.max(F.greatest("lat1", "lat2")).alias("maxy"),
    )
    lines = lines.where(boxes_meet((box[0] - margin, box[1] - margin, box[2] + margin, box[3] + margin))).select("line", "_first", "_last", "_closed")
    open1, open2 = F.col("_closed") | (F.col("seq") > F.col("_first")), F.col("_closed") | (F.col("seq") < F.col("_last"))
    # Ends of the same degrees and places of the same degrees are one row each from here on.
    s = segments.join(lines, "line").select("lon1", "lat1", "lon2", "lat2", open1.alias("_round1"), open2.alias("_round2")).distinct()
    (x1, y1), (x2, y2) = utm(F.col("lon1"), F.col("lat1"), zone), utm(F.col("lon2"), F.col("lat2"), zone)
    s = written(s.select(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), "_round1", "_round2"), "segments")
    within = points.where(F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3])).select("point_id", "lon", "lat")
    x, y = utm(F.col("lon"), F.col("lat"), zone)
    p = written(within.select("lon", "lat").distinct().withColumns({"x": x, "y": y}), "places")
    met = _least_distance(p, s, ("x", "y"), reach, cell_m)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ahead = (F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy
    beside = dx * (F.col("y") - F.col("y1")) - dy * (F.col("x") - F.col("x1"))
    capped = (F.col("_round1") | (ahead >= 0)) & (F.col("_round2") | (ahead <= dx * dx + dy * dy))
    near = met.where(capped & (F.col("distance") <= F.when(beside >= 0, inland).otherwise(offshore))).groupBy("lon", "lat").agg(F.min("distance").alias("distance"))
    return within.join(near, ["lon", "lat"]).groupBy("point_id").agg(F.min("distance").alias("distance"))


def regions(pixels: DataFrame) -> DataFrame:
    """pixels (row, col, value) with region: the 4-connected area of equal value, named by its smallest pixel number."""
    numbered = pixels.withColumn("node", F.col("row").cast("long") * (1 << 31) + F.col("col"))
    links = None
    for dr, dc in ((1, 0), (0, 1)):
        shifted = numbered.select((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.col("value").alias("other"), F.col("node").alias("b"))
        found = numbered.join(shifted, ["row", "col"]).where(F.col("value") == F.col("other")).select(F.col("node").alias("a"), "b")
        links = found if links is None else links.union(found)
    labels = connected(numbered.select("node"), links)
    return numbered.join(labels, "node").select(*pixels.columns, F.col("component").alias("region"))
