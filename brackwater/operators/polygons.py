"""Points and boxes against polygons (J3, P1, P12, SRC13): an equi-join on the cells of polygons' covers.

A polygon is an array of rings, holes and further parts included; a place is inside if a ray from it
crosses the rings an odd number of times, and on a ring counts as inside. A polygon's cover has its edge
cells, which a segment touches, and its inner cells, found row by row between the crossings of the row's
middle. What falls into an inner cell is inside without a look at the polygon; in an edge cell the segments
of the cell's row decide, since a level ray meets no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: A polygon's rings: array<array<struct<x: double, y: double>>>, first and last places equal.
RINGS = "array<array<struct<x:double,y:double>>>"


def polygon_rings(wkt: Column) -> Column:
    """The rings of a WKT polygon or multipolygon, holes included; none for anything else."""
    number = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    rings = F.transform(texts, lambda t: F.transform(F.regexp_extract_all(t, F.lit(rf"({number}\s+{number})"), F.lit(1)), lambda p: F.split(p, r"\s+")))
    places = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y"))))
    return F.when(F.upper(F.ltrim(wkt)).rlike("^(MULTI)?POLYGON"), places)


def segments(polygons: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """key, x1, y1, x2, y2 of the segments of all rings; rings that don't end where they start are closed, segments without length dropped."""
    ring = polygons.select(F.col(key).alias("_key"), F.explode(rings).alias("r")).where("size(r) > 1")
    ends = F.transform("r", lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.get("r", F.pmod(i + 1, F.size("r")))["x"].alias("x2"), F.get("r", F.pmod(i + 1, F.size("r")))["y"].alias("y2")))
    return ring.select("_key", F.explode(ends).alias("s")).select("_key", "s.*").where("x1 <> x2 or y1 <> y2")


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size)


def cover(polygons: DataFrame, key: str, cell_deg: float, rings: str = "rings") -> DataFrame:
    """Cells of each polygon: _key, cx, cy and row, the segments (y1, y2, x1, x2) that meet the cell's row; null in inner cells.

    A segment goes to the columns it spans and in each to the rows that its part there spans, so its cells grow
    with its length. A row's crossings are those of one polygon: nothing else is gathered.
    """
    lines = segments(polygons, key, rings)
    x0, x1 = F.least("x1", "x2"), F.greatest("x1", "x2")
    by_column = lines.withColumn("cx", F.explode(F.sequence(_cell(x0, cell_deg), _cell(x1, cell_deg))))

    def height(x: Column) -> Column:
        """Where a segment is at x, within its ends."""
        t = F.when(F.col("x1") != F.col("x2"), (x - F.col("x1")) / (F.col("x2") - F.col("x1")))
        return F.col("y1") + (F.col("y2") - F.col("y1")) * F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))

    low, high = height(F.col("cx") * cell_deg), height((F.col("cx") + 1) * cell_deg)
    upright = F.col("x1") == F.col("x2")
    # A billionth of a cell on either side: rounding may not take a touched cell away; a cell too many only costs a look.
    bottom = _cell(F.when(upright, F.least("y1", "y2")).otherwise(F.least(low, high)) - cell_deg * 1e-9, cell_deg)
    top = _cell(F.when(upright, F.greatest("y1", "y2")).otherwise(F.greatest(low, high)) + cell_deg * 1e-9, cell_deg)
    edges = by_column.select("_key", "cx", F.explode(F.sequence(bottom, top)).alias("cy"))
    beside = F.when(_cell(x0 - cell_deg * 1e-9, cell_deg) < _cell(x0, cell_deg), 1).otherwise(0)
    left = by_column.where((F.col("cx") == _cell(x0, cell_deg)) & (beside == 1)).select("_key", (F.col("cx") - 1).alias("cx"), F.explode(F.sequence(bottom, top)).alias("cy"))
    edges = edges.union(left).distinct()

    y0, y1 = F.least("y1", "y2"), F.greatest("y1", "y2")
    by_row = lines.withColumn("cy", F.explode(F.sequence(_cell(y0 - cell_deg * 1e-9, cell_deg), _cell(y1 + cell_deg * 1e-9, cell_deg))))
    middle = (F.col("cy") + 0.5) * cell_deg
    crossing = F.when((F.col("y1") > middle) != (F.col("y2") > middle), F.col("x1") + (F.col("x2") - F.col("x1")) * (middle - F.col("y1")) / (F.col("y2") - F.col("y1")))
    rows = by_row.groupBy("_key", "cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("row"), F.sort_array(F.collect_list(crossing)).alias("at"))
    # Between the first and second crossing, the third and fourth and so on: the cells whose middle is there, edge cells apart.
    start = F.ceil(F.get("at", 2 * F.col("i")) / cell_deg - 0.5)
    stop = F.floor(F.get("at", 2 * F.col("i") + 1) / cell_deg - 0.5)
    spans = rows.where("size(at) > 1").withColumn("i", F.explode(F.sequence(F.lit(0), (F.size("at") / 2).cast("int") - 1))).select("_key", "cy", start.alias("a"), stop.alias("z")).where("a <= z")
    inner = spans.select("_key", F.explode(F.sequence("a", "z")).alias("cx"), "cy").join(edges, ["_key", "cx", "cy"], "left_anti")
    empty = F.lit(None).cast(rows.schema["row"].dataType)
    return edges.join(rows.select("_key", "cy", "row"), ["_key", "cy"]).select("_key", "cx", "cy", "row").union(inner.select("_key", "cx", "cy", empty.alias("row")))


def _on(x: Column, y: Column, s: Column) -> Column:
    across = (s["x2"] - s["x1"]) * (y - s["y1"]) == (s["y2"] - s["y1"]) * (x - s["x1"])
    return across & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))


def inside(x: Column, y: Column, row: Column) -> Column:
    """Whether a place is in the polygon whose segments that can meet the place's level ray are in row."""
    crossed = F.aggregate(
        row, F.lit(0),
        lambda n, s: n + ((s["y1"] > y) != (s["y2"] > y)).cast("int") * F.when((s["y1"] > y) != (s["y2"] > y), (x < s["x1"] + (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"])).cast("int")).otherwise(0),
    )
    return (crossed % 2 == 1) | F.exists(row, lambda s: _on(x, y, s))


def _meets_box(s: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether a segment touches a box: their bounds meet, and the box's corners are not all on one side of the line."""
    side = [(s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"]) for x in (minx, maxx) for y in (miny, maxy)]
    bounds = (F.least(s["x1"], s["x2"]) <= maxx) & (F.greatest(s["x1"], s["x2"]) >= minx) & (F.least(s["y1"], s["y2"]) <= maxy) & (F.greatest(s["y1"], s["y2"]) >= miny)
    return bounds & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)


def _shapes(polygons: DataFrame, key: str, rings: str) -> tuple[DataFrame, DataFrame]:
    """Shapes (_shape, rings), one for all polygons with the same rings, and the polygons (_area, _shape) that have them. Rows of one key are one polygon."""
    whole = polygons.where(F.col(rings).isNotNull()).groupBy(F.col(key).alias("_area")).agg(F.sort_array(F.flatten(F.collect_list(rings))).alias("rings"))
    whole = written(whole, "polygons")
    shapes = written(whole.groupBy("rings").agg(F.struct(F.min("_area").alias("area")).alias("_shape")), "shapes")
    return shapes, whole.join(shapes, "rings").select("_area", "_shape")


def points_in_polygons(points: DataFrame, polygons: DataFrame, point_key: str, polygon_key: str, x: str = "lon", y: str = "lat", rings: str = "rings", cell_deg: float = 0.05) -> DataFrame:
    """(point_key, polygon_key) of the points in each polygon, points on its rings included. Null places and polygons without rings match nothing.

    Places and shapes that come up more than once are compared once.
    """
    shapes, areas = _shapes(polygons, polygon_key, rings)
    own = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(point_key).alias("_point"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    places = own.select("_x", "_y").distinct().withColumns({"cx": _cell(F.col("_x"), cell_deg), "cy": _cell(F.col("_y"), cell_deg)})
    met = places.join(cover(shapes, "_shape", cell_deg), ["cx", "cy"])
    hits = met.where(F.col("row").isNull() | inside(F.col("_x"), F.col("_y"), F.col("row"))).select("_x", "_y", F.col("_key").alias("_shape"))
    hits = written(hits, "hits").join(areas, "_shape").select("_x", "_y", "_area")
    return own.join(hits, ["_x", "_y"]).select(F.col("_point").alias(point_key), F.col("_area").alias(polygon_key))


def boxes_meeting_polygons(
    boxes: DataFrame, polygons: DataFrame, box_key: str, polygon_key: str, box: tuple[str, str, str, str] = ("minx", "miny", "maxx", "maxy"), rings: str = "rings", cell_deg: float = 0.05
) -> DataFrame:
    """(box_key, polygon_key) of the boxes that meet each polygon, each pair once; touching counts.

    A box goes to the cells it touches. In an edge cell it meets the polygon if a segment of the row touches
    it, or if the corner of what box and cell share is inside: without a segment, all of that is on one side.
    Boxes and shapes that come up more than once are compared once. Only keys with several boxes can give a pair twice.
    """
    shapes, areas = _shapes(polygons, polygon_key, rings)
    names = [f"_b{i}" for i in range(4)]
    b = [F.col(n) for n in names]
    own = boxes.select(F.col(box_key).alias("_box"), *[F.col(c).alias(n) for c, n in zip(box, names, strict=True)])
    cells = own.select(*names).distinct().withColumn("cx", F.explode(F.sequence(_cell(b[0], cell_deg), _cell(b[2], cell_deg))))
    cells = cells.withColumn("cy", F.explode(F.sequence(_cell(b[1], cell_deg), _cell(b[3], cell_deg))))
    met = cells.join(cover(shapes, "_shape", cell_deg), ["cx", "cy"])
    corner = F.greatest(b[0], F.col("cx") * cell_deg), F.greatest(b[1], F.col("cy") * cell_deg)
    hit = F.col("row").isNull() | F.exists("row", lambda s: _meets_box(s, *b)) | inside(*corner, F.col("row"))
    hits = written(met.where(hit).select(*names, F.col("_key").alias("_shape")).distinct(), "hits").join(areas, "_shape").select(*names, "_area")
    again = written(own.groupBy("_box").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("_box").alias("_again"), F.lit(True).alias("_several")), "again")
    if again.isEmpty():
        return own.join(hits, names).select(F.col("_box").alias(box_key), F.col("_area").alias(polygon_key))
    out = own.join(again, F.col("_box").eqNullSafe(F.col("_again")), "left").join(hits, names).select(F.col("_box").alias(box_key), F.col("_area").alias(polygon_key), "_several")
    return out.where("_several is null").union(out.where("_several").distinct()).drop("_several")


def scenes_in_polygon(scenes: DataFrame, wkt: str, cell_deg: float = 0.05) -> DataFrame:
    """Active scenes whose footprint meets a WKT polygon (P1). Its bounds reach the scan."""
    area = scenes.sparkSession.range(1).select(F.lit(0).alias("area"), polygon_rings(F.lit(wkt)).alias("rings"))
    places = area.select(F.explode(F.flatten("rings")).alias("p")).agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first()
    if None in tuple(places):
        raise ValueError(f"not a polygon: {wkt}")
    near = scenes.where((F.col("status") == "active") & (F.col("maxx") >= places[0]) & (F.col("maxy") >= places[1]) & (F.col("minx") <= places[2]) & (F.col("miny") <= places[3]))
    return near.join(boxes_meeting_polygons(near, area, "scene_id", "area", cell_deg=cell_deg).select("scene_id"), "scene_id", "left_semi")
