"""Polygons: covers, holes, places on rings, boxes, and image checks with missing values."""

import json
import random

import pytest
from pyspark.sql import functions as F

from brackwater.operators import metrics, polygons
from brackwater.sources import readers

#: A square with a square hole, and a second part.
HOLED = "MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1)), ((10 10, 11 10, 10.5 11, 10 10)))"


@pytest.fixture(scope="module")
def area(spark):
    return spark.createDataFrame([("a", HOLED), ("line", "LINESTRING(0 0, 9 9)"), ("none", None), ("empty", "POLYGON EMPTY")], "area string, wkt string").withColumn("rings", polygons.polygon_rings(F.col("wkt")))


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_points_and_rings(spark, area, cell):
    cases = [("in", 0.5, 0.5), ("hole", 2.0, 2.0), ("ring", 4.0, 2.0), ("corner", 0.0, 0.0), ("on hole", 1.0, 2.0), ("out", 5.0, 2.0), ("second", 10.5, 10.2), ("below", -0.1, 0.5), ("null", None, 1.0)]
    points = spark.createDataFrame(cases, "name string, lon double, lat double")
    got = {tuple(r) for r in polygons.points_in_polygons(points, area, "name", "area", cell_deg=cell).collect()}
    assert got == {(n, "a") for n in ("in", "ring", "corner", "on hole", "second")}


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_boxes(spark, area, cell):
    cases = [("around", -1.0, -1.0, 12.0, 12.0), ("in hole", 1.5, 1.5, 2.5, 2.5), ("over hole", 0.5, 1.5, 2.0, 2.0), ("inside", 0.2, 0.2, 0.4, 0.4), ("apart", 6.0, 6.0, 7.0, 7.0), ("touch", 4.0, 1.0, 5.0, 2.0), ("beside", 10.0, 10.9, 10.1, 11.0)]
    boxes = spark.createDataFrame(cases, "name string, minx double, miny double, maxx double, maxy double")
    got = {tuple(r) for r in polygons.boxes_meeting_polygons(boxes, area, "name", "area", cell_deg=cell).collect()}
    assert got == {(n, "a") for n in ("around", "over hole", "inside", "touch")}


def crosses(x, y, ring):
    out = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            out = not out
    return out


def test_random_polygons_and_a_hot_cell(spark):
    """Against ray crossing over all segments; nine tenths of the points are in one cell."""
    rng = random.Random(5)
    rings = {i: [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(rng.randint(3, 12))] for i in range(12)}
    points = [(i, rng.uniform(0, 0.2), rng.uniform(0, 0.2)) if i % 10 else (i, rng.uniform(-3, 3), rng.uniform(-3, 3)) for i in range(600)]
    shapes = spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in r]]) for i, r in rings.items()], f"area int, rings {polygons.RINGS}")
    found = polygons.points_in_polygons(spark.createDataFrame(points, "id int, lon double, lat double"), shapes, "id", "area", cell_deg=0.25)
    assert {tuple(r) for r in found.collect()} == {(i, a) for i, x, y in points for a, r in rings.items() if crosses(x, y, r)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_inner_cells_need_no_segments(spark, area):
    cells = polygons.cover(area.where("area = 'a'"), "area", 0.25).collect()
    inner = {(r.cx, r.cy) for r in cells if r.row is None}
    assert (1, 1) in inner and (7, 7) not in {(r.cx, r.cy) for r in cells} and (0, 0) not in inner and len(cells) == len({(r.cx, r.cy) for r in cells})


def test_scenes_in_polygon(spark):
    scenes = spark.createDataFrame([("s", "active", 0.1, 0.1, 0.2, 0.2), ("t", "archived", 0.1, 0.1, 0.2, 0.2), ("u", "active", 1.5, 1.5, 2.0, 2.0)], "scene_id string, status string, minx double, miny double, maxx double, maxy double")
    assert [r.scene_id for r in polygons.scenes_in_polygon(scenes, HOLED).collect()] == ["s"]
    with pytest.raises(ValueError, match="not a polygon"):
        polygons.scenes_in_polygon(scenes, "POINT(1 2)")


def test_geojson_with_a_hole(spark, tmp_path):
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[0, 0], [2, 0], [2, 4], [0, 4], [0, 0]]]}
    path = tmp_path / "a.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": shape}]}))
    assert readers.aoi_centroid(spark, str(path)) == (2.0, 3.0) and readers.aoi_bounds(spark, str(path)) == (0.0, 0.0, 4.0, 4.0)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0)], "id int, lon double, lat double")
    assert [r.id for r in polygons.points_in_polygons(points, readers.geojson_polygons(spark, str(path)), "id", "feature").collect()] == [2]


def test_missing_values_in_image_checks(spark):
    nan = float("nan")
    rows = [("half", 0, 0, 5.0, 1.0), ("half", 0, 1, None, 2.0), ("nan", 0, 0, nan, 1.0), ("nan", 0, 1, 3.0, nan), ("whole", 0, 0, 1.0, 2.0), ("whole", 0, 1, 3.0, 0.0), ("none", 0, 0, None, None)]
    df = spark.createDataFrame(rows, "scene string, row int, col int, a double, b double")
    got = {r.scene: (r.nan_fraction, r.variance, r.nonzero_fraction, r.passes) for r in metrics.image_qa(df, bands=("a", "b")).collect()}
    assert got == {"half": (0.25, pytest.approx(26 / 9), 1.0, False), "nan": (0.5, 1.0, 1.0, False), "whole": (0.0, 1.25, 0.75, True), "none": (1.0, None, 1.0, False)}
    assert {r.scene: r.has_nan for r in metrics.center_has_nan(df, 2, band="a", window=2).collect()} == {"half": True, "nan": True, "whole": False, "none": True}
