"""Places, boxes and shapes that come up many times are compared once, and every row still gets its result."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from brackwater.operators import catalog, polygons, select


@pytest.fixture
def pairs(monkeypatch):
    """Pairs that cells brought together, by call."""
    seen = []

    def count(module):
        whole = module.met_in_cells

        def counted(*args, **kwargs):
            out = whole(*args, **kwargs)
            seen.append(out.count())
            return out

        monkeypatch.setattr(module, "met_in_cells", counted)
        return seen

    return count


def away(x, y, x1, y1, x2, y2):
    t = min(max(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0.0), 1.0)
    return math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))


def test_near_coast_compares_a_place_once(spark, pairs):
    rng = random.Random(1)
    places = [(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(20)]
    lines = [(x, y, x + rng.uniform(0.01, 0.2), y + rng.uniform(-0.2, 0.2)) for x, y in ((rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(15))]
    points = [(i, *places[i % 20]) for i in range(600)] + [(-1, None, 0.5)]
    seen = pairs(select)
    got = select.near_coast(spark.createDataFrame(points, "point_id int, lon double, lat double"), spark.createDataFrame(lines * 30, "x1 double, y1 double, x2 double, y2 double"), 0.1).collect()
    least = {i: min(away(x, y, *s) for s in lines) for i, x, y in points if x is not None}
    assert {r.point_id: r.distance for r in got} == pytest.approx({i: d for i, d in least.items() if d <= 0.1})
    assert 0 < seen[0] <= 20 * 15


def test_coastal_band_compares_a_place_once(spark, pairs):
    """The same two lines a hundred times, the same three places two hundred times."""
    segments = [(n, k, -76.0 + 0.1 * k, 38.0, -75.9 + 0.1 * k, 38.0) for n in range(100) for k in range(2)]
    points = spark.createDataFrame([(i, -75.95 + 0.01 * (i % 3), 38.01) for i in range(600)], "point_id int, lon double, lat double")
    seen = pairs(select)
    got = select.in_coastal_band(points, spark.createDataFrame(segments, "line int, seq int, lon1 double, lat1 double, lon2 double, lat2 double"), (-77.0, 37.0, -75.0, 39.0)).collect()
    assert len({r.point_id for r in got}) == len(got) == 600 and all(r.distance == pytest.approx(1110, abs=5) for r in got)
    assert 0 < seen[0] <= 3 * 2


def test_polygons_compare_a_shape_and_a_place_once(spark, monkeypatch):
    """Forty polygons of four shapes, one of them in two rows; points and boxes at few places; a box key with two boxes gives a pair once."""
    square = lambda x, y, n: [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]
    shapes = [[square(0.0, 0.0, 1.0)], [square(0.0, 0.0, 2.0), square(0.5, 0.5, 1.0)], [square(5.0, 5.0, 1.0)], [square(0.0, 0.0, 1.0), square(5.0, 5.0, 1.0)]]
    rows = [(i, shapes[i % 4]) for i in range(40) if i % 4 != 3] + [(i, [r]) for i in range(40) if i % 4 == 3 for r in shapes[3]]
    areas = spark.createDataFrame(rows, f"area int, rings {polygons.RINGS}")
    covered, whole = [], polygons.cover
    monkeypatch.setattr(polygons, "cover", lambda df, *a: covered.append(df.count()) or whole(df, *a))
    places = [(0.25, 0.25), (1.0, 1.0), (1.75, 0.25), (5.5, 5.5), (9.0, 9.0)]
    inside = [{0, 1, 3}, {0, 3}, {1}, {2, 3}, set()]
    points = spark.createDataFrame([(i, *places[i % 5]) for i in range(50)] + [(0, *places[0])], "id int, lon double, lat double")
    got = sorted(map(tuple, polygons.points_in_polygons(points, areas, "id", "area", cell_deg=0.3).collect()))
    assert got == sorted((i, a) for i in [*range(50), 0] for a in range(40) if a % 4 in inside[i % 5])
    boxes = [(i, x - 0.125, y - 0.125, x + 0.125, y + 0.125) for i, (x, y) in ((i, places[i % 5]) for i in range(50))]
    met = [{0, 1, 3}, {0, 3}, {1}, {2, 3}, set()]  # the second place is a corner of shape 0 within the hole of shape 1
    for more, want in ((boxes, met), (boxes + boxes[:3] + [(0, 5.25, 5.25, 5.5, 5.5)], met)):
        found = sorted(map(tuple, polygons.boxes_meeting_polygons(spark.createDataFrame(more, "id int, minx double, miny double, maxx double, maxy double"), areas, "id", "area", cell_deg=0.3).collect()))
        extra = {(0, a) for a in range(40) if a % 4 == 2} if more is not boxes else set()
        assert found == sorted({(i, a) for i in range(50) for a in range(40) if a % 4 in want[i % 5]} | extra)
    assert covered == [4, 4, 4]


def test_raster_round_trip_holds_all_scenes(spark):
    from brackwater.plans import registry
    from brackwater.sources import tables

    sf = "/root/testdata/sf0.001"
    got = {r.scene: r.pixels for r in registry.QUERIES["raster_round_trip"](spark, sf).collect()}
    assert got == {r.scene: r["count"] for r in tables.pixels(spark, sf).groupBy("scene").count().collect()}


@pytest.mark.parametrize("ellipsoid", [False, True])
def test_scenes_near_casts_compare_a_place_and_date_once(spark, pairs, ellipsoid):
    day = dt.date(2020, 5, 20)
    casts = [(f"c{i}", day + dt.timedelta(i % 2), 10.0 + 0.3 * (i % 3), 20.0) for i in range(300)]
    scenes = [(f"s{j}", "landsat-5", day + dt.timedelta(j % 4 * 3), "active" if j % 5 else "archived", 10.0 + 0.2 * (j % 2), 20.1, 10.1 + 0.2 * (j % 2), 20.2) for j in range(200)]
    seen = pairs(catalog)
    got = catalog.scenes_near_casts(
        spark.createDataFrame(scenes, "scene_id string, sensor string, acquisition_date date, status string, minx double, miny double, maxx double, maxy double"),
        spark.createDataFrame(casts, "cast_id string, sample_date date, lon double, lat double"), 20.0, 5, ellipsoid=ellipsoid,
    ).collect()
    def km(c, s):
        x, y = min(max(c[2], s[4]), s[6]), min(max(c[3], s[5]), s[7])
        h = math.sin(math.radians(y - c[3]) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(c[3])) * math.sin(math.radians(x - c[2]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))

    want = {(c[0], s[0]): km(c, s) for c in casts for s in scenes if s[3] == "active" and abs((c[1] - s[2]).days) <= 5 and km(c, s) <= 20.0}
    assert len(got) == len(want) > 1000
    assert {(r.cast_id, r.scene_id): r.distance_km for r in got} == pytest.approx(want, rel=0.006)
    assert 0 < seen[0] <= 6 * 8 * 2


def test_points_pick_from_distinct_places_and_boxes(spark, pairs):
    """Against plain loops; a point_id at two places has the best of both, a point without a scene stays."""
    rng = random.Random(3)
    day = dt.date(2020, 5, 20)
    boxes = [(10.0 + 0.1 * k, 20.0 + 0.05 * k) for k in range(6)]
    meta = [(f"s{j:03}", "landsat-5" if j % 3 else "landsat-7", day + dt.timedelta(j % 9), float(rng.randint(0, 9)), j % 7, *boxes[j % 6], boxes[j % 6][0] + 0.1, boxes[j % 6][1] + 0.1) for j in range(240)]
    points = [(i % 290, 20.05 + 0.05 * (i % 5), 10.05 + 0.1 * (i % 4), day + dt.timedelta(i % 2), "landsat-5") for i in range(300)] + [(999, None, 10.0, day, "landsat-5"), (998, 50.0, 10.0, day, "landsat-5")]
    seen = pairs(select)
    p = spark.createDataFrame(points, "point_id int, lat double, lon double, date date, sensor string")
    m = spark.createDataFrame(meta, "scene_id string, sensor string, date date, cloud double, time_ms int, minx double, miny double, maxx double, maxy double")
    got = select.pick_for_points(p, m, 1.0, 2, 3, 8.0, samples=2).collect()
    r = 1.0 / 111.0
    want = []
    for point in points:
        own = [q for q in points if q[0] == point[0]]
        met = sorted((s[3], -s[4], s[0]) for _, lat, lon, date, sensor in own if lat is not None for s in meta if s[1] == sensor and s[3] <= 8.0 and -2 <= (s[2] - date).days <= 3 and s[5] <= lon + r and s[7] >= lon - r and s[6] <= lat + r and s[8] >= lat - r)
        want += [(point[0], s[2], s[0]) for s in met[:2]] or [(point[0], None, None)]
    key = lambda row: tuple(map(str, row))
    assert sorted(((g.point_id, g.scene_id, g.cloud) for g in got), key=key) == sorted(want, key=key)
    assert 0 < seen[0] <= 20 * 9 * 6 * 2
