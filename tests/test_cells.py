"""Joins on cells that follow density, against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brackwater.operators import catalog, cells


def crowd(seed, n, spread):
    """Nine tenths around one place, the others anywhere, and one in twenty at one point."""
    r = random.Random(seed)
    out = [(10.3 + r.random() * spread, 20.6 + r.random() * spread) if i % 10 else (r.uniform(8, 13), r.uniform(18, 23)) for i in range(n)]
    return [(10.25, 20.75) if i % 20 == 7 else at for i, at in enumerate(out)]


@pytest.mark.parametrize(("pairs", "depth"), [(10**9, 4), (2_000, 4), (2_000, 0), (300, 6)])
def test_pairs_come_up_once_and_cells_are_bounded(spark, pairs, depth):
    points = [(i, i % 2, x, y) for i, (x, y) in enumerate(crowd(1, 400, 0.3))] + [(-1, 0, None, 20.0)]
    boxes = [(j, j % 2, x - 0.02, y - 0.03, x + 0.02, y + 0.03) for j, (x, y) in enumerate(crowd(2, 300, 0.3))] + [(-1, 0, None, 1.0, 2.0, 3.0)]
    p, b = spark.createDataFrame(points, "i int, k int, x double, y double"), spark.createDataFrame(boxes, "j int, k int, x0 double, y0 double, x1 double, y1 double")
    how = (p, b, ["k"], (F.col("x"), F.col("y")), tuple(F.col(c) for c in ("x0", "y0", "x1", "y1")), 1.0, depth, pairs)
    met = [(r.i, r.j) for r in cells.met_in_cells(*how).where("x between x0 and x1 and y between y0 and y1").collect()]
    want = {(i, j) for i, k, x, y in points if x for j, h, x0, y0, x1, y1 in boxes if x0 and k == h and x0 <= x <= x1 and y0 <= y <= y1}
    assert len(met) == len(set(met)) and set(met) == want
    a, c, on = cells.dealt(*how)
    most = a.groupBy(*on).agg(F.count("*").alias("a")).join(c.groupBy(*on).agg(F.count("*").alias("c")), on).agg(F.max(F.col("a") * F.col("c"))).first()[0]
    assert most <= 2 * pairs  # parts are dealt by a hash, so they are about equal


def test_scenes_near_casts_on_a_crowded_coast(spark):
    day = dt.date(2020, 5, 20)
    casts = spark.createDataFrame([(f"c{i}", day + dt.timedelta(i % 30), x, y) for i, (x, y) in enumerate(crowd(3, 200, 0.4))], "cast_id string, sample_date date, lon double, lat double")
    rows = [(f"s{j}", "landsat-5", day + dt.timedelta(j % 40), "active", x - 0.05, y - 0.05, x + 0.05, y + 0.05) for j, (x, y) in enumerate(crowd(4, 200, 0.4))]
    scenes = spark.createDataFrame(rows, "scene_id string, sensor string, acquisition_date date, status string, minx double, miny double, maxx double, maxy double")
    plain, split = (sorted(map(tuple, catalog.scenes_near_casts(scenes, casts, 20.0, 5, pairs=n).collect())) for n in (10**9, 200))
    assert plain and plain == split


def test_cells_without_rows(spark):
    p, b = spark.createDataFrame([], "i int, x double, y double"), spark.createDataFrame([], "j int, x0 double, y0 double, x1 double, y1 double")
    assert cells.met_in_cells(p, b, [], (F.col("x"), F.col("y")), tuple(F.col(c) for c in ("x0", "y0", "x1", "y1")), 1.0, 3).count() == 0
    assert cells.levels_down_to(1.0, 50 / 110) == 2 and cells.levels_down_to(1.0, 2.0) == 0
