"""Scenes near casts: rows of one place, or box, and date go as lists, which are paired where they meet and never shuffled as pairs."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brackwater.functions import geo
from brackwater.operators import catalog

DAY = dt.date(2020, 5, 20)
SCENE = "scene_id string, sensor string, acquisition_date date, status string, minx double, miny double, maxx double, maxy double"
CAST = "cast_id string, sample_date date, lon double, lat double"


def tables(spark):
    """Three places and dates with 40 casts each, four boxes and dates with 30 scenes each; ids that are null or come up twice; a cast and scenes without a place, a date or a status."""
    casts = [(None if i == 7 else f"c{i // 2 if i < 6 else i}", DAY + dt.timedelta(i % 3), 10.05, 20.05) for i in range(120)] + [("lost", DAY, None, 20.05), ("undated", None, 10.05, 20.05)]
    scenes = [(None if j == 9 else f"s{j // 2 if j < 8 else j}", "a" if j % 2 else None, DAY + dt.timedelta(j % 4 * 2), "active", 10.0, 20.0, 10.1, 20.1) for j in range(120)]
    scenes += [("old", "a", DAY, "archived", 10.0, 20.0, 10.1, 20.1), ("none", "a", DAY, None, 10.0, 20.0, 10.1, 20.1), ("open", "a", DAY, "active", None, 20.0, 10.1, 20.1), ("far", "a", DAY, "active", 12.0, 20.0, 12.1, 20.1)]
    want = Counter((c[0], s[0], s[1], s[2], 0.0) for c in casts[:120] for s in scenes[:120] if abs((c[1] - s[2]).days) <= 3)
    return spark.createDataFrame(scenes, SCENE), spark.createDataFrame(casts, CAST), want


@pytest.mark.parametrize("ellipsoid", [False, True])
@pytest.mark.parametrize("most", [4096, 5])
def test_lists_are_paired_whole(spark, ellipsoid, most):
    scenes, casts, want = tables(spark)
    got = Counter(map(tuple, catalog.scenes_near_casts(scenes, casts, 20.0, 3, ellipsoid=ellipsoid, digits=4, most=most).collect()))
    assert got == want and got.total() > 8_000


@pytest.mark.parametrize("ellipsoid", [False, True])
def test_pairs_are_not_shuffled(spark, ellipsoid):
    """One join, and no exchange after it."""
    scenes, casts, _ = tables(spark)
    plan = catalog.scenes_near_casts(scenes, casts, 20.0, 3, ellipsoid=ellipsoid)._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join [" in line]
    assert len(joins) == 1 and not any("Exchange" in line for line in plan[: joins[0]])


def test_long_lists_are_dealt(spark):
    rows = spark.createDataFrame([(i % 2, f"v{i}") for i in range(1000)] + [(2, "w"), (2, None), (None, "x")], "k int, v string")
    lists = catalog._listed(rows, ["k"], "v", "lists", 50).collect()
    assert Counter((r.k, v) for r in lists for v in r.vs) == Counter(map(tuple, rows.collect()))
    assert max(len(r.vs) for r in lists) <= 100 and sorted(map(str, (v for r in lists if r.k == 2 for v in r.vs))) == ["None", "w"]


def test_geodesic_in_columns_equals_the_expression(spark):
    places = [(-76.0, 38.0, -76.1, 38.1), (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 179.9, 0.1), (179.95, -10.0, -179.95, -10.2), (10.0, 0.0, 10.3, 0.0), (None, 1.0, 1.0, 1.0), (5.0, 90.0, 7.0, 89.9)]
    places += [(-77.0 + 0.07 * i, 37.0 + 0.03 * i, -77.0 + 0.071 * i, 37.1 + 0.029 * i) for i in range(40)]
    df, names = spark.createDataFrame(places, "a double, b double, c double, d double"), [F.col(n) for n in "abcd"]
    both = geo.with_geodesic(df, "got", *names).withColumn("want", geo.geodesic_km(*names)).collect()
    assert len(both) == len(places) and all(r.got == r.want for r in both) and sum(r.got is None for r in both) == 1
    assert geo.with_geodesic(df, "got", *names).where("got < 1").count() == sum(r.want is not None and r.want < 1 for r in both)
