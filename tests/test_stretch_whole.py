"""The percentile stretch does all bands and keeps all pixels."""

import math

import pytest
from pyspark.sql import functions as F

from brackwater.operators import metrics
from brackwater.plans import registry
from brackwater.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("exact", [True, False])
def test_pixels_without_values_or_scene_stay(spark, exact):
    """A scene without values in one band or in both, pixels of no scene, and gaps within a scene."""
    rows = [("a", i, float(i), 5.0) for i in range(101)] + [("a", 101, None, 5.0), ("a", 102, math.nan, math.nan)]
    rows += [("b", i, None if i % 2 else math.nan, float(i)) for i in range(5)] + [("c", i, None, None) for i in range(3)] + [(None, i, 10.0 * i, float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "scene string, id int, red double, green double")
    got = {(r.scene, r.id): (r.red_8bit, r.green_8bit) for r in metrics.percentile_stretch(df, ("red", "green"), exact=exact).collect()}
    assert got.keys() == {r[:2] for r in rows} and len(got) == len(rows)
    assert all(v is not None for pair in got.values() for v in pair)
    assert got["a", 0] == (0, 0) and got["a", 50][0] == 127 and got["a", 100][0] == 255 and got["a", 101] == got["a", 102] == (0, 0)
    assert {got["c", i] for i in range(3)} == {(0, 0)} and {got["b", i][0] for i in range(5)} == {0} and got["b", 4][1] == got[None, 10][0] == 255


def test_rgb_stretch_has_three_bands(spark):
    out = registry.QUERIES["rgb_stretch"](spark, SF)
    assert {"red_8bit", "green_8bit", "blue_8bit"} <= set(out.columns)
    found = out.agg(F.count("*").alias("n"), *[F.countDistinct(f"{b}_8bit").alias(b) for b in ("red", "green", "blue")]).first()
    assert found.n == tables.pixels(spark, SF).count() and min(found.red, found.green, found.blue) > 200


def test_rgb_stretch_keeps_a_sensor_without_values(spark, tmp_path):
    """Part keys are null for one sensor: its bands have no value, its pixels are still there, as in SQL."""
    import duckdb

    rows = [(i, None if i % 3 == 0 or i == 1 else i * 7, i % 5, i % 4, "1996-01-01") for i in range(60)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, day string").select("*", F.to_date("day").alias("l_shipdate")).drop("day")
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    columns = ("scene", "row", "col", "year", "red_8bit", "green_8bit", "blue_8bit")
    want = duck.execute(f"select {', '.join(columns)} from ({registry.ORACLE_SQL['rgb_stretch']})").fetchall()
    got = list(map(tuple, registry.QUERIES["rgb_stretch"](spark, str(tmp_path)).select(*columns).collect()))
    assert len(want) == 60 and sorted(got, key=str) == sorted(want, key=str)
