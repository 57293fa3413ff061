"""Image checks hold a few numbers for a scene, whatever the bands, and pixels are not sorted to meet the scenes that pass."""

import math
import re
import statistics

from pyspark.sql import functions as F

from brackwater.functions.sensors import BANDS
from brackwater.operators import metrics, stages

NAN = float("nan")


def test_sums_of_a_scene_do_not_grow_with_the_bands(spark):
    pixels = spark.range(1).select(F.lit("a").alias("scene"), *[F.lit(1.0).alias(f"b{i}") for i in range(12)])
    for bands in (2, 12):
        plan = metrics.image_qa(pixels, bands=tuple(f"b{i}" for i in range(bands)))._jdf.queryExecution().executedPlan().toString()
        (held,) = re.findall(r"functions=\[partial_.*output=\[(.*?)\]", plan)
        assert len(held.split(",")) == 7  # the scene and six numbers


def test_checks_count_nulls_and_nan_in_every_band(spark):
    scenes = {
        "even": [(30_000.0, 1.0, 2.0), (30_001.0, 5.0, 0.0)],
        "gaps": [(None, 3.0, NAN), (7.0, 0.0, 9.0), (1.5, None, 4.0)],
        "gone": [(None, NAN, None)],
        "same": [(4.25, 4.25, 4.25)] * 5,
        "zero": [(0.0, 0.0, 0.0)] * 3,
    }
    rows = [(k, *v) for k, own in scenes.items() for v in own]
    got = {r.scene: r for r in metrics.image_qa(spark.createDataFrame(rows, "scene string, a double, b double, c double").repartition(3), bands=("a", "b", "c")).collect()}
    assert set(got) == set(scenes)
    for k, own in scenes.items():
        every = [x for v in own for x in v]
        there = [x for x in every if x is not None and not math.isnan(x)]
        assert got[k].nan_fraction == (len(every) - len(there)) / len(every)
        assert got[k].nonzero_fraction == sum(x != 0 for x in every) / len(every)
        assert got[k].variance is None if not there else math.isclose(got[k].variance, statistics.pvariance(there), rel_tol=1e-12)
        assert got[k].passes == (k == "even")


def test_pixels_of_many_scenes_are_hashed_not_sorted(spark, monkeypatch):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    bands = [(F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id") * (i + 1))).cast("double").alias(b) for i, b in enumerate(BANDS)]
    pixels = spark.range(400).select((F.col("id") % 8).cast("string").alias("scene_id"), "id", *bands)
    want = [i for i in range(400) if i % 4]
    assert sorted(r.id for r in stages.passing_scenes(pixels).collect()) == want
    monkeypatch.setattr(stages, "MANY", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stages.passing_scenes(pixels)
        assert sorted(r.id for r in out.collect()) == want
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
