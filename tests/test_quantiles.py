"""Percentiles by selection against sorted lists: ties, heavy values, nulls, one group for all."""

import math
import random

import pytest
from pyspark.sql import functions as F

from brackwater.operators import metrics, quantiles

SHARES = (0.0, 0.02, 0.5, 0.75, 0.98, 1.0)


def at(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@pytest.mark.parametrize("limit", [3, 60, 100_000])
def test_percentiles(spark, limit):
    rng = random.Random(2)
    rows = [("normal", rng.gauss(0, 1), float(i)) for i in range(700)] + [("wide", rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300), 1.0) for _ in range(400)]
    rows += [("heavy", 5.0 if i > 8 else float(i), None) for i in range(500)] + [("heavy", 7.0, None)] * 3 + [("one", 2.5, float("nan"))] + [(None, float(i % 3), None) for i in range(90)] + [("gone", None, float("nan"))]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(3)
    got = {(r.g, r.band, r.share): r.value for r in quantiles.percentiles(df, "g", ("a", "b"), SHARES, limit).collect()}
    want = {}
    for band in (1, 2):
        for g in {r[0] for r in rows}:
            values = [r[band] for r in rows if r[0] == g and r[band] is not None and not math.isnan(r[band])]
            want |= {(g, "ab"[band - 1], p): at(values, p) for p in SHARES if values}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_stretch_of_one_large_group(spark):
    df = spark.range(5_000).select(F.lit(1).alias("scene"), (F.col("id") * 7 % 5_000).cast("double").alias("red"))
    out = metrics.percentile_stretch(df, ("red",)).agg(F.count(F.when(F.col("red_8bit") == 0, 1)).alias("low"), F.count(F.when(F.col("red_8bit") == 255, 1)).alias("high")).first()
    assert 100 <= out.low <= 125 and 100 <= out.high <= 125
