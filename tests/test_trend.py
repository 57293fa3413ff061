"""Long series against sorted lists of all pairs, and against the form for short ones."""

import random

import numpy as np
from pyspark.sql import functions as F

from brackwater.operators import trend


def test_long_series_equal_listed_pairs(spark):
    r = random.Random(5)
    made = {0: [r.gauss(0, 1) + i * 1e-4 for i in range(5000)], 1: [float(r.randrange(7)) for _ in range(900)], None: [3.0, 1.0, 2.0], 2: [4.0] * 50, 3: [1.0, None, 2.0], 4: [1.0]}
    rows = [(k, i, v) for k, ys in made.items() for i, v in enumerate(ys)]
    got = {x.k: x for x in trend.long_trend(spark.createDataFrame(rows, "k int, year int, fraction double"), ["k"]).collect()}
    assert set(got) == set(made)
    for k in (0, 1, None):
        y = np.array(made[k])
        i, j = np.triu_indices(len(y), 1)
        assert abs(got[k].slope - np.median((y[j] - y[i]) / (j - i))) <= 1e-12
        assert got[k].s == np.sign(y[j] - y[i]).sum() and got[k].n == len(y)
    assert got[2].slope is None and got[2].s == 0 and got[2].pval == 1.0
    assert got[3].slope is None and got[3].pval == 1.0 and got[4].slope is None


def test_both_forms_agree(spark):
    r = random.Random(6)
    rows = [(k, [float(r.randrange(9)) for _ in range(2 + k % 30)]) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, series array<double>")
    listed = {x.k: x.slope for x in df.select("k", trend.theil_sen(F.col("series")).alias("slope")).collect()}
    for x in trend.sen_slopes(df, ["k"]).collect():
        assert x.slope == listed[x.k] or abs(x.slope - listed[x.k]) <= 1e-12
