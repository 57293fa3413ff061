"""Yearly class fractions and their trends per pixel."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .quantiles import percentiles

#: Series up to this length without ties get the exact null distribution of Kendall's statistic.
EXACT = 33

#: Tasks that the pairs of one long series are dealt to.
STRIPES = 64


def yearly_fraction(masks: DataFrame, keys: list[str], class_value: float = 1.0, year: str = "year", value: str = "value", dense: bool = True) -> DataFrame:
    """Share of values of a class by key and year (A1); missing values count as another class.

    dense adds the years without rows between a key's first and last one, with a null fraction.
    """
    own = masks.groupBy(*keys, year).agg(F.avg(F.when(F.col(value) == class_value, 1.0).otherwise(0.0)).alias("fraction"))
    if not dense:
        return own
    years = _by_year(own, keys, year)
    return years.select(*keys, F.explode("_years").alias(year), "_m").select(*keys, year, F.try_element_at("_m", F.col(year)).alias("fraction"))


def _by_year(fractions: DataFrame, keys: list[str], year: str) -> DataFrame:
    """keys, all years between a key's first and last (_years) and its values by year (_m): one shuffle, no join with a spine."""
    held = F.map_from_entries(F.collect_list(F.struct(year, "fraction"))).alias("_m")
    return fractions.groupBy(*keys).agg(held, F.sequence(F.min(year), F.max(year)).alias("_years"))


def yearly_series(masks: DataFrame, keys: list[str], class_value: float = 1.0, year: str = "year", value: str = "value") -> DataFrame:
    """keys and series, the yearly fractions in order with gaps as nulls."""
    own = yearly_fraction(masks, keys, class_value, year, value, dense=False)
    return _by_year(own, keys, year).select(*keys, F.transform("_years", lambda y: F.try_element_at("_m", y)).alias("series"))


def series(fractions: DataFrame, keys: list[str], year: str = "year", value: str = "fraction") -> DataFrame:
    """The values of each key in order of years, as an array; gaps are nulls."""
    ordered = F.array_sort(F.collect_list(F.struct(year, value)))
    return fractions.groupBy(*keys).agg(ordered.alias("_s")).select(*keys, F.transform("_s", lambda s: s[value]).alias("series"))


def _pairs(ys: Column, f) -> Column:
    """f(earlier value, later value, distance) over all pairs of places of an array."""
    n = F.size(ys)

    def with_later(i: Column) -> Column:
        return F.transform(F.sequence(i + 1, n - 1), lambda j: f(F.get(ys, i), F.get(ys, j), j - i))

    return F.when(n >= 2, F.flatten(F.transform(F.sequence(F.lit(0), n - 2), with_later))).otherwise(F.array().cast("array<double>"))


def median(values: Column) -> Column:
    """Median of an array; null for an empty one."""
    s, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)


def theil_sen(ys: Column) -> Column:
    """Median of the pairwise slopes over places (A2). Null for a series with a gap, a constant one, or fewer than two values."""
    slopes = _pairs(ys, lambda a, b, d: (b - a) / d)
    usable = ~F.exists(ys, lambda y: y.isNull()) & (F.array_max(ys) > F.array_min(ys))
    return F.when(usable, median(slopes))


def sen_slopes(df: DataFrame, keys: list[str], ys: str = "series") -> DataFrame:
    """keys and slope: theil_sen() for series of any length, one row per key of df.

    The slopes of a series are rows, made one after the other and never listed; the median is selected among them in
    bounded memory (operators.quantiles). Keys are unique in df; null keys are keys.
    """
    col = F.col(ys)
    usable = ~F.exists(col, lambda y: y.isNull()) & (F.array_max(col) > F.array_min(col))
    # The places are dealt to STRIPES tasks, each with a copy of the series: one task would make all pairs of a key.
    dealt = df.where(usable).select(F.struct(*keys).alias("_of"), col.alias("_ys"), F.explode(F.sequence(F.lit(0), F.least(F.lit(STRIPES), F.size(col) - 1) - 1)).alias("_stripe"))
    places = F.sequence(F.col("_stripe"), F.size("_ys") - 2, F.lit(STRIPES))
    tasks = max(STRIPES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # by number: the rows are few and small, their pairs are not
    of = dealt.repartition(tasks, "_of", "_stripe").select("_of", "_ys", F.explode(places).alias("_i"))
    later = F.sequence(F.col("_i") + 1, F.size("_ys") - 1)
    slopes = of.select("_of", F.explode(F.transform(later, lambda j: (F.get("_ys", j) - F.get("_ys", F.col("_i"))) / (j - F.col("_i")))).alias("_slope"))
    found = percentiles(slopes, "_of", ("_slope",), (0.5,)).select("_of", F.col("value").alias("slope"))
    every = df.select(F.struct(*keys).alias("_key"))
    return every.join(found, F.col("_key").eqNullSafe(F.col("_of")), "left").select("_key.*", "slope")


def kendall_s(ys: Column) -> Column:
    """Concordant less discordant pairs of a series with its order. Pairs are added up as they are met, never listed."""
    n = F.size(ys)

    def with_later(acc: Column, i: Column) -> Column:
        return acc + F.aggregate(F.sequence(i + 1, n - 1), F.lit(0.0), lambda own, j: own + F.signum(F.get(ys, j) - F.get(ys, i)))

    return F.when(n >= 2, F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), with_later)).otherwise(0.0)


def tie_terms(ys: Column) -> Column:
    """Sum of t (t - 1) (2 t + 5) over the groups of t equal values."""
    def state(value: Column, run: Column, total: Column) -> Column:
        return F.struct(value.cast("double").alias("value"), run.cast("double").alias("run"), total.cast("double").alias("total"))

    def term(t: Column) -> Column:
        return t * (t - 1) * (2 * t + 5)

    def step(acc: Column, y: Column) -> Column:  # values come in order: equal ones make a run
        same = (acc["run"] > 0) & (acc["value"] == y.cast("double"))
        return state(y, F.when(same, acc["run"] + 1).otherwise(1), F.when(same, acc["total"]).otherwise(acc["total"] + term(acc["run"])))

    zero = F.lit(0.0)
    return F.aggregate(F.array_sort(ys), state(zero, zero, zero), step, lambda acc: acc["total"] + term(acc["run"]))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0: a Chebyshev fit with a relative error below 1.2e-7."""
    t = 1.0 / (1.0 + 0.5 * x)
    # Coefficients of the fit, constant first.
    coefficients = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    poly = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


@cache
def kendall_tails(n: int) -> list[float]:
    """Two-sided p-value by |S| (0, 1, ...) for n values without ties, from the counts of permutations by inversions."""
    counts = [1]
    for k in range(2, n + 1):
        grown = [0] * (len(counts) + k - 1)
        for i, c in enumerate(counts):
            for j in range(k):
                grown[i + j] += c
        counts = grown
    top, total = n * (n - 1) // 2, sum(counts)
    return [min(1.0, sum(c for i, c in enumerate(counts) if abs(top - 2 * i) >= s) / total) for s in range(top + 1)]


def mann_kendall(df: DataFrame, ys: str = "series", longest: int = EXACT) -> DataFrame:
    """df with s and pval: Kendall's test of a series against time, two-sided (A3).

    Exact where no values are equal and the series has at most `longest` values, or is longer and at most one pair
    is out of a single order; else normal with tie correction. A constant series and one with a gap have p = 1.
    """
    spark = df.sparkSession
    rows = [(n, s, p) for n in range(2, longest + 1) for s, p in enumerate(kendall_tails(n))]
    tails = F.broadcast(spark.createDataFrame(rows, "_n int, _abs int, _exact double"))  # fixed size: all series lengths up to `longest`
    col = F.col(ys)
    n = F.size(col)
    gap = F.exists(col, lambda y: y.isNull())
    out = df.withColumn("s", F.when(~gap, kendall_s(col))).withColumn("_ties", F.when(~gap, tie_terms(col))).withColumn("_size", n)
    out = out.join(tails, (F.col("_size") == F.col("_n")) & (F.abs("s").cast("long") == F.col("_abs")) & (F.col("_ties") == 0), "left")
    size = F.col("_size").cast("double")  # its third power leaves 32 bits early
    variance = (size * (size - 1) * (2 * size + 5) - F.col("_ties")) / 18.0
    normal = F.when(variance > 0, erfc(F.abs("s") / F.sqrt(F.when(variance > 0, variance)) / F.sqrt(F.lit(2.0))))
    # Of n! orders one has no pair out of order and n - 1 have one, and the same again from the other end.
    odd = ((size * (size - 1) / 2 - F.abs("s")) / 2).cast("long")
    orders = F.aggregate(F.sequence(F.lit(1), F.col("_size") - odd), F.lit(1.0), lambda acc, k: acc * k)
    ordered = F.when((F.col("_size") > longest) & (F.col("_ties") == 0) & (odd <= 1), 2.0 / orders)
    p = F.least(F.coalesce("_exact", ordered, normal, F.lit(1.0)), F.lit(1.0))
    return out.withColumn("pval", p).drop("_ties", "_size", "_n", "_abs", "_exact")


def long_trend(values: DataFrame, keys: list[str], year: str = "year", value: str = "fraction", alpha: float = 0.05) -> DataFrame:
    """pixel_trend() for series of thousands of values, such as daily ones: no task lists the pairs of a series."""
    rows = written(series(values, keys, year, value), "series")
    tested = written(mann_kendall(rows), "tested").select(F.struct(*keys).alias("_key"), F.size("series").alias("n"), "s", "pval", (F.col("pval") < alpha).alias("significant"))
    slopes = sen_slopes(rows, keys).select(F.struct(*keys).alias("_of"), "slope")
    return tested.join(slopes, F.col("_key").eqNullSafe(F.col("_of"))).select("_key.*", "n", "s", "slope", "pval", "significant")


def pixel_trend(fractions: DataFrame, keys: list[str], year: str = "year", value: str = "fraction", alpha: float = 0.05) -> DataFrame:
    """keys, n, slope, pval and significant of each key's yearly series (A4, A5): one shuffle by key."""
    return _tested(series(fractions, keys, year, value), keys, alpha)


def _tested(df: DataFrame, keys: list[str], alpha: float) -> DataFrame:
    out = mann_kendall(df)
    return out.select(*keys, F.size("series").alias("n"), theil_sen(F.col("series")).alias("slope"), "pval", (F.col("pval") < alpha).alias("significant"))


def trend_heatmap(masks: DataFrame, keys: list[str], class_value: float = 1.0, alpha: float = 0.05) -> DataFrame:
    """Masks (keys, year, value) to a table that a heatmap draws."""
    return _tested(yearly_series(masks, keys, class_value), keys, alpha)
