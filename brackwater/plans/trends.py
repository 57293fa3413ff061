"""Yearly fractions and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trend
from ..sources import tables as t
from .registry import query

FRACTIONS = """own as (select pixel, year, avg(case when value = 1 then 1.0::double else 0.0::double end) as fraction from masks group by pixel, year),
    spine as (select pixel, unnest(range(a, z + 1))::int as year from (select pixel, min(year) as a, max(year) as z from own group by pixel)),
    f as (select spine.pixel, spine.year, fraction from spine left join own using (pixel, year))"""
SERIES = """numbered as (select pixel, fraction as y, (row_number() over (partition by pixel order by year)) as i from f),
    whole as (select pixel, count(*) as n, count(*) filter (where y is null) as gaps, min(y) as low, max(y) as high from numbered group by pixel),
    pairs as (select a.pixel, (b.y - a.y) / (b.i - a.i) as slope, sign(b.y - a.y) as s from numbered a join numbered b on a.pixel = b.pixel and a.i < b.i)"""
SLOPES = "slopes as (select pixel, median(slope) as slope from pairs group by pixel)"
TAILS = ", ".join(f"({n}, {s}, {p!r}::double)" for n in range(2, 13) for s, p in enumerate(trend.kendall_tails(n)))
# The same fit of the complementary error function as in operators.trend.
ERFC = "(1 / (1 + 0.5 * x)) * exp(-x * x + (-1.26551223::double + (1 / (1 + 0.5 * x)) * (1.00002368::double + (1 / (1 + 0.5 * x)) * (0.37409196::double + (1 / (1 + 0.5 * x)) * (0.09678418::double + (1 / (1 + 0.5 * x)) * (-0.18628806::double + (1 / (1 + 0.5 * x)) * (0.27886807::double + (1 / (1 + 0.5 * x)) * (-1.13520398::double + (1 / (1 + 0.5 * x)) * (1.48851587::double + (1 / (1 + 0.5 * x)) * (-0.82215223::double + (1 / (1 + 0.5 * x)) * 0.17087277::double))))))))))"
KENDALL = f"""kendall as (select pixel, sum(s) as s from pairs group by pixel),
    ties as (select pixel, sum(t * (t - 1) * (2 * t + 5)) as ties from (select pixel, y, count(*) as t from numbered group by pixel, y) group by pixel),
    tails(n, s, p) as (values {TAILS}),
    joined as (select w.pixel, w.n, w.gaps, w.low, w.high, case when w.gaps = 0 then coalesce(k.s, 0) end as s, t.ties, tails.p as exact_p, (w.n * (w.n - 1) * (2 * w.n + 5) - t.ties) / 18.0::double as variance
        from whole w left join kendall k using (pixel) left join ties t using (pixel) left join tails on tails.n = w.n and tails.s = abs(k.s) and t.ties = 0 and w.gaps = 0),
    tested as (select *, case when gaps > 0 then 1.0::double else least(1.0::double, coalesce(exact_p, case when variance > 0 then (select {ERFC} from (select abs(s) / sqrt(variance) / sqrt(2.0::double) as x)) end, 1.0::double)) end as pval from joined)"""


@query(f"with {FRACTIONS} select pixel, year, round(fraction, 9) as fraction from f", "masks")
def yearly_fraction(spark, d):
    return trend.yearly_fraction(t.masks(spark, d), ["pixel"]).select("pixel", "year", F.round("fraction", 9).alias("fraction"))


@query(f"with {FRACTIONS}, {SERIES}, {SLOPES} select w.pixel, case when gaps = 0 and high > low then round(slope, 9) end as slope from whole w left join slopes using (pixel)", "masks")
def theil_sen(spark, d):
    out = trend.yearly_series(t.masks(spark, d), ["pixel"])
    return out.select("pixel", F.round(trend.theil_sen(F.col("series")), 9).alias("slope"))


@query(f"with {FRACTIONS}, {SERIES}, {KENDALL} select pixel, s::double as s, round(pval, 6) as pval from tested", "masks")
def mann_kendall(spark, d):
    return trend.mann_kendall(trend.yearly_series(t.masks(spark, d), ["pixel"])).select("pixel", "s", F.round("pval", 6).alias("pval"))


@query(
    f"""with {FRACTIONS}, {SERIES}, {SLOPES}, {KENDALL} select k.pixel, k.n::int as n, case when gaps = 0 and high > low then round(slope, 9) end as slope, round(pval, 6) as pval,
    pval < 0.05 as significant from tested k left join slopes using (pixel)""",
    "masks",
)
def pixel_trend(spark, d):
    out = trend.trend_heatmap(t.masks(spark, d), ["pixel"])
    return out.select("pixel", "n", F.round("slope", 9).alias("slope"), F.round("pval", 6).alias("pval"), "significant")


#: Daily sums are whole numbers, so that both engines find the same ties.
DAILY = """f as (select l_linenumber::int as line, l_shipdate::date as day, sum(l_quantity)::double as fraction from lineitem group by all),
    numbered as (select line as pixel, fraction as y, (row_number() over (partition by line order by day)) as i from f),
    whole as (select pixel, count(*) as n, 0 as gaps, min(y) as low, max(y) as high from numbered group by pixel),
    pairs as (select a.pixel, (b.y - a.y) / (b.i - a.i) as slope, sign(b.y - a.y) as s from numbered a join numbered b on a.pixel = b.pixel and a.i < b.i)"""


@query(
    f"""with {DAILY}, {SLOPES}, {KENDALL} select k.pixel as line, k.n::int as n, k.s::double as s, round(slope, 9) as slope, round(pval, 6) as pval, pval < 0.05 as significant
    from tested k left join slopes using (pixel)"""
)
def daily_trend(spark, d):
    """Trends of what is shipped on each day, by line: series of about 2,500 values."""
    own = t.read(spark, d, "lineitem").groupBy(F.col("l_linenumber").cast("int").alias("line"), F.col("l_shipdate").cast("date").alias("day")).agg(F.sum("l_quantity").cast("double").alias("fraction"))
    out = trend.long_trend(own, ["line"], year="day")
    return out.select("line", "n", "s", F.round("slope", 9).alias("slope"), F.round("pval", 6).alias("pval"), "significant")
