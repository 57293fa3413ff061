"""Pixel queries: band algebra, quality, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as b
from ..functions import labels as lab
from ..operators import metrics
from ..operators.quantiles import percentiles
from ..sources import tables as t
from .registry import query

BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
KEY = ("scene", "row", "col", "year")
KEY_SQL = "scene, row, col, year"


def reflectances(df: DataFrame) -> DataFrame:
    """Reflectance of all bands: what follows is work per pixel, so a table of few splits is spread first."""
    return t.spread(df).withColumns({n: b.reflectance(F.col(n), F.col("sensor")) for n in BANDS})


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def _scaled(band: str) -> str:
    return f"case when {band} is null or isnan({band}::double) then 0.0::double when sensor = 'sentinel-2' then {band}::double / 10000.0::double else {band}::double * 0.0000275::double + -0.2::double end as {band}"


def _nd(a: str, c: str) -> str:
    return f"case when {a} + {c} <> 0 then ({a} - {c}) / ({a} + {c}) else 0.0::double end"


def _ratio(a: str, c: str) -> str:
    return f"case when {c} <> 0 then {a} / {c} else 0.0::double end"


def _clip(x: str) -> str:
    return f"least(greatest({x}, 0.0::double), 1.0::double)"


SCALED = f"refl as (select scene, sensor, row, col, year, {', '.join(map(_scaled, BANDS))} from pixels)"
INDICES = f"""idx as (select *, {_nd('green', 'nir')} as ndwi, {_nd('green', 'swir1')} as mndwi, {_nd('nir', 'red')} as ndvi, {_nd('green', 'blue')} as ndti,
    {_ratio('red', 'green')} as turbidity_ratio, {_ratio('green', 'blue')} as chlorophyll_ratio, greatest(swir1 + swir2, 0.0::double) as salinity_proxy,
    {_clip('greatest(swir1 + swir2, 0.0::double) / 1.2::double')} as salinity_proxy_norm from refl)"""
SCORED = f"""scored as (select *, ndwi > 0.2 or mndwi > 0.2 or (salinity_proxy_norm > 0.35 and (ndwi > 0 or mndwi > 0)) as water_mask,
    {_clip(f"0.20::double * (1 - {_clip('(ndwi + 1) / 2')}) + 0.15::double * (1 - {_clip('(mndwi + 1) / 2')}) + 0.45::double * salinity_proxy_norm + 0.10::double * {_clip('turbidity_ratio / 2')} + 0.10::double * (1 - {_clip('chlorophyll_ratio / 2')})")} as raw from idx)"""
CLASSED = """classed as (select *, case when water_mask then raw end as score,
    case when not water_mask then 'land' when raw < 0.35 then 'fresh' when raw < 0.60 then 'brackish' else 'saline' end as salinity_class from scored)"""
CHAIN = f"with {SCALED}, {INDICES}, {SCORED}, {CLASSED}"


@query(f"with {SCALED} select {KEY_SQL}, {', '.join(f'round({n}, 6) as {n}' for n in BANDS)} from refl", "pixels")
def band_scale(spark, d):
    return reflectances(t.pixels(spark, d)).select(*KEY, *r6(*BANDS))


INDEX_NAMES = ("ndwi", "mndwi", "ndvi", "ndti", "turbidity_ratio", "chlorophyll_ratio", "salinity_proxy", "salinity_proxy_norm")


@query(f"with {SCALED}, {INDICES} select {KEY_SQL}, {', '.join(f'round({n} + 1e-9::double, 5) as {n}' for n in INDEX_NAMES)} from idx", "pixels")
def spectral_indices(spark, d):
    return b.spectral_indices(reflectances(t.pixels(spark, d))).select(*KEY, *[F.round(F.col(n) + 1e-9, 5).alias(n) for n in INDEX_NAMES])


@query(
    f"""{CHAIN} select {KEY_SQL}, water_mask, round(score, 6) as score, salinity_class,
    case salinity_class when 'land' then 0 when 'fresh' then 1 when 'brackish' then 2 else 3 end as class_code from classed""",
    "pixels",
)
def salinity_classify(spark, d):
    return b.classify_salinity(reflectances(t.pixels(spark, d))).select(*KEY, "water_mask", *r6("score"), "salinity_class", "class_code")


@query(f"{CHAIN} select sensor, salinity_class, count(*) as n, round(avg(score), 6) as mean_score from classed group by sensor, salinity_class", "pixels")
def salinity_class_counts(spark, d):
    found = b.classify_salinity(reflectances(t.pixels(spark, d)))
    return found.groupBy("sensor", "salinity_class").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


MASK = """case when green <> 0 and nir <> 0 and not isnan(g) and not isnan(n) and (case when g + n <> 0 then (g - n) / (g + n) > 0 else g - n > 0 end) then 1.0::double else 0.0::double end as mask
    from (select *, case when sensor like '%landsat%' then green * 0.0000275::double - 0.2::double else green::double end as g,
    case when sensor like '%landsat%' then nir * 0.0000275::double - 0.2::double else nir::double end as n from pixels)"""


@query(f"select {KEY_SQL}, {MASK}", "pixels")
def ndwi_mask(spark, d):
    return t.pixels(spark, d).select(*KEY, b.ndwi_mask(F.col("green"), F.col("nir"), F.col("sensor")).alias("mask"))


@query(f"select scene, count(*) as pixels, sum(mask)::bigint as water from (select scene, {MASK}) group by scene", "pixels")
def water_mask_area(spark, d):
    masked = t.pixels(spark, d).withColumn("mask", b.ndwi_mask(F.col("green"), F.col("nir"), F.col("sensor")))
    return masked.groupBy("scene").agg(F.count("*").alias("pixels"), F.sum("mask").cast("long").alias("water"))


def gappy(px: DataFrame, scene: str = "scene") -> DataFrame:
    """Pixels with missing values: every eleventh scene has none at all, every fifth lacks every second row; a few rows are null and a few columns NaN."""
    gone = (F.col(scene) % 11 == 0) | ((F.col(scene) % 5 == 0) & (F.col("row") % 2 == 0)) | (F.col("row") % 37 == 0)
    return px.withColumns({n: F.when(~gone, F.when(F.col("col") % 41 == 0, F.lit(float("nan"))).otherwise(F.col(n).cast("double"))) for n in BANDS})


def _gap(band: str) -> str:
    return f"case when scene % 11 = 0 or (scene % 5 = 0 and row % 2 = 0) or row % 37 = 0 then null when col % 41 = 0 then 'nan'::double else {band}::double end as {band}"


GAPPY = f"gappy as (select scene, sensor, row, col, year, {', '.join(map(_gap, BANDS))} from pixels)"
#: Figures of the values of all bands by scene; a value that is null or NaN is missing.
CHECKED = """v as (select scene, unnest([blue, green, red, nir, swir1, swir2]) as x from gappy),
    checked as (select scene, count(*) filter (where x is null or isnan(x)) / count(*)::double as nan_fraction, var_pop(x) filter (where not isnan(x)) as variance,
        count(*) filter (where x is null or isnan(x) or x <> 0) / count(*)::double as nonzero_fraction from v group by scene),
    good as (select scene from checked where nan_fraction < 0.1 and variance >= 1e-6 and nonzero_fraction >= 0.01)"""


@query(
    f"""with {GAPPY}, {CHECKED} select scene, round(nan_fraction, 6) as nan_fraction, round(variance, 2) as variance, round(nonzero_fraction, 6) as nonzero_fraction,
    scene in (select scene from good) as passes from checked""",
    "pixels",
)
def image_qa(spark, d):
    found = metrics.image_qa(gappy(t.pixels(spark, d)))
    return found.select("scene", *r6("nan_fraction"), F.round("variance", 2).alias("variance"), *r6("nonzero_fraction"), "passes")


@query("select scene, row - 30 as crow, col - 30 as ccol, green from pixels where row between 30 and 69 and col between 30 and 69", "pixels")
def center_window(spark, d):
    crop = {c: b.crop_index(F.col(n), 100, 40) for c, n in (("crow", "row"), ("ccol", "col"))}
    inside = t.pixels(spark, d).where(F.col("row").between(30, 69) & F.col("col").between(30, 69))
    return inside.withColumns(crop).select("scene", "crow", "ccol", "green")


RGB = ("red", "green", "blue")


def _stretched(band: str) -> str:
    return f"case when {band}_z <= {band}_a then 0 else trunc(least(greatest(({band} - {band}_a) / ({band}_z - {band}_a), 0.0::double), 1.0::double) * 255.0::double)::int end as {band}_8bit"


@query(
    f"""with cut as (select sensor, {", ".join(f"quantile_cont({b}, 0.02) as {b}_a, quantile_cont({b}, 0.98) as {b}_z" for b in RGB)} from pixels group by sensor)
    select {KEY_SQL}, {", ".join(map(_stretched, RGB))} from pixels join cut using (sensor)""",
    "pixels",
)
def rgb_stretch(spark, d):
    return metrics.percentile_stretch(t.pixels(spark, d), RGB, scene="sensor").select(*KEY, *[f"{n}_8bit" for n in RGB])


@query(
    """with v as (select 'green' as band, green / 7.0::double as v from pixels union all select 'nir', ln(nir + 1.0::double) from pixels)
    select band, share, round(case share when 0.02 then a when 0.5 then b else c end, 6) as value
    from (select band, quantile_cont(v, 0.02) as a, quantile_cont(v, 0.5) as b, quantile_cont(v, 0.98) as c from v group by band), (values (0.02::double), (0.5::double), (0.98::double)) s(share)""",
    "pixels",
)
def band_percentiles(spark, d):
    """Percentiles of float bands over the whole table as one group, by selection."""
    px = t.pixels(spark, d).select(F.lit("all").alias("whole"), (F.col("green") / 7.0).alias("green"), F.log(F.col("nir") + 1.0).alias("nir"))
    return percentiles(px, "whole", ("green", "nir"), (0.02, 0.5, 0.98), limit=1_000).select("band", "share", *r6("value"))


def _ranges_sql(code: str, default: str) -> str:
    parts = " ".join(f"when {' or '.join(f'{code} between {a} and {z}' for a, z in ranges)} then {c}" for c, ranges in lab.SUPERCLASS_RANGES.items())
    return f"case {parts} else {default} end"


@query(f"select code, {_ranges_sql('code', '0')} as superclass, count(*) as n from label_pixels group by all", "label_pixels")
def cdl_superclass(spark, d):
    return t.labels(spark, d).groupBy("code").agg(F.count("*").alias("n")).select("code", lab.superclass(F.col("code")).alias("superclass"), "n")


@query(
    f"select code, case when {_ranges_sql('code', 'null')} in (1, 2, 3, 4, 5) then 1 when {_ranges_sql('code', 'null')} is not null then 0 end as vegetated, count(*) as n from label_pixels group by all",
    "label_pixels",
)
def cdl_binary(spark, d):
    return t.labels(spark, d).groupBy("code").agg(F.count("*").alias("n")).select("code", lab.vegetated(F.col("code")).alias("vegetated"), "n")


@query(f"select code, {_ranges_sql('code', 'code')} as label, count(*) as n from label_pixels group by all", "label_pixels")
def training_labels(spark, d):
    return t.labels(spark, d).groupBy("code").agg(F.count("*").alias("n")).select("code", lab.training_label(F.col("code")).alias("label"), "n")


@query(
    f"""with c as (select {_ranges_sql('code', '255')} as class from label_pixels), n as (select r.class, count(c.class) as n from (select unnest(range(10))::int as class) r left join c using (class) group by r.class),
    w as (select class, n, sum(n) over () / (10 * n + 1e-6::double) as raw from n) select class, n, round(raw / avg(raw) over (), 6) as weight from w""",
    "label_pixels",
)
def class_weights(spark, d):
    return metrics.class_weights(t.labels(spark, d)).select("class", "n", *r6("weight"))


TARGETS = f"(select sat, {_ranges_sql('code', '255')} as target, pred from label_pixels)"


def _targets(spark, d):
    """Counts by satellite, label and prediction first, so that labels are mapped once per group."""
    counts = t.labels(spark, d).groupBy("sat", "code", "pred").agg(F.count("*").alias("k"))
    return counts.select("sat", lab.weight_label(F.col("code")).alias("target"), "pred", "k")


@query(f"select target, pred, count(*) as n from {TARGETS} where target between 0 and 9 group by all", "label_pixels")
def confusion_matrix(spark, d):
    return metrics.confusion(_targets(spark, d), count="k")


@query(f"select sat, target, pred, count(*) as n from {TARGETS} where target between 0 and 9 group by grouping sets ((sat, target, pred), (target, pred))", "label_pixels")
def confusion_rollup(spark, d):
    return metrics.confusion(_targets(spark, d), by="sat", count="k")


@query(
    f"""with n as (select target, pred, count(*) as n from {TARGETS} where target between 0 and 9 group by all),
    c as (select c.class, coalesce(sum(n) filter (where target = c.class and pred = c.class), 0) as i, coalesce(sum(n) filter (where target = c.class or pred = c.class), 0) as u
    from (select unnest(range(10)) as class) c, n group by c.class) select round(coalesce(avg(i / u::double) filter (where u > 0), 0), 9) as miou from c""",
    "label_pixels",
)
def miou(spark, d):
    return metrics.mean_iou(metrics.confusion(_targets(spark, d), count="k")).select(F.round("miou", 9).alias("miou"))


@query(
    """with l as (select (l_orderkey % 20)::int as run, l_linenumber as epoch, avg(l_extendedprice) as loss from lineitem group by all),
    b as (select *, min(loss) over (partition by run order by epoch) as best, coalesce(loss < min(loss) over (partition by run order by epoch rows between unbounded preceding and 1 preceding), true) as improved from l)
    select run, epoch, round(best, 4) as best, improved, epoch - max(case when improved then epoch end) over (partition by run order by epoch) as since from b"""
)
def training_best(spark, d):
    log = t.read(spark, d, "lineitem").groupBy(F.pmod("l_orderkey", F.lit(20)).cast("int").alias("run"), F.col("l_linenumber").alias("epoch")).agg(F.avg("l_extendedprice").alias("loss"))
    return metrics.best_so_far(log).select("run", "epoch", F.round("best", 4).alias("best"), "improved", "since")
