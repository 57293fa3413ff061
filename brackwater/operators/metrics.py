"""Label metrics, image statistics and training-log queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import clean, stretch
from ..functions.labels import CLASSES, weight_label
from ..sources.shared import written
from .quantiles import percentiles


def missing(value: Column) -> Column:
    """Whether a value is null or NaN; isnan alone is false for null."""
    return value.isNull() | F.isnan(value.cast("double"))


def confusion(pixels: DataFrame, target: str = "target", pred: str = "pred", classes: int = CLASSES, by: str | None = None, count: str | None = None) -> DataFrame:
    """Counts by target and prediction, and by group too with `by`: its null row set is the whole.

    Targets of 255, below 0 or beyond the classes are left out. count names a column of counts if the rows are sums.
    """
    n = (F.sum(count) if count else F.count("*")).alias("n")
    kept = pixels.where(F.col(target).between(0, classes - 1) & (F.col(target) != 255))
    if by is None:
        return kept.groupBy(target, pred).agg(n)
    sets = kept.groupingSets([[F.col(by), F.col(target), F.col(pred)], [F.col(target), F.col(pred)]], F.col(by), F.col(target), F.col(pred))
    return sets.agg(n)


def class_iou(counts: DataFrame, target: str = "target", pred: str = "pred") -> DataFrame:
    """class and iou of a confusion table: intersection over union of each class that occurs."""
    cells = counts.select(
        F.explode(
            F.array(
                F.struct(F.col(target).alias("class"), F.when(F.col(target) == F.col(pred), F.col("n")).otherwise(0).alias("inter"), F.col("n").alias("union")),
                F.struct(F.col(pred).alias("class"), F.lit(0).cast("long").alias("inter"), F.when(F.col(target) == F.col(pred), 0).otherwise(F.col("n")).alias("union")),
            )
        ).alias("c")
    )
    sums = cells.groupBy("c.class").agg(F.sum("c.inter").alias("inter"), F.sum("c.union").alias("union"))
    return sums.where("union > 0").select("class", (F.col("inter") / F.col("union")).alias("iou"))


def mean_iou(counts: DataFrame, target: str = "target", pred: str = "pred") -> DataFrame:
    """One row: miou over the classes with a union, 0 without any."""
    return class_iou(counts, target, pred).agg(F.coalesce(F.avg("iou"), F.lit(0.0)).alias("miou"))


def confusion_matrix(counts: DataFrame, target: str = "target", pred: str = "pred", classes: int = CLASSES) -> DataFrame:
    """Target rows by prediction columns."""
    return counts.groupBy(target).pivot(pred, list(range(classes))).agg(F.sum("n")).na.fill(0)


def class_weights(labels: DataFrame, code: str = "code", classes: int = CLASSES) -> DataFrame:
    """class and weight: total / (classes * count + 1e-6), over the mean weight (A8). Unmapped labels are left out; a class without rows counts 0."""
    spark = labels.sparkSession
    counts = labels.select(weight_label(F.col(code)).alias("class")).where("class <> 255").groupBy("class").agg(F.count("*").alias("n"))
    spine = spark.range(classes).select(F.col("id").cast("int").alias("class"))
    whole = Window.partitionBy()  # over as many rows as classes
    out = spine.join(counts, "class", "left").na.fill(0, ["n"]).withColumn("raw", F.sum("n").over(whole) / (classes * F.col("n") + 1e-6))
    return out.select("class", "n", (F.col("raw") / F.avg("raw").over(whole)).alias("weight"))


def first_images(images: DataFrame, name: str = "name", limit: int = 200) -> DataFrame:
    """The first images in order of names."""
    return images.orderBy(name).limit(limit)


def image_qa(pixels: DataFrame, scene: str = "scene", bands: tuple[str, ...] = ("blue", "green", "red", "nir", "swir1", "swir2"), max_nan: float = 0.1, least_variance: float = 1e-6, least_nonzero: float = 0.01) -> DataFrame:
    """Share of NaN, population variance and share of non-zero values of all bands by scene, and whether the scene passes.

    Nulls count as NaN. NaN counts as non-zero and makes no variance. One pass: bands are rows of one column, so that a task holds
    six numbers for a scene, whatever the number of bands.
    """
    value = F.col("_value")
    gone = missing(value)
    sums = pixels.select(scene, F.explode(F.array(*[F.col(b).cast("double") for b in bands])).alias("_value")).groupBy(scene).agg(
        F.count("*").alias("values"), F.count(F.when(gone, 1)).alias("missing"), F.count(F.when(gone | (value != 0), 1)).alias("nonzero"), F.var_pop(F.when(~gone, value)).alias("variance")
    )
    out = sums.select(scene, (F.col("missing") / F.col("values")).alias("nan_fraction"), "variance", (F.col("nonzero") / F.col("values")).alias("nonzero_fraction"))
    ok = (F.col("nan_fraction") < max_nan) & (F.coalesce("variance", F.lit(0.0)) >= least_variance) & (F.col("nonzero_fraction") >= least_nonzero)
    return out.withColumn("passes", ok)


def center_has_nan(pixels: DataFrame, size: int, scene: str = "scene", row: str = "row", col: str = "col", band: str = "value", window: int = 100) -> DataFrame:
    """Whether any value of the centred window is NaN or null, by scene (P17, SRC4): the window's bounds reach the scan."""
    top = max(0, (size - window) // 2)
    inside = pixels.where(F.col(row).between(top, top + window - 1) & F.col(col).between(top, top + window - 1))
    return inside.groupBy(scene).agg(F.bool_or(missing(F.col(band))).alias("has_nan"))


def percentile_stretch(pixels: DataFrame, bands: tuple[str, ...], scene: str = "scene", low: float = 0.02, high: float = 0.98, exact: bool = True) -> DataFrame:
    """pixels with <band>_8bit: each scene's band stretched from its low to its high percentile (A12, B20, SNK14).

    Percentiles are exact with linear interpolation, in bounded memory whatever a scene's size (operators.quantiles);
    exact=False takes approximate ones in one pass. Nulls and NaN don't count and become 0. Every pixel stays: those without a scene
    are a group, and a scene without any value in a band is 0 there.
    """
    ends = ((low, "low"), (high, "high"))
    if exact:
        found = percentiles(pixels, scene, bands, (low, high))
        cuts = found.groupBy(scene).agg(*[F.max(F.when((F.col("band") == b) & (F.col("share") == p), F.col("value"))).alias(f"_{b}_{n}") for b in bands for p, n in ends])
        cuts = written(cuts, "cuts")  # few groups are known to be few then, and pixels stay where they are
    else:
        cuts = pixels.groupBy(scene).agg(*[F.approx_percentile(clean(F.col(b)), F.lit(p)).alias(f"_{b}_{n}") for b in bands for p, n in ends])
    cuts = cuts.withColumnRenamed(scene, "_group")
    joined = pixels.join(cuts, F.col(scene).eqNullSafe(F.col("_group")), "left").drop("_group")
    return joined.withColumns({f"{b}_8bit": stretch(F.col(b), F.col(f"_{b}_low"), F.col(f"_{b}_high")) for b in bands}).drop(*[f"_{b}_{n}" for b in bands for _, n in ends])


def best_so_far(log: DataFrame, run: str = "run", epoch: str = "epoch", loss: str = "loss", patience: int = 10) -> DataFrame:
    """A training log with best (smallest loss up to the epoch), improved, since (epochs since the best one) and stop."""
    before = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = log.withColumn("best", F.min(loss).over(upto)).withColumn("improved", F.coalesce(F.col(loss) < F.min(loss).over(before), F.lit(True)))
    out = out.withColumn("since", F.col(epoch) - F.max(F.when(F.col("improved"), F.col(epoch))).over(upto))
    return out.withColumn("stop", F.col("since") >= patience)
