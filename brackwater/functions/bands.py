"""Band algebra on pixel rows: one row per pixel, one column per band.

Everything is a Column expression, so a whole chain runs in one generated stage and reads only the bands
it needs. NaN bands count as missing (null): comparisons with NaN would be true in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sensors import BANDS, MISSIONS

#: Class codes of the salinity classifier.
CLASS_CODES = {"land": 0, "fresh": 1, "brackish": 2, "saline": 3}


def reflectance(dn: Column, sensor: Column) -> Column:
    """Digital number to surface reflectance (B2); null for an unknown sensor."""
    out = F.lit(None).cast("double")
    for m in MISSIONS:
        value = dn.cast("double") / 10000.0 if m.offset == 0 else dn.cast("double") * m.gain + m.offset
        out = F.when(sensor == m.slug, value).otherwise(out)
    return out


def clean(value: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(value), value)


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(a - b, a + b), (a - b) * 0.0 + 0.0)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), a * b + 0.0)


def clip(value: Column, low: float, high: float | None = None) -> Column:
    """Limited to [low, high]; null stays null."""
    raised = F.greatest(value, F.lit(low))
    return F.when(value.isNotNull(), raised if high is None else F.least(raised, F.lit(high)))


def ndwi_mask(green: Column, nir: Column, sensor: Column, threshold: float = 0.0) -> Column:
    """Water mask 1.0 / 0.0 from digital numbers (B1).

    Landsat numbers are scaled to reflectance, Sentinel's are not. No data in either band (zero, null or NaN) is 0. A zero
    denominator compares as the sign of the numerator (infinity), and 0/0 as no water.
    """
    landsat = sensor.contains("landsat")
    g = F.when(landsat, green * 0.0000275 - 0.2).otherwise(green.cast("double"))
    n = F.when(landsat, nir * 0.0000275 - 0.2).otherwise(nir.cast("double"))
    water = F.when(g + n != 0, (g - n) / (g + n) > threshold).otherwise(g - n > 0)
    valid = (green != 0) & (nir != 0) & ~F.isnan(g) & ~F.isnan(n)
    return F.when(water & valid, 1.0).otherwise(0.0)


def spectral_indices(df: DataFrame, proxy_scale: float = 1.2) -> DataFrame:
    """Indices and ratios of reflectance bands."""
    b = {n: F.col(f"_{n}") for n in BANDS}
    cleaned = df.withColumns({f"_{n}": clean(F.col(n)) for n in BANDS}).withColumn("_swir", clip(F.col("_swir1") + F.col("_swir2"), 0.0))
    return cleaned.withColumns(
        {
            "ndwi": normalised_difference(b["green"], b["nir"]),
            "mndwi": normalised_difference(b["green"], b["swir1"]),
            "ndvi": normalised_difference(b["nir"], b["red"]),
            "ndti": normalised_difference(b["green"], b["blue"]),
            "turbidity_ratio": ratio(b["red"], b["green"]),
            "chlorophyll_ratio": ratio(b["green"], b["blue"]),
            "salinity_proxy": F.col("_swir"),
            "salinity_proxy_norm": clip(F.col("_swir") / proxy_scale, 0.0, 1.0),
        }
    ).drop("_swir", *[f"_{n}" for n in BANDS])


def require_bands(df: DataFrame) -> None:
    """ValueError that names the bands a frame lacks (P20)."""
    missing = sorted(set(BANDS) - set(df.columns))
    if missing:
        raise ValueError(f"pixels lack the bands {missing}")


def classify_salinity(
    df: DataFrame, water_threshold: float = 0.2, proxy_scale: float = 1.2, proxy_threshold: float = 0.35, chlorophyll_reference: float = 2.0
) -> DataFrame:
    """Indices, water_mask, score, salinity_class and class_code from six reflectance bands.

    The score is null outside water. A pixel with a missing band is land.
    """
    require_bands(df)
    out = spectral_indices(df, proxy_scale)
    # Weights, scales and cuts of the classifier, in this expression and the names below.
    ndwi, mndwi, proxy = F.col("ndwi"), F.col("mndwi"), F.col("salinity_proxy_norm")
    water = (ndwi > water_threshold) | (mndwi > water_threshold) | ((proxy > proxy_threshold) & ((ndwi > 0) | (mndwi > 0)))
    score = clip(
        0.20 * (1.0 - clip((ndwi + 1.0) / 2.0, 0.0, 1.0))
        + 0.15 * (1.0 - clip((mndwi + 1.0) / 2.0, 0.0, 1.0))
        + 0.45 * proxy
        + 0.10 * clip(F.col("turbidity_ratio") / 2.0, 0.0, 1.0)
        + 0.10 * (1.0 - clip(F.col("chlorophyll_ratio") / chlorophyll_reference, 0.0, 1.0)),
        0.0,
        1.0,
    )
    out = out.withColumn("water_mask", F.coalesce(water, F.lit(False))).withColumn("score", F.when(F.col("water_mask"), score))
    filled = F.coalesce("score", F.lit(0.0))
    name = F.when(~F.col("water_mask"), "land").when(filled < 0.35, "fresh").when(filled < 0.60, "brackish").otherwise("saline")
    return out.withColumn("salinity_class", name).withColumn("class_code", class_code(F.col("salinity_class")))


def class_code(name: Column) -> Column:
    """Code of a class name, 0 for an unknown one."""
    pairs = [F.lit(x) for kv in CLASS_CODES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(0))


def binarise(value: Column, class_value: float) -> Column:
    """1 where the value is the class, else 0 - missing included."""
    return F.when(value == class_value, 1).otherwise(0)


def preview(mask: Column) -> Column:
    """255 for a set mask pixel, else 0."""
    return F.when(mask > 0, 255).otherwise(0)


def no_data(*bands: Column) -> Column:
    """Whether all bands are zero."""
    out = F.lit(True)
    for b in bands:
        out = out & (b == 0)
    return out


def unit_scale(value: Column, image_max: Column) -> Column:
    """0-1 scaling by the depth the whole image's maximum tells: over 255 as 16 bit, over 1 as 8 bit."""
    return F.when(image_max > 255, value / 65535.0).when(image_max > 1, value / 255.0).otherwise(value.cast("double"))


def stretch(value: Column, low: Column, high: Column) -> Column:
    """Linear stretch of [low, high] to 0..255, truncated; 0 if the range is empty, or the value null or NaN."""
    scaled = (F.nanvl(value.cast("double"), F.lit(None).cast("double")) - low) / F.when(high > low, high - low)
    return (F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)) * 255.0).cast("int")  # greatest() passes over a null


def argmax(values: Column) -> Column:
    """Place of the first largest value, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def crop_index(place: Column, size: int, crop: int) -> Column:
    """Place after a centred crop, or null outside it (B19, SRC3)."""
    top = (size - crop) // 2
    return F.when((place >= top) & (place < top + crop), place - top)


def reflect_index(place: Column, size: int) -> Column:
    """The source place of a place outside [0, size) when the border is mirrored without repeating the edge."""
    if size == 1:
        return place * 0
    period = 2 * (size - 1)
    folded = F.pmod(place, F.lit(period))
    return F.when(folded < size, folded).otherwise(period - folded)


def rotate90(row: Column, col: Column, height: int) -> tuple[Column, Column]:
    """(row, col) after a quarter turn clockwise of an image of this height (B21, deterministic part)."""
    return col, F.lit(height - 1) - row


def flip(place: Column, size: int) -> Column:
    """Place after mirroring an axis of this size."""
    return F.lit(size - 1) - place
