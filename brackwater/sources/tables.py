"""Domain tables as projections of the driver's tables, and the same projections in DuckDB's SQL.

The driver's tables hold no imagery or casts, so scenes, casts, levels, runs, pixels, labels and yearly
masks are computed from keys by formulas that both engines evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multipliers (part, supplier, line) of the digital numbers of each band.
DN = {"blue": (31, 17, 7), "green": (37, 11, 101), "red": (41, 29, 13), "nir": (1, 53, 19), "swir1": (43, 3, 59), "swir2": (23, 61, 5)}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where it comes in fewer splits than there are, as one small file does; inputs of many splits stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def pick(index: Column, *values: str) -> Column:
    """The value of a place (from 0)."""
    out = F.lit(values[-1])
    for i, v in reversed(list(enumerate(values[:-1]))):
        out = F.when(index == i, v).otherwise(out)
    return out


def _hundredths(key: Column, times: int, span: int, base: float) -> Column:
    return F.lit(base) + (F.pmod(key * times, F.lit(span))).cast("double") / 100.0


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    third = F.pmod(key, F.lit(3))
    code, day = pick(third, "S2A", "LT05", "LE07"), F.col("o_orderdate").cast("date")
    scene_id = F.concat_ws("_", code, F.lpad(key.cast("string"), 8, "0"), F.date_format(day, "yyyyMMdd"))
    x, y = _hundredths(key, 11, 300, -77.5), _hundredths(key, 7, 250, 37.5)
    return o.select(
        scene_id.alias("scene_id"), key.alias("scene_key"), pick(third, "sentinel-2", "landsat-5", "landsat-7").alias("sensor"), day.alias("acquisition_date"),
        F.lit(6).alias("band_count"), F.lit("EPSG:32618").alias("crs"),
        F.when(F.col("o_orderstatus") == "P", "archived").otherwise("active").alias("status"),
        F.array(F.concat(F.lit("data/"), scene_id, F.lit("_multiband.tif"))).alias("file_locations"),
        F.md5(F.col("o_orderpriority")).alias("file_hash"),
        (x - 0.05).alias("minx"), (y - 0.05).alias("miny"), (x + 0.05).alias("maxx"), (y + 0.05).alias("maxy"),
    )


SCENES_SQL = """
    select concat_ws('_', case o_orderkey % 3 when 0 then 'S2A' when 1 then 'LT05' else 'LE07' end, lpad(o_orderkey::varchar, 8, '0'), strftime(o_orderdate, '%Y%m%d')) as scene_id,
        o_orderkey as scene_key, case o_orderkey % 3 when 0 then 'sentinel-2' when 1 then 'landsat-5' else 'landsat-7' end as sensor,
        o_orderdate::date as acquisition_date, 6 as band_count, 'EPSG:32618' as crs,
        case when o_orderstatus = 'P' then 'archived' else 'active' end as status, md5(o_orderpriority) as file_hash,
        (-77.5::double + (o_orderkey * 11 % 300)::double / 100.0::double) - 0.05::double as minx, (37.5::double + (o_orderkey * 7 % 250)::double / 100.0::double) - 0.05::double as miny,
        (-77.5::double + (o_orderkey * 11 % 300)::double / 100.0::double) + 0.05::double as maxx, (37.5::double + (o_orderkey * 7 % 250)::double / 100.0::double) + 0.05::double as maxy
    from orders"""


def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, key = read(spark, sf_dir, "customer"), F.col("c_custkey")
    return c.select(
        F.concat(F.lit("CAST_"), F.lpad(key.cast("string"), 8, "0")).alias("cast_id"), key.alias("point_id"),
        _hundredths(key, 13, 290, -77.45).alias("lon"), _hundredths(key, 17, 240, 37.55).alias("lat"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(key * 13, F.lit(2400)).cast("int")).alias("sample_date"),
        (F.abs("c_acctbal") / 300.0).alias("surface_salinity"), (F.pmod(key, F.lit(30)) + 1).cast("double").alias("max_depth"),
    )


CASTS_SQL = """
    select 'CAST_' || lpad(c_custkey::varchar, 8, '0') as cast_id, c_custkey as point_id,
        -77.45::double + (c_custkey * 13 % 290)::double / 100.0::double as lon, 37.55::double + (c_custkey * 17 % 240)::double / 100.0::double as lat,
        date '1995-01-01' + (c_custkey * 13 % 2400)::int as sample_date, abs(c_acctbal) / 300.0::double as surface_salinity, (c_custkey % 30 + 1)::double as max_depth
    from customer"""


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("CAST_"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("cast_id"), F.col("l_linenumber").alias("level"), F.col("l_orderkey").alias("profile"),
        (F.col("l_quantity") / 10.0).alias("depth_m"), (F.col("l_extendedprice") / 3000.0).alias("salinity"),
        F.when(F.pmod("l_partkey", F.lit(10)) != 0, F.col("l_tax") * 100.0 + 10.0).alias("temperature"),
    )


LEVELS_SQL = """
    select 'CAST_' || lpad(l_suppkey::varchar, 8, '0') as cast_id, l_linenumber as level, l_orderkey as profile, l_quantity / 10.0::double as depth_m,
        l_extendedprice / 3000.0::double as salinity, case when l_partkey % 10 <> 0 then l_tax * 100.0::double + 10.0::double end as temperature
    from lineitem"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, key = read(spark, sf_dir, "events"), F.col("event_id")
    scene = scenes(spark, sf_dir).select("scene_key", F.col("scene_id").alias("base_scene_id"))
    rows = e.select(
        F.concat(F.lit("R"), key.cast("string")).alias("product_id"), (key + 1).alias("scene_key"),
        F.when(F.col("event_type").isin("view", "click"), "water_mask").when(F.col("event_type") == "purchase", "salinity").otherwise("trend").alias("task"),
        pick(F.pmod(key, F.lit(4)), "not_started", "running", "complete", "failed").alias("status"), F.col("ts").alias("started_at"), F.col("props").alias("parameters"),
    )
    return rows.join(scene, "scene_key").drop("scene_key")


RUNS_SQL = """
    select 'R' || event_id::varchar as product_id, s.scene_id as base_scene_id,
        case when event_type in ('view', 'click') then 'water_mask' when event_type = 'purchase' then 'salinity' else 'trend' end as task,
        case event_id % 4 when 0 then 'not_started' when 1 then 'running' when 2 then 'complete' else 'failed' end as status, ts as started_at, props as parameters
    from events e join scenes s on s.scene_key = e.event_id + 1"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digital numbers: 16 bit for Sentinel-2, offset ones for Landsat; a few zeros in nir."""
    li = read(spark, sf_dir, "lineitem")
    landsat = F.pmod("l_orderkey", F.lit(3)) != 0
    bands = {}
    for band, (a, b, c) in DN.items():
        mixed = F.col("l_partkey") * a + F.col("l_suppkey") * b + F.col("l_linenumber") * c
        bands[band] = F.when(landsat, F.pmod(mixed * 4, F.lit(30000)) + 7500).otherwise(F.pmod(mixed, F.lit(9000)) + 500).cast("int")
    bands["nir"] = F.when(F.pmod("l_partkey", F.lit(97)) == 0, 0).otherwise(bands["nir"])
    return li.select(
        F.col("l_orderkey").alias("scene"), pick(F.pmod("l_orderkey", F.lit(3)), "sentinel-2", "landsat-5", "landsat-7").alias("sensor"),
        F.pmod("l_partkey", F.lit(100)).cast("int").alias("row"), F.pmod("l_suppkey", F.lit(100)).cast("int").alias("col"), F.year("l_shipdate").alias("year"), *[v.alias(k) for k, v in bands.items()],
    )


def _dn_sql(band: str) -> str:
    a, b, c = DN[band]
    mixed = f"(l_partkey * {a} + l_suppkey * {b} + l_linenumber * {c})"
    value = f"(case when l_orderkey % 3 <> 0 then {mixed} * 4 % 30000 + 7500 else {mixed} % 9000 + 500 end)::int"
    return f"case when l_partkey % 97 = 0 then 0 else {value} end as nir" if band == "nir" else f"{value} as {band}"


PIXELS_SQL = f"""
    select l_orderkey as scene, case l_orderkey % 3 when 0 then 'sentinel-2' when 1 then 'landsat-5' else 'landsat-7' end as sensor,
        (l_partkey % 100)::int as row, (l_suppkey % 100)::int as col, year(l_shipdate)::int as year, {", ".join(map(_dn_sql, DN))}
    from lineitem"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.pmod("l_partkey", F.lit(256)).cast("int").alias("code"), F.pmod("l_suppkey", F.lit(10)).cast("int").alias("pred"), F.pmod("l_orderkey", F.lit(3)).cast("int").alias("sat"))


LABELS_SQL = "select (l_partkey % 256)::int as code, (l_suppkey % 10)::int as pred, (l_orderkey % 3)::int as sat from lineitem"


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask value per pixel and day; even pixels have no rows in 1998, so that a gap year exists."""
    li = read(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_suppkey").alias("pixel"), F.year("l_shipdate").alias("year"), F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("value"))
    return rows.where((F.col("year") != 1998) | (F.col("pixel") % 2 == 1))


MASKS_SQL = """
    select l_suppkey as pixel, year(l_shipdate)::int as year, case when l_quantity > 25 then 1.0::double else 0.0::double end as value
    from lineitem where year(l_shipdate) <> 1998 or l_suppkey % 2 = 1"""


def scene_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("scene_key")
    return scenes(spark, sf_dir).select(
        "scene_id", "sensor", F.col("acquisition_date").alias("date"), (F.pmod(key * 13, F.lit(1000)) / 10.0).alias("cloud"),
        (F.datediff("acquisition_date", F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000).alias("time_ms"), "minx", "miny", "maxx", "maxy",
    )


META_SQL = """
    select scene_id, sensor, acquisition_date as date, (scene_key * 13 % 1000) / 10.0::double as cloud,
        (acquisition_date - date '1970-01-01')::bigint * 86400000 as time_ms, minx, miny, maxx, maxy
    from scenes"""

#: In an order in which each may use those before it.
SQL = {"scenes": SCENES_SQL, "casts": CASTS_SQL, "levels": LEVELS_SQL, "runs": RUNS_SQL, "pixels": PIXELS_SQL, "label_pixels": LABELS_SQL, "masks": MASKS_SQL, "meta": META_SQL}


def with_tables(sql: str, *names: str) -> str:
    """A query with the domain tables it names in front."""
    needed = {"runs": ["scenes", "runs"], "meta": ["scenes", "meta"]}
    wanted = {n for name in names for n in needed.get(name, [name])}
    tables = ", ".join(f"{n} as ({body})" for n, body in SQL.items() if n in wanted)
    if sql.lstrip().startswith("with recursive "):
        return f"with recursive {tables}, {sql.lstrip()[len('with recursive ') :]}"
    return f"with {tables}, {sql.lstrip()[5:]}" if sql.lstrip().startswith("with ") else f"with {tables} {sql}"
