"""Exact percentiles of groups of any size in bounded memory.

The built-in percentile keeps every distinct value of a group in one task. Here groups beyond a limit are
narrowed down: sketches give each wanted rank a bracket of values, exact counts below and inside the bracket
say where the rank lies, and only the values inside go on, until few are left to sort. Sums and sketches are
combined before they are shuffled, so a group that is the whole table is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: Values of a group, or of a bracket, that one task may sort.
LIMIT = 100_000
#: Rows by which a sketch of this accuracy may be off, as a share of its rows, doubled to be safe.
ACCURACY = 2_000


def _marked(values: DataFrame, ranks: DataFrame, on: list[str]) -> DataFrame:
    """Values with the ranks (and what is known of them) that they may hold; null groups meet."""
    other = ranks.select([F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in ranks.columns])
    same = F.lit(True)
    for c in on:
        same = same & values[c].eqNullSafe(other[f"_{c}"])
    return values.join(other, same).drop(*[f"_{c}" for c in on])


def percentiles(df: DataFrame, by: str, columns: tuple[str, ...], shares: tuple[float, ...], limit: int = LIMIT) -> DataFrame:
    """by, band (the column), share and value: percentiles with linear interpolation between the two ranks beside them.

    Nulls and NaN don't count; a group without values in a column has no row for it. A null in `by` is a group.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("band"), F.col(c).cast("double").alias("v")) for c in columns]))
    rows = df.select(F.col(by).alias("g"), values.alias("x")).select("g", "x.*").where("v is not null and not isnan(v)")
    sizes = written(rows.groupBy("g", "band").agg(F.count("*").alias("n")), "sizes")
    share = F.explode(F.array(*[F.lit(float(p)) for p in shares])).alias("share")
    wanted = sizes.select("g", "band", "n", share).withColumn("at", F.col("share") * (F.col("n") - 1))
    ranks = wanted.select("g", "band", "n", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    ranks = written(ranks.withColumns({"below": F.lit(0).cast("long"), "inside": F.col("n")}).drop("n"), "ranks")
    held, found, key = rows, [], ["g", "band", "rank"]
    on = ["g", "band"]  # in the first round a group's values serve all its ranks
    while True:
        small = ranks.where(F.col("inside") <= limit)
        lists = _marked(held, small.select(*on).distinct(), on).groupBy(*on).agg(F.sort_array(F.collect_list("v")).alias("all"))  # once for all ranks
        found.append(written(_marked(lists, small, on).select(*key, F.get("all", (F.col("rank") - F.col("below")).cast("int")).alias("value")), "found"))
        large = ranks.where(F.col("inside") > limit)
        if large.isEmpty():
            break
        sketched = _marked(held, large.select(*on).distinct(), on).groupBy(*on)  # once for all ranks, too
        sketches = written(sketched.agg(F.approx_percentile("v", F.array(*[F.lit(i / 64) for i in range(65)]), ACCURACY).alias("cuts"), F.min("v").alias("least"), F.max("v").alias("most")), "sketches")
        ends = _marked(sketches, large, on)
        place = (F.col("rank") - F.col("below")) / F.col("inside")
        # The sketch is off by 1 / ACCURACY of the rows at most, a cut is 1 / 64 of them: one cut more on either side is sure to hold the rank.
        slot = F.floor(place * 64).cast("int")
        low = F.when(slot >= 2, F.get("cuts", F.greatest(slot - 1, F.lit(0)))).otherwise(F.col("least"))
        high = F.when(slot <= 61, F.get("cuts", F.least(slot + 2, F.lit(64)))).otherwise(F.col("most"))
        brackets = written(ends.select(*key, "below", low.alias("low"), high.alias("high")), "brackets")
        inside = _marked(held, brackets, on)
        # The bracket's ends may be values that many rows have, so they are told apart from what lies between, which is a few cuts at most.
        parts = {"under": F.col("v") < F.col("low"), "at_low": F.col("v") == F.col("low"), "between": (F.col("v") > F.col("low")) & (F.col("v") < F.col("high")), "at_high": (F.col("v") == F.col("high")) & (F.col("low") < F.col("high"))}
        counts = inside.groupBy(*key, "below", "low", "high").agg(*[F.count(F.when(c, 1)).alias(n) for n, c in parts.items()])
        own, low_end = F.col("rank") - F.col("below"), F.col("under") + F.col("at_low")
        place = F.when(own < F.col("under"), "lost").when(own < low_end, "low").when(own < low_end + F.col("between"), "between").when(own < low_end + F.col("between") + F.col("at_high"), "high").otherwise("lost")
        counts = written(counts.withColumn("place", F.when(place == "lost", F.raise_error("a sketch was further off than it may be")).otherwise(place)), "counts")
        found.append(written(counts.where("place <> 'between'").select(*key, F.when(F.col("place") == "low", F.col("low")).otherwise(F.col("high")).alias("value")), "found"))
        ranks = written(counts.where("place = 'between'").select(*key, (F.col("below") + low_end).alias("below"), F.col("between").alias("inside")), "ranks")
        held = written(_marked(inside.where("v > low and v < high").select(*key, "v"), ranks.select(*key), key).select(*key, "v"), "held")
        on = key
        if ranks.isEmpty():
            break
    at_rank = found[0]
    for more in found[1:]:
        at_rank = at_rank.union(more)
    ends = [at_rank.select(F.col("g").alias(f"g{i}"), F.col("band").alias(f"c{i}"), F.col("rank").alias(f"r{i}"), F.col("value").alias(f"v{i}")) for i in (0, 1)]
    out = wanted
    for i, (end, rank) in enumerate(zip(ends, (F.floor("at"), F.ceil("at")), strict=True)):
        out = out.join(end, F.col("g").eqNullSafe(F.col(f"g{i}")) & (F.col("band") == F.col(f"c{i}")) & (rank == F.col(f"r{i}")))
    value = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("at") - F.floor("at"))
    return out.select(F.col("g").alias(by), "band", "share", value.alias("value"))
