"""Outlines of raster regions as rings of corners.

A pixel has four directed sides with itself on their right. Within a region a side comes in both directions and
cancels out; what is left is the outline, found by one aggregation. Straight runs of sides become segments. Where a
region touches itself at a corner, the outline turns left there, so that rings are simple: a hole that touches the
outer ring stays a ring of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

#: Directions of sides, the region on their right (rows count downwards): right along the top, down, left, up.
RIGHT, DOWN, LEFT, UP = range(4)


def segments(labelled: DataFrame) -> DataFrame:
    """Straight pieces of all outlines of labelled pixels (row, col, region): segment, region, direction, x1, y1, x2, y2.

    Corners count in pixels from the raster's upper left one; segment is a number by start and direction, for fewer than
    2^29 rows and 2^31 columns. Repeated pixels count once; pixels without a place or region are dropped.
    """
    def side(dx: int, dy: int, direction: int) -> Column:
        return F.struct((F.col("col").cast("long") + dx).alias("x"), (F.col("row").cast("long") + dy).alias("y"), F.lit(direction % 2 == 1).alias("vertical"), F.lit(direction).alias("direction"))

    # Sides by their lesser end: the two directions of a side between pixels of a region meet in one group.
    sides = F.array(side(0, 0, RIGHT), side(1, 0, DOWN), side(0, 1, LEFT), side(0, 0, UP))
    every = labelled.where("row is not null and col is not null and region is not null").select("region", F.inline(sides))
    ways = every.groupBy("region", "x", "y", "vertical").agg(F.min("direction").alias("direction"), F.max("direction").alias("_other"))
    line, at = F.when(F.col("vertical"), F.col("x")).otherwise(F.col("y")), F.when(F.col("vertical"), F.col("y")).otherwise(F.col("x"))
    outer = ways.where("direction = _other").select("region", "direction", line.alias("line"), at.alias("at"))
    along = Window.partitionBy("region", "direction", "line").orderBy("at")  # one line of the raster at most
    runs = outer.withColumn("_run", F.col("at") - F.row_number().over(along)).groupBy("region", "direction", "line", "_run").agg(F.min("at").alias("low"), (F.max("at") + 1).alias("high"))
    onward = F.col("direction").isin(RIGHT, DOWN)
    first, last = F.when(onward, F.col("low")).otherwise(F.col("high")), F.when(onward, F.col("high")).otherwise(F.col("low"))
    level = F.col("direction").isin(RIGHT, LEFT)
    ends = {"x1": (first, F.col("line")), "y1": (F.col("line"), first), "x2": (last, F.col("line")), "y2": (F.col("line"), last)}
    placed = runs.select("region", "direction", *[F.when(level, a).otherwise(b).alias(n) for n, (a, b) in ends.items()])
    return placed.withColumn("segment", (F.col("y1") * (1 << 31) + F.col("x1")) * 4 + F.col("direction"))


def _successors(pieces: DataFrame) -> DataFrame:
    """(node, up): the segment that follows each one. A region has at most two segments into a corner and two out of it."""
    way = F.struct("segment", "direction")
    came = pieces.select("region", F.col("x2").alias("x"), F.col("y2").alias("y"), way.alias("came"), F.lit(None).cast("struct<segment:bigint,direction:int>").alias("left"))
    left = pieces.select("region", F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(None).cast("struct<segment:bigint,direction:int>").alias("came"), way.alias("left"))
    met = came.union(left).groupBy("region", "x", "y").agg(F.collect_list("came").alias("came"), F.collect_list("left").alias("left"))
    one = met.select(F.explode("came").alias("came"), "left")
    turn = F.filter("left", lambda w: (F.size("left") == 1) | (w["direction"] == F.pmod(F.col("came.direction") + 3, F.lit(4))))
    return one.select(F.col("came.segment").alias("node"), F.get(turn, F.lit(0))["segment"].alias("up"))


def ring_corners(labelled: DataFrame) -> DataFrame:
    """region, ring (its smallest segment), position (from 0, clockwise for outer rings), x, y and the next corner x2, y2: one row per corner.

    Pointer doubling: after k rounds a segment knows the smallest one among the 2^k that follow it and how far it is
    off. A round in which no segment learns of a smaller one is the last; rounds grow with the logarithm of the longest ring.
    """
    pieces = written(segments(labelled))
    state = written(_successors(pieces).select("node", "up", F.col("node").alias("ring"), F.lit(0).cast("long").alias("off")))
    reach = 1
    while True:
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("ring").alias("_ring"), F.col("off").alias("_off"))
        less = F.col("_ring") < F.col("ring")
        state = written(
            state.join(ahead, "up").select(
                "node", F.col("_up").alias("up"), F.least("ring", "_ring").alias("ring"), F.when(less, F.col("_off") + reach).otherwise(F.col("off")).alias("off"), less.alias("moved")
            )
        )
        if state.where("moved").isEmpty():
            break
        state, reach = state.drop("moved"), reach * 2
    sizes = state.groupBy("ring").agg(F.count("*").alias("_n"))
    placed = state.join(sizes, "ring").select(F.col("node").alias("segment"), "ring", F.pmod(F.col("_n") - F.col("off"), F.col("_n")).alias("position"))
    return pieces.join(placed, "segment").select("region", "ring", "position", F.col("x1").alias("x"), F.col("y1").alias("y"), "x2", "y2")


def rings(corners: DataFrame) -> DataFrame:
    """Of ring_corners, one row per ring: region, ring, hole, corners, perimeter and area in pixels (negative for holes, so that a region's areas add up to its pixels)."""
    twice = F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))
    whole = corners.groupBy("region", "ring").agg(
        F.count("*").alias("corners"), F.sum(F.abs(F.col("x2") - F.col("x")) + F.abs(F.col("y2") - F.col("y"))).alias("perimeter"), twice.alias("_twice")
    )
    return whole.select("region", "ring", (F.col("_twice") < 0).alias("hole"), "corners", "perimeter", F.expr("_twice div 2").alias("area"))


def outline_wkt(corners: DataFrame, origin: tuple[float, float] = (0.0, 0.0), size: tuple[float, float] = (1.0, -1.0)) -> DataFrame:
    """region and wkt, a POLYGON with its outer ring first and holes by their number.

    origin is the place of the raster's upper left corner, size a pixel's width and height (negative where rows run southwards).
    A row holds all corners of its region; regions too large for one row are ring_corners' to read.
    """
    place = F.concat_ws(" ", *[(F.lit(float(o)) + F.col(n) * F.lit(float(s))).cast("string") for n, o, s in zip("xy", origin, size, strict=True)])
    twice = F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))
    own = corners.groupBy("region", "ring").agg(F.array_sort(F.collect_list(F.struct("position", place.alias("at")))).alias("_at"), (twice < 0).alias("hole"))
    text = F.concat(F.lit("("), F.array_join(F.concat(F.col("_at.at"), F.slice("_at.at", 1, 1)), ", "), F.lit(")"))
    whole = own.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("hole", "ring", text.alias("text")))).alias("_rings"))
    return whole.select("region", F.concat(F.lit("POLYGON ("), F.array_join(F.col("_rings.text"), ", "), F.lit(")")).alias("wkt"))
