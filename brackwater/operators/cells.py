"""Grid cells that follow density, for joins of points with boxes.

An equi-join on grid cells sends a cell to one task. Where points and boxes crowd, a cell's pairs outgrow it: such
cells are split into quarters, level by level, and at the last level the points are dealt into parts that each meet all
boxes of the cell. A point lies in one cell and part, so a pair still comes up once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: Pairs of a point and a box that one cell may hold before it is split.
PAIRS = 20_000_000
_CELL = ["_level", "_cx", "_cy"]
_ENDS = ("_x0", "_y0", "_x1", "_y1")


def _between(low: Column, high: Column, side: float) -> Column:
    return F.sequence(F.floor(low / side), F.floor(high / side))


def _first(df: DataFrame, ends: tuple[Column, Column, Column, Column], side: float) -> DataFrame:
    """df with its extent and a row for every cell of the first level that this touches."""
    at = df.withColumns(dict(zip(_ENDS, ends, strict=True))).withColumn("_level", F.lit(0))
    return at.withColumn("_cx", F.explode(_between(F.col("_x0"), F.col("_x1"), side))).withColumn("_cy", F.explode(_between(F.col("_y0"), F.col("_y1"), side)))


def _split(df: DataFrame, crowded: DataFrame, keys: list[str], level: int, side: float) -> DataFrame:
    """df with its rows in crowded cells of a level moved to those quarters of them that their extent touches."""
    met = df.join(crowded.select(*keys, *_CELL, F.lit(True).alias("_open")), [*keys, *_CELL], "left")
    half = side / 2 ** (level + 1)

    def quarters(n: str, low: str, high: str) -> Column:
        within = F.filter(_between(F.col(low), F.col(high), half), lambda q: F.floor(q / 2) == F.col(n))
        return F.explode(F.when(F.col("_open"), within).otherwise(F.array(n)))

    out = met.withColumn("_cx", quarters("_cx", "_x0", "_x1")).withColumn("_cy", quarters("_cy", "_y0", "_y1"))
    return out.withColumn("_level", F.when(F.col("_open"), level + 1).otherwise(F.col("_level"))).drop("_open")


def dealt(
    points: DataFrame, boxes: DataFrame, keys: list[str], place: tuple[Column, Column], extent: tuple[Column, Column, Column, Column], side: float, depth: int, pairs: int = PAIRS
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points and boxes with the cells and parts that they lie in, and the columns to join them on.

    Only cells with more than `pairs` pairs are split: counts of both sides by cell, combined before they are shuffled, say which.
    """
    x, y = place
    p, b = _first(points, (x, y, x, y), side), _first(boxes, extent, side)
    for level in range(depth + 1):
        here = [s.where(F.col("_level") == level).groupBy(*keys, *_CELL).agg(F.count("*").alias(n)) for s, n in ((p, "_p"), (b, "_b"))]
        crowded = here[0].join(here[1], [*keys, *_CELL]).where(F.col("_p") * F.col("_b") > pairs)
        crowded = written(crowded.withColumn("_parts", F.least("_p", F.ceil(F.col("_p") * F.col("_b") / pairs)).cast("int")).drop("_p", "_b"), "crowded")
        if crowded.isEmpty():
            on = [*keys, *_CELL]
            break
        if level == depth:
            parts = F.coalesce("_parts", F.lit(1))
            p = p.join(crowded, [*keys, *_CELL], "left").withColumn("_part", F.pmod(F.xxhash64(*points.columns), parts)).drop("_parts")
            b = b.join(crowded, [*keys, *_CELL], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
            b = b.withColumn("_part", F.col("_part").cast("long"))
            on = [*keys, *_CELL, "_part"]
            break
        p, b = (_split(s, crowded, keys, level, side) for s in (p, b))
    return p.drop(*_ENDS), b.drop(*_ENDS), on


def met_in_cells(
    points: DataFrame, boxes: DataFrame, keys: list[str], place: tuple[Column, Column], extent: tuple[Column, Column, Column, Column], side: float, depth: int, pairs: int = PAIRS
) -> DataFrame:
    """Every pair of a point and a box with equal keys whose extent holds the point, and some more that share a cell, each once.

    place is a point's x and y, extent a box's least x and y and greatest x and y. side is a cell's width at
    first; it is halved up to depth times. Points without a place and boxes without an extent meet nothing.
    """
    p, b, on = dealt(points, boxes, keys, place, extent, side, depth, pairs)
    return p.join(b, on).drop(*_CELL, "_part")


def levels_down_to(side: float, reach: float) -> int:
    """Halvings after which a cell is no wider than what boxes are grown by; smaller ones would only repeat the boxes."""
    return max(0, math.ceil(math.log2(side / reach))) if reach > 0 else 8
