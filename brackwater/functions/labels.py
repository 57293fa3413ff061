"""Land-cover label maps (B15-B17). Public codes of the crop data layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label ranges by class, both ends included.
SUPERCLASS_RANGES = {
    0: [(81, 81), (255, 255)],  # background
    1: [(1, 60), (66, 77), (204, 254)],  # crops
    2: [(61, 61)],  # fallow
    3: [(62, 62), (176, 176)],  # grassland
    4: [(63, 63), (141, 143)],  # forest
    5: [(64, 64), (152, 152)],  # shrubland
    6: [(65, 65), (131, 131)],  # barren
    7: [(82, 82), (92, 92), (111, 112)],  # water
    8: [(83, 83), (190, 190), (195, 195)],  # wetlands
    9: [(84, 88), (121, 124)],  # developed
}
VEGETATED = (1, 2, 3, 4, 5)
CLASSES = len(SUPERCLASS_RANGES)


def _mapped(code: Column, classes: dict[int, list[tuple[int, int]]]) -> Column:
    """Class of a code by place in an array of 256, which is one literal in the plan; null for unmapped codes."""
    by_code: list[int | None] = [None] * 256
    for name, ranges in classes.items():
        for low, high in ranges:
            by_code[low : high + 1] = [name] * (high + 1 - low)
    return F.get(F.array(*[F.lit(c).cast("int") for c in by_code]), code)


def superclass(code: Column) -> Column:
    """Class 0-9 of a label, 0 for an unmapped one."""
    return F.coalesce(_mapped(code, SUPERCLASS_RANGES), F.lit(0))


def training_label(code: Column) -> Column:
    """Label limited to 0..255, then its class; unmapped labels stay as they are."""
    limited = F.least(F.greatest(code, F.lit(0)), F.lit(255))
    return F.coalesce(_mapped(limited, SUPERCLASS_RANGES), limited)


def weight_label(code: Column) -> Column:
    """Class of a label, 255 (ignored) for an unmapped one."""
    return F.coalesce(_mapped(code, SUPERCLASS_RANGES), F.lit(255))


def vegetated(code: Column) -> Column:
    """1 for vegetation, 0 for other mapped labels, null for unmapped ones."""
    return _mapped(code, {0: sum((r for c, r in SUPERCLASS_RANGES.items() if c not in VEGETATED), []), 1: sum((SUPERCLASS_RANGES[c] for c in VEGETATED), [])})
