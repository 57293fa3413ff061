"""What the two vector operators share: reading vectors of any numeric array type into matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    double = vector.cast("array<double>")
    return F.coalesce(vector.isNotNull() & F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def matrix(vectors) -> np.ndarray:
    """Rows of doubles from a sequence of arrays; shorter ones are filled up with zeros."""
    parts = [np.asarray(v, np.float64) for v in vectors]
    width = max((len(p) for p in parts), default=0)
    if all(len(p) == width for p in parts):
        return np.stack(parts) if parts else np.zeros((0, 0))
    out = np.zeros((len(parts), width))
    for row, p in zip(out, parts, strict=True):
        row[: len(p)] = p
    return out


def unpacked(blobs) -> np.ndarray:
    """matrix() of little-endian doubles packed as bytes."""
    return matrix([np.frombuffer(b, "<f8") for b in blobs])
