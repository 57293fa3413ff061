"""Operator 11: embedding whitening from a compensated covariance.

Sums and centred outer products are accumulated as double-doubles: a block of rows is cut into slices of
few bits with one exponent by column, so that products of slices add up in doubles without any rounding
(an error-free transformation of the matrix product), and the exact parts are added by two-sum into a high
and a low part. Tasks send both parts, which are merged in two levels by the same two-sum. LAPACK's divide
and conquer on the tridiagonal form (numpy's eigh) solves the covariance, one number for each pair of
dimensions; two steps of refinement with residuals in double-double follow, so that small eigenvalues
beside great ones are right as well. Projection uses both parts, too.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, runs, saved

#: Entries c become floor(SCALE * c) + SHIFT; beyond LIMIT they count as LIMIT, so that doubles hold them exactly.
SCALE, SHIFT, LIMIT = 64.0, 1_000_000, float(1 << 52)
#: Rows multiplied at once and bits of a slice: 2 * BITS and the rows' bits stay below a double's 53.
ROWS, BITS, SLICES = 2_048, 20, 5
#: First level groups of the merge.
GROUPS = 64
#: Components with less than this share of the greatest eigenvalue have no variance.
NOTHING = 1e-24

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """a + b as the rounded sum and its exact error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def added(a: Pair, b: Pair) -> Pair:
    s, e = two_sum(a[0], b[0])
    return two_sum(s, e + (a[1] + b[1]))


def _slices(m: Pair) -> list[np.ndarray]:
    """SLICES matrices that add up to m: those of one column are multiples of one power of two, of BITS bits each."""
    hi, lo = m
    unit = np.ldexp(1.0, np.frexp(np.abs(hi).max(axis=0, initial=0))[1] - BITS)
    out = []
    for _ in range(SLICES):
        part = np.rint(hi / unit) * unit
        out.append(part)
        hi, lo = two_sum(hi - part, lo)
        unit = unit * 2.0**-BITS
    return out


def product(a: Pair, b: Pair) -> Pair:
    """The transpose of a times b."""
    total = (np.zeros((a[0].shape[1], b[0].shape[1])),) * 2
    for lo in range(0, len(a[0]), ROWS):
        left = _slices((a[0][lo : lo + ROWS], a[1][lo : lo + ROWS]))
        right = left if a is b else _slices((b[0][lo : lo + ROWS], b[1][lo : lo + ROWS]))
        for i in range(SLICES):
            for j in range(i if a is b else 0, SLICES - i):
                exact = left[i].T @ right[j]
                total = added(total, (exact, np.zeros_like(exact)))
                if a is b and i != j:
                    total = added(total, (exact.T, np.zeros_like(exact)))
    return total


def eigen(v: Pair) -> tuple[np.ndarray, Pair]:
    """Falling eigenvalues of a symmetric matrix and its unit eigenvectors as columns."""
    x = np.linalg.eigh(v[0])[1]
    vectors = (x, np.zeros_like(x))
    one, none = np.eye(len(x)), np.zeros_like(x)
    for last in (False, False, False, True):
        away = product(vectors, vectors)
        away = added((one, none), (-away[0], -away[1]))[0]
        turned = sum(product(vectors, product(v, vectors)))
        values = np.diag(turned) / (1 - np.diag(away))
        if last:
            order = np.argsort(-values, kind="stable")
            return values[order], (vectors[0][:, order], vectors[1][:, order])
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= 2 * (np.linalg.norm(turned - np.diag(values)) + np.linalg.norm(v[0]) * np.linalg.norm(away))
        step = np.where(near, away / 2, (turned + values[None, :] * away) / np.where(near, 1.0, gap))
        vectors = added(vectors, (vectors[0] @ step, none))
        small = np.flatnonzero(values <= 1e-8 * values.max())
        if len(small):  # beside great eigenvalues the first solution mixes these; they get one of their own
            own = one.copy()
            own[np.ix_(small, small)] = np.linalg.eigh(turned[np.ix_(small, small)])[1]
            vectors = product((vectors[0].T, vectors[1].T), (own, none))


def usable(array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of an Arrow list column are there with all their entries, present and finite; and those as rows of doubles, shorter ones filled up with zeros."""
    keep = np.asarray(array.is_valid())
    sizes = np.asarray(array.value_lengths().fill_null(0), np.int64)
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # missing entries are not a number
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep[row[~np.isfinite(flat)]] = False
    if not keep.all():
        flat, sizes = flat[keep[row]], sizes[keep]
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return keep, flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return keep, out


def filled(m: np.ndarray, width: int) -> np.ndarray:
    """m with columns of zeros up to this width."""
    return np.pad(m, [(0, 0)] * (m.ndim - 1) + [(0, max(width - m.shape[-1], 0))])


def merged_pair(a: Pair | None, b: Pair) -> Pair:
    """The sum of two double-doubles, the narrower filled up with zeros."""
    if a is None:
        return b
    width = max(a[0].shape[-1], b[0].shape[-1])
    return added((filled(a[0], width), filled(a[1], width)), (filled(b[0], width), filled(b[1], width)))


def accumulated(rows: DataFrame, of: Callable[[object], np.ndarray], outer: Callable[[np.ndarray], tuple[Pair, Pair]]) -> Pair:
    """The double-double product of what outer() makes of all rows, which of() takes from an Arrow column. No rows: an empty matrix."""

    def partial(batches):
        import pyarrow as pa

        held, size, total = [], 0, None
        number = 0

        def multiply():
            width = max(m.shape[1] for m in held)
            return product(*outer(np.concatenate([filled(m, width) for m in held])))

        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                held.append(of(batch.column(0).slice(lo, ROWS)))
                size += len(held[-1])
                number = batch.column(1)[0].as_py()
                if size >= ROWS:
                    total = merged_pair(total, multiply())
                    held, size = [], 0
        if held:
            total = merged_pair(total, multiply())
        if total is not None:
            n = len(total[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number % GROUPS), pa.int32()), pa.array(np.arange(n), pa.int32()), *[pa.array([r.tobytes() for r in part], pa.binary()) for part in total]],
                names=["part", "line", "hi", "lo"],
            )

    def merged(batches):
        import pandas as pd

        for block in runs(batches, ["part", "line"]):
            total = None
            for hi, lo in zip(block["hi"], block["lo"], strict=True):
                total = merged_pair(total, (np.frombuffer(hi), np.frombuffer(lo)))
            yield pd.DataFrame([[block["part"].iat[0], block["line"].iat[0], *[x.tobytes() for x in total]]], columns=["part", "line", "hi", "lo"])

    fixed = "part int, line int, hi binary, lo binary"
    sums = rows.withColumn("number", F.spark_partition_id()).mapInArrow(partial, fixed)
    for key in (F.col("part"), F.lit(0)):  # within groups of tasks, then over the groups
        sums = sums.withColumn("part", key).repartition("part", "line").sortWithinPartitions("part", "line").mapInPandas(merged, fixed)
    found = sorted(sums.select("line", "hi", "lo").collect())
    if not found:
        return np.zeros((0, 0)), np.zeros((0, 0))
    return np.stack([np.frombuffer(r["hi"]) for r in found]), np.stack([np.frombuffer(r["lo"]) for r in found])


def column_sums(rows: DataFrame, of: Callable[[object], np.ndarray]) -> tuple[int, list[Fraction]]:
    """How many rows of() takes, and the exact sums of their columns."""

    def counted(array):
        m = of(array)
        return np.c_[np.ones(len(m)), m]

    def ones(m: np.ndarray):
        return (np.ones((len(m), 1)), np.zeros((len(m), 1))), (m, np.zeros_like(m))

    hi, lo = accumulated(rows, counted, ones)
    n, *sums = [Fraction(h) + Fraction(x) for h, x in zip(hi.ravel().tolist(), lo.ravel().tolist(), strict=True)] or [0]
    return int(n), sums


def _double_doubles(values: list[Fraction]) -> Pair:
    hi = [float(v) for v in values]
    return np.array(hi), np.array([float(v - Fraction(h)) for v, h in zip(values, hi, strict=True)])


def _centred(m: np.ndarray, mean: Pair) -> Pair:
    hi, lo = two_sum(m, -mean[0])
    return two_sum(hi, lo - mean[1])


def covariance(rows: DataFrame, of: Callable[[object], np.ndarray], mean: Pair, n: int) -> Pair:
    """The covariance, divisor n, of what of() takes from the rows, centred at mean before multiplying."""

    def centred(m: np.ndarray):
        y = _centred(m, mean)
        return y, y

    hi, lo = accumulated(rows, of, centred)
    share, rest = _double_doubles([(Fraction(h) + Fraction(x)) / n for h, x in zip(hi.ravel().tolist(), lo.ravel().tolist(), strict=True)])
    return share.reshape(hi.shape), rest.reshape(hi.shape)


def integers(m: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * m), -LIMIT, LIMIT) + SHIFT


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact sums of (n * x - S)^2 by row; beyond 64 bits the greatest 64-bit number."""
    most = max((max(abs(n * int(lo) - s), abs(n * int(hi) - s)) for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), sums, strict=True)), default=0)
    if most * most * max(len(sums), 1) < 1 << 62 and n * int(np.abs(x).max(initial=0)) < 1 << 62:
        away = n * x.astype(np.int64) - np.array(sums, np.int64)
        return (away * away).sum(axis=1)
    return np.array([min(sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)), (1 << 63) - 1) for row in x], np.int64)


def whitened(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every vector on the leading principal components, at unit variance.

    Entries c count as x = floor(64 * c) + 1000000. Returns id_col, component (from 1, by falling
    eigenvalue), n, deviation (exact sum of (n * x - S)^2), whitened, explained (share of the trace) and
    identity_error (the largest absolute entry of whitened's covariance minus the identity), a row for each
    vector and component. Vectors that are null or hold null or non-finite entries are left out; rows that
    repeat count each, null ids too. Shorter vectors are filled up with zeros. A component without variance
    (all vectors alike, or fewer vectors than dimensions) has whitened and explained 0 and no part in
    identity_error. No rows, or no dimensions: no rows. Other columns are not read. The driver holds a
    number for each pair of dimensions.
    """
    vector = column(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        vector = vector.cast("array<double>")
    rows = vectors.select(column(id_col).alias("_id"), vector.alias("vector"))
    n, sums = column_sums(rows.select("vector"), lambda a: integers(usable(a)[1]) - SHIFT)
    width = len(sums)
    fixed = f"_id {rows.schema['_id'].dataType.simpleString()}, deviation bigint, whitened array<double>"
    explained = scale = np.zeros(0)
    sums = [int(s) + n * SHIFT for s in sums]
    mean = _double_doubles([Fraction(s, n) for s in sums])

    def entries(array):
        keep, m = usable(array)
        return keep, integers(filled(m, width))

    if width:
        cov = covariance(rows.select("vector"), lambda a: entries(a)[1], mean, n)
        values, axes = eigen(cov)
        k = min(components, width)
        live = values[:k] > NOTHING * max(values[0], 0)
        explained = np.where(live, values[:k] / max(np.trace(cov[0]), np.finfo(float).tiny), 0.0)
        axes = axes[0][:, :k], axes[1][:, :k]
        scale = np.where(live, 1 / np.sqrt(np.where(live, values[:k], 1.0)), 0.0)

    def projected(batches):
        import pyarrow as pa

        k = len(scale)
        for batch in batches:
            for lo in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(lo, ROWS)
                keep, x = entries(part.column(1))
                if not len(x):
                    continue
                hi, low = _centred(x, mean)
                w = (sum(product((hi.T, low.T), axes)) * scale).reshape(-1)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, pa.array(w))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(keep)), pa.array(_deviations(x, n, sums)), lists], names=["_id", "deviation", "whitened"])

    out = saved(rows.mapInArrow(projected, fixed), "whitened")
    error = 0.0
    if len(scale):
        own = out.select("whitened")
        middle = _double_doubles([s / n for s in column_sums(own, lambda a: usable(a)[1])[1]])
        cov = covariance(own, lambda a: usable(a)[1], middle, n)
        at = np.flatnonzero(scale)
        error = float(np.abs(sum(cov) - np.eye(len(scale)))[np.ix_(at, at)].max(initial=0.0))
    shares = F.array(*[F.lit(float(s)) for s in explained]) if len(explained) else F.array().cast("array<double>")
    long = out.select("_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return long.select(
        F.col("_id").alias(id_col), (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
