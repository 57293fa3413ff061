"""Operator 2: near-duplicate vectors by spherical-cap filters.

A filter is a direction; its cap holds the vectors whose product with it reaches a threshold. The
directions are a structured random product code: after a seeded rotation the dimensions fall into two
blocks, each block has a code of random unit vectors, and every pair of a word of the first and a word
of the second is a direction. A vector's filters are list-decoded: the words of either block that can still
reach the threshold with the best of the other, and of those the pairs that do. The threshold is a margin below
the vector's best score, which leaves no vector without filters and few with many; the margin is fitted, for the code
in use, so that a set share of pairs at exactly the least cosine has a filter in common: a larger code gives more
filters to a vector.

Vectors meet in their filters as short sign sketches, which bring those together that may be near. Groups that
are found so are small as a rule; their vectors, shipped once, are compared all with all. Large
groups are compared filter by filter in blocks, a pair counting in the least filter that it shares. Cosines are in
double precision. Equal vectors are one vector with a count, and groups yield stars, not their pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, components, runs, saved
from .vectors import finite, matrix

#: Share of pairs at the least cosine that have a filter in common.
RECALL = 0.99
#: Vectors aimed at per filter, and the words of a code at most (beyond, filters hold more vectors and are split into blocks).
AIM, MOST_WORDS = 64, 1 << 15
#: Vectors that are compared in one block.
BLOCK = 1_024
#: Bits of a sketch. Bits of near vectors differ with a known chance; a pair is looked at up to so many deviations above that.
BITS, DEVIATIONS = 256, 5.5
#: One vector in so many is counted to find filters that need several blocks.
COUNTED = 16
#: Vectors that the margin is fitted on, at most (every vector is decoded).
SAMPLE = 1_024
SEED = 20_240


class ProductCode:
    """Filter directions for vectors of one width: words_per_block ** 2 of them."""

    def __init__(self, width: int, words_per_block: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.half = max(1, width // 2)
        self.turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        self.blocks = []
        for n in (self.half, width - self.half):
            words = rng.standard_normal((words_per_block, max(n, 1)))
            self.blocks.append(words / np.linalg.norm(words, axis=1, keepdims=True) / np.sqrt(2))
        self.size = words_per_block

    def scores(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the words of either block fall short of the best one by: a filter's score less the vector's best is the sum of two."""
        turned = units @ self.turn
        left, right = turned[:, : self.half] @ self.blocks[0].T, turned[:, self.half :] @ self.blocks[1][:, : units.shape[1] - self.half].T
        return left - left.max(axis=1, keepdims=True), right - right.max(axis=1, keepdims=True)

    def rows_at_once(self) -> int:
        """Vectors whose scores take some tens of megabytes."""
        return max(16, (1 << 21) // self.size)

    def decode(self, units: np.ndarray, margin: float) -> list[np.ndarray]:
        """For each vector the sorted filters whose score is at most the margin below its best one's."""
        out: list[np.ndarray] = []
        for lo in range(0, len(units), step := self.rows_at_once()):
            for a, b in zip(*self.scores(units[lo : lo + step]), strict=True):
                i, j = np.flatnonzero(a >= -margin), np.flatnonzero(b >= -margin)
                x, y = np.nonzero(a[i][:, None] + b[j][None, :] >= -margin)
                out.append(i[x] * self.size + j[y])
        return out

    def margin_for(self, units: np.ndarray, cosine: float, recall: float = RECALL, tries: int = 24) -> float:
        """The margin at which this share of pairs at this cosine, one of each taken from units, has a common filter."""
        rng = np.random.default_rng(self.size)
        z = rng.standard_normal(units.shape)
        z -= (z * units).sum(axis=1, keepdims=True) * units
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        others = cosine * units + np.sqrt(max(0.0, 1 - cosine**2)) * z
        best = []  # the least margin at which a pair shares a filter, among the likeliest words of both blocks
        for lo in range(0, len(units), step := self.rows_at_once()):
            (a1, b1), (a2, b2) = self.scores(units[lo : lo + step]), self.scores(others[lo : lo + step])
            k = min(tries, self.size)
            i, j = (np.argpartition(-np.minimum(x, y), k - 1, axis=1)[:, :k] for x, y in ((a1, a2), (b1, b2)))
            sums = [np.take_along_axis(a, i, 1)[:, :, None] + np.take_along_axis(b, j, 1)[:, None, :] for a, b in ((a1, b1), (a2, b2))]
            best.append(-np.minimum(*sums).max(axis=(1, 2)))
        return float(np.quantile(np.concatenate(best), recall))


def fitted_code(width: int, count: int, sample: np.ndarray, cosine: float) -> tuple[ProductCode, float]:
    """The smallest code whose filters hold AIM of count vectors or fewer on average, and its margin."""
    words = 8
    while True:
        code = ProductCode(width, words)
        margin = code.margin_for(sample, cosine)
        filters = np.mean([len(f) for f in code.decode(sample[:256], margin)])
        if words >= MOST_WORDS or words**2 * AIM >= count * filters:
            return code, margin
        words *= 2


def _joined(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least row that it reaches."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _meet(most: int):
    """Of each pair of blocks of a filter: stars (u, v) of vectors whose sketches differ in at most so many bits."""
    import pandas as pd

    def run(batches):
        for group in runs(batches, ["filter", "left", "right"]):
            n = len(group)
            if n < 2:
                continue
            bits = np.frombuffer(b"".join(group["sketch"]), np.uint64).reshape(n, -1)
            near = np.empty((n, n), bool)
            for lo in range(0, n, 128):
                near[lo : lo + 128] = np.bitwise_count(bits[lo : lo + 128, None, :] ^ bits[None, :, :]).sum(axis=2) <= most
            np.fill_diagonal(near, False)
            at = np.flatnonzero(near.any(axis=1))
            if not len(at):
                continue
            rid, label = group["rid"].to_numpy()[at], _joined(near[np.ix_(at, at)])
            yield pd.DataFrame({"u": rid, "v": rid[label]})

    return run


def _compare(least_cosine: float, units):
    """Of each group, or pair of blocks of one in a filter: rid, links counted here, and the root of those linked."""
    import pandas as pd

    def run(batches):
        for group in runs(batches, ["root", "filter", "left", "right"]):
            if len(group) < 2:
                continue
            own = int(group["filter"].iat[0])
            u = units(group["vector"])
            near = u @ u.T >= least_cosine
            np.fill_diagonal(near, False)
            if group["left"].iat[0] != group["right"].iat[0]:
                blk = group["blk"].to_numpy()
                near &= blk[:, None] != blk[None, :]
            at = np.flatnonzero(near.any(axis=1))
            if not len(at):
                continue
            near, rid, copies = near[np.ix_(at, at)], group["rid"].to_numpy()[at], group["copies"].to_numpy()[at]
            root = rid[_joined(near)]
            if own >= 0:  # pairs that share a lesser filter count there
                lists = [f[f < own] for f in (np.asarray(x) for x in group["filters"].iloc[at])]
                lesser = np.unique(np.concatenate(lists))
                holds = np.zeros((len(at), len(lesser)), np.float32)
                for i, f in enumerate(lists):
                    holds[i, np.searchsorted(lesser, f)] = 1
                near &= holds @ holds.T == 0
            yield pd.DataFrame({"rid": rid, "links": near @ copies, "root": root})

    return run


def _blocks(n: str):
    return F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK)).cast("int")


def _dealt(cells: DataFrame, *more: str) -> DataFrame:
    """Rows with filter, rid and blocks, once for each pair of blocks that their own is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return cells.withColumn("blk", F.pmod(F.hash("rid"), F.col("blocks"))).withColumn("other", other).select("filter", F.least("blk", "other").alias("left"), F.greatest("blk", "other").alias("right"), "blk", "rid", *more)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least_cosine: float = 0.95) -> DataFrame:
    """Link vectors of at least this cosine and group them over links.

    Returns a row per row: id_col, n_links (other vectors linked directly), component_id (the smallest id
    reachable, its own included) and kept (whether that is its own id). Vectors that are null, zero or
    hold null or non-finite components link with nothing. A null id never is the smallest: such a row is
    kept only if its group has no id. Repeated rows are vectors that link with each other. Vectors of different
    widths are compared as if zeros followed the shorter. No rows: no rows. Other columns are not read.
    """
    vector = column(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = vectors.select(column(id_col).alias("id"), vector.alias("vector"), (finite(vector) & F.exists(vector, lambda x: x != 0)).alias("ok"))
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(SEED), "vector")})  # equal vectors have equal 128 bits, and others don't
    distinct = rows.where("ok").groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("id").alias("least_id"), F.first("vector").alias("vector"))
    distinct = saved(distinct.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    count, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(2))).first()
    width = max(width, 2)

    def units(values) -> np.ndarray:
        m = matrix(values)
        m = np.pad(m, ((0, 0), (0, width - m.shape[1])))
        m = m / np.abs(m).max(axis=1, keepdims=True)
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    sample = distinct.select("vector").orderBy("h1", "h2").limit(SAMPLE).collect()
    drawn = units([r["vector"] for r in sample]) if sample else np.eye(width)
    if len(drawn) < SAMPLE:
        drawn = np.tile(drawn, (-(-SAMPLE // len(drawn)), 1))[:SAMPLE]
    code, margin = fitted_code(width, count, drawn, least_cosine)
    planes = np.random.default_rng(SEED).standard_normal((width, BITS))
    differ = np.arccos(min(1.0, max(-1.0, least_cosine))) / np.pi
    most = int(BITS * differ + DEVIATIONS * np.sqrt(BITS * differ * (1 - differ))) + 1

    def decoded(batches):
        import pandas as pd

        for pdf in batches:
            for lo in range(0, len(pdf), 2_000):
                part = pdf.iloc[lo : lo + 2_000]
                u = units(part["vector"])
                sketch = np.packbits(u @ planes > 0, axis=1)
                yield pd.DataFrame({"rid": part["rid"], "sketch": [x.tobytes() for x in sketch], "filters": [f.astype(np.int32) for f in code.decode(u, margin)]})

    caps = saved(distinct.select("rid", "vector").mapInPandas(decoded, "rid bigint, sketch binary, filters array<int>"), "caps")
    counted = caps.where(F.pmod(F.xxhash64("rid"), F.lit(COUNTED)) == 0).select(F.explode("filters").alias("filter")).groupBy("filter").agg((F.count("*") * COUNTED).alias("n"))
    heavy = saved(counted.where(F.col("n") > BLOCK // 2), "heavy")  # a written table, so that its size decides how it is joined
    cells = caps.select("rid", "sketch", F.explode("filters").alias("filter")).join(heavy, "filter", "left").withColumn("blocks", F.coalesce(_blocks("n"), F.lit(1)))
    cells = _dealt(cells, "sketch").repartition("filter", "left", "right").sortWithinPartitions("filter", "left", "right")
    groups = saved(components(cells.mapInPandas(_meet(most), "u bigint, v bigint")).select(F.col("node").alias("rid"), "root"), "groups")

    large = saved(groups.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK).select("root"), "large")
    spot = F.lit(0)
    small = groups.join(large, "root", "left_anti").select("root", F.lit(-1).alias("filter"), spot.alias("left"), spot.alias("right"), spot.alias("blk"), "rid", F.lit(None).cast("array<int>").alias("filters"))
    own = saved(groups.join(large, "root").join(caps.select("rid", "filters"), "rid"), "large-caps").withColumn("filter", F.explode("filters"))
    held = saved(own.groupBy("root", "filter").agg(F.count("*").alias("n")).where("n > 1"), "large-filters")
    big = _dealt(own.join(held, ["root", "filter"]).withColumn("blocks", _blocks("n")), "root", "filters").select(*small.columns)
    met = small.union(big).join(distinct.select("rid", "copies", "vector"), "rid")
    met = met.repartition("root", "filter", "left", "right").sortWithinPartitions("root", "filter", "left", "right")
    found = saved(met.mapInPandas(_compare(least_cosine, units), "rid bigint, links bigint, root bigint"), "links")

    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rid").alias("u"), F.col("root").alias("v")))
    grouped = distinct.select("h1", "h2", "rid", "copies", "least_id").join(links, "rid", "left").join(roots, F.col("rid") == F.col("node"), "left").select(
        "h1", "h2", "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root")
    )
    smallest = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_vector = grouped.join(smallest, "root").select("h1", "h2", "n_links", "component_id")
    good = rows.where("ok").select("id", "h1", "h2").join(by_vector, ["h1", "h2"]).select("id", "n_links", "component_id")
    rest = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.union(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
