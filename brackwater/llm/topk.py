"""Operator 6: exact top-k inner products over vectors in order of length.

Components are turned into integers, so scores are exact. Candidates fall into bands of length, and within
a band into slices; an SVD rotation puts most of the length into the first few dimensions. The longest
vectors give every query a first bound on its k-th score. A band whose greatest length cannot reach the
bound (product of lengths) is out of a query's reach, so queries are put in order of the shortest band
that they reach, and a block of them is sent to the slices of the bands from there up only. A slice is
gone through by descending length: the product of the leading dimensions plus the product of the lengths
of the rest (Cauchy-Schwarz) rules out candidates, what remains is scored in full, and the bounds rise
to the k-th score found so far. Bounds only ever drop what cannot be among the k best, so the result is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import runs, saved
from .vectors import finite, matrix, unpacked

#: Candidates scored at once, candidates of a slice, and queries of a block.
BLOCK, SLICE, QUERIES = 2_048, 8_192, 256
#: Bands of length for each doubling: the lengths of a band differ by 2 % at most.
BANDS = 32
#: Longest vectors that give the first bounds, and vectors that the rotation is fitted on (any rotation is exact).
SEEDS, SAMPLE = 2_048, 2_048
#: Leading dimensions of the rotation.
LEADING = 16
#: Doubles hold integers exactly below this; vectors whose products could reach it are multiplied as Python integers.
EXACT = float(1 << 53)


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of integer matrices held as doubles, exact; as an int64 matrix, limited to its range."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    if np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object) @ np.array([[int(x) for x in row] for row in vectors], object).T
    return np.maximum(np.minimum(exact, (1 << 63) - 1), -(1 << 63)).astype(np.int64)


def _bands(length: np.ndarray) -> np.ndarray:
    """Numbers of the bands; what is shorter than 1 is in the first."""
    return np.floor(np.log2(np.minimum(np.maximum(length, 1), np.finfo(float).max)) * BANDS).astype(np.int64)


def _padded(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def top_products(vectors: DataFrame, every: int = 100, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query with every other row.

    Queries are the rows whose id is divisible by `every`. Components x become floor(scale * x). Returns
    query_id, rank (from 1), vec_id and score; all others, if fewer than k. Ties go to smaller ids. Rows
    with a null id and vectors that are null or hold null or non-finite components take no part. Of rows
    that repeat, each is a candidate, and each that is a query has its own result, against all rows but
    itself. Vectors of different widths are multiplied as if zeros followed the shorter. Scores
    beyond 64 bits count as the nearest 64-bit number. No rows: no rows. Other columns are not read.
    """
    vector = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & finite(vector)).select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vector"))

    def whole(batches):
        import pandas as pd

        for pdf in batches:
            m = np.floor(matrix(pdf["vector"]) * scale)
            top = np.maximum(np.abs(m).max(axis=1, initial=0), 1)
            length = top * np.linalg.norm(m / top[:, None], axis=1)
            yield pd.DataFrame({"id": pdf["id"], "uid": pdf["uid"], "ints": [x.astype("<f8").tobytes() for x in m], "length": length, "band": _bands(length)})

    numbered = rows.withColumn("uid", F.monotonically_increasing_id())
    ints = saved(numbered.mapInPandas(whole, "id bigint, uid bigint, ints binary, length double, band bigint"), "ints")
    bands = ints.groupBy("band").count().orderBy("band").collect()  # not more than BANDS for each power of two that a double can have
    tops = np.exp2(np.array([r["band"] + 1 for r in bands]) / BANDS) * (1 + 1e-9)
    levels = [(i, r["band"], -(-r["count"] // SLICE)) for i, r in enumerate(bands)]
    levels = vectors.sparkSession.createDataFrame(levels, "level int, band bigint, slices bigint")
    width = max(1, (ints.agg(F.max(F.length("ints"))).first()[0] or 8) // 8)
    seeds = ints.orderBy(F.desc("length"), "uid").limit(SEEDS).collect()
    seed_ids, seed_uids = np.array([r["id"] for r in seeds], np.int64), np.array([r["uid"] for r in seeds], np.int64)
    seed_ints = _padded(unpacked([r["ints"] for r in seeds]), width) if seeds else np.zeros((0, width))
    sample = [r["ints"] for r in ints.orderBy(F.xxhash64("uid")).limit(SAMPLE).collect()]
    turn = np.linalg.svd(_padded(unpacked(sample), width), full_matrices=True)[2].T if sample else np.eye(width)
    lead = min(LEADING, width)

    def split(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading dimensions, length of the rest, whole length; the latter two rounded up."""
        turned = m @ turn
        rest, length = np.linalg.norm(turned[:, lead:], axis=1), np.linalg.norm(m, axis=1)
        return turned[:, :lead], rest * (1 + 1e-9), length * (1 + 1e-9)

    def bounded(batches):
        import pandas as pd

        for pdf in batches:
            for lo in range(0, len(pdf), QUERIES):
                part = pdf.iloc[lo : lo + QUERIES]
                q = _padded(unpacked(part["ints"]), width)
                scores = _products(q, seed_ints)
                bound = np.full(len(q), -(1 << 63), np.int64)
                for i, uid in enumerate(part["uid"]):
                    own = scores[i][seed_uids != uid]
                    if len(own) >= k:
                        bound[i] = np.partition(own, len(own) - k)[len(own) - k]
                product = np.linalg.norm(q, axis=1)[:, None] * tops[None, :]
                out = product * (1 + 1e-9) + 1e-6 < bound[:, None]  # not a number rules nothing out; more length never rules out
                yield pd.DataFrame({"id": part["id"], "uid": part["uid"], "ints": part["ints"], "bound": bound, "least": out.sum(axis=1)})

    def query_blocks(batches):
        import pandas as pd

        for pdf in batches:
            for lo in range(0, len(pdf), QUERIES):
                part = pdf.iloc[lo : lo + QUERIES]
                q = _padded(unpacked(part["ints"]), width)
                yield pd.DataFrame([[*[part[c].to_numpy("<i8").tobytes() for c in ("id", "uid")], q.astype("<f8").tobytes(), part["bound"].to_numpy("<i8").tobytes(), part["least"].min()]], columns=["ids", "uids", "ints", "bounds", "least"])

    asked = saved(ints.where(F.col("id") % every == 0).select("id", "uid", "ints").mapInPandas(bounded, "id bigint, uid bigint, ints binary, bound bigint, least int"), "asked")
    parts = max(1, -(-asked.count() // (4 * QUERIES)))
    asked = asked.repartitionByRange(parts, "least", F.xxhash64("uid")).sortWithinPartitions("least")
    asked = saved(asked.mapInPandas(query_blocks, "ids binary, uids binary, ints binary, bounds binary, least int"), "queries")

    def slices(batches):
        import pandas as pd

        for part in runs(batches, ["level", "slice"]):
            m = _padded(unpacked(part["ints"]), width)
            yield pd.DataFrame([[part["level"].iat[0], part["slice"].iat[0], *[part[c].to_numpy("<i8").tobytes() for c in ("id", "uid")], m.astype("<f8").tobytes()]], columns=["level", "slice", "vec_ids", "vec_uids", "vecs"])

    placed = ints.join(levels, "band").withColumn("slice", F.pmod(F.xxhash64("uid"), F.col("slices")))
    placed = placed.repartition("level", "slice").sortWithinPartitions("level", "slice", F.desc("length"))
    held = saved(placed.select("level", "slice", "id", "uid", "ints").mapInPandas(slices, "level int, slice bigint, vec_ids binary, vec_uids binary, vecs binary"), "slices")
    reached = asked.where(F.col("least") < len(bands)).withColumn("level", F.explode(F.sequence("least", F.lit(len(bands) - 1))))
    reached = reached.join(levels, "level").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).drop("least", "band", "slices")
    met = held.join(reached, ["level", "slice"]).drop("level", "slice")

    def best(batches):
        import pandas as pd

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                all_ids, all_uids = np.frombuffer(row.vec_ids, "<i8"), np.frombuffer(row.vec_uids, "<i8")
                everything = np.frombuffer(row.vecs, "<f8").reshape(-1, width)
                q_ids, q_uids, bounds = (np.frombuffer(x, "<i8") for x in (row.ids, row.uids, row.bounds))
                q = np.frombuffer(row.ints, "<f8").reshape(-1, width)
                q_lead, q_rest, q_length = split(q)
                bounds, best_ids, best_scores = bounds.copy(), [np.empty(0, np.int64)] * len(q), [np.empty(0, np.int64)] * len(q)
                for lo in range(0, len(everything), BLOCK):  # by descending length
                    ids, uids, m = all_ids[lo : lo + BLOCK], all_uids[lo : lo + BLOCK], everything[lo : lo + BLOCK]
                    lead_m, rest, length = split(m)
                    slack = 1e-9 * q_length.max(initial=0) * length.max(initial=0) + 1e-6
                    live = np.flatnonzero(~(q_length * length.max(initial=0) + slack < bounds))  # not a number rules nothing out
                    if not len(live):
                        break
                    hope = ~(q_lead[live] @ lead_m.T + q_rest[live, None] * rest[None, :] + slack < bounds[live, None])
                    vec_any = np.flatnonzero(hope.any(axis=0))
                    if not len(vec_any):
                        continue
                    dense = hope.mean() > 0.05
                    full = _products(q[live], m[vec_any]) if dense else None
                    for i, a in enumerate(live):
                        at = np.flatnonzero(hope[i][vec_any] & (uids[vec_any] != q_uids[a]))
                        if not len(at):
                            continue
                        scores = full[i][at] if dense else _products(q[a : a + 1], m[vec_any[at]])[0]
                        ok = scores >= bounds[a]
                        own_ids = np.concatenate((best_ids[a], ids[vec_any[at[ok]]]))
                        own_scores = np.concatenate((best_scores[a], scores[ok]))
                        top = _top(own_ids, own_scores, k)
                        best_ids[a], best_scores[a] = own_ids[top], own_scores[top]
                        if len(top) == k:
                            bounds[a] = max(bounds[a], own_scores[top].min())
                sizes = [len(x) for x in best_ids]
                if sum(sizes):
                    yield pd.DataFrame({"query_id": np.repeat(q_ids, sizes), "query_uid": np.repeat(q_uids, sizes), "vec_id": np.concatenate(best_ids), "score": np.concatenate(best_scores)})

    found = met.mapInPandas(best, "query_id bigint, query_uid bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
