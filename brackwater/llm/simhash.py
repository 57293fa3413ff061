"""Operator 8: SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits; its three segments (22, 21 and 21 bits, filled up to 23 with zeros) are
decoded with the binary Golay code [23, 12, 7]. The code is perfect, so each segment has exactly one
nearest codeword; its keys are all codewords within distance 4, one to six of them. Two words that
differ in one bit have each other's nearest codeword among their keys, and two that differ in two bits
share a key. If two fingerprints differ in at most four bits, two of the three segments hold at most
two of the differing bits together, so (nearest of the one, any key of the other) meets for that pair
of segments: at most 33 keys of 24 bits per fingerprint find every such pair. Candidates are verified
by counting differing bits, so the links are exact: none is lost and none is wrong.

near_copies() also links texts whose word shingles are similar although their fingerprints are further apart:
at a Jaccard similarity of 0.8 some ten of the 64 bits differ, with a tail beyond any radius that has selective
keys. Min-hash bands bring such texts together, and the shingle sets themselves decide.

Only distinct fingerprints are compared. Keys with many holders are split into blocks of bounded size,
and each pair of blocks yields a star per connected group, never all pairs.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, runs, saved, short_batches, words_of

#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Links are for at most so many differing bits; the keys above are made for four.
MAX_BITS = 4
#: Fingerprints of one key that are compared in one block.
BLOCK = 1024
#: Up to so many fingerprints of a key, every linked pair is a row; among more, a star per group.
FEW = 8
#: near_copies: words of a shingle and least Jaccard similarity of their sets.
SHINGLE, LEAST = 5, 0.8
#: Min-hash bands that bring near copies together, and hashes of each: a pair at 0.8 shares none with a chance of 5e-8.
BANDS, BAND_HASHES = 32, 4
#: Shingle sets of one band key that are compared in one block, and their shingles; shingles that one set is compared with at once.
SETS, SHINGLES, PART = 256, 250_000, 500_000


@cache
def golay_keys() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome (2048): error of the nearest codeword, and the errors of all codewords within 4 (six columns, -1 where fewer)."""

    def syndrome(words: np.ndarray) -> np.ndarray:
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
        return rest

    bits = np.int64(1) << np.arange(23, dtype=np.int64)
    errors = np.zeros(1, np.int64)
    all_errors = [errors]
    for _ in range(4):
        grown = (errors[:, None] | bits[None, :]).ravel()
        errors = np.unique(grown[~np.isin(grown, np.concatenate(all_errors))])
        all_errors.append(errors)
    flat = np.concatenate(all_errors)
    order = np.argsort(syndrome(flat), kind="stable")
    flat, syn = flat[order], np.sort(syndrome(flat))
    starts = np.searchsorted(syn, np.arange(2048))
    nth = np.arange(len(flat)) - starts[syn]
    table = np.full((2048, nth.max() + 1), -1, np.int64)
    table[syn, nth] = flat
    return table[:, 0].copy(), table


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (12 bits) of 23-bit words: the nearest, and a matrix of all within distance 4 (-1 where fewer)."""
    nearest, table = golay_keys()
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    many = table[rest]
    return (words ^ nearest[rest]) >> 11, np.where(many < 0, -1, (words[:, None] ^ many) >> 11)


def fingerprint_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of unsigned 64-bit fingerprints; a key holds the segment pair and two codeword indices."""
    parts = [segment_keys(((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
    rows, keys = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        (near_a, all_a), (near_b, all_b) = parts[a], parts[b]
        for left, right in ((near_a[:, None], all_b), (all_a[:, 1:], near_b[:, None])):
            ok = (left >= 0) & (right >= 0)
            key = (pair << 24) | (left << 12) | right
            rows.append(np.nonzero(ok)[0])
            keys.append(np.broadcast_to(key, ok.shape)[ok])
    return np.concatenate(rows), np.concatenate(keys)


def shingle_hashes(parts: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 hashes of the word shingles, repeats included; fewer words than a shingle has are one."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        return np.array([digest(b" ".join(parts), 42)] if parts else [], np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(parts) - shingle + 1
    return np.fromiter(
        [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)], np.uint64, n
    )


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles, repeats included: a bit is set if over half the XXH64 hashes have it."""
    hashes = shingle_hashes(words_of(text), shingle)
    return majority(hashes) if len(hashes) else 0


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):  # bounded memory whatever the text's length
        part = hashes[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """id_col and fp (long: the fingerprint's 64 bits as a signed number) for every row."""
    short_batches(docs)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp bigint"

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            prints = np.array([text_fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=[id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(hashed, schema)


def _star(fps: np.ndarray, blk: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) with v the smallest fingerprint of u's group, for links among fingerprints (across: between two blocks)."""
    order = np.argsort(fps)
    fps, blk = fps[order], blk[order]
    bits = fps.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= MAX_BITS
    if across:
        near &= blk[:, None] != blk[None, :]
    np.fill_diagonal(near, True)
    label = np.arange(len(fps))
    while True:
        new = label[np.where(near, label[None, :], len(fps)).min(axis=1)]
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(len(fps))
    return fps[linked], fps[label[linked]]


def _links(batches):
    """Links within each pair of blocks, from rows sorted by key and blocks: all pairs of a few, stars of more."""
    import pandas as pd

    def found(rows: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        fps, blk = rows["fp"].to_numpy(), rows["blk"].to_numpy()
        across = (rows["left"] != rows["right"]).to_numpy()
        bits, run = fps.view(np.uint64), np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        size = np.diff(cuts)
        few = ((size <= FEW) & ~across[cuts[:-1]])[run]
        u, v = [], []
        for lag in range(1, FEW):  # neighbours at each distance, over all short runs at once
            if lag >= len(fps):
                break
            hit = few[lag:] & (run[lag:] == run[:-lag]) & (np.bitwise_count(bits[lag:] ^ bits[:-lag]) <= MAX_BITS)
            u.append(fps[lag:][hit])
            v.append(fps[:-lag][hit])
        for r in np.flatnonzero((size > FEW) | across[cuts[:-1]] & (size > 1)):
            at = slice(cuts[r], cuts[r + 1])
            a, b = _star(fps[at], blk[at], across[cuts[r]])
            u.append(a)
            v.append(b)
        return pd.DataFrame({"u": np.concatenate(u or [fps[:0]]), "v": np.concatenate(v or [fps[:0]])})

    held = None
    for pdf in batches:
        rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(rows):
            continue
        k = rows[["key", "left", "right"]].to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1))
        held = rows.iloc[cuts[-1] :]
        if len(cuts) > 1:
            yield found(rows.iloc[: cuts[-1]], cuts)
    if held is not None and len(held):
        yield found(held, np.array([0, len(held)]))


def fingerprint_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (u, v) of distinct fingerprints (fp long) that join the same groups as all pairs at four or fewer differing bits do."""

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            fps = np.asarray(batch.column(0)).astype(np.int64)
            rows, keys = fingerprint_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(fps[rows])], names=["key", "fp"])

    keys = prints.select("fp").mapInArrow(keyed, "key int, fp bigint")
    large = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block).cast("int"), F.lit(1))
    cells = (
        keys.join(large, "key", "left")
        .select("key", "fp", blocks.alias("blocks"), F.pmod(F.hash("fp"), blocks).alias("blk"))
        .select("key", "fp", "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("key", "fp", "blk", F.least("blk", "other").alias("left"), F.greatest("blk", "other").alias("right"))
    )
    return cells.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right").mapInPandas(_links, "u bigint, v bigint")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Group documents whose fingerprints link, directly or over others.

    Returns a row per row of docs: id_col, fingerprint (16 hex digits) and component_id, the smallest id
    of the group. Null and empty texts have fingerprint zero and link like any other. A null id never
    is the smallest, so component_id is null only in a group without ids. Repeated rows are each
    returned. No rows: no rows. Other columns of docs are not read.
    """
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = saved(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")), "distinct")
    roots = components(fingerprint_links(distinct))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = grouped.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@cache
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(80)
    return tuple(rng.integers(0, 1 << 64, BANDS * BAND_HASHES, np.uint64, endpoint=False) | np.uint64(1) for _ in range(2))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of shingle hashes, each of BAND_HASHES minima; none for the empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    times, plus = _mixers()
    least = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), 1 << 12):  # bounded memory whatever the text's length
        part = hashes[None, lo : lo + (1 << 12)]
        least = np.minimum(least, (part * times[:, None] + plus[:, None]).min(axis=1))
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_HASHES).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _parts(size: np.ndarray) -> list[np.ndarray]:
    """The places in parts of about PART shingles, or of one set."""
    return np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // PART)) + 1)


def _similar(least: float):
    """Links (u, v) between groups known so far, from rows sorted by band key and blocks."""
    import pandas as pd

    def run(batches):
        for group in runs(batches, ["key", "left", "right"]):
            unit, label, blk, reach = (group[c].to_numpy().copy() for c in ("unit", "root", "blk", "reach"))
            across = group["left"].iat[0] != group["right"].iat[0]
            sets = [np.asarray(x, np.int64).view(np.uint64) for x in group["shingles"]]  # each in order (of unsigned numbers), without repeats
            size = np.array([len(x) for x in sets])
            u, v = [], []
            for part in _parts(size):
                for i in range(part[-1] + 1):
                    todo = (part > i) & (label[part] != label[i]) & (np.minimum(size[part], size[i]) >= least * np.maximum(size[part], size[i]))
                    todo &= (1 + least) * np.minimum(reach[part], reach[i]) >= (1 - 1e-9) * least * (size[part] + size[i])
                    if across:
                        todo &= blk[part] != blk[i]
                    if not todo.any():
                        continue
                    late = part[todo]
                    flat = np.concatenate([sets[j] for j in late])
                    at = np.minimum(np.searchsorted(sets[i], flat), size[i] - 1)
                    both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(size[late]) - size[late])
                    for j in late[both >= least * (size[late] + size[i] - both)]:
                        if label[j] != label[i]:
                            u.append(unit[i])
                            v.append(unit[j])
                            label[label == label[j]] = label[i]
            if u:
                yield pd.DataFrame({"u": u, "v": v})

    return run


def _reaching(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """rows (key, unit, root) that may have a link to another group of their key, with size, the unit's shingles, and reach, those that any unit of another group has too.

    Sets a and b at a Jaccard similarity of least or more share at least least * (a + b) / (1 + least) shingles, and least times the larger's;
    no more can be shared with other groups than reach. Shingles are counted over the units of all keys, once for each unit.
    """
    slack = 1 - 1e-9  # for rounding
    units = rows.select("unit", "root").distinct().join(sets, "unit")
    each = units.select("unit", "root", F.explode("shingles").alias("shingle"))
    met = each.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    reach = each.select("unit", "shingle").join(met, "shingle", "left_semi").groupBy("unit").agg(F.count("*").alias("reach"))
    sizes = units.select("unit", F.size("shingles").alias("size")).join(reach, "unit").where(F.col("reach") >= slack * least * F.col("size"))
    found = saved(rows.join(sizes, "unit").select("key", "unit", "root", "size", "reach"), "reach")
    sides = found.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("size").alias("smallest")).where("lo <> hi")
    partner = F.greatest(F.col("smallest"), slack * least * F.col("size"))
    near = found.join(sides, "key").where((1 + least) * F.col("reach") >= slack * least * (F.col("size") + partner))
    return saved(near.select("key", "unit", "root", "size", "reach"), "near")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """Group documents that simhash_groups() links or whose sets of word shingles have at least this Jaccard similarity, directly or over others.

    Returns a row per row of docs: id_col and component_id, as simhash_groups() does. Texts are compared by their
    words, so texts of the same words are one unit; each unit of a band key is compared with the key's smallest,
    and where that leaves several groups in a key, all that may be similar to one of another group, in blocks:
    a key's largest group is dealt, not sent to all blocks, so that only what is left outside of it meets all.
    """
    short_batches(docs)
    kind = docs.schema[id_col].dataType.simpleString()

    def unit_of(parts: list[bytes]) -> int:
        import xxhash

        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(parts), 7)).view(np.int64))

    def sketched(batches):
        import pyarrow as pa

        for batch in batches:
            unit, prints, bands = [], [], []
            for text in batch.column(1).to_pylist():
                parts = words_of(text)
                unit.append(unit_of(parts))
                prints.append(text_fingerprint(text))
                bands.append(band_keys(np.unique(shingle_hashes(parts, shingle))))
            prints = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit, pa.int64()), pa.array(prints), pa.array(bands, pa.list_(pa.int64()))], names=[id_col, "unit", "fp", "bands"])

    def united(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array([unit_of(words_of(t)) for t in texts.to_pylist()], pa.int64()), texts], names=["unit", "text"])

    def shingled(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [np.unique(shingle_hashes(words_of(t), shingle)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["unit", "shingles"])

    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    sketches = saved(texts.mapInArrow(sketched, f"`{id_col}` {kind}, unit bigint, fp bigint, bands array<bigint>"), "sketches")
    units = saved(sketches.groupBy("unit").agg(F.min(id_col).alias("least_id"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "units")

    reps = saved(units.groupBy("fp").agg(F.min("unit").alias("rep")), "distinct")
    same = units.join(reps, "fp").where("unit <> rep").select(F.col("unit").alias("u"), F.col("rep").alias("v"))
    close = fingerprint_links(reps).toDF("fp", "other").join(reps, "fp").select("other", F.col("rep").alias("u"))
    close = close.join(reps.toDF("other", "v"), "other").select("u", "v")

    keys = units.select("unit", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("unit").alias("rep")).where("n > 1")
    held = saved(keys.join(shared, "key").select("key", "unit", "rep"), "bands")
    wanted = held.select("unit").distinct()
    named = texts.select("text").mapInArrow(united, "unit bigint, text string").join(wanted, "unit", "left_semi")
    sets = saved(named.dropDuplicates(["unit"]).select("unit", "text").mapInArrow(shingled, "unit bigint, shingles array<bigint>"), "shingles")

    pairs = held.where("unit <> rep").select(F.col("unit").alias("u"), F.col("rep").alias("v")).distinct()
    pairs = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
    both = F.size(F.array_intersect("a", "b"))
    first = pairs.where(both >= least * (F.size("a") + F.size("b") - both)).select("u", "v")
    first = saved(same.union(close).union(first), "links")
    roots = components(first)
    rest = held.join(roots, held.unit == roots.node, "left").select("key", "unit", F.coalesce("root", "unit").alias("root"))
    mixed = rest.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi and n > 2")  # of two units, one is the smallest: they have been compared
    rest = _reaching(saved(rest.join(mixed, "key", "left_semi"), "mixed"), sets, least)
    by_root = rest.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    shape = by_root.groupBy("key").agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), F.max(F.struct("n", "root", "shingles")).alias("top"), F.count("*").alias("groups")).where("groups > 1")

    def blocks(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / SETS), F.ceil(shingles / SHINGLES)).cast("int")

    # The largest group of a key takes the first `tops` blocks, which don't meet each other; a key that fits into one block is one.
    whole = (F.col("n") <= SETS) & (F.col("shingles") <= SHINGLES)
    tops = F.when(whole, 0).otherwise(blocks(F.col("top.n"), F.col("top.shingles")))
    others = F.when(whole, 1).otherwise(blocks(F.col("n") - F.col("top.n"), F.col("shingles") - F.col("top.shingles")))
    dealt = rest.join(shape.select("key", F.col("top.root").alias("top"), tops.alias("tops"), others.alias("others")), "key")
    large = (F.col("tops") > 0) & (F.col("root") == F.col("top"))
    cells = (
        dealt.withColumn("blk", F.when(large, F.pmod(F.hash("unit"), F.greatest("tops", F.lit(1)))).otherwise(F.col("tops") + F.pmod(F.hash("unit"), F.col("others"))))
        .withColumn("other", F.explode(F.sequence(F.when(large, F.col("tops")).otherwise(0), F.col("tops") + F.col("others") - 1)))
        .select("key", F.least("blk", "other").alias("left"), F.greatest("blk", "other").alias("right"), "blk", "unit", "root", "reach")
        .join(sets, "unit")
    )
    cells = cells.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    second = saved(cells.mapInPandas(_similar(least), "u bigint, v bigint"), "links")  # read in both directions, compared once

    roots = components(first.union(second))
    grouped = units.join(roots, units.unit == roots.node, "left").select("unit", "least_id", F.coalesce("root", "unit").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_unit = grouped.join(smallest, "root").select("unit", "component_id")
    return sketches.join(by_unit, "unit").select(F.col(id_col), "component_id")
