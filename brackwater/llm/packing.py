"""Operator 9: mixture-controlled packing into windows of a fixed number of tokens.

Texts are tokenized once; ids go to a table in the shared folder. Documents are dealt to shards of
bounded size by a hash of what they hold, equal rows by their number among them as well, so every shard
holds every source in about its share, whatever the order, skew or file splits of the input: the same
rows give the same pieces. Within a shard, the sources are queues that a deficit round-robin serves: each
window gives every queue its target share of tokens as credit, a queue whose credit reaches the least
piece is served, and what it could not take stays as its deficit for the next window. The deficits a
shard starts with are what the shards before it leave behind, found from sums per shard and source, so
they carry over partitions without running these one after another.

A window is full at 2048 tokens. What a shard has left at its end is cut at powers of two, which need
no padding, so no token of padding arises at all.
"""

from __future__ import annotations

import math
import sys
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import load_ranks
from .common import runs, saved, short_batches

#: Tokens that a shard holds on average; a task holds one shard's ids in memory.
SHARD_TOKENS = 2_000_000
#: A queue is served once it has this many tokens of credit, so that pieces don't get tiny.
LEAST_PIECE = 256
#: Rows whose digests a task counts at a time; those after them are counted as another split's.
COUNTED = 1_000_000
_WORKER: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _WORKER:
        from tokenizers import Tokenizer

        _WORKER[path] = Tokenizer.from_file(path)
    return _WORKER[path]


def _encoder(rank_file: str, pattern: str):
    if rank_file not in _WORKER:
        import tiktoken

        _WORKER[rank_file] = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=load_ranks(rank_file), special_tokens={})
    return _WORKER[rank_file]


def tokenized(docs: DataFrame, tokenizer_file: str, rank_file: str, pattern: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """key (the id as text), source, n (ids with the end), ids (little-endian 16- or 32-bit binary), and what numbers equal rows:
    digest (of key, source and ids), split (rows counted together) and nth (from 0 among those of a digest and split).

    The encoder of the rank file gives the tokenizer's ids on any text without the string of a special
    token (the tests compare them over all code points); the tokenizer itself takes the texts that have one.
    """
    short_batches(docs)
    schema = "key string, source string, n bigint, ids binary, digest bigint, split bigint, nth bigint"
    whole = _tokenizer(tokenizer_file)
    code, width = ("H", 2) if whole.get_vocab_size() <= 1 << 16 else ("I", 4)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(batches):
        from array import array

        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        split = TaskContext.get().partitionId() << 32
        met: dict[int, int] = {}
        counted = 0

        def digest(key: str | None, source: str, raw: bytes) -> int:
            head = b"" if key is None else b"%d:%s" % (len(key), key.encode("utf-8", "surrogatepass"))
            own = xxhash.xxh64(head + b"|%d:" % len(source) + source.encode("utf-8", "surrogatepass"))
            own.update(raw)
            return own.intdigest() - (1 << 63)

        quick = _encoder(rank_file, pattern)

        def ids(text: str | None) -> bytes:
            if not text:
                own = []
            elif any(s in text for s in special):
                own = _tokenizer(tokenizer_file).encode(text, add_special_tokens=False).ids
            else:
                own = quick.encode_ordinary(text)
            out = array(code, own)
            out.append(end_id)
            if sys.byteorder == "big":
                out.byteswap()
            return out.tobytes()

        for batch in batches:
            keys, sources = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = [ids(t) for t in batch.column(1).to_pylist()]
            digests = [digest(*row) for row in zip(keys, sources, out, strict=True)]
            splits, nths = [], []
            for d in digests:
                if counted == COUNTED:
                    split, counted = split + 1, 0
                    met.clear()
                counted += 1
                splits.append(split)
                nths.append(met.get(d, 0))
                met[d] = nths[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(x) // width for x in out], pa.int64()), pa.array(out, pa.binary()),
                 pa.array(digests, pa.int64()), pa.array(splits, pa.int64()), pa.array(nths, pa.int64())],
                names=["key", "source", "n", "ids", "digest", "split", "nth"],
            )

    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("string"), F.col(text_col), source.alias("source")).mapInArrow(encode, schema)


def placed(ids: DataFrame) -> DataFrame:
    """ids with place, a hash of a row and its number among equal ones.

    Only digests met in several splits need a join: rows of one split have their numbers from the task that
    encoded them. The join is by digest and split, so that a text that is repeated everywhere stays spread.
    """
    splits = ids.groupBy("digest", "split").agg(F.count("*").alias("m"))
    several = Window.partitionBy("digest")  # one row per split
    earlier = F.sum("m").over(several.orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    ahead = saved(splits.withColumn("ahead", earlier).where("ahead > 0").select("digest", "split", "ahead"), "ahead")
    if ahead.isEmpty():
        return ids.withColumn("place", F.xxhash64("digest", "nth"))
    nth = F.col("nth") + F.coalesce("ahead", F.lit(0))
    return ids.join(ahead, ["digest", "split"], "left").withColumn("place", F.xxhash64("digest", nth))


def sums_before(sums: DataFrame, keys: list[str], value: str, shards: int) -> DataFrame:
    """sums (keys, shard, value) with before: the sum over lesser shards of equal keys.

    In two levels, so that no task sees more than about the root of the number of shards for a key.
    """
    block = math.isqrt(shards) + 1
    cut = sums.withColumn("_block", F.floor(F.col("shard") / block))
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy(*keys, "_block").agg(F.sum(value).alias("_n"))
    blocks = blocks.select(*keys, "_block", F.coalesce(F.sum("_n").over(earlier(*(keys or [F.lit(0)])).orderBy("_block")), F.lit(0)).alias("_lesser"))
    within = F.coalesce(F.sum(value).over(earlier(*keys, "_block").orderBy("shard")), F.lit(0))
    return cut.withColumn("_within", within).join(blocks, [*keys, "_block"]).withColumn("before", F.col("_within") + F.col("_lesser")).drop("_within", "_lesser", "_block")


def deal_windows(lengths: dict[str, int], shares: dict[str, float], deficits: dict[str, float], window: int, least: int) -> list[list[tuple[str, int]]]:
    """Windows as lists of (source, tokens): deficit round-robin over queues of so many tokens.

    Every full window holds `window` tokens; what is left at the end makes windows of powers of two.
    """
    left = {s: n for s, n in lengths.items() if n}
    credit = {s: deficits.get(s, 0.0) for s in left}
    total, out = sum(left.values()), []
    while total:
        size = window if total >= window else 1 << (total.bit_length() - 1)
        room, parts = size, []
        for s in left:
            credit[s] += shares.get(s, 0.0) * size
        for s in sorted(left, key=lambda s: (-credit[s], s)):  # those that are owed most come first
            take = min(int(credit[s]), left[s], room)
            if take >= min(least, left[s], room) and take > 0:
                parts.append((s, take))
                room -= take
        while room:  # queues that ran dry or wait for credit leave room: it goes to the largest deficit
            served = dict(parts)
            s = max((s for s in left if left[s] > served.get(s, 0)), key=lambda s: (credit[s] - served.get(s, 0), s))
            take = min(room, left[s] - served.get(s, 0), max(least, int(credit[s] - served.get(s, 0))))
            served[s] = served.get(s, 0) + take
            parts, room = list(served.items()), room - take
        for s, take in parts:
            credit[s] -= take
            left[s] -= take
            if not left[s]:
                del left[s], credit[s]
        total -= size
        out.append(parts)
    return out


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    rank_file: str,
    pattern: str,
    end_id: int = 1,
    window: int = 2048,
    shares: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shard_tokens: int = SHARD_TOKENS,
    least: int = LEAST_PIECE,
) -> DataFrame:
    """Pack every document into windows of target token shares by source.

    shares gives the target share of sources; None takes each source's share of all tokens. Every id of
    every document (its ids, then end_id) lies in exactly one piece. Returns a row per piece: id_col, start,
    length, ids_crc32, doc_tokens, sequence_id, offset, and source. Null and empty texts are the end id
    alone; a null source is the source ''. The result does not depend on the order or splits of docs. Repeated rows and null ids are documents of their own. No rows:
    no pieces. Other columns of docs are not read.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    ids = saved(tokenized(docs, tokenizer_file, rank_file, pattern, end_id, id_col, text_col, source_col), "ids")
    total = ids.agg(F.sum("n").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = placed(ids).withColumn("shard", F.pmod("place", F.lit(shards)))

    # Tokens by shard and source; a source's deficit before a shard: its share of all tokens so far, less its own.
    sums = saved(dealt.groupBy("shard", "source").agg(F.sum("n").alias("n")), "sums")
    own = sums.groupBy("source").agg((F.sum("n") / F.lit(max(total, 1))).alias("share"))
    if shares is not None:
        given = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]) if shares else F.create_map().cast("map<string,double>")
        own = own.select("source", F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0)).alias("share"))
    so_far = sums_before(sums.groupBy("shard").agg(F.sum("n").alias("shard_n")), [], "shard_n", shards).select("shard", F.col("before").alias("all_before"))
    state = (
        sums_before(sums, ["source"], "n", shards)
        .join(own, "source")
        .join(so_far, "shard")
        .select("shard", "source", "share", (F.col("share") * F.col("all_before") - F.col("before")).alias("deficit"))
    )
    rows = dealt.join(state, ["shard", "source"])
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = "key string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint, source string"

    def packed(batches):
        import pandas as pd

        for shard in runs(batches, ["shard"]):
            base = int(shard["shard"].iat[0]) << 32
            queues = {s: q for s, q in shard.groupby("source", sort=True)}
            lengths = {s: int(q["n"].sum()) for s, q in queues.items()}
            share = {s: float(q["share"].iat[0]) for s, q in queues.items()}
            deficit = {s: float(q["deficit"].iat[0]) for s, q in queues.items()}
            heads = {s: [zip(q["key"], q["n"], q["ids"], strict=True), None, 0, 0] for s, q in queues.items()}
            out = []
            for w, parts in enumerate(deal_windows(lengths, share, deficit, window, least)):
                offset = 0
                for s, take in parts:
                    head = heads[s]
                    while take:
                        if head[1] is None:
                            doc, n, raw = next(head[0])
                            size = len(raw) // n
                            head[1], head[2] = (doc, n, np.frombuffer(raw, f"<u{size}")), 0
                        doc, n, own_ids = head[1]
                        start = head[2]
                        length = min(take, n - start)
                        crc = zlib.crc32(own_ids[start : start + length].astype("<u4").tobytes())
                        out.append((doc, start, length, crc, n, base + w, offset, s))
                        offset, take = offset + length, take - length
                        head[2] += length
                        if head[2] == n:
                            head[1] = None
            yield pd.DataFrame(out, columns=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    windows = rows.select("key", "source", "n", "ids", "shard", "share", "deficit", "place").repartition(shards, "shard").sortWithinPartitions("shard", "source", "place", "key", "ids")
    return windows.mapInPandas(packed, schema).select(F.col("key").cast(id_type).alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")
