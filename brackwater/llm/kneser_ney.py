"""Operator 7: interpolated modified Kneser-Ney bigram model, counted in Spark, scored from mapped hash arrays.

Words are 64-bit hashes. Tasks count the bigrams of their documents and send packed blocks of distinct
ones to the shard of their context; the shards add the counts up and write sorted arrays of bigram
hashes and counts to the shared folder, and packed sums per context and per word go on to word shards,
which write sorted arrays likewise. Scoring tasks map those files into memory and look up a block of
documents at a time by binary search, so the model is read where it is needed and never held whole.

A context that many rows have (found on a sample; it only sets who adds up what) is dealt over all
shards by the following word.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from array import array
from collections import Counter, OrderedDict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import local_path, runs, saved, shared_path, short_batches, words_of

#: Hashes of the start (a context only) and the end of a text, which are no words.
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Characters of text for each shard of the bigrams and words.
SHARD_CHARS = 8_000_000
#: Tokens that a task gathers before it counts their bigrams.
BLOCK_TOKENS = 2_000_000
#: Tokens scored together.
SCORE_TOKENS = 1_000_000
#: Arrays that a process keeps mapped, each with one file descriptor.
MAPPED = 64
#: Documents of the sample that tells common contexts.
SAMPLE = 2_000


class Store:
    """Arrays in the shared folder: put() writes one whole or not at all, get() maps one into memory. At most MAPPED stay mapped, the last used ones."""

    def __init__(self, uri: str):
        self.uri = uri
        self._open: OrderedDict[str, np.ndarray] = OrderedDict()

    def __getstate__(self):
        return {"uri": self.uri, "_open": OrderedDict()}

    def put(self, name: str, values: np.ndarray) -> None:
        data = io.BytesIO()
        np.save(data, values)
        if (folder := local_path(self.uri)) is not None:
            os.makedirs(folder, exist_ok=True)
            part = f"{folder}/.{name}-{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(data.getbuffer())
            os.replace(part, f"{folder}/{name}.npy")
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            store.create_dir(path, recursive=True)
            with store.open_output_stream(f"{path}/.{name}-{(mark := uuid.uuid4().hex)}") as f:
                f.write(data.getbuffer())
            store.move(f"{path}/.{name}-{mark}", f"{path}/{name}.npy")

    def get(self, name: str) -> np.ndarray | None:
        """The array, or None if there is none of this name."""
        if name not in self._open:
            folder = local_path(self.uri)
            if folder is None:  # the store has no paths to map: fetch the file, map it, and let the name go
                from pyarrow import fs

                store, path = fs.FileSystem.from_uri(self.uri)
                if store.get_file_info(f"{path}/{name}.npy").type == fs.FileType.NotFound:
                    return None
                with tempfile.NamedTemporaryFile(suffix=".npy") as copy, store.open_input_stream(f"{path}/{name}.npy") as f:
                    while chunk := f.read(1 << 22):
                        copy.write(chunk)
                    copy.flush()
                    self._open[name] = np.load(copy.name, mmap_mode="r")
            elif os.path.exists(f"{folder}/{name}.npy"):
                self._open[name] = np.load(f"{folder}/{name}.npy", mmap_mode="r")
            else:
                return None
        self._open.move_to_end(name)
        while len(self._open) > MAPPED:
            self._open.popitem(last=False)
        return self._open[name]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a bigram from those of its words."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


class Ids(dict):
    """Dense numbers for words as they come, with their hashes."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q", [int(START), int(END)])  # 0 and 1

    def __missing__(self, word: bytes) -> int:
        import xxhash

        got = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word, 7))
        return got


def _gather(tokens: list[array]) -> tuple[np.ndarray, np.ndarray]:
    """(context, word) numbers of all tokens of documents given as number arrays that end with 1."""
    flat = np.frombuffer(b"".join(t.tobytes() for t in tokens), np.int32)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[0] = 0
    before[np.cumsum([len(t) for t in tokens])[:-1]] = 0
    return before, flat


def _numbers(text: str | None, ids: Ids) -> array:
    out = array("i", map(ids.__getitem__, words_of(text)))
    out.append(1)
    return out


def shard_of(context: np.ndarray, word: np.ndarray, common: np.ndarray, shards: int) -> np.ndarray:
    own = context % np.uint64(shards)
    if len(common):
        hot = np.isin(context, common)
        own = np.where(hot, mixed(context, word) % np.uint64(shards), own)
    return own.astype(np.int64)


def _by_shard(own: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The shards that are there, in order, and the places of each: work and rows follow what is there, not the number of shards."""
    order = np.argsort(own, kind="stable")
    present, first = np.unique(own[order], return_index=True)
    return list(zip(present.tolist(), np.split(order, first[1:]), strict=True)) if len(own) else []


def _sums(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the columns' sums for each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return (keys[first], *[np.add.reduceat(c[order].astype(np.int64), first) if len(keys) else c.astype(np.int64) for c in columns])


def _bigram_blocks(common: np.ndarray, shards: int):
    """Documents to packed blocks of distinct bigrams with their counts, by shard."""

    def run(batches):
        import pyarrow as pa

        ids, held, size = Ids(), [], 0

        def flush():
            hashes = np.frombuffer(ids.hashes, np.uint64)
            before, word = _gather(held)
            keys, counts = np.unique((before.astype(np.int64) << 32) | word, return_counts=True)
            context, word = keys >> 32, keys & 0xFFFFFFFF
            own = shard_of(hashes[context], hashes[word], common, shards)
            rows = []
            for s, at in _by_shard(own):
                c = context[at]
                first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
                spans = np.diff(np.append(first, len(c))).astype("<u4")
                rows.append((s, hashes[c[first]].tobytes(), spans.tobytes(), hashes[word[at]].tobytes(), counts[at].astype("<u4").tobytes()))
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["shard", "contexts", "spans", "words", "counts"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = _numbers(text, ids)
                held.append(own)
                size += len(own)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    ids, held, size = Ids(), [], 0
        if held:
            yield flush()

    return run


def _word_rows(shards: int, context: np.ndarray, word: np.ndarray, counts: np.ndarray):
    """A shard's sums by context (tokens, and bigrams seen once, twice and more often) and by word (tokens, contexts), packed by word shard."""
    import pandas as pd

    ones = np.ones(len(counts), np.int64)
    as_context = _sums(context, counts, counts == 1, counts == 2, counts >= 3)
    as_word = _sums(word, counts, ones)
    n, m = len(as_context[0]), len(as_word[0])
    keys = np.concatenate((as_context[0], as_word[0]))
    table = np.zeros((n + m, 6), np.int64)
    table[:n, :4] = np.stack(as_context[1:], axis=1)
    table[n:, 4:] = np.stack(as_word[1:], axis=1)
    own = (keys % np.uint64(shards)).astype(np.int64)
    width = "<u4" if table.size == 0 or table.max() < 1 << 32 else "<u8"
    rows = [(s, keys[at].tobytes(), table[at].astype(width).tobytes()) for s, at in _by_shard(own)]
    return pd.DataFrame(rows, columns=["shard", "keys", "sums"])


def _bigram_shards(store: Store, shards: int):
    """Packed blocks to one sorted array of bigrams per shard (in the store), and packed sums for the word shards."""

    def run(batches):
        for block in runs(batches, ["shard"]):
            shard = int(block["shard"].iat[0])
            context = np.concatenate([np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, "<u4")) for a, b in zip(block["contexts"], block["spans"], strict=True)])
            word = np.concatenate([np.frombuffer(x, np.uint64) for x in block["words"]])
            counts = np.concatenate([np.frombuffer(x, "<u4") for x in block["counts"]])
            keys = mixed(context, word)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            total = np.add.reduceat(counts[order].astype(np.int64), first)
            at = order[first]
            store.put(f"bigram-{shard}-key", keys[first])
            store.put(f"bigram-{shard}-count", total.astype(np.uint32) if total.max() < 1 << 32 else total.astype(np.uint64))
            out = _word_rows(shards, context[at], word[at], total)
            out["ones"], out["twos"], out["threes"], out["fours"] = 0, 0, 0, 0
            out.loc[out.index[0], ["ones", "twos", "threes", "fours"]] = [int((total == k).sum()) for k in (1, 2, 3, 4)]
            yield out

    return run


def _word_shards(store: Store):
    """Packed sums to sorted arrays of words per shard (in the store), and a row of totals."""
    import pandas as pd

    def run(batches):
        for block in runs(batches, ["shard"]):
            shard = int(block["shard"].iat[0])
            keys = np.concatenate([np.frombuffer(x, np.uint64) for x in block["keys"]])
            tables = [np.frombuffer(x, "<u4" if len(x) == 3 * len(k) else "<u8").reshape(-1, 6) for k, x in zip(block["keys"], block["sums"], strict=True)]
            table = np.concatenate(tables)
            keys, *columns = _sums(keys, *table.T)
            store.put(f"word-{shard}-key", keys)
            store.put(f"word-{shard}-sums", np.stack(columns, axis=1))
            tokens, contexts = columns[4], columns[5]
            yield pd.DataFrame([[shard, int(tokens.sum()), int((tokens > 0).sum()), int(contexts.sum()), *[int((contexts == k).sum()) for k in (1, 2, 3, 4)], int((contexts >= 3).sum())]], columns=["shard", "tokens", "words", "bigrams", "ones", "twos", "threes", "fours", "more"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more; where counts of counts are missing, half of what absolute discounting takes."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    raw = [k - (k + 1) * y * more / less if less else 0.5 for k, less, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *[min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]])


class Model:
    """Looks up and scores; the arrays are mapped files."""

    def __init__(self, store: Store, shards: int, common: np.ndarray, totals: dict[str, int], bigrams: tuple[int, ...], words: tuple[int, ...]):
        self.store, self.shards, self.common, self.totals = store, shards, common, totals
        self.cut, self.word_cut = discounts(*bigrams), discounts(*words[:4])
        seen = max(totals["bigrams"], 1)
        self.spare = float(self.word_cut[1] * words[0] + self.word_cut[2] * words[1] + self.word_cut[3] * words[4]) / seen if totals["bigrams"] else 1.0

    def _find(self, kind: str, shard: np.ndarray, keys: np.ndarray, values: str, width: int) -> np.ndarray:
        out = np.zeros((len(keys), width), np.int64)
        for s, at in _by_shard(shard):
            at = at[np.argsort(keys[at])]
            held = self.store.get(f"{kind}-{s}-key")
            if held is None or not len(held):
                continue
            place = np.searchsorted(held, keys[at])
            place[place == len(held)] = 0
            hit = held[place] == keys[at]
            found = self.store.get(f"{kind}-{s}-{values}")[place[hit]]
            out[at[hit]] = found.reshape(-1, width)
        return out

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """For each word: tokens as a context, bigrams seen once, twice and more often; its tokens, its contexts."""
        return self._find("word", (hashes % np.uint64(self.shards)).astype(np.int64), hashes, "sums", 6)

    def score(self, tokens: list[array], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By document: known tokens, base score, model score (log10)."""
        sums = self.words(hashes)
        count, contexts = sums[:, 4], sums[:, 5]
        base = np.log10((count + 0.5) / (self.totals["tokens"] + 0.5 * (self.totals["words"] + 1)))
        alone = np.maximum(contexts - self.word_cut[np.minimum(contexts, 3)], 0) / max(self.totals["bigrams"], 1) + self.spare / (self.totals["words"] + 1)
        total = np.maximum(sums[:, 0], 1)
        back = np.where(sums[:, 0] > 0, (sums[:, 1:4] @ self.cut[1:]) / total, 1.0)
        before, word = _gather(tokens)
        pairs, place = np.unique((before.astype(np.int64) << 32) | word, return_inverse=True)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        seen = self._find("bigram", shard_of(hashes[a], hashes[b], self.common, self.shards), mixed(hashes[a], hashes[b]), "count", 1)[:, 0]
        chance = np.log10(np.maximum(seen - self.cut[np.minimum(seen, 3)], 0) / total[a] + back[a] * alone[b])
        starts = np.concatenate(([0], np.cumsum([len(t) for t in tokens])[:-1]))
        return tuple(np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64)[word], base[word], chance[place]))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the model over all texts of docs. Null texts count as empty. No rows: every word is equally likely."""
    short_batches(docs)
    texts = docs.select(F.col(text_col).alias("text"))
    spark = docs.sparkSession
    size = texts.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    shards = max(4, -(-(size["chars"] or 0) // SHARD_CHARS))
    share = min(1.0, SAMPLE / max(size["n"], 1))

    def sampled(batches):
        import pyarrow as pa

        said: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                said.update(words_of(text))
        top = said.most_common(4 * shards)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64()), pa.array([said.total()] * len(top), pa.int64())], names=["word", "n", "total"])

    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int(share * (1 << 40))).limit(SAMPLE)
    often = drawn.coalesce(1).mapInArrow(sampled, "word binary, n bigint, total bigint").where(F.col("n") * 4 * shards > F.col("total")).collect()
    ids = Ids()
    common = np.array([ids.hashes[ids[bytes(r["word"])]] for r in often] + [int(START)], np.uint64)

    store = Store(shared_path(spark, "model"))
    blocks = texts.mapInArrow(_bigram_blocks(common, shards), "shard int, contexts binary, spans binary, words binary, counts binary")
    sums = saved(
        blocks.repartition(shards, "shard").sortWithinPartitions("shard").mapInPandas(_bigram_shards(store, shards), "shard int, keys binary, sums binary, ones bigint, twos bigint, threes bigint, fours bigint"),
        "sums",
    )
    bigrams = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("ones", "twos", "threes", "fours")]).first()
    words = (
        sums.select("shard", "keys", "sums").repartition(shards, "shard").sortWithinPartitions("shard")
        .mapInPandas(_word_shards(store), "shard int, tokens bigint, words bigint, bigrams bigint, ones bigint, twos bigint, threes bigint, fours bigint, more bigint")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words", "bigrams", "ones", "twos", "threes", "fours", "more")])
        .first()
    )
    totals = {k: words[k] for k in ("tokens", "words", "bigrams")}
    return Model(store, shards, common, totals, tuple(bigrams), tuple(words[k] for k in ("ones", "twos", "threes", "fours", "more")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", flag_col: str | None = None) -> DataFrame:
    """Score every text: id_col, flag_col if given, n_tokens, n_known, train_tokens, base_score, score (log10), perplexity.

    Null and empty texts are the end token alone. Null ids and repeated rows give a row each; other columns
    are not read. A word without training text is as likely as all unknown words together.
    """
    flag = F.col(flag_col) if flag_col else F.lit(False)
    rows = docs.select(F.col(id_col), F.col(text_col), flag.alias("_flag"))
    fixed = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}"

    def scored(batches):
        import pyarrow as pa

        held: list = []  # batches whose texts wait for their block to fill
        ids, tokens, size = Ids(), [], 0

        def flush():
            known, base, own = model.score(tokens, np.frombuffer(ids.hashes, np.uint64))
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            n = np.array([len(t) for t in tokens], np.int64)
            return pa.RecordBatch.from_arrays(
                [whole.column(0), whole.column(1), pa.array(n), pa.array(known), pa.array(base), pa.array(own)],
                names=[id_col, "_flag", "n_tokens", "n_known", "base_score", "score"],
            )

        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part = batch.slice(lo, 100)
                held.append(part.select([0, 2]))
                new = [_numbers(text, ids) for text in part.column(1).to_pylist()]
                tokens += new
                size += sum(map(len, new))
                if size >= SCORE_TOKENS:
                    yield flush()
                    held, ids, tokens, size = [], Ids(), [], 0
        if held:
            yield flush()

    out = rows.mapInArrow(scored, f"{fixed}, _flag boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(
        F.col(id_col), *[F.col("_flag").alias(flag_col or "_flag")] * bool(flag_col), "n_tokens", "n_known",
        F.lit(model.totals["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents whose crc32 of the id as text leaves another remainder than 1 by 5, and score all; held_out marks the others. Without an id a document is trained on."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))
    rows = docs.select(F.col(id_col), F.col(text_col), held.alias("held_out"))
    return score(rows, train(rows.where("not held_out"), text_col), id_col, text_col, "held_out")
