"""Operator 12: toxicity from class-conditional Kneser-Ney models.

A bounded sample of labelled documents is counted by class: in how many documents each pair of words and
each word occurs, so that repetition within one document tells nothing. The likelihood of a word under a
class comes from the pair with the word before it, backs off to the word, from there to its stem (its first
letters), and from there to counts that both classes share. Discounts leave the lower orders their part.
An expression that fewer than LEAST documents of the sample hold rests on the shared counts of the next
order alone, the same for both classes. So the ratio of the two likelihoods of any token is that of the
longest expression known, and the model is one sorted array of expressions with the logarithms of their
ratios; tasks map it into memory. Ratios of a text's distinct tokens are normalised by length: their mean,
the mean of the strongest passage, and the strong evidence for a token. A logistic curve over these, fitted
on a share of the labelled documents that the models never count, turns them into a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, runs, saved, shared_path, short_batches
from .kneser_ney import Store, mixed
from .retrieval import terms_of

#: Labelled documents of each class that are used, at most (drawn by a hash of the id), and the share of them that sets the curve, one in CURVE.
SAMPLE, CURVE = 10_000, 4
#: Discount of counts, documents that an expression needs, letters of a stem.
DISCOUNT, LEAST, STEM = 0.75, 2, 4
#: Distinct tokens of a passage; ratios above STRONG are strong evidence; tokens added to the length that it is divided by.
PASSAGE, STRONG, MORE = 8, 1.5, 20
#: Texts that score at least this are predicted toxic.
THRESHOLD = 0.7
#: Tokens counted or scored at once, and rows of a shard of the model.
BLOCK_TOKENS, SHARD_ROWS = 500_000, 4_000_000
#: The word before the first one.
BEFORE = np.uint64(0x9E3779B97F4A7C15)
#: Marks of the orders in expressions' hashes.
STEM_MARK, WORD_MARK = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


class Words(dict):
    """Dense numbers for words as they come, with their hashes and their stems' hashes."""

    def __init__(self):
        super().__init__()
        self.hashes, self.stems = [int(BEFORE)], [0]

    def __missing__(self, word: bytes) -> int:
        import xxhash

        got = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word, 11))
        self.stems.append(xxhash.xxh64_intdigest(word.decode("utf-8", "surrogatepass")[:STEM].encode("utf-8", "surrogatepass"), 12))
        return got

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.hashes, np.uint64), np.array(self.stems, np.uint64)


def pairs_of(text: str | None, words: Words) -> tuple[list[int], list[int]]:
    """The distinct words of a text in order of their first place, each with the word before it in that order (0 for none)."""
    own = list(dict.fromkeys(map(words.__getitem__, terms_of(text))))
    return [0, *own[:-1]] if own else [], own


def _counted(batches):
    """Texts with their class to counts of documents by pair (before, word) and by word (before 0)."""
    import pyarrow as pa

    words, before, own, toxic, size = Words(), [], [], [], 0

    def flush():
        hashes, stems = words.arrays()
        word, said = np.array(own, np.int64), np.array(toxic, np.int64)
        rows = []
        for level, keys in ((2, (np.array(before, np.int64) << 32) | word), (1, word)):
            keys, back = np.unique(keys, return_inverse=True)
            t = np.bincount(back, said, len(keys)).astype(np.int32)
            w = keys & 0xFFFFFFFF
            first = hashes[keys >> 32] if level == 2 else stems[w]
            rows.append((np.full(len(keys), level, np.int8), first.view(np.int64), hashes[w].view(np.int64), t, np.bincount(back, minlength=len(keys)).astype(np.int32) - t))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], names=["level", "first", "word", "t", "o"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            b, w = pairs_of(text, words)
            before += b
            own += w
            toxic += [label] * len(w)
            if len(own) >= BLOCK_TOKENS:
                yield flush()
                words, before, own, toxic = Words(), [], [], []
    if own:
        yield flush()


def _rest(count: Column, types: Column, back: Column, total: Column) -> Column:
    """What discounted counts of an expression and its lower order's part make, for one class; the lower order alone where the class has no such context."""
    return F.when(total > 0, (F.greatest(count - DISCOUNT, F.lit(0.0)) + DISCOUNT * types * back) / total).otherwise(back)


def ratios(counts: DataFrame) -> DataFrame:
    """(level, first, word, ratio) of all expressions that LEAST documents hold: the logarithm of the likelihood under the toxic class over that under the other.

    counts has level (1: first is the stem; 2: first is the word before), first, word and documents by class, t and o.
    """
    words, pairs = counts.where("level = 1"), counts.where("level = 2")
    seen = [F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_types") for c in "to"]
    stems = words.groupBy("first").agg(F.sum("t").alias("st"), F.sum("o").alias("so"), *seen)
    totals = stems.agg(
        F.sum("st").alias("nt"), F.sum("so").alias("no"), F.count(F.when(F.col("st") > 0, 1)).alias("ut"), F.count(F.when(F.col("so") > 0, 1)).alias("uo"), F.count("*").alias("stems")
    ).first()
    total = {c: max(totals[f"n{c}"] or 0, 1) for c in "to"}
    shared = (F.col("st") + F.col("so") + 0.5) / (total["t"] + total["o"] + 0.5 * (totals["stems"] + 1))
    at_stem = {c: (F.greatest(F.col(f"s{c}") - DISCOUNT, F.lit(0.0)) + DISCOUNT * totals[f"u{c}"] * shared) / total[c] for c in "to"}
    # A class without any document has no say: the shared counts alone.
    at_stem = {c: p if totals[f"n{c}"] else shared for c, p in at_stem.items()}
    stems = stems.withColumns({"pt": at_stem["t"], "po": at_stem["o"]}).where(F.col("st") + F.col("so") >= LEAST)
    share = (F.col("t") + F.col("o")) / (F.col("st") + F.col("so"))
    at_word = {c: F.col(f"p{c}") * _rest(F.col(c), F.col(f"{c}_types"), share, F.col(f"s{c}")) for c in "to"}
    known = words.where(F.col("t") + F.col("o") >= LEAST).join(stems, "first")
    known = known.select("first", "word", (F.col("t") + F.col("o")).alias("n"), F.log(at_word["t"] / at_word["o"]).alias("ratio"))
    contexts = pairs.groupBy("first").agg(F.sum("t").alias("ct"), F.sum("o").alias("co"), *seen, F.count("*").alias("types"))
    pooled = pairs.where(F.col("t") + F.col("o") >= LEAST).join(known.select("word", "n", F.col("ratio").alias("lower")), "word").join(contexts, "first")
    both = (F.col("t") + F.col("o") - DISCOUNT + DISCOUNT * F.col("types") * F.col("n") / (total["t"] + total["o"])) / (F.col("ct") + F.col("co"))
    at_pair = {"t": _rest(F.col("t"), F.col("t_types"), both * F.exp("lower"), F.col("ct")), "o": _rest(F.col("o"), F.col("o_types"), both, F.col("co"))}
    pooled = pooled.select(F.lit(2).alias("level"), "first", "word", F.log(at_pair["t"] / at_pair["o"]).alias("ratio"))
    stemmed = stems.select(F.lit(0).alias("level"), "first", F.lit(0).cast("long").alias("word"), F.log(F.col("pt") / F.col("po")).alias("ratio"))
    return pooled.unionByName(known.select(F.lit(1).alias("level"), "first", "word", "ratio")).unionByName(stemmed)


class Model:
    """Ratios of expressions from mapped arrays, and the curve over a text's figures."""

    def __init__(self, store: Store, shards: int):
        self.store, self.shards, self.curve = store, shards, np.zeros(5)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ratio of each expression, or not a number."""
        out = np.full(len(keys), np.nan)
        for s in range(self.shards):
            at = np.flatnonzero(keys % np.uint64(self.shards) == s)
            held = self.store.get(f"ratio-{s}-key") if len(at) else None
            if held is None or not len(held):
                continue
            place = np.minimum(np.searchsorted(held, keys[at]), len(held) - 1)
            hit = held[place] == keys[at]
            out[at[hit]] = self.store.get(f"ratio-{s}-value")[place[hit]]
        return out

    def figures(self, before: np.ndarray, word: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """By text: mean ratio, the mean of the strongest passage, strong evidence for a token, logarithm of the length."""
        low = self.find(hashes ^ WORD_MARK)
        low = np.where(np.isnan(low), self.find(stems ^ STEM_MARK), low)
        low = np.where(np.isnan(low), 0.0, low)
        pairs, back = np.unique((before << 32) | word, return_inverse=True)
        ratio = self.find(mixed(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF]))
        ratio = np.where(np.isnan(ratio), low[pairs & 0xFFFFFFFF], ratio)[back]
        out = np.zeros((len(sizes), 4))
        ends = np.cumsum(sizes)
        run = np.append(0.0, np.cumsum(ratio))
        start = ends - sizes
        out[:, 0] = (run[ends] - run[start]) / np.maximum(sizes, 1)
        out[:, 1] = out[:, 0]  # texts of one passage
        strong = np.append(0.0, np.cumsum(np.where(ratio > STRONG, ratio, 0.0)))
        out[:, 2] = (strong[ends] - strong[start]) / (sizes + MORE)
        out[:, 3] = np.log1p(sizes)
        if len(ratio) >= PASSAGE:
            mean = (run[PASSAGE:] - run[:-PASSAGE]) / PASSAGE
            for i in np.flatnonzero(sizes > PASSAGE):
                out[i, 1] = mean[start[i] : ends[i] - PASSAGE + 1].max()
        return out

    def score(self, figures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(figures @ self.curve[:4] + self.curve[4], -500, 500)))


def curve(figures: np.ndarray, toxic: np.ndarray, weight: np.ndarray, decay: float = 1.0) -> np.ndarray:
    """Weights and bias of a logistic regression, by Newton's method; one class alone gives its share."""
    weights = np.zeros(5)
    if not len(figures):
        return weights
    mean, spread = np.average(figures, axis=0, weights=weight), figures.std(axis=0) + 1e-9
    z = np.c_[(figures - mean) / spread, np.ones(len(figures))]
    keep = decay * np.array([1, 1, 1, 1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -500, 500)))
        weights -= np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (weight * (p - toxic)) + keep * weights)
    own = weights[:4] / spread
    return np.append(own, weights[4] - own @ mean)


def _figured(batches, model: Model, text: int, build):
    """Batches of build(columns of the rows, figures); the rows' texts are in the column numbered text."""
    import pyarrow as pa

    held, words, before, own, sizes = [], Words(), [], [], []

    def flush():
        figures = model.figures(np.array(before, np.int64), np.array(own, np.int64), np.array(sizes, np.int64), *words.arrays())
        return build(pa.Table.from_batches(held).combine_chunks().to_batches()[0], figures)

    for batch in batches:
        for lo in range(0, batch.num_rows, 100):
            part = batch.slice(lo, 100)
            held.append(part.select([c for c in range(part.num_columns) if c != text]))
            for t in part.column(text).to_pylist():
                b, w = pairs_of(t, words)
                before += b
                own += w
                sizes.append(len(w))
            if len(own) >= BLOCK_TOKENS:
                yield flush()
                held, words, before, own, sizes = [], Words(), [], [], []
    if held:
        yield flush()


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The models and the curve from the labelled documents whose id satisfies learn (a Column over id_col of labels).

    An id with several labels is toxic if one of them says so; null labels and ids tell nothing. Rows of documents that repeat count once.
    """
    short_batches(docs)
    spark = docs.sparkSession
    said = labels.where(learn & column(label_col).isNotNull() & column(id_col).isNotNull())
    said = said.groupBy(column(id_col).alias("_id")).agg(F.max((column(label_col) > 0).cast("int")).alias("_toxic"))
    key = F.pmod(F.xxhash64("_id"), F.lit(1 << 40))
    counts = dict(said.groupBy("_toxic").count().collect())
    part = F.when(F.col("_toxic") == 1, int(min(1.0, sample / max(counts.get(1, 0), 1)) * (1 << 40))).otherwise(int(min(1.0, sample / max(counts.get(0, 0), 1)) * (1 << 40)))
    drawn = said.where(key < part).withColumn("_curve", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(CURVE)) == 0)  # about 2 * sample rows, whatever the input
    rows = docs.select(column(id_col).alias("_id"), column(text_col).alias("_text")).join(F.broadcast(drawn), "_id").dropDuplicates(["_id", "_text"])
    chosen = saved(rows.select(F.col("_text").alias("text"), F.col("_toxic").cast("long").alias("toxic"), F.col("_curve").alias("curve")), "labelled")

    counted = chosen.where("not curve").select("text", "toxic").mapInArrow(_counted, "level tinyint, first bigint, word bigint, t int, o int")
    counted = saved(counted.groupBy("level", "first", "word").agg(F.sum("t").cast("int").alias("t"), F.sum("o").cast("int").alias("o")), "expressions")
    found = ratios(counted)
    shards = max(1, -(-counted.count() // SHARD_ROWS))
    store = Store(shared_path(spark, "toxicity"))

    def kept(batches):
        import pandas as pd

        for block in runs(batches, ["shard"]):
            keys, values = block["hash"].to_numpy().view(np.uint64), block["ratio"].to_numpy(np.float32)
            order = np.argsort(keys)
            store.put(f"ratio-{block['shard'].iat[0]}-key", keys[order])
            store.put(f"ratio-{block['shard'].iat[0]}-value", values[order])
            yield pd.DataFrame({"n": [len(block)]})

    def hashed(batches):
        import pandas as pd

        for pdf in batches:
            level, first, word = pdf["level"].to_numpy(), pdf["first"].to_numpy().view(np.uint64), pdf["word"].to_numpy().view(np.uint64)
            hashes = np.where(level == 2, mixed(first, word), np.where(level == 1, word ^ WORD_MARK, first ^ STEM_MARK))
            yield pd.DataFrame({"shard": (hashes % np.uint64(shards)).astype(np.int32), "hash": hashes.view(np.int64), "ratio": pdf["ratio"]})

    placed = found.mapInPandas(hashed, "shard int, hash bigint, ratio double").repartition(shards, "shard").sortWithinPartitions("shard")
    placed.mapInPandas(kept, "n bigint").agg(F.sum("n")).collect()
    model = Model(store, shards)

    def figured(batches):
        import pyarrow as pa

        return _figured(batches, model, 0, lambda rows, f: pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, f.T)], names=["toxic", "a", "b", "c", "d"]))

    held = chosen.where("curve").select("text", "toxic").mapInArrow(figured, "toxic bigint, a double, b double, c double, d double").toPandas()
    toxic = held["toxic"].to_numpy(np.float64)
    each = {c: max(1.0, n / sample) for c, n in counts.items()}  # what a drawn document of the class stands for
    model.curve = curve(held[["a", "b", "c", "d"]].to_numpy(np.float64), toxic, np.where(toxic > 0, each.get(1, 1.0), each.get(0, 1.0)))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id_col, score (0 to 1) and predicted of every row. Null and empty texts and texts without words score as the curve does at no evidence. Null ids and repeated rows give a row each; other columns are not read. No rows: no rows."""
    short_batches(docs)
    rows = docs.select(column(id_col).alias("_id"), column(text_col).alias("_text"))

    def scored(batches):
        import pyarrow as pa

        return _figured(batches, model, 1, lambda rows, f: pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.score(f))], names=["_id", "score"]))

    out = rows.mapInArrow(scored, f"_id {rows.schema['_id'].dataType.simpleString()}, score double")
    return out.select(F.col("_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Learn from the labelled documents whose crc32 of the id as text leaves another remainder than 1 by 3, and score all; held_out marks the others.

    Without labels, or with labels of one class only, every text has the same evidence and scores by the share of toxic labels (one half without any).
    """
    held = F.crc32(column(id_col).cast("string")) % 3 == 1
    out = score(docs, train(docs, labels, ~held, id_col, text_col, label_col, sample), id_col, text_col)
    return out.select(id_col, F.coalesce(F.crc32(column(id_col).cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "score", "predicted")
