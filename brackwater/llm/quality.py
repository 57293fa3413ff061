"""Operator 1: quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Votes are counted by
pattern over the whole corpus (a pattern is one of 3^11, so the counts fit the driver whatever the
input), and expectation-maximisation over the pattern counts estimates how accurate each labeller is
and the posterior label of each pattern. Posteriors of a bounded sample train a linear scorer over
hashed features, which then scores every document. Labels given by people are not used.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, short_batches

#: Documents that train the scorer, at most (drawn by a hash over all rows); the label model counts all.
SAMPLE = 6_000
#: Buckets of the hashed features.
BUCKETS = 1 << 16
#: Documents that score at least this are kept.
THRESHOLD = 0.5

GOOD, NONE, BAD = 1, 0, -1
LABELLERS = ("symbols", "capitals", "bars", "ends", "word_length", "sentences", "lines", "variety", "repeats", "digits", "length")

#: Byte classes: 0 beyond ASCII, 1 lower case, 2 capital, 3 digit, 4 white space, 5 plain punctuation, 6 symbol, 7 full stop.
CLASSES = np.full(256, 6, np.uint8)
CLASSES[128:] = 0
CLASSES[97:123] = 1
CLASSES[65:91] = 2
CLASSES[48:58] = 3
CLASSES[[9, 10, 11, 12, 13, 32]] = 4
CLASSES[[ord(c) for c in ",;:'\"-()"]] = 5
CLASSES[[ord(c) for c in ".?!"]] = 7


def vote(value: float, good_below: float, bad_above: float) -> int:
    return GOOD if value <= good_below else BAD if value >= bad_above else NONE


def votes(text: str, words: list[str], distinct: int) -> tuple[int, ...]:
    """One vote per labeller, each from the whole text. No words: all bad."""
    n = len(words)
    if not n:
        return (BAD,) * len(LABELLERS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by = np.bincount(CLASSES[raw], minlength=8)
    solid = max(1, int(by.sum() - by[4]))
    letters = max(1, int(by[0] + by[1] + by[2]))
    lines = [x for x in text.split("\n") if x]
    mean = solid / n
    stops = int(by[7]) / n
    return (
        vote(by[6] / solid, 0.01, 0.06),
        vote(by[2] / letters, 0.15, 0.4),
        vote(sum(w in ("|", "||", "*", "#") for w in words) / n, 0.01, 0.1),
        vote(sum(not (w[-1].isalnum() or w[-1] in ".,;:?'\")-") for w in words) / n, 0.02, 0.15),
        GOOD if 3 <= mean <= 9 else BAD if mean < 2 or mean > 14 else NONE,
        GOOD if 0.01 <= stops <= 0.35 else BAD if n > 40 and (stops < 0.002 or stops > 0.8) else NONE,
        vote(1 - len(set(lines)) / max(1, len(lines)), 0.1, 0.4) if len(lines) > 2 else NONE,
        NONE if n < 50 else BAD if distinct / n < 0.08 else GOOD if distinct / n > 0.15 else NONE,
        vote(sum(map(eq, words, words[1:])) / n, 0.03, 0.15),
        vote(by[3] / solid, 0.1, 0.4),
        GOOD if n >= 20 else NONE,
    )


def pattern_of(vote_row: tuple[int, ...]) -> int:
    """A vote row as a number in base 3."""
    out = 0
    for v in vote_row:
        out = out * 3 + v + 1
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 200, smooth: float = 1.0) -> np.ndarray:
    """Posterior of good by pattern: EM for a class prior and, by class, each labeller's chance of a good vote if it votes.

    It starts from the share of good votes among those given, so that the first class is the good one.
    """
    digits = (patterns[:, None] // 3 ** np.arange(labellers - 1, -1, -1)) % 3
    given = (digits != 1).sum(axis=1)
    good = np.where(given, (digits == 2).sum(axis=1) / np.maximum(given, 1), 0.5)
    post = np.clip(good, 0.05, 0.95)
    hot = np.eye(3)[digits][:, :, [0, 2]]  # pattern, labeller, vote given; no vote tells nothing
    for _ in range(rounds):
        weight = np.stack([post * counts, (1 - post) * counts])
        prior = (weight.sum(axis=1) + smooth) / (counts.sum() + 2 * smooth)
        chance = np.einsum("cp,plv->clv", weight, hot) + smooth
        chance /= chance.sum(axis=2, keepdims=True)
        logs = np.log(prior)[:, None] + np.einsum("plv,clv->cp", hot, np.log(chance))
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
        if np.abs(new - post).max() < 1e-7:
            return new
        post = new
    return post


def shape(word: str) -> str:
    """A word's outline: its case and its last character unless a letter or digit."""
    case = "U" if word.isupper() and len(word) > 1 else "l"
    return f"\x00{case}{'' if word[-1].isalnum() else word[-1]}"


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def features(words: list[str], vote_row: tuple[int, ...]) -> dict[int, float]:
    """Hashed features: shares of words and outlines, and the votes."""
    out: dict[int, float] = {}
    n = max(1, len(words))
    for w, k in Counter(words).items():
        for f in (w.lower(), shape(w)):
            b = bucket(f)
            out[b] = out.get(b, 0.0) + k / n
    for i, v in enumerate(vote_row):
        if v:
            b = bucket(f"\x01{i}{v}")
            out[b] = out.get(b, 0.0) + 0.3
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 150, rate: float = 0.5, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression with Adagrad on (buckets, values, probability of good); the last weight is the bias."""
    idx = np.concatenate([i for i, _, _ in rows] or [np.zeros(0, np.int32)])
    val = np.concatenate([v for _, v, _ in rows] or [np.zeros(0, np.float32)])
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _, _ in rows])
    target = np.array([q for _, _, q in rows])
    weights, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    for _ in range(rounds if len(rows) else 0):
        z = np.bincount(row, val * weights[idx], len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - target) / len(rows)
        grad = np.append(np.bincount(idx, val * error[row], BUCKETS), error.sum()) + decay * weights
        seen += grad**2
        weights -= rate * grad / np.sqrt(seen)
    return weights


def _scored(docs: DataFrame, carried: list[str], id_col: str, text_col: str, sample: int) -> DataFrame:
    """_keep_0, _keep_1 and so on (the carried columns), _posterior and _score."""
    short_batches(docs)
    key = F.xxhash64(column(id_col), column(text_col))
    said = f"_keep_{carried.index(text_col)}" if text_col in carried else "_text"
    rows = docs.select(*[column(c).alias(f"_keep_{i}") for i, c in enumerate(carried)], *[column(text_col).alias("_text")] * (said == "_text"))

    def patterns_in(batches):
        import pyarrow as pa

        for batch in batches:
            out = Counter()
            for text in batch.column(0).to_pylist():
                words = text.split() if text else []
                out[pattern_of(votes(text or "", words, len(set(words))))] += 1
            yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.int64())], names=["pattern", "n"])

    counted = rows.select(said).mapInArrow(patterns_in, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counted.sort(key=lambda r: r["pattern"])
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], float)
    posterior = dict(zip(patterns.tolist(), label_model(patterns, counts, len(LABELLERS)).tolist(), strict=True)) if counted else {}

    def featured(batches):
        import pyarrow as pa

        for batch in batches:
            got = []
            for text in batch.column(1).to_pylist():
                words = text.split() if text else []
                row = votes(text or "", words, len(set(words)))
                f = features(words, row)
                got.append((np.fromiter(f, "<i4", len(f)).tobytes(), np.fromiter(f.values(), "<f4", len(f)).tobytes(), pattern_of(row)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.int64())],
                names=["key", "buckets", "shares", "pattern"],
            )

    # Drawn by a hash of id and text: the same rows whatever the files' splits and the order of tasks.
    share = 1.2 * sample / max(float(counts.sum()), 1.0)
    drawn = docs.select(key.alias("key"), column(text_col).alias("_text")).where(F.pmod("key", F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40)))
    chosen = drawn.mapInArrow(featured, "key bigint, buckets binary, shares binary, pattern bigint").orderBy("key", "buckets").limit(sample).collect()
    weights = train([(np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["shares"], "<f4"), posterior.get(r["pattern"], 0.5)) for r in chosen])

    names = [n for n in rows.columns if n != "_text"]
    schema = T.StructType([rows.schema[n] for n in names]).add("_posterior", T.DoubleType()).add("_score", T.DoubleType())

    def scored(batches):
        import pyarrow as pa

        class Weights(dict):
            def __missing__(self, word: str) -> float:
                got = float(weights[bucket(word.lower())] + weights[bucket(shape(word))])
                if len(self) < 150_000:
                    self[word] = got
                return got

        of = Weights()
        by_vote = {(i, v): 0.3 * float(weights[bucket(f"\x01{i}{v}")]) for i in range(len(LABELLERS)) for v in (GOOD, BAD)}
        for batch in batches:
            post, score = [], []
            for text in batch.column(said).to_pylist():
                words = text.split() if text else []
                row = votes(text or "", words, len(set(words)))
                post.append(posterior.get(pattern_of(row), 0.5))
                if not words:
                    score.append(0.0)
                    continue
                z = float(weights[-1]) + sum(map(of.__getitem__, words)) / len(words) + sum(by_vote[i, v] for i, v in enumerate(row) if v)
                score.append(1 / (1 + float(np.exp(min(500.0, -z)))))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(post, pa.float64()), pa.array(score, pa.float64())], names=schema.names)

    return rows.mapInArrow(scored, schema)


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """Score every document's quality.

    Returns id_col, posterior (the label model's, from the document's votes alone), score (the scorer's) and
    kept (score >= threshold); keep names further columns of docs to carry along, but for those named like one of
    these. Null and texts without words have score 0 and are not kept. Null ids and repeated rows give a row each;
    texts are read whole, however long. No rows: no rows.
    """
    carried = [id_col, *[c for c in keep or [] if c not in (id_col, "posterior", "score", "kept")]]
    out = _scored(docs, carried, id_col, text_col, sample)
    return out.select(
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(carried)],
        F.col("_posterior").alias("posterior"), F.col("_score").alias("score"), (F.col("_score") >= threshold).alias("kept"),
    )


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that quality() keeps, with all their columns, whatever their names. No rows: no rows."""
    out = _scored(docs, docs.columns, id_col, text_col, sample).where(F.col("_score") >= threshold)
    return out.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(docs.columns)])
