"""Operator 13: ranked lexical search by a threshold-seeded join.

Documents are turned into postings of the terms that items have, one row per document. Every term's k
highest impacts are found over all documents and stored; the greatest kth impact among an item's terms is
a score that k documents reach, so it bounds the item's kth score from below. An item's terms are put in
order of their highest impacts; the terms at the end whose highest impacts together stay below the bound
cannot lift a document into the result by themselves, so they generate no candidates. Postings are joined
with the other terms by item; a document whose sum there, with all that the end could add, reaches the
bound is scored exactly. Bounds rise to the kth score that a task has found. They only ever drop what
cannot be among the k best, so the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, saved, short_batches

#: Terms of items held at once, about: more items are taken in blocks of this many terms.
ITEM_TERMS = 200_000
#: Pairs of posting and item that a task expands at once.
PAIRS = 2_000_000
#: Factors of the score: w * ((GRAIN * tf) div (STEEP * tf + LONG * m)), m being BASE + (SLOPE * n * N) div L.
GRAIN, STEEP, LONG, BASE, SLOPE = 1_000_000_000, 1_000, 12, 75, 25
#: A missing document id while documents are compared: it sorts first.
NO_ID = -(1 << 63)

_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: Bytes as terms hold them; all that separates terms is a space.
BYTES = bytes(b if b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased, in UTF-8; None has none."""
    return text.encode("utf-8", "surrogatepass").translate(BYTES).split() if text else []


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((GRAIN * tf) // (STEEP * tf + LONG * m))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1 and so on, sizes[i] each, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _best(group: np.ndarray, score: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of every group, ties to smaller numbers."""
    order = np.lexsort((ties, -score, group))
    own = group[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[rank < k]


class Items:
    """A block of items against the terms' statistics: which terms generate candidates, and what the rest may add."""

    def __init__(self, item: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, kth: np.ndarray, top: np.ndarray):
        self.n, self.weight = int(item.max(initial=-1)) + 1, weight
        live = top[term] > 0
        item, term, times = item[live], term[live], times[live]
        order = np.lexsort((term, -times * top[term], item))
        item, term, times = item[order], term[order], times[order]
        self.bound = np.ones(self.n, np.int64)
        np.maximum.at(self.bound, item, times * kth[term])
        most = np.cumsum((times * top[term])[::-1])[::-1]
        ends = np.searchsorted(item, np.arange(self.n), side="right")
        after = np.append(most, 0)[ends]
        suffix = most - after[item]  # what this term and those behind it can add
        asks = suffix >= self.bound[item]
        self.rest = np.zeros(self.n, np.int64)
        np.maximum.at(self.rest, item[~asks], suffix[~asks])
        #: By term: the items that it generates candidates for.
        at = np.flatnonzero(asks)
        at = at[np.argsort(term[at], kind="stable")]
        self.term_start = np.searchsorted(term[at], np.arange(len(weight) + 1))
        self.asked_item, self.asked_times = item[at], times[at]
        #: By item: the terms that generate none.
        at = np.flatnonzero(~asks)
        self.item_start = np.searchsorted(item[at], np.arange(self.n + 1))
        self.end_term, self.end_times = term[at], times[at]

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, score) of all pairs that reach the item's bound, from postings in order of document and term."""
        sizes = (self.term_start[1:] - self.term_start[:-1])[term]
        place = _ranges(self.term_start[term], sizes)
        pair = np.repeat(doc, sizes) * self.n + self.asked_item[place]
        pair, back = np.unique(pair, return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, back, np.repeat(impact, sizes) * self.asked_times[place])
        own, item = pair // max(self.n, 1), pair % max(self.n, 1)
        near = total + self.rest[item] >= bound[item]
        own, item, total = own[near], item[near], total[near]
        sizes = self.item_start[item + 1] - self.item_start[item]
        place = _ranges(self.item_start[item], sizes)
        width = len(self.weight)
        keys, wanted = doc * width + term, np.repeat(own, sizes) * width + self.end_term[place]
        found = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = keys[found] == wanted if len(keys) else np.zeros(0, bool)
        np.add.at(total, np.repeat(np.arange(len(own)), sizes)[hit], impact[found[hit]] * self.end_times[place[hit]])
        full = total >= bound[item]
        return own[full], item[full], total[full]


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a number), item_id, term and times of each item's terms."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), column(id_col).cast("long").alias("item_id"), column(text_col).alias("text"))

    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(i, j, t, n) for i, j, text in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True) for t, n in Counter(terms_of(text)).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int64()))], names=["item", "item_id", "term", "times"])

    return saved(rows.mapInArrow(counted, "item bigint, item_id bigint, term binary, times bigint"), "items")


def _postings(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, and the numbers and counts of the terms sought, of every document with terms."""

    def posted(batches):
        import pyarrow as pa

        for batch in batches:
            ids, ns, terms, counts, ends = [], [], [], [], [0]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not (words := terms_of(text)):
                    continue
                own = sorted((number[w], n) for w, n in Counter(words).items() if w in number)
                ids.append(i)
                ns.append(len(words))
                terms += [t for t, _ in own]
                counts += [n for _, n in own]
                ends.append(len(terms))
            ends = np.array(ends, np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"))
    return saved(rows.mapInArrow(posted, "doc_id bigint, n bigint, terms array<int>, counts array<int>"), "postings")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k highest-scoring documents for every item: item_col, rank (from 1), id_col, score.

    A term's weight falls with the documents that hold it, its impact rises with its occurrences and falls
    with the document's length; a score sums impacts over the item's terms, repeats included. Scores of 0 are
    left out; ties go to smaller ids, missing ids first. Every row is a document, and every row of items an
    item with a result of its own, null ids too. Null and empty texts and texts without terms neither match
    nor count. No documents or no items: no rows. Other columns are not read. An item's terms are held whole by each task.
    """
    short_batches(docs)
    asked = _item_terms(items, item_col, item_text_col)
    blocks = max(1, -(-asked.count() // ITEM_TERMS))
    found = None
    for b in range(blocks):
        part = _block(docs, asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k, id_col, text_col)
        found = part if found is None else found.union(part)
    names = asked.select("item", "item_id").distinct()
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "item").select(F.col("item_id").alias(item_col), "rank", F.nullif("doc_id", F.lit(NO_ID)).alias(id_col), "score")


def _block(docs: DataFrame, asked: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """item, doc_id (NO_ID for none) and score: k candidates or more for every item of a block, by task."""
    rows = asked.select("item", "term", "times").collect()  # about ITEM_TERMS rows
    number = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    uids = np.array(sorted({r["item"] for r in rows}), np.int64)
    item = np.searchsorted(uids, np.array([r["item"] for r in rows], np.int64))
    term, times = np.array([number[bytes(r["term"])] for r in rows], np.int64), np.array([r["times"] for r in rows], np.int64)

    postings = _postings(docs, number, id_col, text_col)
    size = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(1)).alias("terms")).first()
    n_docs, n_terms = size["docs"], size["terms"]
    weight = np.zeros(len(number), np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))

    def read(batch):
        """Document by posting, its term and its impact; ids by document."""
        sizes = np.asarray(batch.column(2).value_lengths(), np.int64)
        terms, counts = (np.asarray(batch.column(c).flatten(), np.int64) for c in (2, 3))
        m = BASE + np.array([SLOPE * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
        return np.repeat(np.arange(len(sizes)), sizes), terms, impacts(weight[terms], counts, np.repeat(m, sizes))

    def highest(batches):
        import pyarrow as pa

        held, size, kept = [], 0, 0

        def best():
            terms, found = (np.concatenate(x) for x in zip(*held, strict=True))
            at = _best(terms, found, np.zeros(len(terms)), k)
            return terms[at], found[at]

        for batch in batches:
            held.append(read(batch)[1:])
            size += len(held[-1][0])
            if size > 2 * kept + PAIRS:
                held = [best()]
                size = kept = len(held[0][0])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best()], names=["term", "impact"])

    by_term = Window.partitionBy("term").orderBy(F.desc("impact"))
    stored = postings.mapInArrow(highest, "term bigint, impact bigint").withColumn("place", F.row_number().over(by_term)).where(F.col("place") <= k)
    stored = saved(stored.groupBy("term").agg(F.max("impact").alias("top"), F.max(F.when(F.col("place") == k, F.col("impact"))).alias("kth")), "impacts")
    kth, top = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    for r in stored.collect():
        top[r["term"]], kth[r["term"]] = r["top"], r["kth"] or 0
    join = Items(item, term, times, weight, kth, top)
    fan = np.diff(join.term_start)

    def candidates(batches):
        import pyarrow as pa

        bound = join.bound.copy()
        best = [np.zeros(0, np.int64)] * 3  # item, document, score

        for batch in batches:
            doc, terms, impact = read(batch)
            ids = np.asarray(batch.column(0).fill_null(NO_ID), np.int64)
            ends = np.cumsum(np.bincount(doc, fan[terms], len(ids)))
            cuts = np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS)) + 1
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(ids)), strict=True):
                a, b = np.searchsorted(doc, (lo, hi))
                own, items_of, score = join.scores(doc[a:b], terms[a:b], impact[a:b], bound)
                best = [np.concatenate(x) for x in zip(best, (items_of, ids[own], score), strict=True)]
                at = _best(best[0], best[2], best[1], k)
                best = [x[at] for x in best]
                count = np.bincount(best[0], minlength=join.n)
                last = np.searchsorted(best[0], np.flatnonzero(count == k), side="right") - 1
                bound[best[0][last]] = np.maximum(bound[best[0][last]], best[2][last])
        yield pa.RecordBatch.from_arrays([pa.array(uids[best[0]]), pa.array(best[1]), pa.array(best[2])], names=["item", "doc_id", "score"])

    return postings.mapInArrow(candidates, "item bigint, doc_id bigint, score bigint")
