"""Whitening, toxicity and ranked search against brute force, and on hostile rows."""

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from brackwater.llm import retrieval, toxicity, urls, whitening

SF = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.1"


# 11: whitening


def exact(rows):
    return [[int(math.floor(64 * c)) + 1_000_000 for c in r] for r in rows]


def test_products_equal_fractions():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(2_500, 4)) * 10.0 ** np.arange(4), rng.normal(size=(2_500, 4)) * 1e-17
    hi, lo = whitening.product(a, a)
    cells = [[Fraction(h) + Fraction(x) for h, x in zip(*row, strict=True)] for row in zip(a[0].tolist(), a[1].tolist(), strict=True)]
    for i in range(4):
        for j in range(4):
            want = sum(r[i] * r[j] for r in cells)
            scale = float(sum(r[i] ** 2 for r in cells) * sum(r[j] ** 2 for r in cells)) ** 0.5
            assert abs(float(Fraction(hi[i, j]) + Fraction(lo[i, j]) - want)) < 1e-27 * scale


@pytest.mark.parametrize("kind", ["table", "graded"])
def test_whitening(spark, kind):
    if kind == "table":
        df = spark.read.parquet(f"{SF}/embeddings.parquet")
    else:  # variances over twenty orders of magnitude, turned
        rng = np.random.default_rng(3)
        rows = rng.normal(size=(300, 10)) * 10.0 ** np.arange(1, 11) @ np.linalg.qr(rng.normal(size=(10, 10)))[0]
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>").repartition(3)
    raw = {r.vec_id: r.embedding for r in df.collect()}
    n, x = len(raw), exact(raw.values())
    sums = [sum(c) for c in zip(*x, strict=True)]
    out = whitening.whitened(df).toPandas()
    k = min(32, len(sums))
    assert len(out) == n * k and set(out["n"]) == {n} and sorted(set(out["component"])) == list(range(1, k + 1))
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for i, row in zip(raw, x, strict=True)}
    got = out.groupby("vec_id")["deviation"].first().to_dict()
    assert got == {i: min(d, (1 << 63) - 1) for i, d in deviation.items()}
    w = out.sort_values(["vec_id", "component"])["whitened"].to_numpy().reshape(n, k)
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-6 and out["identity_error"].iat[0] < 1e-6
    # The exact covariance, in fractions: w times the root of e must be the projection on unit vectors that V leaves in place.
    y = [[Fraction(n * c - s, n) for c, s in zip(row, sums, strict=True)] for row in x]
    d = len(sums)
    cov = np.array([[float(sum(r[i] * r[j] for r in y) / n) for j in range(d)] for i in range(d)])
    if kind == "table":
        e, v = np.linalg.eigh(cov)
        e, v = e[::-1], v[:, ::-1]
        want = np.array(y, float) @ v[:, :k] / np.sqrt(e[:k])
        assert np.abs(np.abs(want) - np.abs(w[np.argsort(np.argsort(list(raw)))])).max() < 1e-8
        assert np.abs(out.sort_values(["vec_id", "component"])["explained"].to_numpy()[:k] / (e[:k] / e.sum()) - 1).max() < 1e-10


def test_whitening_of_odd_rows(spark):
    rows = [(None, None, "t"), (1, [0.5, None], "t"), (2, [float("nan"), 1.0], "t"), (3, [float("inf"), 1.0], "t"), (4, [0.5, 0.25], "t"), (4, [0.5, 0.25], "t"), (None, [0.1], "t"), (5, [], "t"), (6, [1e300, 0.0], "t")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    out = whitening.whitened(df).collect()
    assert Counter(r.vec_id for r in out) == {4: 4, None: 2, 5: 2, 6: 2}
    assert {r.n for r in out} == {5} and {r.identity_error for r in out} != {None} and out[0].identity_error < 1e-4
    same = whitening.whitened(df.where("vec_id = 4")).collect()
    assert len(same) == 4 and {(r.whitened, r.explained, r.identity_error) for r in same} == {(0.0, 0.0, 0.0)}
    assert whitening.whitened(df.where("vec_id < 4")).collect() == [] and whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(df.where("vec_id = 5")).collect() == []  # no dimensions


# 12: toxicity


def test_toxic_held_out_documents_are_found(spark):
    docs, labels = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")
    out = toxicity.toxicity(docs, labels).toPandas()
    assert len(out) == docs.count() and out["score"].between(0, 1).all()
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out["doc_id"]]).all()
    assert (out["predicted"] == (out["score"] >= 0.7)).all()
    unseen = out[out["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert unseen.loc[unseen["toxic"] == 1, "predicted"].mean() > 0.8 and unseen.loc[unseen["toxic"] == 0, "predicted"].mean() < 0.005


def test_ratios_equal_plain_counts(spark, tmp_path):
    """The table of ratios against the same formulas over dictionaries."""
    texts = [("the cat sat on the mat", 0), ("the dog sat on the cat", 0), ("catty cats bite the dog", 1), ("bite the cat, bite!", 1), ("bite the catty dog", 1), ("", 0), (None, 1)]
    docs = spark.createDataFrame(texts, "text string, toxic long")
    counted = docs.mapInArrow(toxicity._counted, "level tinyint, first bigint, word bigint, t int, o int").groupBy("level", "first", "word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    got = {(r.level, r.first, r.word): r.ratio for r in toxicity.ratios(counted).collect()}

    words = toxicity.Words()
    uni, pair = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for text, y in texts:
        before, own = toxicity.pairs_of(text, words)
        for b, w in zip(before, own, strict=True):
            uni[w][y] += 1
            pair[b, w][y] += 1
    hashes, stems = (a.view(np.int64).tolist() for a in words.arrays())
    st, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    ctx, ckinds, call = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), Counter()
    for w, c in uni.items():
        for y in (0, 1):
            st[stems[w]][y] += c[y]
            kinds[stems[w]][y] += c[y] > 0
    for (b, _), c in pair.items():
        call[b] += 1
        for y in (0, 1):
            ctx[b][y] += c[y]
            ckinds[b][y] += c[y] > 0
    total = [sum(c[y] for c in st.values()) for y in (0, 1)]
    used = [sum(c[y] > 0 for c in st.values()) for y in (0, 1)]
    d = toxicity.DISCOUNT

    def stem_p(s, y):
        return (max(st[s][y] - d, 0) + d * used[y] * (sum(st[s]) + 0.5) / (sum(total) + 0.5 * (len(st) + 1))) / total[y]

    def cut(c, types, back, all_):
        return (max(c - d, 0) + d * types * back) / all_ if all_ else back

    want = {(0, s, 0): math.log(stem_p(s, 1) / stem_p(s, 0)) for s in st if sum(st[s]) >= 2}
    lower = {}
    for w, c in uni.items():
        s = stems[w]
        if sum(c) >= 2:
            p = [stem_p(s, y) * cut(c[y], kinds[s][y], sum(c) / sum(st[s]), st[s][y]) for y in (0, 1)]
            lower[w] = want[1, s, hashes[w]] = math.log(p[1] / p[0])
    for (b, w), c in pair.items():
        if sum(c) >= 2:
            both = (sum(c) - d + d * call[b] * sum(uni[w]) / sum(total)) / sum(ctx[b])
            p = [cut(c[y], ckinds[b][y], both * (math.exp(lower[w]) if y else 1), ctx[b][y]) for y in (0, 1)]
            want[2, hashes[b], hashes[w]] = math.log(p[1] / p[0])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_toxicity_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "..."), (None, "vile scum of vile"), (4, "word " * 250_000), (5, "vile scum"), (5, "vile scum"), (6, "日本語 " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"toxic": F.lit("x"), "score": F.lit(1), "held_out": F.lit(0)})
    labels = spark.createDataFrame([(1, 1), (5, 1), (5, 0), (4, 0), (None, 1), (7, None), (2, 0)], "doc_id long, toxic int")
    for said in (labels, labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        out = toxicity.toxicity(docs, said).collect()
        assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows) and all(0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1 and not [r for r in out if r.doc_id is None and r.held_out]
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    want = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    monkeypatch.setattr(toxicity, "BLOCK_TOKENS", 500)
    rows = []
    for lo in range(0, 200, 50):
        part = docs.where(f"doc_id >= {lo} and doc_id < {lo + 50}").toPandas()
        words = toxicity.Words()
        for i, text in zip(part["doc_id"], part["text"], strict=True):
            before, own = toxicity.pairs_of(text, words)
            figures = model.figures(np.array(before, np.int64), np.array(own, np.int64), np.array([len(own)]), *words.arrays())
            rows.append((i, float(model.score(figures)[0])))
    assert all(abs(want[i] - s) < 1e-9 for i, s in rows if i in want)


# 13: ranked search


def brute(docs, items, k=20):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    have = [(i, Counter(t)) for i, t in ((i, find(t)) for i, t in docs) if t]
    n, size = len(have), sum(sum(c.values()) for _, c in have)
    df = Counter(w for _, c in have for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for w, x in df.items()}
    out = Counter()
    for item, text in items:
        asked, found = Counter(find(text)), []
        for i, c in have:
            m = 75 + (25 * sum(c.values()) * n) // size
            s = sum(times * weight[w] * ((1_000_000_000 * c[w]) // (1_000 * c[w] + 12 * m)) for w, times in asked.items() if w in c)
            if s > 0:
                found.append((-s, i is not None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, i, -s] += 1
    return out


def test_ranked_equals_all_scores(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = Counter(tuple(r) for r in retrieval.ranked(docs.repartition(3), items).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


@pytest.mark.parametrize("size", [(retrieval.ITEM_TERMS, retrieval.PAIRS), (10, 50)])
def test_ranked_odd_rows(spark, monkeypatch, size):
    """Nulls, repeats, ties, very long texts and items, several blocks of items; pairs are cut inside tasks, so a small PAIRS goes through the operator's own function."""
    monkeypatch.setattr(retrieval, "ITEM_TERMS", size[0])
    rows = [(1, None), (2, ""), (3, "--- ..."), (None, "alpha beta"), (None, "alpha beta"), (4, "Alpha, BETA; gamma"), (4, "Alpha, BETA; gamma"), (5, "alpha " * 200_000 + "delta"), (6, "größe GRÖßE"), (7, "beta-2 x_y")]
    rows += [(100 + i, f"alpha word{i % 7} beta word{i % 3}") for i in range(60)]
    items = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (None, "gamma gamma delta größe"), (4, "nothing like it"), (5, "word1 word2 x y alpha " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"term": F.lit(1), "n": F.lit("n"), "score": F.lit(0)}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit("r"), "times": F.lit(1)})
    got = Counter(tuple(r) for r in retrieval.ranked(docs, asked).collect())
    assert got == brute(rows, items)
    assert retrieval.ranked(docs.limit(0), asked).collect() == [] and retrieval.ranked(docs, asked.limit(0)).collect() == []


def test_ranked_prunes_terms(spark):
    """Of an item's terms, those that cannot lift a document into the result generate no candidates."""
    weight = np.array([5000, 4000, 10, 5])
    kth, top = weight * 400_000, weight * 600_000
    items = retrieval.Items(np.zeros(4, np.int64), np.arange(4), np.ones(4, np.int64), weight, kth, top)
    assert np.diff(items.term_start).tolist() == [1, 1, 0, 0] and items.rest.tolist() == [15 * 600_000] and items.bound.tolist() == [5000 * 400_000]


# 3: paths of any depth


def test_urls_deep_templates_have_verdicts_of_their_own(spark):
    """Two templates that part at the ninth segment, one blocked and one allowed, and paths without a rule below each; a path of 10,000 segments ends."""
    deep = "/a/b/c/d/e/f/g/h"
    rows = [(i, f"http://x.com{deep}/bad/{i}") for i in range(40)] + [(100 + i, f"http://x.com{deep}/good/{i}") for i in range(40)]
    rows += [(300, f"http://x.com{deep}/bad/new/page"), (301, "http://y.com/" + "/".join(f"s{i}" for i in range(10_000))), (302, "http://y.com/" + "s/" * 10_000), (303, "http://z.com/" + "x" * 1_000_000)]
    rules = [("block", "x.com", f"{deep}/bad/1"), ("block", "x.com", f"{deep}/bad/2"), ("block", "x.com", f"{deep}/bad/3"), ("allow", "x.com", f"{deep}/good/1"), ("allow", "x.com", f"{deep}/good/2")]
    out = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(out) == len(rows)
    assert {out[i].verdict for i in (4, 5, 6, 7)} == {"block"} and {out[i].verdict for i in (103, 104, 105)} == {"allow"}
    assert out[4].template == f"{deep}/bad/*" and out[301].template.count("/") == 10_000 and out[303].template == "/" + "x" * 1_000_000
