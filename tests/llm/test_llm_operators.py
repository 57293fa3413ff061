"""The first ten operators against brute force on small tables, and on hostile rows."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from brackwater.llm import bpe as bpe_op
from brackwater.llm import caps, kneser_ney, licences, packing, pii, quality, simhash, topk, urls
from brackwater.llm.common import components, words_of

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON, SAME_RANKS = (public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken"))
PATTERN = public_tokenizers.PATTERN

HOSTILE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "x" * 3000), (6, "日本語のテキスト。 " * 40), (7, "same text again and again"), (8, "same text again and again"),
    (8, "same text again and again"), (None, "no id here, mail me@x.example.org or +1 (168) 555-5254"), (9, "emoji 😀 \u200d é\x00\x0b z"), (10, "<|endoftext|> is text"), (11, "word " * 5000),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def hostile(spark):
    """Rows with nulls, empty, long and repeated texts, and further columns whose names operators use inside."""
    df = spark.createDataFrame(HOSTILE, "doc_id long, text string")
    return df.withColumns({"source": F.when(F.col("doc_id") != 4, F.lit("s")), "n": F.lit(1), "id": F.lit("x"), "fp": F.lit(0), "row": F.lit(1), "term": F.lit("a"), "_flag": F.lit(True),
                           "kept": F.lit("k"), "score": F.lit("s"), "posterior": F.lit(0), "sanitised": F.lit("t"), "spans": F.lit(2), "n_email": F.lit("e"), "a.b": F.lit("dot"), "unit": F.lit(3), "shard": F.lit(4)})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# 10: byte-level BPE


def encoding(path):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe_op.load_ranks(path), special_tokens={})


@pytest.mark.parametrize("which", ["docs", "hostile", "nothing"])
def test_bpe(request, which):
    df, enc = request.getfixturevalue(which), encoding(RANKS)
    want = Counter()
    for i, t in texts_of(df):
        ids = np.array(enc.encode_ordinary(t), "<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe_op.bpe(df, RANKS, PATTERN).collect()) == want


def test_bpe_round_trip(hostile):
    rows = bpe_op.bpe(hostile.where("doc_id = 6"), RANKS, PATTERN, keep_ids=True).collect()
    assert bytes(rows[0].decoded).decode() == "日本語のテキスト。 " * 40 and len(rows[0].ids) == rows[0].n_tokens


@pytest.mark.parametrize("piece", ["a" * 1500, "abab" * 60, "aaaabaaab" * 20, "é" * 200, " " * 150, "zyx"])
def test_bpe_long_pieces(piece):
    check_piece(bpe_op.DuckBpe(bpe_op.load_ranks(RANKS)), piece)


def check_piece(encoder, piece):
    (got,) = encoder.encode([piece])
    assert np.frombuffer(got[1], "<u4").tolist() == encoding(RANKS)._core_bpe.encode_single_piece(piece.encode()) and got[2] == piece.encode()


def test_bpe_very_long_pieces():
    rng = np.random.default_rng(4)
    encoder = bpe_op.DuckBpe(bpe_op.load_ranks(RANKS))
    check_piece(encoder, "".join(map(chr, rng.integers(97, 123, 200_000))))
    check_piece(encoder, "a" * 1_000_000)
    check_piece(encoder, "abc" * 5_001)
    check_piece(encoder, " " * 1_001)
    check_piece(encoder, "".join("a" * n + "b" for n in rng.integers(20, 200, 40)))
    clauses = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 67))) for _ in range(60)] + ["".join(map(chr, rng.integers(0xE01, 0xE3A, 70))) for _ in range(60)]
    got = {piece: ids for piece, ids, _ in encoder.encode(clauses)}
    for clause in clauses:
        assert np.frombuffer(got[clause], "<u4").tolist() == encoding(RANKS)._core_bpe.encode_single_piece(clause.encode())


# 9: packing


def check_pieces(rows, df, window=2048):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    want = Counter()
    for i, t in texts_of(df):
        want[i, np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()] += 1
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append((r.offset, r.length))
    for places in by_window.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end == window or (end < window and end & (end - 1) == 0)
    for (i, raw), times in want.items():
        ids = np.frombuffer(raw, "<u4")
        own = [r for r in by_doc[i] if r.doc_tokens == len(ids)]
        got = Counter((r.start, r.length, r.ids_crc32) for r in own)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in got)
        assert sum(r.length for r in own) == times * len(ids)
    assert sum(r.length for r in rows) == sum(len(raw) // 4 * k for (_, raw), k in want.items())


@pytest.mark.parametrize("which", ["docs", "hostile", "nothing"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    check_pieces(packing.pack(df, JSON, SAME_RANKS, PATTERN, shard_tokens=50_000).collect(), df)


def test_packing_does_not_depend_on_splits(spark, docs, monkeypatch):
    """Equal rows in one split and in several, null ids among them, are dealt alike whatever the splits."""
    monkeypatch.setattr(packing, "COUNTED", 40)
    copies = spark.range(300).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("one text of all").alias("text"), F.lit("hot").alias("source"))
    rows = docs.limit(150).select("doc_id", "text", "source").union(copies)
    rows = rows.union(rows.limit(40))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
    got = []
    for n in (1, 7):
        split = spark.createDataFrame(rows.collect(), rows.schema).repartition(n)
        out = packing.pack(split, JSON, SAME_RANKS, PATTERN, shard_tokens=3_000).select(*columns).collect()
        got.append(sorted(map(tuple, out), key=str))
    assert got[0] == got[1]
    assert len({r[5] >> 32 for r in got[0] if r[7] == "hot"}) > 5  # copies lie in many shards


def test_sums_before_equal_plain_sums(spark):
    rows = [(s, k, (s * 7 + k * 3) % 11) for s in range(200) for k in range(3) if (s + k) % 4]
    got = packing.sums_before(spark.createDataFrame(rows, "shard int, source int, n int"), ["source"], "n", 200).collect()
    assert len(got) == len(rows)
    assert all(r.before == sum(n for s, k, n in rows if k == r.source and s < r.shard) for r in got)


def test_mixture_reaches_targets():
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    dealt = packing.deal_windows({"a": 500_000, "b": 300_000, "c": 200_000}, shares, {}, 2048, 64)
    full = [dict(p) for p in dealt if sum(n for _, n in p) == 2048]
    for s, share in shares.items():
        sums = np.cumsum([w.get(s, 0) for w in full]) - share * 2048 * np.arange(1, len(full) + 1)
        assert np.abs(sums[:-3]).max() <= 2048 * 0.2  # deficits stay bounded: they are carried, not forgotten
    assert sum(n for w in dealt for _, n in w) == 1_000_000


def test_carried_deficit_is_served_first():
    (first, *_) = packing.deal_windows({"a": 4096, "b": 4096}, {"a": 0.5, "b": 0.5}, {"b": 900.0}, 2048, 64)
    assert dict(first)["b"] > 1800


def test_tokenizers_agree_on_all_characters():
    from tokenizers import Tokenizer

    tok, quick = Tokenizer.from_file(JSON), encoding(SAME_RANKS)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)} b{chr(c)}!" for c in points]
    assert [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)] == [quick.encode_ordinary(t) for t in texts]


# 8: SimHash


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(n, linked):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("which", ["docs", "hostile", "nothing"])
def test_simhash(request, which):
    df = request.getfixturevalue(which)
    rows = texts_of(df)
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    want = Counter((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()) == want


def test_every_close_pair_shares_a_key():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = []
    for x in (a, b):
        held = defaultdict(set)
        for r, k in zip(*simhash.fingerprint_keys(x), strict=True):
            held[r].add(k)
        keys.append(held)
    assert all(keys[0][i] & keys[1][i] for i in range(len(a)))


def test_blocks_of_a_large_key(spark):
    base = np.uint64(0x0123456789ABCDEF)
    fps = [int((base ^ np.uint64(1 << i) ^ np.uint64(1 << j)).astype(np.int64)) for i in range(40) for j in range(i)]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), block=64)
    roots = components(links)
    assert roots.select("root").distinct().count() == 1 and roots.count() == len(fps)


def test_components_of_a_path(spark):
    got = components(spark.range(0, 300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")))
    assert got.count() == 301 and got.where("root <> 0").count() == 0
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# 7: language model


@pytest.mark.parametrize("which", ["docs", "hostile"])
def test_kneser_ney(request, which):
    df = request.getfixturevalue(which)
    rows = texts_of(df)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    bigrams = Counter()
    for i, t in rows:
        if not held[i]:
            w = [None, *words_of(t), 0]
            bigrams.update(zip(w, w[1:], strict=False))
    tokens, total, contexts = Counter(), Counter(), Counter(b for _, b in bigrams)
    seen = defaultdict(lambda: [0, 0, 0])
    for (a, b), n in bigrams.items():
        tokens[b] += n
        total[a] += n
        seen[a][min(n, 3) - 1] += 1
    n_all, v = sum(tokens.values()), len(tokens)
    of, of1 = Counter(bigrams.values()), Counter(contexts.values())
    cut, cut1 = (kneser_ney.discounts(*[c[k] for k in (1, 2, 3, 4)]) for c in (of, of1))
    spare = sum(cut1[min(k, 3)] * n for k, n in of1.items()) / len(bigrams)

    def chance(a, b):
        low = max(contexts[b] - cut1[min(contexts[b], 3)], 0) / len(bigrams) + spare / (v + 1)
        if not total[a]:
            return low
        n = bigrams[a, b]
        return max(n - cut[min(n, 3)], 0) / total[a] + sum(x * y for x, y in zip(cut[1:], seen[a], strict=True)) / total[a] * low

    assert abs(sum(chance(None, b) for b in tokens) + chance(None, "\x00 never") - 1) < 1e-9
    want = {}
    for i, t in rows:
        w = [None, *words_of(t), 0]
        want[i] = (held[i], len(w) - 1, sum(tokens[x] > 0 for x in w[1:]), n_all, sum(math.log10((tokens[x] + 0.5) / (n_all + 0.5 * (v + 1))) for x in w[1:]), sum(math.log10(chance(a, b)) for a, b in zip(w, w[1:], strict=False)))
    got = kneser_ney.held_out_scores(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(want[r.doc_id]) == pytest.approx((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), rel=1e-9)


def test_model_beats_unigrams_on_held_out_text(docs):
    sums = kneser_ney.held_out_scores(docs).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > sums[0]


def test_open_files_do_not_grow_with_shards(spark, docs, monkeypatch, tmp_path):
    import os

    store = kneser_ney.Store(f"file://{tmp_path}/model")
    for k in range(300):
        store.put(f"word-{k}-key", np.arange(k + 1, dtype=np.uint64))
    before = len(os.listdir("/proc/self/fd"))
    assert all(store.get(f"word-{k}-key")[-1] == k for k in range(300)) and store.get("word-3-key")[1] == 1
    assert len(os.listdir("/proc/self/fd")) - before <= kneser_ney.MAPPED
    whole = {r.doc_id: r.score for r in kneser_ney.held_out_scores(docs).collect()}
    monkeypatch.setattr(kneser_ney, "SHARD_CHARS", 5_000)  # many shards, few tokens each
    model = kneser_ney.train(docs.where("crc32(cast(doc_id as string)) % 5 <> 1"))
    assert model.shards > 40 and {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()} == pytest.approx(whole, rel=1e-9)


def test_kneser_ney_without_text(nothing):
    assert kneser_ney.held_out_scores(nothing).count() == 0


# 6: exact top-k


def brute_top(rows, every=100, k=10):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % every == 0:
            best = sorted((-max(min(sum(x * y for x, y in zip(q, v, strict=False)), 2**63 - 1), -(2**63)), j) for b, (j, v) in enumerate(ok) if a != b)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return out


def test_top_products(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert Counter(tuple(r) for r in topk.top_products(df, every=20).collect()) == Counter(brute_top(rows, every=20))


def test_top_products_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (None, [1.0, 1.0]), (4, [None, 1.0]), (5, [-1.0, 3.0]), (6, [1.0]), (7, []), (8, [1e4, -1e4]), (200, [1e9, 1e5]), (9, [1e200, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"uid": F.lit(1), "score": F.lit(2)})
    assert Counter(tuple(r) for r in topk.top_products(df).collect()) == Counter(brute_top(rows))
    assert topk.top_products(df.limit(0)).count() == 0
    assert topk.top_products(df.where("vec_id = 5")).count() == 0


def test_top_products_over_many_bands_and_slices(spark, monkeypatch):
    """Lengths over five powers of ten, groups of equal vectors, slices of several blocks: bands out of reach are never met."""
    monkeypatch.setattr(topk, "SLICE", 64)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "SEEDS", 40)
    saved, kept = topk.saved, {}
    monkeypatch.setattr(topk, "saved", lambda df, kind: kept.setdefault(kind, saved(df, kind)))
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 12)) * 10 ** rng.uniform(-3, 2, size=(900, 1))
    vectors[300:340] = vectors[299]
    vectors[600:] = vectors[600:] / np.linalg.norm(vectors[600:], axis=1, keepdims=True)  # a third has one length
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_products(df, every=10)
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute_top(rows, every=10))
    levels = [r.level for r in kept["slices"].select("level").collect()]
    met = sum(sum(level >= r.least for level in levels) for r in kept["queries"].select("least").collect())
    assert 0 < met < 0.7 * len(levels) * kept["queries"].count()


# 2: near-duplicate vectors


def brute_near(rows, least=0.95):
    ok = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.linalg.norm(v) if o else None for (_, v), o in zip(rows, ok, strict=True)]
    near = [[a != b and ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= least for b in range(len(rows))] for a in range(len(rows))]
    roots = brute_groups(len(rows), lambda a, b: near[a][b])
    out = Counter()
    for a, (i, _) in enumerate(rows):
        members = [rows[b][0] for b in range(len(rows)) if roots[b] == roots[a] and rows[b][0] is not None]
        least_id = min(members, default=None)
        out[i, sum(near[a]), least_id, i == least_id] += 1
    return out


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).tolist()) for i in range(120)]
    for i in range(120, 260):  # near copies at all distances, chains of them, and exact copies
        base = np.array(rows[rng.integers(0, 60)][1])
        rows.append((i, (base + rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.2])).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in caps.near_vectors(df).collect()) == brute_near(rows)


def test_near_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.15).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = Counter(tuple(r) for r in caps.near_vectors(df).collect()), brute_near(rows)
    found, there = (sum(r[1] * k for r, k in c.items()) for c in (got, want))
    assert 0.99 * there <= found <= there and {r[2] for r in got} == {r[2] for r in want}


@pytest.mark.parametrize("words", [8, 32, 128, 512, 2048, 4096])
def test_filters_find_near_pairs_whatever_the_code(words):
    rng = np.random.default_rng(9)
    x, z, sample = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in rng.standard_normal((3, 1000, 64)))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    code = caps.ProductCode(64, words)
    margin = code.margin_for(sample, 0.95)
    pairs = list(zip(code.decode(x, margin), code.decode(y, margin), strict=True))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.97
    assert np.mean([len(a) for a, _ in pairs]) < 40
    whole = [a[:, None] + b[None, :] for a, b in zip(*code.scores(x[:20]), strict=True)]
    assert all((np.flatnonzero(w.ravel() >= -margin) == f).all() for w, (f, _) in zip(whole, pairs, strict=False))


def test_near_vectors_against_brute_force_at_size(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((6000, 64))
    near = base[rng.integers(0, 3000, 3000)] + rng.standard_normal((3000, 64)) * rng.choice([0.1, 0.2, 0.3, 0.33], (3000, 1))
    rows = np.concatenate([base, near]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    units = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    there = (units @ units.T >= 0.95).sum() - len(rows)
    assert 0.985 * there <= sum(r.n_links for r in caps.near_vectors(df).collect()) <= there


def test_near_vectors_of_odd_rows(spark):
    nan = float("nan")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [1.0, 2.0]), (5, [2.0, 4.0]), (6, [None, 1.0]), (None, [-1.0, 5.0]), (7, [1e200, 2e200]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rid": F.lit(1), "filter": F.lit(1), "id": F.lit(0)})
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in caps.near_vectors(df).collect())
    assert got == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, 4, 4): 2, (None, 4, 4): 1, (5, 4, 4): 1, (6, 0, 6): 1, (None, 0, None): 1, (7, 4, 4): 1, (8, 0, 8): 1})
    assert caps.near_vectors(df.limit(0)).count() == 0


# 3: URLs


def brute_base(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_url_rules(spark):
    odd = [None, "", "foo", "HTTP://A.ORG", "http://a.org/", "x://B.example.ORG/es/1?q=://", "http://é.com/de/ü#x", "http://com/de/1", "http://xcom/de/1", "a\nb://h.com/fr/x\ny", "http://user:p@h.COM:80/de/", "://x.com/fr/", "http://a.org?x/en/1", "http://example.org/en/1"]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    df = pages.union(spark.createDataFrame([(i, u) for i, u in enumerate(odd, 10_000)], "page_id long, url string")).withColumns({"host": F.lit("x"), "n": F.lit(1), "template": F.lit(2)})
    rows = urls.judge_urls(df).collect()
    source = {r.page_id: r.url for r in df.collect()}
    assert len(rows) == len(source)
    for r in rows:
        host, path, rule, verdict = brute_base(source[r.page_id], urls.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_url_tree(spark):
    rows = [(f"http://h.net/tag/w{i}", ) for i in range(60)] + [(f"http://h.net/blog/{i}.html",) for i in range(30)] + [(f"http://h.net/spam/{i}",) for i in range(40)] + [(f"http://g.net/spam/{i}/x",) for i in range(9)]
    rules = (("block", "h.net", "/spam/1"), ("block", "h.net", "/spam/2"), ("allow", "h.net", "/blog/1"))
    df = spark.createDataFrame([(i, u) for i, (u,) in enumerate(rows)], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge_urls(df, rules).collect()}
    assert {got[i].template for i in range(60)} == {"/tag/*"} and {got[i].template for i in range(60, 90)} == {"/blog/*"}
    assert {(got[i].template, got[i].verdict) for i in range(90, 130)} == {("/spam/*", "block")}
    assert {got[i].verdict for i in range(60)} == {"allow"} and {got[i].verdict for i in range(60, 90)} == {"allow"}


def plain_branches(counts, apart):
    """Branch of each (host, template) by plain loops over a nested walk of the tree."""
    def differ(a, b):
        p = (a[1] + b[1]) / (a[0] + b[0])
        return abs(a[1] / a[0] - b[1] / b[0]) > apart * (p * (1 - p) * (1 / a[0] + 1 / b[0])) ** 0.5

    def walk(leaves):
        """Leaves (segments, key, n, bad) under one node to {key: branch below}."""
        out, children = {}, {}
        for segments, key, n, bad in leaves:
            if segments:
                children.setdefault(segments[0], []).append((segments[1:], key, n, bad))
            else:
                out[key] = ""
        below = {c: walk(found) for c, found in children.items()}
        places = {}
        for c, found in children.items():
            for _, key, n, bad in found:
                for place in (below[c][key], "whole"):
                    was = places.setdefault(c, {}).get(place, (0, 0))
                    places[c][place] = (was[0] + n, was[1] + bad)
        ranked = sorted((c for c in children if c not in ("*", "**") and places[c]["whole"][0]), key=lambda c: (-places[c]["whole"][0], c))
        alike = {c: [d for d in ranked[:i] if not any(places[c][x][0] and places[d].get(x, (0, 0))[0] and differ(places[c][x], places[d][x]) for x in places[c])] for i, c in enumerate(ranked)}
        for c, found in below.items():
            root = next((d for d in alike.get(c, []) if not alike[d]), c)
            out |= {key: f"/{root}{rest}" for key, rest in found.items()}
        return out

    hosts = {}
    for (host, template), (n, bad) in counts.items():
        hosts.setdefault(host, []).append((template.split("/")[1:] if template else [], (host, template), n, bad))
    return {key: branch for leaves in hosts.values() for key, branch in walk(leaves).items()}


def test_branches_merge_as_by_plain_loops(spark):
    counts = {
        ("h", "/en/news/*"): (40, 38), ("h", "/fr/news/*"): (30, 28), ("h", "/de/news/*"): (30, 1),  # de is another kind
        ("h", "/en/help"): (40, 2), ("h", "/fr/help"): (20, 1), ("h", "/es/help"): (9, 9),  # es is unlike where both have something
        ("h", "/it/news/*"): (0, 0), ("h", ""): (3, 0), ("h", "/*"): (50, 25),
    }
    rng = np.random.default_rng(3)
    for _ in range(400):
        template = "".join(f"/{rng.choice(['a', 'b', 'c', 'd', '*'])}" for _ in range(rng.integers(0, 5)))
        n = int(rng.integers(0, 40))
        counts["r", template] = counts["s", template[:4]] = (n, int(rng.binomial(n, rng.choice([0.1, 0.3, 0.8]))))
    df = spark.createDataFrame([(*key, *value) for key, value in counts.items()], "host string, template string, labelled long, blocked long")
    got = {(r.host, r.template): r.branch for r in urls.merged_branches(df).collect()}
    assert got == plain_branches(counts, urls.APART)
    assert got["h", "/fr/news/*"] == "/en/news/*" and got["h", "/fr/help"] == "/en/help" and got["h", "/de/news/*"] == "/de/news/*"
    assert got["h", "/es/help"] == "/es/help" and got["h", "/it/news/*"] == "/it/news/*"
    assert sum(a != b for (_, a), b in got.items()) > 20
    assert urls.merged_branches(df.limit(0)).count() == 0


# 4: personal data

BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    def ok(kind, s):
        digits = [int(c) for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p[-3:]) <= 255 and not p[:-3].strip("0") for p in s.split("."))
        if kind == "card":
            odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
            return 16 <= len(digits) <= 19 and odd % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in BRUTE.items() for m in re.finditer(p, text) if ok(k, m.group())]


TRICKY = [
    "a@b.c@d.e", "a@b.c_x@d.e", "@x.y a@@b.c", "x@y z@w.v.", "1.2.3.4.5.6.7.8", "256.1.1.1 001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (168) 555-5254", "+12345678901234567890", "++1 2345678",
    "41111111111111111111111111", "a.b%c+d-e@f-g.h-i.j", "é@b.c", "+1234 567", "9" * 300 + ".1.1.1", "0" * 4400 + ".1.1.1", "1.2.3.4.5", "1.2.3.256.7.8.9.1", "00255.0.0.1 1.1.1.0300", "1..2.3.4 1.2.3.4.", "",
]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


@pytest.mark.parametrize("text", ["0" * 1_000_000 + ".1.1.1", "12." * 300_000, "1 " * 500_000, "+1" + "." * 1_000_000, "a@" * 500_000, "9" * 1_000_000])
def test_spans_of_very_long_texts(text):
    start = time.monotonic()
    spans = pii.base_spans(text)
    assert time.monotonic() - start < 20 and all(0 <= a < b <= len(text) for _, a, b in spans)
    assert (spans == [("ip", 0, len(text))]) == text.endswith(".1.1.1")


@pytest.mark.parametrize("which", ["docs", "hostile", "nothing"])
def test_pii(request, which):
    df = request.getfixturevalue(which)
    want = Counter()
    for i, t in texts_of(df):
        spans = brute_spans(t)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[i, *[sum(k == s[0] for s in spans) for k in BRUTE], hashlib.sha256(base.encode()).hexdigest()] += 1
    got = pii.pii(df).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(r.spans.startswith(",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(t))) for r in got for t in [dict(texts_of(df))[r.doc_id]])


@pytest.mark.parametrize("few", [True, False])
def test_disclosing_terms(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(pii, "SENT_TERMS", 0)
    rows = [(i, f"today number {i} our agent Zorblatt writes from jane@x.org about thing{i} and more") for i in range(6)] + [(i, f"plain words about thing{i} and our more of today writes from") for i in range(6, 400)] + [(400, "call Zorblatt now"), (401, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term for r in pii.disclosing_terms(df).collect()}
    assert "zorblatt" in terms and "about" not in terms and "thing1" not in terms
    got = {r.doc_id: r for r in pii.pii(df, sanitise=True).collect()}
    assert got[400].spans == "term:5:13" and got[400].sanitised == "call <NAME> now" and got[400].n_term == 1
    assert "jane@x.org" not in got[0].sanitised and "<EMAIL>" in got[0].sanitised and "Zorblatt" not in got[0].sanitised
    assert got[401].sanitised is None and got[7].sanitised == rows[7][1]


@pytest.mark.parametrize("few", [True, False])
def test_disclosing_terms_are_split_alike(spark, monkeypatch, few):
    """Combining marks, superscripts and letters whose lower case depends on their neighbours, sent and joined."""
    if not few:
        monkeypatch.setattr(pii, "SENT_TERMS", 0)
    texts = ["हिन्दी here", "area m² here", "ΟΔΟΣ.Α and ΟΔΟΣ", "İstanbul here", "plain", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ["हिन्दी", "m²", "οδος", "İstanbul"]
    terms = spark.createDataFrame([(t.lower(),) for n in names for t in pii.TERM.findall(n)], "term string")
    got = {r.doc_id: r.spans for r in pii.pii(df, terms=terms).collect()}
    for i, t in enumerate(texts):
        words = {x.lower() for n in names for x in pii.TERM.findall(n)}
        assert got[i] == ",".join(f"term:{m.start()}:{m.end()}" for m in pii.TERM.finditer(t or "") if m.group().lower() in words)
    assert got[0] and got[1] and got[2].count("term") == 2 and got[3]


def test_disclosing_terms_of_whole_documents(spark):
    """A name at the head of a letter whose address stands far below, an entity of two documents, and copies."""
    far = "plain words of a letter that goes on and on and on " * 20
    rows = [f"Dear Quillfeather, {far} number{i} write to quill@x.org" for i in range(4)]
    rows += [f"Brandywhistle {far} case{i} call +1 (168) 555-5254" for i in range(2)]
    rows += [f"Copyname {far} mail copy@x.org"] * 9  # one text is no evidence
    long = " ".join(f"nearname{i}" for i in range(400))
    rows += [f"{long} mail near@x.org {'and so on ' * i}" for i in range(5)]  # nor are near copies of one
    rows += [f"{far} other{i}" for i in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    terms = {(r.term, r.entity) for r in pii.disclosing_terms(df).collect()}
    assert {("quillfeather", "email:quill@x.org"), ("brandywhistle", "phone:11685555254")} <= terms
    assert not {"copyname", "nearname7", "plain", "number1", "case1"} & {t for t, _ in terms}


def test_disclosure_equals_plain_counts(spark):
    """Mutual information and the bound on chance from plain counts over distinct texts."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        words = [f"w{k}" for k in rng.integers(0, 40, 12)] + [f"u{i}"]
        if i < 24:
            words += [f"person{i % 4}", f"mail p{i % 4}@x.org"] + ["often"] * (i % 3 > 0) + [f"side{k}x{i}" for k in range(60)]
        rows.append(" ".join(words))
    rows += rows[:5]
    got = {(r.term, r.entity): r.disclosure for r in pii.disclosing_terms(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    said, holds = Counter(), defaultdict(list)
    for text in set(rows):
        spans = brute_spans(text)
        said.update(pii.terms_of(text))
        rest = text
        for _, a, b in reversed(spans):
            rest = rest[:a] + " " + rest[b:]
        for _, a, b in spans:
            holds["email:" + text[a:b]].append(pii.terms_of(rest))
    total = len(set(rows))
    pairs = {e: Counter(t for own in texts for t in own) for e, texts in holds.items() if len(texts) > 1}
    tested = sum(map(len, pairs.values()))
    want = {}
    for e, both in pairs.items():
        n = len(holds[e])
        for t, k in both.items():
            x, q = k / n, said[t] / total
            apart = x * math.log(x / q) + ((1 - x) * math.log((1 - x) / (1 - q)) if x < 1 else 0)
            share = math.log(k * total / (n * said[t])) / math.log(total / n)
            if k > 1 and x > q and n * apart >= math.log(tested / pii.CHANCE) and share >= pii.THRESHOLD:
                want[t, e] = share
    assert got == pytest.approx(want) and {t for t, _ in got} == {f"person{k}" for k in range(4)} | {f"p{k}" for k in range(4)} - {f"p{k}" for k in range(4)}


# 5: licences


def test_licences(spark):
    named = {text: name for name, texts in licences.TEMPLATES.items() for text in texts}
    others = ["He has a license plate.", "Copyright law is hard.", "plain text", None, "", "\n\n", "The warranty and the license of the dog were licensed"]
    rows = [(i, f"some words\nfoo {t} bar\nmore") for i, t in enumerate(named)] + [(1000 + i, t) for i, t in enumerate(others)] + [(None, "x " * 5000 + "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "line": F.lit(2), "family": F.lit("x")})
    got = {r.doc_id: r for r in licences.licences(df).collect()}
    right = sum(got[i].licences == name for i, name in enumerate(named.values()))
    assert right >= 0.9 * len(named) and len(got) == len(rows)
    assert all(got[1000 + i].licences == "" for i in range(len(others))) and got[None].licences == "MIT"
    assert licences.licences(df.limit(0)).count() == 0


def test_licence_probabilities_are_calibrated():
    """Of texts left out of training: where a class is named, probabilities keep what they say, and few are wrong."""
    weights, bias, temperature, held = licences.calibrated()
    assert len(weights) < 6000 and len(bias) == len(licences.CLASSES)
    named = [(p, right) for p, right in held if p >= licences.NAMED]
    assert len(named) > 0.6 * len(held) and np.mean([right for _, right in named]) > 0.65
    gap = sum(abs(sum(p - right for p, right in part)) for lo in np.arange(0, 1, 0.2) if (part := [x for x in held if lo <= x[0] < lo + 0.2 or (lo > 0.7 and x[0] == 1)]))
    assert gap / len(held) < 0.12


WRAPPED = {
    "GPL": "/*\n * This program is free software: you can redistribute it\n * and/or modify it under the terms of the GNU General\n * Public License as published by the Free Software\n * Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */",
    "MIT": "# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and associated documentation\n# files (the \"Software\"), to deal in the Software without\n# restriction, including without limitation the rights to use",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "AGPL": "you can redistribute it and/or modify it under\nthe terms of the GNU Affero General Public License as\npublished by the Free Software Foundation",
    "CC BY-SA": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "MPL": "// This Source Code Form is subject to the terms of the\n// Mozilla Public License, v. 2.0.",
    "Apache": "Project notes\n\nReleased under Apache 2.0 license.",
    "LGPL": "Distributed under the GNU LGPL 2.1 license",
}


def test_wrapped_and_unseen_wordings(spark):
    others = ["Licensed under the Zlorp License 3.0.", "the licence of the boat costs a lot", "This file is subject to the Quux Public License", "x " * 200_000]
    rows = [(i, "some words before.\n\n" + t + "\n\nand after") for i, t in enumerate(WRAPPED.values())] + [(100 + i, t) for i, t in enumerate(others)]
    rows += [(200, "plain words " * 150 + "Released under the MIT License. " + "more plain words " * 150), (201, "Released under the MIT License.\n\nLicensed under CC BY 4.0.")]
    got = {r.doc_id: r for r in licences.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licences for i in range(len(WRAPPED))] == list(WRAPPED)
    assert all(got[100 + i].licences == "" for i in range(len(others)))
    assert got[200].licences == "MIT" and got[201].licences == "CC BY,MIT"


def test_spans_without_key_words_are_unknown():
    """What is not looked at could not have been named: without features the bias alone speaks, for unknown."""
    weights, bias, _ = licences.model()
    assert all(set(g.split()) & set(licences.KEYS) for g in weights) and bias.argmax() == 0


def test_licences_run_no_python(spark, docs):
    plan = licences.licences(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# 1: quality


def test_quality_finds_bad_documents(spark):
    base = "/root/testdata/sf0.01"
    rows = quality.quality(spark.read.parquet(f"{base}/documents.parquet")).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").collect()
    good, bad = [[r.kept for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.15


def test_label_model_weighs_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth) for a in (0.95, 0.9, 0.6, 0.55)], axis=1)
    patterns = np.array([quality.pattern_of(tuple(1 if v else -1 for v in row)) for row in votes])
    seen, counts = np.unique(patterns, return_counts=True)
    post = dict(zip(seen.tolist(), quality.label_model(seen, counts.astype(float), 4), strict=True))
    guess = np.array([post[p] > 0.5 for p in patterns])
    assert (guess == truth).mean() > 0.94


def test_quality_of_odd_rows(hostile, nothing):
    rows = quality.quality(hostile, keep=hostile.columns).collect()
    assert len(rows) == len(HOSTILE) and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.kept and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert quality.quality(nothing).count() == 0


def test_quality_does_not_depend_on_splits(docs):
    few, many = ({r.doc_id: r.score for r in quality.quality(docs.repartition(n, "text")).collect()} for n in (1, 7))
    assert few == many


def test_label_model_equals_plain_loops():
    """Expectation-maximisation by plain loops over single documents."""
    rng = np.random.default_rng(1)
    rows = [tuple(int(v) for v in rng.integers(-1, 2, 3)) for _ in range(60)]
    seen = sorted({quality.pattern_of(r) for r in rows})
    counts = Counter(quality.pattern_of(r) for r in rows)
    got = quality.label_model(np.array(seen), np.array([float(counts[p]) for p in seen]), 3, rounds=5)
    post = [min(0.95, max(0.05, sum(v == 1 for v in r) / max(1, sum(v != 0 for v in r)) if any(r) else 0.5)) for r in rows]
    for _ in range(5):
        prior = (sum(post) + 1) / (len(rows) + 2)
        right = {}
        for c in (0, 1):
            for k in range(3):
                share = {v: 1.0 + sum(p if c else 1 - p for p, r in zip(post, rows, strict=True) if r[k] == v) for v in (-1, 1)}
                right[c, k] = {v: x / sum(share.values()) for v, x in share.items()}
        new = []
        for r in rows:
            good, bad = prior, 1 - prior
            for k, v in enumerate(r):
                if v:
                    good, bad = good * right[1, k][v], bad * right[0, k][v]
            new.append(good / (good + bad))
        post = new
    want = {quality.pattern_of(r): p for r, p in zip(rows, post, strict=True)}
    assert got == pytest.approx([want[p] for p in seen])
