"""The pipeline's stages on their own input, and as a whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from brackwater.llm import pii, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    assert 4 <= len(pipeline.STAGES) <= 5
    kept = pipeline.keep_quality(spark, docs, SF)
    assert kept.schema == docs.schema and kept.exceptAll(docs).isEmpty() and 0 < kept.count() < docs.count()
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()}
    alone = pipeline.drop_near_duplicates(spark, docs, SF)
    assert alone.columns == COLUMNS and {r.doc_id for r in alone.collect()} <= set(groups.values())
    masked = pipeline.mask_personal_data(spark, docs, SF)
    assert masked.schema.simpleString() == docs.schema.simpleString() and masked.count() == docs.count()
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in masked.collect():
        spans = pii.base_spans(before[r.doc_id])
        assert all(before[r.doc_id][a:b] not in r.text for _, a, b in spans) and r.n_chars == len(r.text)
        assert spans or r.text == before[r.doc_id]


def test_run(spark):
    rows = pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def survivors(rows):
    """Ids of the smallest of each group over links at Jaccard 0.8 of five-word shingles or four bits, all pairs compared."""
    sets, prints = {i: shingle_set(t) for i, t in rows}, {i: simhash.text_fingerprint(t) for i, t in rows}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and root[i] != root[j]:
                a, b = sets[i], sets[j]
                if a == b or len(a & b) >= 0.8 * len(a | b) or (prints[i] ^ prints[j]).bit_count() <= 4:
                    x, y = sorted((root[i], root[j]))
                    root = {k: x if r == y else r for k, r in root.items()}
    return set(root.values())


def edited(words, rng, share):
    out = list(words)
    for at in rng.choice(len(out), max(1, round(share * len(out))), replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return out


@pytest.mark.parametrize("sets", [256, 4])
def test_near_copies_beyond_four_bits_go(spark, monkeypatch, sets):
    monkeypatch.setattr(simhash, "SETS", sets)
    rng = np.random.default_rng(5)
    rows = []
    for group in range(12):  # chains of copies on both sides of 0.8, some with a common passage
        words = [f"g{group}w{rng.integers(1000)}" for _ in range(120)]
        if group % 2:
            words[:90] = [f"passage{k}" for k in range(90)]
        for _ in range(6):
            rows.append((len(rows), " ".join(words)))
            words = edited(words, rng, rng.choice([0.01, 0.02, 0.03]))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "a b"), (len(rows) + 3, "A  b")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = survivors(rows)
    assert {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, SF).collect()} == want
    narrow = {r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert want < narrow


def test_near_copies_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    left = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert left == survivors([(r.doc_id, r.text) for r in docs.collect()])


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "x" * 1_000_000), (6, "1" * 1_000_000), (7, "same text again and again, mail me@x.example.org"), (7, "same text again and again, mail me@x.example.org"),
    (8, "same text again and again, mail me@x.example.org"), (None, "no id here"), (9, "0" * 4400 + ".1.1.1"), (10, "The river runs past the old mill and the town sleeps. " * 3000),
]
CLASHING = ["kept", "score", "posterior", "sanitised", "spans", "component_id", "unit", "fp", "bands", "_keep_0", "key", "place", "n", "ids", "shard", "a.b", "term"]


@pytest.mark.parametrize("rows", [ODD, []])
@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES])
def test_stages_on_odd_rows(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({name: F.lit(f"own {name}") for name in CLASHING})
    out = stage(spark, docs, SF)
    got = out.collect()
    if stage is pipeline.STAGES[-1][1]:
        assert {r.doc_id for r in got} == {i for i, _ in rows}
        return
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert all(r[name] == f"own {name}" for r in got for name in CLASHING)
    ids = {r.doc_id for r in got}
    if stage is pipeline.mask_personal_data:
        texts = {r.doc_id: r.text for r in got}
        assert len(got) == len(rows) and (not rows or texts[9] == "<IP>" and texts[1] is None and texts[2] == "" and "@" not in texts[7])
    elif stage is pipeline.drop_near_duplicates:
        assert not rows or ids == {None, 1, 4, 5, 6, 7, 9, 10}
    else:
        assert not ids & {1, 2, 3}
