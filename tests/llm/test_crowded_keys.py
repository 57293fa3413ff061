"""Band keys of many near copies: what is sent to be compared grows with the units, and no link is lost."""

import random
from collections import Counter

from brackwater.llm import simhash


def shingles(text):
    return set(simhash.shingle_hashes(simhash.words_of(text), simhash.SHINGLE).tolist())


def test_a_crowd_is_dealt_and_its_outliers_meet_all(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    base = [f"word{i}" for i in range(120)]

    def copy(edits, tag):
        words = list(base)
        for at in rng.sample(range(len(words)), edits):
            words[at] = f"{tag}x{at}"
        return " ".join(words)

    texts = [copy(rng.choice((0, 1, 1, 2)), f"near{i}") for i in range(150)] + [copy(rng.choice((3, 4, 6, 9)), f"far{i}") for i in range(60)]
    texts += [" ".join([*base[60:], *(f"tail{i % 3}y{k}" for k in range(60 + i))]) for i in range(9)]
    rng.shuffle(texts)
    rows, whole = tmp_path / "rows", simhash._similar
    rows.mkdir()

    def counted(least):
        def run(batches):
            def seen():
                import uuid

                for pdf in batches:
                    (rows / uuid.uuid4().hex).write_text(str(len(pdf)))
                    yield pdf

            yield from whole(least)(seen())

        return run

    monkeypatch.setattr(simhash, "SETS", 8)
    monkeypatch.setattr(simhash, "_similar", counted)
    got = dict(simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())

    sets, prints = [shingles(t) for t in texts], [simhash.text_fingerprint(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if group[i] != group[j] and (both >= simhash.LEAST * (len(sets[i]) + len(sets[j]) - both) or (prints[i] ^ prints[j]).bit_count() <= simhash.MAX_BITS):
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    assert got == dict(enumerate(group)) and max(Counter(group).values()) > 100 and len(set(group)) > 30
    keys = Counter(k for s in sets for k in simhash.band_keys(simhash.np.array(sorted(s), simhash.np.uint64)).tolist())
    assert max(keys.values()) > 100
    assert sum(int(f.read_text()) for f in rows.iterdir()) <= 2 * sum(n for n in keys.values() if n > 1)
