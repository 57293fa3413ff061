"""Near copies: a band key of two texts is judged once."""

from brackwater.llm import simhash


def test_two_texts_of_a_key_are_not_compared_again(spark, monkeypatch):
    def none_expected(least):
        def run(batches):
            for pdf in batches:
                assert not len(pdf), "compared again"
                yield pdf[["unit", "root"]].set_axis(["u", "v"], axis=1)

        return run

    words = [f"word{i}" for i in range(200)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:140] + [f"other{i}" for i in range(60)]))]
    monkeypatch.setattr(simhash, "_similar", none_expected)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2}
    shared = [set(simhash.band_keys(simhash.np.unique(simhash.shingle_hashes(simhash.words_of(t), 5))).tolist()) for _, t in docs]
    assert shared[0] & shared[1]
