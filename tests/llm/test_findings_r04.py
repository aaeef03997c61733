"""Faults that a review found in the training-data operators, made small."""

import numpy as np

import corpus_pipeline
import tidemark.llm.decontaminate as module
from tidemark.llm.decontaminate import decontaminate, features, windows_of
from tidemark.llm.words import split_words

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def test_spaces_are_fitted_on_all_documents(spark, monkeypatch):
    """Not on a sample: a step's product is that of all passages, which a plain loop adds up."""
    rng = np.random.default_rng(3)
    texts = [" ".join([f"w{int(x)}" for x in rng.zipf(1.5, 40)] + ITEM.split()[: i % 7]) for i in range(1500)]
    seen = []

    def spy(codes, spaces, idf, fit=module.fit_spaces):
        seen.append((codes.count(), fit(codes, spaces, idf, steps=1), spaces, idf))
        return fit(codes, spaces, idf)

    monkeypatch.setattr(module, "fit_spaces", spy)
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(5)
    decontaminate(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    rows, (got,), (space,), idf = seen[0]
    assert rows == 1500
    table = idf[space.known][:, None] * np.linalg.qr(np.random.default_rng(11).standard_normal((12, 12)))[0]
    total = np.zeros((12, 12))
    for text, weight in [(x, 1.0) for x in texts] + [(ITEM, space.weight)]:
        words, at = split_words([text.encode()], bare=True)
        _, start, end = windows_of(at, 24, 24)
        for a, b, upto in zip(start, end, [*start[1:], len(words)], strict=True):
            c = [x for x in space.index[features(words[a:b])] if x < 12]
            y = table[c].sum(0) if c else np.zeros(12)
            if (size := np.sqrt(y @ y)) > 1e-6:
                own = [x for x in space.index[features(words[a : min(b, upto)])] if x < 12]
                np.add.at(total, own, y / size * weight)
    want = idf[space.known][:, None] * np.linalg.qr(idf[space.known][:, None] * total)[0]
    assert np.allclose(got[:-1, :6], want[:, :6], atol=1e-3 * np.abs(want).max())  # the last columns hang on rounding


def test_items_with_a_null_id_are_searched(spark):
    bench = spark.createDataFrame([(None, ITEM), (None, "What is the capital?"), (5, "one of the other items that have an id of their own here")], "item_id long, text string")
    filler = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{filler} {ITEM} {filler}"), (2, f"{filler} what is the capital {filler}"), (3, filler), (4, "one of the other items that have an id of their own here")]
    got = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, None), 4: (True, 5)}


def test_ties_go_to_an_id_before_none(spark):
    bench = spark.createDataFrame([(None, ITEM), (7, ITEM), (None, "what is the capital"), (8, "what is the capital")], "item_id long, text string")
    got = decontaminate(spark.createDataFrame([(1, ITEM), (2, "what is the capital")], "doc_id long, text string"), bench).collect()
    assert {r["doc_id"]: r["item_id"] for r in got} == {1: 7, 2: 8}


def test_the_pipeline_drops_rows_with_items_without_an_id(spark, tmp_path):
    spark.createDataFrame([(None, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, f"before {ITEM} after"), (2, "none of it"), (None, ITEM)], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()] == [2]
