import numpy as np

from conftest import SF
from trawl.llm.common import labelled_sample
from trawl.llm.quality import FEATURES, AdditiveModel, fit_quality, score_quality, text_features
from trawl.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op6_additive_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_learns_an_interaction_that_single_features_miss():
    rnd = np.random.default_rng(0)
    x = rnd.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = AdditiveModel.fit(x, y)
    assert (0, 1) in [(a, b) for a, b, _ in model.pairs]
    fresh = rnd.random((1000, 3))
    right = (model.score(fresh) >= 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))
    assert right.mean() > 0.95


def test_features_of_every_text():
    assert text_features(None) == text_features("") == text_features(" \n") == [0.0] * len(FEATURES)
    one = dict(zip(FEATURES, text_features("the the the | CAT 12.\nthe the the | CAT 12.")))
    assert one["repeated_lines"] == 0.5 and one["lone_symbols"] == 1 / 6 and one["top_word"] == 0.5
    long = "word " * 1_000_000
    assert len(text_features(long)) == len(FEATURES) and np.isfinite(text_features(long)).all()


def test_rows_of_every_kind(spark, docs_of, words):
    good = [(i, " ".join(words(40, i)).capitalize() + ".") for i in range(60)]
    bad = [(100 + i, " | ".join(words(40, i)) + " |") for i in range(60)]
    odd = [(500, None), (501, ""), (None, "text"), (1, good[1][1])]
    docs = docs_of(good + bad + odd, score="old", label="old", features="old", predicted="old")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (2, 1, 0), (3, 0, 1), (4, None, 0),
                                                                       (999, 1, 0), (5, 7, 0)],
        "doc_id long, quality int, toxic int")
    sample = labelled_sample(labels, "quality", 3, 1, 1000)
    drawn = {r["doc_id"] for r in sample.collect()}
    assert None not in drawn and 3 not in drawn  # no id, and two labels
    scored = score_quality(docs, fit_quality(docs, sample))
    rows = scored.collect()
    assert len(rows) == len(good + bad + odd) and scored.columns.count("score") == 1
    by_id = {r["doc_id"]: r["predicted"] for r in rows}
    assert sum(by_id[i] for i, _ in good) >= 58 and sum(by_id[i] for i, _ in bad) <= 2
    assert len({r["score"] for r in rows if r["doc_id"] in (500, 501)}) == 1
    assert fit_quality(docs, sample).score(np.zeros((1, len(FEATURES)))) == fit_quality(
        docs.repartition(7), sample).score(np.zeros((1, len(FEATURES))))


def test_without_labels_or_rows(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "a b")])
    model = fit_quality(docs, labelled_sample(labels, "quality", 3, 1, 10))
    assert [r["score"] for r in score_quality(docs, model).collect()] == [0.5]
    assert score_quality(docs_of([]), model).count() == 0
