import time

import numpy as np
import pytest

from conftest import SF
from trawl.llm.common import labelled_sample
from trawl.llm.queries import QUERIES
from trawl.llm.toxicity import EVENTS, PRIOR, Lexicon, ToxicityModel, Transducer, grammar, score_toxicity

LEXICON = Lexicon({"idiot$", "moron$", "grob+"})


def events(text):
    return [dict((e, n) for e, n in zip(EVENTS, counts) if n) for _, counts in LEXICON.clauses(text)]


@pytest.mark.parametrize("text, wanted", [
    ("what an idiot", [{"insult": 1}]),
    ("you idiot", [{"aimed_insult": 1}]),
    ("an idiot, that is what you are", [{"insult": 1, "aimed_insult": 1}]),
    ("an idiot. you are kind", [{"insult": 1}]),
    ("he said you are an idiot", [{"quoted": 1}]),
    ("you are not an idiot", [{"negated": 1}]),
    ("not that it matters but you are an idiot", [{"aimed_insult": 1}]),
    ("i will kill you", [{"threat": 1}]),
    ("kill the process", []),
    ("you kill time", [{"threat": 1}]),
    ("idiotic behaviour; grobian; grob", [{"insult": 1}]),
    ("IDIOT! Moron?", [{"insult": 1}, {"insult": 1}]),
    ("scatteridiot idiots", []),
    ("", []), (None, []),
])
def test_clauses(text, wanted):
    assert events(text) == wanted


def test_composition_equals_running_one_after_another():
    first = Transducer({(0, "a"): (1, "b"), (1, "a"): (0, "bb")})
    second = Transducer({(0, "b"): (1, "x"), (1, "b"): (0, "")})
    both = first.compose(second, "ab")
    for text in ("", "a", "aab", "abba", "aaaabbab"):
        assert both.run(text) == second.run(first.run(text))
    assert len(grammar().arcs) > 100


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op10_clause_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit >= 0.9 * sum(r["toxic"] for r in rows) and hit >= 0.9 * sum(r["predicted"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_rows_of_every_kind(spark, docs_of, words):
    clean = [(i, " ".join(words(40, i)) + ".") for i in range(80)]
    toxic = [(100 + i, " ".join(words(20, i) + ["glorpface" + "xyz"[i % 3]] + words(20, 500 + i))) for i in range(30)]
    copies = [(200 + i, toxic[0][1] + " tail") for i in range(30)]
    odd = [(500, None), (501, ""), (None, "glorpfacex"), (100, toxic[0][1]), (502, "fine words. " * 50_000 + "you idiot")]
    docs = docs_of(clean + toxic + copies + odd, score="old", label="old", clauses="old")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 1, 1) for i, _ in toxic + copies],
                                   "doc_id long, quality int, toxic int")
    model = ToxicityModel.fit(docs, labelled_sample(labels, "toxic", 4, 2, 1000))
    assert any(k.startswith("glorpface") for k in model.lexicon.insults)
    # The words of a text that was copied thirty times are no insults.
    assert not any(w + "$" in model.lexicon.insults for w in words(20, 0))
    scored = score_toxicity(docs, model)
    rows = scored.collect()
    assert len(rows) == docs.count() and scored.columns.count("score") == 1
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["predicted"] == 1 for i, _ in toxic + copies)
    assert all(by_id[i]["predicted"] == 0 for i, _ in clean)
    assert by_id[500]["score"] == by_id[501]["score"] and by_id[500]["strongest"] is None
    assert by_id[502]["strongest"] == "you idiot" and by_id[None]["predicted"] == 1


def test_without_labels_or_rows(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = ToxicityModel.fit(docs_of([(1, "a")]), labelled_sample(labels, "toxic", 4, 2, 10))
    assert np.allclose(model.weights, PRIOR)
    assert score_toxicity(docs_of([(1, "you idiot"), (2, "hello")]), model).collect()[0]["predicted"] == 1
    assert score_toxicity(docs_of([]), model).count() == 0


def test_long_text_with_a_trigger_in_every_sentence():
    text = "you idiot, it is so and so. " * 180_000  # 5 MB
    start = time.time()
    assert sum(1 for _ in LEXICON.clauses(text)) == 180_000 and time.time() - start < 30
    assert sum(1 for _ in LEXICON.clauses("idiot " * 100_000)) == 1
