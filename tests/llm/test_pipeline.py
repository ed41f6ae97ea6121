import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF
from test_decontaminate import squeeze
from test_ngram_join import brute
from test_packing import check

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "language_id", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert sorted(n.split("_")[0] for n in entry.queries() if n.startswith("op")) == sorted(f"op{n}" for n in range(1, 14))


def test_each_stage_on_its_own_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda *_: str(tmp_path))
    result = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [squeeze(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [docs] + [spark.read.parquet(f"{tmp_path}/{n}-{name}") for n, (name, _) in enumerate(corpus_pipeline.STAGES)]
    assert all(k.columns == COLUMNS for k in kept[:-1])
    rows = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept[:-1]]
    quality = {i for i, _ in rows[1]}
    assert sum(quality_ok == (i in quality) for i, quality_ok in labels.items()) >= 0.95 * len(labels)
    assert len(rows[2]) >= 0.99 * len(rows[1])  # every text here is in a language
    assert sorted(i for i, _ in rows[3]) == sorted(i for i, _, c in brute(rows[2]) if i == c)
    leaking = {i for i, t in rows[3] if any(x in squeeze(t) for x in items)}
    left = {i for i, _ in rows[4]}
    assert leaking and not leaking & left and len(left) >= 0.95 * (len(rows[3]) - len(leaking))
    check(rows[4], result.collect(), 2048)


def test_stages_keep_odd_columns_and_rows(spark, docs_of, words):
    rows = [(i, " ".join(words(60, i)) + ".") for i in range(30)] + [(30, None), (31, ""), (None, "a b"), (3, "x y")]
    docs = docs_of(rows, score="s", lang_pred="l", predicted="p", component_id="c")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {r["score"] for r in out.collect()} <= {"s"}
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
