from conftest import SF
from trawl.llm.langid import LanguageModel, identify
from trawl.llm.queries import QUERIES

EN = "the quick brown fox jumps over the lazy dog and runs through the woods with three others"
DE = "der schnelle braune fuchs springt über den faulen hund und läuft durch die wälder mit drei anderen"


def test_held_out_accuracy(spark):
    found = QUERIES["op3_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_texts_of_every_kind(spark, docs_of):
    train = docs_of([(1, EN, "en"), (2, DE, "de"), (3, None, "fr"), (4, "bonjour", None), (5, "", "it")])
    model = LanguageModel.fit(train)
    assert model.languages == ["de", "en", "it"]
    rows = [(10, EN), (10, EN), (11, None), (12, ""), (13, "12 34 !?"), (14, DE.upper()), (None, EN),
            (15, (EN + " ") * 30_000), (16, "x" * 3_000_000 + " " + DE), (17, "\ud83d\ude00")]
    found = identify(docs_of([r for r in rows if r[0] != 17], lang_pred="old"), model)
    assert "lang_pred" in found.columns and found.columns.count("lang_pred") == 1
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert got[10][0] == got[10][1] and got[10][0][0] == "en"
    assert got[11] == got[12] == got[13] == [("und", 0.0)]
    assert got[14][0][0] == "de" and got[None][0][0] == "en"
    assert got[15][0] == ("en", 1.0)
    assert got[16][0][0] in model.languages


def test_long_texts_are_read_whole(spark, docs_of, monkeypatch):
    model = LanguageModel.fit(docs_of([(1, EN, "en"), (2, DE, "de")]))
    texts = [EN + " " + DE * 2, DE * 5 + EN, None, "", EN]
    whole = model.score(texts)
    monkeypatch.setattr("trawl.llm.langid.CHUNK", 40)
    cut = model.score(texts)
    assert cut[0] == whole[0]


def test_nothing_learned_and_empty_tables(spark, docs_of):
    model = LanguageModel.fit(docs_of([(1, None, "en"), (2, "text", None)]))
    assert [r["lang_pred"] for r in identify(docs_of([(1, EN)]), model).collect()] == ["und"]
    assert identify(docs_of([]), LanguageModel.fit(docs_of([]))).count() == 0


def test_ties_go_to_the_first_language(spark, docs_of):
    model = LanguageModel.fit(docs_of([(1, "abc", "zz"), (2, "abc", "aa")]))
    assert model.score(["abc"]) == (["aa"], [0.5])


def test_more_languages_than_a_worker_holds(spark, docs_of, monkeypatch):
    """Dirty language columns: block by block, as with all languages at once."""
    rows = [(i, f"{EN if i % 2 else DE} {chr(97 + i % 26) * 4}", f"l{i:03}") for i in range(300)] + [
        (400 + i, EN, "en") for i in range(5)]
    docs, asked = docs_of(rows), docs_of([(1, EN), (2, DE + " zzzz zzzz"), (3, None), (4, "1 2")], score_total="old")
    many = LanguageModel.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(asked, many).collect()}
    monkeypatch.setattr("trawl.llm.langid.BLOCK_LANGUAGES", 400)
    whole = LanguageModel.fit(docs)
    assert len(whole.languages) == 301 and isinstance(whole, LanguageModel) and not isinstance(many, LanguageModel)
    wanted = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(asked, whole).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in wanted.items()} and got[1][0] == "en"
    assert all(abs(got[i][1] - s) < 1e-9 for i, (_, s) in wanted.items()) and got[3] == got[4] == ("und", 0.0)
    assert identify(asked, many).columns == [*asked.columns, "lang_pred", "score"]
