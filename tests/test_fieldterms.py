"""Term predicates by an index of terms against the same predicates row by row."""

import random
import re

import pytest
from pyspark.sql import functions as F

from test_collection import make
from trawl import Analyzer, IndexedJsonField, MetadataIndex
from trawl.operators import filters
from trawl.operators.fieldterms import FieldTerms, pairs_of, required_texts
from trawl.operators.filters import apply_filter
from trawl.plans.filters import GRAMS, PARTS, WORDS
from trawl.schema import CollectionSchema, IndexedColumn
from trawl.sources.storage import Folder

SPLIT = Analyzer("split")
SCHEMA = CollectionSchema(id_column="id", json_column=None, metadata_columns={"t": "TEXT", "n": "BIGINT"}).with_index(
    MetadataIndex(columns=[IndexedColumn("t", SPLIT)]))

PREDICATES = [
    {"$startswith": "str"}, {"$startswith": ""}, {"$startswith": "nothing"}, {"$regex": "st.*n"}, {"$regex": "(ab|st)o+ne?"},
    {"$regex": "a"}, {"$regex": "[a-c]+"}, {"$regex": "(?i)STONE"}, {"$fuzzy": "stone"}, {"$fuzzy": "ab"}, {"$fuzzy": "shores"},
    {"$fuzzy": "aba"}, {"$fuzzy": "sotne"}, {"$match": ["stone", "shore"]}, {"$match": {"tokens": ["stone", "shore", "ab"], "min_match": 2}},
    {"$match": {"tokens": ["stone", "stone"], "min_match": 2}}, {"$ngram": {"text": "stone shore ab", "threshold": 0.5}},
    {"$ngram": {"text": "stone", "threshold": 0}}, {"$ngram": {"text": "stone shore", "threshold": 1.2}},
    {"$phrase": "stone shore"}, {"$phrase": ["stone", 1, "ab"]}, {"$phrase": ["stone", [0, 2], "ab"]},
    {"$phrase": {"text": "stone ab shore", "slop": 2}}, {"$phrase": "ab ab"}, {"$phrase": "!"},
]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    words = ["stone", "stones", "store", "strone", "shore", "ab", "aba", "a", "c", "tone", "Stone", "shorés"]
    texts = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 8))), i % 7) for i in range(150)]
    return spark.createDataFrame([*texts, (500, None, 1), (501, "", 2), (502, "!?", 3)], "id long, t string, n long").cache()


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    built = FieldTerms.build(rows, "id", F.col("t"), SPLIT, buckets=3)
    return built.write(Folder(spark, str(tmp_path_factory.mktemp("terms"))))


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("predicate", PREDICATES, ids=str)
def test_index_changes_no_result(rows, index, predicate):
    plain, found = (ids(apply_filter(rows, {"t": predicate}, SCHEMA, t)) for t in (None, {"t": index}))
    assert found == plain


@pytest.mark.parametrize("spec", [
    {"$not": {"t": {"$match": ["stone"]}}}, {"$not": [{"t": {"$fuzzy": "stone"}}, {"t": {"$startswith": "sh"}}]},
    {"$or": [{"t": {"$phrase": "stone shore"}}, {"n": {"$gt": 4}}]}, {"t": {"$regex": "sto.*"}, "n": {"$in": [1, 2]}},
    {"$and": [{"$not": {"t": {"$match": ["ab"]}}}, {"$or": [{"t": {"$startswith": "st"}}, {"t": {"$exists": False}}]}]},
], ids=str)
def test_logic_and_unknown_values(rows, index, spec):
    assert ids(apply_filter(rows, spec, SCHEMA, {"t": index})) == ids(apply_filter(rows, spec, SCHEMA)) != []


def test_no_row_is_analyzed(rows, index):
    for predicate in PREDICATES[:3] + PREDICATES[8:15]:
        plan = apply_filter(rows, {"t": predicate}, SCHEMA, {"t": index})._jdf.queryExecution().toString()
        assert "regexp_extract_all" not in plan, predicate
    assert "regexp_extract_all" in apply_filter(rows, {"t": PREDICATES[0]}, SCHEMA)._jdf.queryExecution().toString()
    plan = apply_filter(rows, {"t": {"$startswith": "str"}}, SCHEMA, {"t": index})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,strone)" in plan  # the terms found reach the scan of the postings


def test_near_terms_equal_all_terms(spark):
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8))) for _ in range(600)})
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, t string")
    built = FieldTerms.build(docs, "id", F.col("t"), SPLIT)
    terms = built.lexical.terms.select("term").cache()
    built.pairs = FieldTerms.pairs_of_terms(terms).cache()
    for word in ["abc", "abca", "aabbcc", "ccccccc", "ab", "bbbbb", "abcabcab"]:
        budget = 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2
        wanted = {r["term"] for r in terms.where(F.levenshtein("term", F.lit(word)) <= budget).collect()}
        assert {r["term"] for r in built.near(word).collect()} == wanted, word


def test_texts_a_pattern_requires():
    assert required_texts("stone") == ["stone"] and required_texts("st.ne") == ["st", "ne"]
    assert required_texts("a(bc)d") == ["abcd"] and required_texts("ab?cd") == ["a", "cd"]
    assert required_texts("(?i)ab") == [] == required_texts("ab|cd") == required_texts("[ab]*") == required_texts("(")
    assert required_texts("ab{2,3}c") == ["a", "b", "c"] and required_texts(r"a\.b") == ["a.b"]
    assert required_texts("(?:ab)+x") == [] and required_texts(r"\Qab\E") == [] and required_texts("a++b") == []
    rnd = random.Random(6)
    for _ in range(3000):
        pattern = "".join(rnd.choice(["a", "b", "c", ".", "a?", "(ab)", "b*", "[ab]", "(a|c)", "c{1,2}", "a+"]) for _ in range(rnd.randint(1, 6)))
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7)))
        if re.fullmatch(pattern, word):
            assert all(t in word for t in required_texts(pattern)), (pattern, word)
            assert {p for t in required_texts(pattern) for p in pairs_of(t)} <= set(pairs_of(word))


def test_long_lists_are_joined(spark, rows, monkeypatch):
    monkeypatch.setattr(filters, "MAX_LISTED", 2)
    extended = rows.unionByName(spark.createDataFrame([(900, "x", None)], "id long, t string, n long"))
    for members in ([1, 2, 3], [1.0, 2, 5.5, 1], ["stone", "ab", "zz"]):
        field = "t" if isinstance(members[0], str) else "n"
        for operator in ("$in", "$nin"):
            for spec in ({field: {operator: members}}, {"$not": {field: {operator: members}}}):
                found = apply_filter(extended, spec, SCHEMA)
                assert ids(found) == ids(extended.where(filters.compile_filter(spec, SCHEMA)))
                assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_collections_look_terms_up(spark, name):
    index = MetadataIndex(columns=[IndexedColumn("kind", SPLIT)],
                          json_fields=[IndexedJsonField("note", "TEXT", Analyzer("ngram"))])
    c = make(spark, name, schema={"metadata_index": index}, sync_load=False)
    metas = [{"kind": f"grey stone {i % 5}", "note": f"note {i % 3}", "n": i} for i in range(30)]
    c.add_texts(texts=[f"text {i}" for i in range(30)], ids=[str(i) for i in range(30)], metadatas=metas)
    c.refresh()
    assert any("_field_" in t.name for t in spark.catalog.listTables() if t.name.startswith(name))
    c.add_texts(texts=["renewed"] * 2, ids=["3", "new"], metadatas=[{"kind": "wet sand"}, {"kind": "grey sand", "note": "note 9"}])
    c.delete(ids=["4"])
    for spec in ({"kind": {"$match": ["grey"]}}, {"kind": {"$phrase": "grey stone"}}, {"kind": {"$fuzzy": "stome"}},
                 {"note": {"$ngram": {"text": "note 9", "threshold": 0.9}}}, {"$not": {"kind": {"$startswith": "st"}}},
                 {"kind": {"$match": ["2"]}, "n": {"$gte": 10}}):
        wanted = sorted(r["id"] for r in c.rows().where(filters.compile_filter(spec, c.schema)).collect())
        assert sorted(r["id"] for r in c.find(spec).collect()) == wanted != []
        assert sorted(r["id"] for r in c.search("text", k=50, filter=spec).collect()) == wanted
    assert c.delete(filter={"kind": {"$match": ["0"]}}) and c.find({"kind": {"$match": ["0"]}}).count() == 0
    c.compact()
    assert c.find({"kind": {"$match": ["grey"]}}).count() == c.rows().where("kind LIKE 'grey%'").count()


def test_schemas_of_the_queries_agree():
    assert WORDS.analyzed_fields() == {"p_name": SPLIT} and GRAMS.analyzed_fields() == {"p_name": Analyzer("ngram")}
    assert PARTS.analyzed_fields() == {}
