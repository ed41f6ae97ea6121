"""The filter language on literal rows, and its errors."""

import datetime as dt
import json

import pytest

from trawl import Analyzer, CollectionSchema, IndexedColumn, IndexedJsonField, MetadataIndex
from trawl.operators.filters import apply_filter, compile_filter

JSON_ROWS = [
    ("oak", {"grower": "mara", "height": 21, "density": 0.72, "evergreen": False, "use": "hull"}),
    ("pine", {"grower": "olaf", "height": 34, "density": 0.46, "evergreen": True, "use": "mast"}),
    ("yew", {"grower": "mara", "height": 12, "density": 0.67, "evergreen": True, "use": "bow"}),
    ("ash", {"grower": "piet", "height": 27, "density": 0.68, "evergreen": False, "use": "oar"}),
    ("balsa", {"grower": "ines", "height": 30, "density": 0.16, "evergreen": True, "cut": None}),
    ("teak", {"grower": "ines", "height": 40, "density": 0.63, "evergreen": False, "use": "hull-deck"}),
]
JSON_SCHEMA = CollectionSchema()
BOATS = [
    ("kayak", "paddle", {"length": 5, "maker": "ida"}),
    ("canoe", "paddle", {"length": 6, "maker": "bo"}),
    ("sloop", "sail", {"length": 9, "maker": "ida"}),
    ("ketch", "sail", {"length": 14, "maker": "lea"}),
    ("dinghy", "sail", {"length": 4, "maker": "bo"}),
]
MIXED_SCHEMA = CollectionSchema(metadata_columns={"kind": "TEXT"})


def names(df, spec, schema):
    return {r["content"] for r in apply_filter(df, spec, schema).select("content").collect()}


@pytest.fixture(scope="module")
def json_rows(spark):
    rows = [(c, json.dumps(m)) for c, m in JSON_ROWS]
    return spark.createDataFrame(rows, "content string, metadata string").cache()


@pytest.fixture(scope="module")
def mixed_rows(spark):
    rows = [(c, t, json.dumps(m)) for c, t, m in BOATS]
    return spark.createDataFrame(rows, "content string, kind string, metadata string").cache()


@pytest.mark.parametrize("spec, expected", [
    ({"evergreen": False}, "oak ash teak"),
    ({"grower": {"$eq": "ines"}}, "balsa teak"),
    ({"use": {"$ne": "mast"}}, "oak yew ash teak"),
    ({"height": {"$gte": 30}}, "pine balsa teak"),
    ({"height": {"$lt": 21}}, "yew"),
    ({"density": {"$between": [0.63, 0.68]}}, "yew ash teak"),
    ({"use": {"$in": ["bow", "oar", "keel"]}}, "yew ash"),
    ({"use": {"$nin": ["bow", "oar"]}}, "oak pine teak"),
    ({"use": {"$like": "hull%"}}, "oak teak"),
    ({"use": {"$like": "%-%"}}, "teak"),
    ({"grower": {"$ilike": "%A%"}}, "oak pine yew"),
    ({"use": {"$exists": False}}, "balsa"),
    ({"use": {"$exists": True}}, "oak pine yew ash teak"),
    ({"cut": {"$exists": True}}, ""),
    ({"$or": [{"height": {"$lte": 12}}, {"density": {"$lt": 0.2}}]}, "yew balsa"),
    ({"$and": [{"evergreen": True}, {"$not": {"grower": "ines"}}]}, "pine yew"),
    ({"$NOT": [{"evergreen": True}, {"use": "oar"}]}, "oak teak"),
    ({"grower": "mara", "evergreen": True}, "yew"),
    ({"density": 0.46}, "pine"),
    ({"grower": {"$lt": 3}}, ""),
    ({}, "oak pine yew ash balsa teak"),
])
def test_json_fields(json_rows, spec, expected):
    assert names(json_rows, spec, JSON_SCHEMA) == set(expected.split())


@pytest.mark.parametrize("spec, expected", [
    ({"kind": "sail", "length": {"$lte": 9}}, "sloop dinghy"),
    ({"$or": [{"kind": "paddle"}, {"maker": "lea"}]}, "kayak canoe ketch"),
    ({"$and": [{"kind": {"$ne": "sail"}}, {"maker": {"$nin": ["ida"]}}]}, "canoe"),
    ({"$not": {"$or": [{"kind": "paddle"}, {"length": {"$gt": 10}}]}}, "sloop dinghy"),
    ({"kind": {"$nin": []}}, "kayak canoe sloop ketch dinghy"),
    ({"kind": {"$in": []}}, ""),
])
def test_mixed_fields(mixed_rows, spec, expected):
    assert names(mixed_rows, spec, MIXED_SCHEMA) == set(expected.split())


def test_dates_and_times(spark):
    rows = [("a", '{"day":"2031-05-09","hour":"06:15:00","at":"2031-05-09 06:15:00"}'),
            ("b", '{"day":"2031-11-20","hour":"21:40:00","at":"2031-11-20 21:40:00"}')]
    df = spark.createDataFrame(rows, "content string, metadata string")
    assert names(df, {"day": {"$gt": dt.date(2031, 10, 1)}}, JSON_SCHEMA) == {"b"}
    assert names(df, {"hour": {"$lte": dt.time(6, 15)}}, JSON_SCHEMA) == {"a"}
    assert names(df, {"at": {"$ne": dt.datetime(2031, 5, 9, 6, 15)}}, JSON_SCHEMA) == {"b"}


def test_null_fails_every_comparison(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "content string, kind string")
    schema = CollectionSchema(metadata_columns={"kind": "TEXT"}, json_column=None)
    for spec in ({"kind": "y"}, {"kind": {"$nin": ["x"]}}, {"$not": {"kind": "x"}},
                 {"kind": {"$ne": "x"}}):
        assert names(df, spec, schema) == set()


@pytest.mark.parametrize("spec", [
    {"$bad": []}, {"$and": {}}, {"$and": []}, {"$or": []}, {"$not": 3}, {"$not": []},
    {"$and": [{}]}, {"a": 1, "$and": []}, {"a": {"$gt": 1, "$lt": 2}}, {"a": {"$what": 1}},
    {"1a": 2}, {"a": None}, {"a": {"$in": []}}, {"a": {"$exists": "yes"}}, {"a": {"$between": [1]}},
    {"a": {"$match": ["x"]}}, {"a": {"$eq": {"x": 1}}}, {5: 1}, {"a": {"$and": [1, {}]} , "$x": 1},
    {"kind": {"$match": []}}, {"kind": {"$match": {"tokens": ["a"], "min_match": True}}},
    {"kind": {"$match": {"tokens": ["a"], "min_match": 0}}},
    {"kind": {"$ngram": ""}}, {"kind": {"$ngram": {"text": "a", "threshold": "x"}}},
    {"kind": {"$phrase": []}}, {"kind": {"$phrase": ["a", 1]}},
    {"kind": {"$phrase": ["a", -1, "b"]}}, {"kind": {"$phrase": ["a", [2, 1], "b"]}},
    {"kind": {"$phrase": ["", 1, "b"]}}, {"kind": {"$phrase": ["a", "x", "b"]}},
    {"kind": {"$phrase": {"text": "a b", "slop": -1}}},
    {"kind": {"$phrase": {"text": ["a", [0, 1], "b"], "slop": 1}}},
])
def test_value_errors(spark, spec):
    with pytest.raises(ValueError):
        compile_filter(spec, MIXED_SCHEMA)


def test_other_errors(spark):
    with pytest.raises(ValueError):
        compile_filter([("a", 1)], MIXED_SCHEMA)
    for spec in ({"kind": {"$in": [True]}}, {"kind": {"$in": [dt.date(2024, 1, 1)]}},
                 {"kind": {"$and": [1]}}):
        with pytest.raises(NotImplementedError):
            compile_filter(spec, MIXED_SCHEMA)


# -- terms -------------------------------------------------------------------------------

PAINTS = [("p", "maroon"), ("q", "marine"), ("r", "teal"), ("s", "olive"), ("t", "ultramarine")]


@pytest.mark.parametrize("spec, expected", [
    ({"$startswith": "mar"}, "p q"),
    ({"$regex": ".*marine"}, "q t"),
    ({"$regex": "marin"}, ""),
    ({"$fuzzy": "oliv"}, "s"),
    ({"$match": ["teal", "olive", "navy"]}, "r s"),
    ({"$match": {"tokens": ["navy", "olive"], "min_match": 1}}, "s"),
    ({"$match": {"tokens": ["teal", "olive"], "min_match": 2}}, ""),
    ({"$phrase": "teal"}, "r"),
])
def test_verbatim_terms(spark, spec, expected):
    df = spark.createDataFrame(PAINTS, "content string, kind string")
    assert names(df, {"kind": spec}, MIXED_SCHEMA) == set(expected.split())
    combined = {"$or": [{"kind": spec}, {"kind": {"$regex": "ultra.*"}}]}
    assert names(df, combined, MIXED_SCHEMA) == set(expected.split()) | {"t"}


def test_terms_need_an_index(spark):
    schema = MIXED_SCHEMA.with_index(MetadataIndex(columns=[]))
    with pytest.raises(ValueError, match="metadata index"):
        compile_filter({"kind": {"$startswith": "x"}}, schema)
    with pytest.raises(ValueError, match="metadata index"):
        compile_filter({"tag": {"$startswith": "x"}}, MIXED_SCHEMA)


def test_terms_of_a_json_field(spark):
    schema = CollectionSchema().with_index(MetadataIndex(
        json_fields=[IndexedJsonField("tag", "TEXT"), IndexedJsonField("n", "INTEGER")]))
    rows = [(t, json.dumps({"tag": t, "n": i})) for i, t in enumerate(("marine", "maroon", "teal"))]
    df = schema.promote(spark.createDataFrame(rows, "content string, metadata string"))
    assert names(df, {"tag": {"$startswith": "mar"}}, schema) == {"marine", "maroon"}
    assert names(df, {"n": {"$gte": 1}}, schema) == {"maroon", "teal"}
    with pytest.raises(ValueError):
        compile_filter({"n": {"$match": ["1"]}}, schema)


def test_index_declarations():
    decimals = CollectionSchema(metadata_columns={"weight": "DECIMAL(9,3)", "kind": "TEXT"})
    assert list(decimals.indexed_columns()) == ["kind"]
    with pytest.raises(ValueError):
        decimals.with_index(MetadataIndex(columns=[IndexedColumn("weight")]))
    with pytest.raises(ValueError):
        CollectionSchema(json_column=None).with_index(
            MetadataIndex(json_fields=[IndexedJsonField("a", "TEXT")]))


TITLES = ["north wind over the cold sea", "north sea", "cold north wind sea", "the sea over north"]
TITLE_SCHEMA = CollectionSchema(id_column="content", metadata_columns={"title": "TEXT"},
                                json_column=None).with_index(
    MetadataIndex(columns=[IndexedColumn("title", Analyzer("split"))]))


@pytest.mark.parametrize("spec, expected", [
    ("north sea", {1}),
    ("OVER, the", {0}),
    ({"text": "north sea", "slop": 0}, {1}),
    ({"text": "north sea", "slop": 4}, {0, 1, 2}),
    ({"text": "sea north", "slop": 1}, {3}),
    (["north", 1, "sea"], {2}),
    (["north", [0, 4], "sea"], {0, 1, 2}),
    (["wind", [2, 2], "cold"], {0}),
    (["wind", [0, 1], "cold"], set()),
    (["cold north", [0, 1], "sea"], {2}),
    ({"text": ["north", 1, "sea"], "slop": 1}, {1, 2}),
])
def test_phrases(spark, spec, expected):
    rows = [(str(i), t) for i, t in enumerate(TITLES)] + [("null", None)]
    df = spark.createDataFrame(rows, "content string, title string")
    assert names(df, {"title": {"$phrase": spec}}, TITLE_SCHEMA) == {str(i) for i in expected}


def test_ngrams(spark):
    schema = CollectionSchema(id_column="content", metadata_columns={"title": "TEXT"},
                              json_column=None).with_index(
        MetadataIndex(columns=[IndexedColumn("title", Analyzer("ngram"))]))
    df = spark.createDataFrame([(t, t) for t in ("stone", "store", "gravel", "s")],
                               "content string, title string")
    spec = lambda t: {"title": {"$ngram": {"text": "stone", "threshold": t}}}
    assert names(df, spec(0.3), schema) == {"stone", "store"}
    assert names(df, spec(0.51), schema) == {"stone"}
    assert names(df, {"title": {"$ngram": "stone"}}, schema) == {"stone"}


def test_typed_predicates_reach_the_scan(spark, tmp_path):
    schema = MIXED_SCHEMA.with_index(MetadataIndex(json_fields=[IndexedJsonField("n", "INTEGER")]))
    rows = [(str(i), "x", json.dumps({"n": i})) for i in range(10)]
    df = spark.createDataFrame(rows, "content string, kind string, metadata string")
    schema.promote(df).write.parquet(str(tmp_path / "t"))
    found = apply_filter(spark.read.parquet(str(tmp_path / "t")),
                         {"kind": "x", "n": {"$lt": 3}}, schema)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(kind,x)" in pushed and "LessThan(json__n,3)" in pushed
    assert found.count() == 3
