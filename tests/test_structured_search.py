"""Structured web queries and Boolean expressions through a collection."""

import pytest

from trawl import CollectionSchema, Column, HashModel, HybridConfig, TextIndexOptions
from trawl.sources.collection import Collection

TEXTS = ["red fox runs", "red dog sleeps", "blue fox sleeps", "the quick red fox", "fox red"]
ASKED = "qid int, text string, must array<string>, should array<string>, must_not array<string>, phrases array<array<string>>"


@pytest.fixture(scope="module")
def foxes(spark):
    schema = CollectionSchema.declare(4, metadata_columns=[Column("n", "INT")], id_column=Column("id", "INT"))
    config = HybridConfig(tsquery_function="websearch_to_tsquery", primary_top_k=1, secondary_top_k=5,
                          rrf_k=1)
    made = Collection.create(spark, "foxes", schema, overwrite=True, embedder=HashModel(4), hybrid=config,
                             text_index=TextIndexOptions())
    made.add_texts(texts=TEXTS, ids=list(range(len(TEXTS))), metadatas=[{"n": i} for i in range(len(TEXTS))])
    yield made
    made.drop()


def _ids(found, qid=0):
    return {int(r["id"]) for r in found.collect() if "qid" not in found.columns or r["qid"] == qid}


def test_web_columns_reach_the_text_branch(spark, foxes):
    asked = spark.createDataFrame([
        (0, TEXTS[0], ["fox"], ["red"], ["blue"], None),
        (1, TEXTS[1], None, None, None, [["red", "fox"]]),
        (2, TEXTS[2], None, None, ["red"], None),
    ], ASKED)
    found = foxes.search(asked, k=5).cache()
    # The nearest vector is that of the text itself; all else comes from the words.
    assert _ids(found, 0) == {0, 3, 4}
    assert _ids(found, 1) == {0, 1, 3}
    # Only banned terms: by distance alone, over the whole collection.
    assert _ids(found, 2) == set(range(5))
    assert found.where("qid = 2 AND rank = 1").first()["id"] == "2"


def test_filter_holds_in_both_branches(spark, foxes):
    asked = spark.createDataFrame([(0, TEXTS[0], ["fox"], None, None, None)], ASKED)
    assert _ids(foxes.search(asked, k=5, filter={"n": {"$gte": 2}})) <= {2, 3, 4}


def test_columns_that_lack_are_named(spark, foxes):
    with pytest.raises(ValueError, match="must_not"):
        foxes.search(spark.createDataFrame([(0, "x", ["fox"])], "qid int, text string, must array<string>"), k=2)


def test_boolean_expressions_find_documents(foxes):
    assert _ids(foxes.match({"and": ["fox", {"not": "red"}]})) == {2}
    assert _ids(foxes.match({"not": "red"})) == {2}
    assert _ids(foxes.match({"or": [{"phrase": ["fox", "red"]}, "dog"]})) == {1, 4}
    assert _ids(foxes.match({"or": ["fox", "dog"]}, filter={"n": {"$lt": 2}})) == {0, 1}


def test_deleted_rows_do_not_match(foxes):
    foxes.add_texts(texts=["lonely wolf"], ids=[9], metadatas=[{"n": 9}])
    assert _ids(foxes.match("wolf")) == {9}
    foxes.sync_load = False
    foxes.delete(ids=[9])
    assert _ids(foxes.match("wolf")) == set()
