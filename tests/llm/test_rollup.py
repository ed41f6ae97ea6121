import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF
from test_packing import ids_of
from trawl.llm.queries import QUERIES, tokenizer_file
from trawl.llm.rollup import TokenRollup, count_tokens
from trawl.session import scratch_path

CHANGE = "op string, doc_id long, version string, source string, lang string, tokens long, bytes long"


@pytest.fixture
def rollup(spark):
    return TokenRollup(spark, scratch_path(spark, f"rollup-{uuid.uuid4().hex}"))


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    first = {}
    for r in rows:
        first[r["text"]] = min(first.get(r["text"], r["doc_id"]), r["doc_id"])
    wanted = {}
    for r in rows:
        if r["text"] is None or first[r["text"]] == r["doc_id"]:
            t = wanted.setdefault((r["source"], r["lang"], "byte_bpe_50k"), [0, 0, 0])
            t[0] += 1
            t[1] += len(ids_of(r["text"])) - 1
            t[2] += len((r["text"] or "").encode())
    found = {tuple(r)[:3]: list(tuple(r)[3:]) for r in QUERIES["op9_token_rollup"](spark, SF).collect()}
    assert found == wanted


def test_inserts_revisions_and_deletions(spark, rollup):
    def batch(*rows):
        return spark.createDataFrame([r + ("x",) for r in rows], CHANGE + ", batch string")

    assert rollup.apply("1", batch(("insert", 1, "v1", "a", "en", 10, 100), ("insert", 2, "v1", "a", "en", 5, 50),
                                   ("insert", 3, "v1", None, None, None, 7), ("insert", 1, "v2", "a", "en", 12, 100)))
    assert totals(rollup) == sorted([("a", "en", "v1", 2, 15, 150), ("a", "en", "v2", 1, 12, 100),
                                     (None, None, "v1", 1, 0, 7)], key=repr)
    # Moved to another source, deleted, an unknown one deleted, an unknown one revised.
    assert rollup.apply("2", batch(("revise", 1, "v1", "b", "en", 11, 100), ("delete", 2, "v1", None, None, None, None),
                                   ("delete", 9, "v1", None, None, None, None), ("revise", 4, "v1", "b", "en", 1, 1),
                                   (None, 5, "v1", "b", "en", 1, 1), ("insert", None, "v1", "b", "en", 1, 1),
                                   ("drop", 5, "v1", "b", "en", 1, 1)))
    assert totals(rollup) == sorted([("a", "en", "v2", 1, 12, 100), ("b", "en", "v1", 2, 12, 101),
                                     (None, None, "v1", 1, 0, 7)], key=repr)
    # Several changes to one document; an insertion of what is there replaces it.
    assert rollup.apply("3", batch(("insert", 4, "v1", "b", "en", 3, 3), ("delete", 4, "v1", None, None, 0, 0),
                                   ("insert", 4, "v1", "b", "en", 3, 3)))
    assert ("b", "en", "v1", 2, 14, 103) in totals(rollup)
    assert rollup.batches() == ["1", "2", "3"]


def test_a_batch_counts_once(spark, rollup):
    rows = spark.createDataFrame([("insert", 1, "v", "a", "en", 10, 1)], CHANGE)
    assert rollup.apply("1", rows) and not rollup.apply("1", rows)
    assert totals(rollup) == [("a", "en", "v", 1, 10, 1)]
    assert rollup.apply("2", rows)  # the same counts again change nothing
    assert totals(rollup) == [("a", "en", "v", 1, 10, 1)]


def test_what_a_failed_batch_left_is_not_read(spark, rollup):
    rows = spark.createDataFrame([("insert", 1, "v", "a", "en", 10, 1)], CHANGE)
    rollup.apply("0", rows)
    left = rollup.entries().select("doc_id", "source", "lang", "version", "documents", "tokens", "bytes",
                                   F.lit("1").alias("batch"), F.lit("lost").alias("attempt"))
    left.write.mode("append").parquet(f"{rollup.root}/entries")
    left.drop("doc_id").write.mode("append").parquet(f"{rollup.root}/sums")
    assert totals(rollup) == [("a", "en", "v", 1, 10, 1)]
    assert rollup.apply("1", spark.createDataFrame([("delete", 1, "v", None, None, None, None)], CHANGE))
    assert totals(rollup) == []


def test_empty_batches_and_tables(spark, rollup):
    assert totals(rollup) == [] and rollup.batches() == []
    assert rollup.apply("none", spark.createDataFrame([], CHANGE))
    assert totals(rollup) == [] and rollup.batches() == ["none"]


def test_counted_tokens(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "some text"), (3, "some text"), (4, "word " * 20_000), (None, "a")]
    found = count_tokens(docs_of(rows, tokens="old"), tokenizer_file()).collect()
    assert all(r["tokens"] == len(ids_of(r["text"])) - 1 for r in found) and len(found) == 6
    assert count_tokens(docs_of([]), tokenizer_file()).count() == 0
