"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare
from conftest import SF
from trawl.plans import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"graph_walk", "ivf_recall", "quant_recall"}


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    problem, _, _ = compare(spark, SF, QUERIES[name], ORACLES[name])
    assert problem is None


def test_approximate_recall(spark):
    rows = {r["method"]: r["recall"] for r in QUERIES["ivf_recall"](spark, SF).collect()}
    assert rows["ivf_nprobe_1"] <= rows["ivf_nprobe_4"] <= rows["ivf_nprobe_16"]
    assert rows["ivf_nprobe_16"] > 0.9
    rows = {r["method"]: r["recall"] for r in QUERIES["quant_recall"](spark, SF).collect()}
    assert rows["none"] == 1.0
    assert min(rows[m] for m in ("fp16", "bf16", "sq8", "usq8")) > 0.97
    assert min(rows[m] for m in ("sq4", "rabitq", "bq", "tq", "osq")) > 0.8
    assert rows["pq"] > 0.7


def test_graph_walk_recall(spark):
    walked = {(r["qid"], r["id"]) for r in QUERIES["graph_walk"](spark, SF).collect()}
    exact = {(r["qid"], r["id"]) for r in QUERIES["knn_join_cosine"](spark, SF).collect()}
    assert len(walked & exact) / len(exact) > 0.95
