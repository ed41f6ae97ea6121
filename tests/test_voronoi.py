"""The join over Voronoi cells against brute force, and how much it leaves out."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_search import expected, frame, hits
from trawl import knn_join
from trawl.operators import dense, voronoi
from trawl.schema import Metric


@pytest.fixture(scope="module")
def clustered():
    """Thirty tight clusters, one holding a third of the rows."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(30, 10)) * 10
    which = np.where(rng.random(3000) < 1 / 3, 0, rng.integers(0, 30, 3000))
    x = centers[which] + rng.normal(size=(3000, 10)) * 0.3
    q = centers[rng.integers(0, 30, 600)] + rng.normal(size=(600, 10)) * 0.3
    return q.astype(np.float32).astype(float), x.astype(np.float32).astype(float)


def renamed(spark, q, x):
    return (frame(spark, q, "qid").withColumnRenamed("embedding", "qv"),
            frame(spark, x).repartition(6).withColumnRenamed("embedding", "v"))


@pytest.mark.parametrize("metric", ["l2", "l1", "cosine"])
def test_pruned_join_equals_brute_force(spark, clustered, metric, monkeypatch):
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 128)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    monkeypatch.setattr(voronoi, "ROWS_PER_PIVOT", 64)
    q, x = clustered
    found = knn_join(frame(spark, q, "qid"), frame(spark, x).repartition(6), 9, metric, layout="pruned")
    assert hits(found) == expected(metric, q, x, 9)


def test_fewer_pairs_and_rows_than_the_grid(spark, clustered, monkeypatch):
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 128)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    q, x = clustered
    left, right = renamed(spark, q, x)
    cells = voronoi.plan_cells(left, right, 5, Metric.L2, pivots=40)
    q_blocks, c_blocks = dense.block_count(len(q), 16), dense.block_count(len(x), 128)
    assert cells.queries.sum() == len(q) and cells.pairs < q_blocks * c_blocks / 2
    assert cells.copies.sum() < len(x) * q_blocks / 4
    assert cells.shipped < (len(q) * c_blocks + len(x) * q_blocks) / 2
    # The hot cluster is cut: no block of a cell is much larger than asked for.
    assert (cells.copies / cells.corpus_blocks).max() <= 128
    out = dense.result_schema(left, "qid", right, "id")
    found = dense.rank_best(voronoi.voronoi_topk(left, right, out, 5, cells), 5)
    assert hits(found) == expected("l2", q, x, 5)


def test_auto_takes_the_cheaper_layout(spark, clustered, monkeypatch):
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 10)
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 128)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    monkeypatch.setattr(voronoi, "ROWS_PER_PIVOT", 64)
    taken = []
    real = voronoi.voronoi_topk
    monkeypatch.setattr(voronoi, "voronoi_topk", lambda *a: taken.append(a) or real(*a))
    q, x = clustered
    found = knn_join(frame(spark, q, "qid"), frame(spark, x), 3, "l2")
    assert hits(found) == expected("l2", q, x, 3) and len(taken) == 1
    # No structure to prune by, and no triangle inequality: the grid.
    rng = np.random.default_rng(8)
    q, x = rng.normal(size=(60, 48)), rng.normal(size=(600, 48))
    q, x = q.astype(np.float32).astype(float), x.astype(np.float32).astype(float)
    for metric in ("l2", "ip"):
        assert hits(knn_join(frame(spark, q, "qid"), frame(spark, x), 3, metric)) == expected(metric, q, x, 3)
    assert len(taken) == 1


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_copies_ties_and_undefined_rows(spark, metric):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(5, 4)).astype(np.float32).astype(float)
    x = np.concatenate([np.repeat(base, 60, axis=0)[rng.permutation(300)], np.zeros((3, 4))])
    q = np.concatenate([base[:3], np.zeros((1, 4))])
    wanted = {(r["qid"], r["rank"], r["id"], r["distance"] is None)
              for r in knn_join(frame(spark, q, "qid"), frame(spark, x), 70, metric, layout="grid").collect()}
    found = knn_join(frame(spark, q, "qid"), frame(spark, x).repartition(4), 70, metric, layout="pruned").collect()
    assert {(r["qid"], r["rank"], r["id"], r["distance"] is None) for r in found} == wanted and len(found) == 280


def test_short_empty_and_text_ids(spark):
    names = ["b", "a", "c"]
    corpus = frame(spark, [[1, 0], [0, 1], [1, 1]], kind=T.StringType(), names=names)
    q = frame(spark, [[1, 1]], "qid", T.StringType(), ["q"])
    for k, wanted in ((2, ["c", "a"]), (10, ["c", "a", "b"])):
        assert [h[2] for h in hits(knn_join(q, corpus, k, "l2", layout="pruned"))] == wanted
    assert knn_join(q, corpus.where(F.lit(False)), 2, "l2", layout="pruned").count() == 0
    assert knn_join(q.where(F.lit(False)), corpus, 2, "l2", layout="pruned").count() == 0
