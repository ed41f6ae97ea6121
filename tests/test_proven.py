"""Exact answers from the cells that can hold a neighbour."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_search import VECTOR, brute, frame, hits
from trawl import IvfIndex, filtered_search, knn_join
from trawl.operators import dense
from trawl.operators.proven import proven_search
from trawl.sources.storage import Folder


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors in twenty clusters, a third of them in one; a label that few rows have."""
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(20, 8)) * 8
    which = np.where(rng.random(2000) < 1 / 3, 0, rng.integers(0, 20, 2000))
    x = (centers[which] + rng.normal(size=(2000, 8)) * 0.4).astype(np.float32).astype(float)
    q = (centers[rng.integers(0, 20, 25)] + rng.normal(size=(25, 8)) * 0.4).astype(np.float32).astype(float)
    shape = T.StructType([T.StructField("id", T.LongType()), T.StructField("embedding", VECTOR), T.StructField("label", T.LongType())])
    corpus = spark.createDataFrame([(i, v.tolist(), int(i % 50)) for i, v in enumerate(x)], shape)
    return q, x, corpus


@pytest.fixture(scope="module", params=["l2", "cosine"])
def index(request, clustered, spark, tmp_path_factory):
    built = IvfIndex.build(clustered[2], request.param, cells=20)
    written = built.write(Folder(spark, str(tmp_path_factory.mktemp("ivf"))))
    return IvfIndex.read(Folder(spark, written.cells.inputFiles()[0].removeprefix("file://").split("/cells/")[0]))


@pytest.mark.parametrize("k", [1, 6, 150])
def test_equals_exact_search_and_reads_fewer_cells(spark, clustered, index, k):
    q, x, _ = clustered
    found = proven_search(index, frame(spark, q, "qid"), k)
    assert hits(found.hits) == hits(knn_join(frame(spark, q, "qid"), clustered[2], k, index.metric))
    assert found.cells == 20 and 1 <= found.cells_read < (8 if k < 100 else 20)


@pytest.mark.parametrize("label", [3, 49])
def test_filtered_search_reads_fewer_cells(spark, clustered, index, label):
    """Forty rows pass, spread over all clusters; still not every cell is opened for every query."""
    q, x, corpus = clustered
    where = F.col("label") == label
    wanted = hits(knn_join(frame(spark, q, "qid"), corpus, 4, index.metric, where=where))
    found = proven_search(index, frame(spark, q, "qid"), 4, where=where)
    assert hits(found.hits) == wanted and found.cells_read < found.cells
    assert hits(filtered_search(index, frame(spark, q, "qid"), 4, where, "auto")) == wanted


def test_radii_bound_every_row(clustered, index):
    q, x, _ = clustered
    points = x / np.linalg.norm(x, axis=1)[:, None] if index.metric == "cosine" else x
    radii = {r["cell"]: (r["n"], r["radius"]) for r in index.radii.collect()}
    cell = {r["id"]: r["cell"] for r in index.cells.select("id", "cell").collect()}
    apart = brute("l2", points, index.centroids)
    for i, c in cell.items():
        assert apart[i, c] <= radii[c][1] + 1e-9
    assert sum(n for n, _ in radii.values()) == 2000


def test_fewer_rows_than_asked_ties_and_zeros(spark, tmp_path):
    x = [[1, 0], [1, 0], [0, 0], [-1, 0], [0, 2], [0, 0]]
    corpus, q = frame(spark, x), frame(spark, [[1, 0], [0, 0]], "qid")
    for metric in ("cosine", "l2"):
        index = IvfIndex.build(corpus, metric, cells=3).write(Folder(spark, str(tmp_path / metric)))
        for k in (1, 3, 10):
            key = lambda df: sorted((r["qid"], r["rank"], r["id"], r["distance"] is None) for r in df.collect())
            assert key(proven_search(index, q, k).hits) == key(knn_join(q, corpus, k, metric))
        assert proven_search(index, q, 2, where=F.col("id") > 90).hits.count() == 0
        assert proven_search(index, q.where("qid > 90"), 2).hits.count() == 0
    for metric in ("ip", "l1"):
        assert proven_search(IvfIndex.build(corpus, metric, cells=2).write(Folder(spark, str(tmp_path / metric))), q, 1) is None


@pytest.mark.parametrize("where", [None, "label = 3"])
def test_large_query_tables_are_answered_in_blocks(spark, clustered, index, where, monkeypatch):
    q, x, corpus = clustered
    where = None if where is None else F.expr(where)
    wanted = hits(knn_join(frame(spark, q, "qid"), corpus, 6, index.metric, where=where))
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 10)
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 200)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 4)
    found = proven_search(index, frame(spark, q, "qid"), 6, where=where)
    assert hits(found.hits) == wanted and 1 <= found.cells_read < found.cells


def test_large_query_tables_with_zeros(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 1)
    x = [[1, 0], [1, 0], [0, 0], [-1, 0], [0, 2], [0, 0]]
    corpus, q = frame(spark, x), frame(spark, [[1, 0], [0, 0], [3, 1]], "qid")
    key = lambda df: sorted((r["qid"], r["rank"], r["id"], r["distance"] is None) for r in df.collect())
    for metric in ("cosine", "l2"):
        index = IvfIndex.build(corpus, metric, cells=3).write(Folder(spark, str(tmp_path / metric)))
        for k in (2, 10):
            assert key(proven_search(index, q, k).hits) == key(knn_join(q, corpus, k, metric, layout="grid"))
        assert proven_search(index, q, 2, where=F.col("id") > 90).hits.count() == 0
