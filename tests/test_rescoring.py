"""Pairs that a quantized search in blocks holds against the codes."""

import numpy as np
import pytest

from trawl.operators import dense, ivf
from trawl.operators.quant import Quantizer
from trawl.schema import Metric


def _data(metric, kind="usq4", query_bits=None, rows=400, asked=60, dim=12):
    rnd = np.random.default_rng(3)
    x, q = rnd.normal(size=(rows, dim)), rnd.normal(size=(asked, dim))
    model = Quantizer(kind, dim, metric, 4 if kind == "osq" else None, query_bits,
                      {"lo": np.full(dim, -4.0), "hi": np.full(dim, 4.0)})
    ready = model.prepare(x)
    codes = model.decode(model.encode(ready))
    return x, q, model, codes, np.sqrt(((ready - codes) ** 2).sum(axis=1))


@pytest.mark.parametrize("kind, query_bits", [("usq4", None), ("osq", 3)])
@pytest.mark.parametrize("metric", [Metric.COSINE, Metric.L2, Metric.IP])
def test_pairs_are_judged_as_whole_blocks(metric, kind, query_bits):
    x, q, model, codes, err = _data(metric, kind, query_bits)
    seen, moved = model.quantize_queries(q)
    cuts = np.quantile(dense.coarse(metric, q, x), 0.05, axis=1)
    for width in (0.0, 0.4, 1.0):
        whole = ivf.may_be_within(metric, seen, moved, cuts, width, codes, err)
        qi, xi = np.divmod(np.arange(whole.size), len(x))
        single = ivf.pair_may_be_within(metric, seen[qi], moved[qi], cuts[qi], width, codes[xi], err[xi])
        assert (single == whole.ravel()).mean() > 0.9999 and 0 < whole.mean() < 1
        if width == 1.0:
            assert single[(dense.precise(metric, q[qi], x[xi]) <= cuts[qi])].all()


@pytest.mark.parametrize("metric", [Metric.COSINE, Metric.L2, Metric.IP])
def test_only_pairs_within_the_cut_meet_the_codes(metric):
    x, q, model, codes, err = _data(metric)
    k, ids, seen = 5, np.arange(400), model.quantize_queries(q)[0]
    exact = dense.precise(metric, np.repeat(q, len(x), 0), np.tile(x, (len(q), 1))).reshape(len(q), -1)
    cuts = np.sort(exact, axis=1)[:, 9]
    cuts[7] = np.inf  # too few neighbours by code
    tried = []

    def keep(rows, which):
        tried.append(len(rows))
        return ivf.pair_may_be_within(metric, seen[rows], np.zeros(len(rows)), cuts[rows], 1.0, codes[which], err[which])

    best = dense.Best(metric, q, k)
    best.limit = cuts.copy()
    best.add(ids, x, keep=keep)
    assert sum(tried) <= 20 * len(q)  # of 400 * 60 pairs
    order = np.lexsort((np.tile(ids, (len(q), 1)), exact), axis=1)[:, :k]
    assert np.array_equal(best.ids.reshape(len(q), k), order)


@pytest.mark.parametrize("metric, width", [("cosine", 1), ("l2", 0.5), ("ip", 2)])
def test_rescored_blocks_equal_the_broadcast_search(spark, monkeypatch, metric, width):
    """Zero vectors, repeated rows and queries, and fewer rows than asked for in a block."""
    rnd = np.random.default_rng(5)
    vectors = rnd.normal(size=(90, 6)).round(2)
    vectors[::17] = 0.0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([vectors, vectors[:9]]))]
    table = spark.createDataFrame(rows, "id int, embedding array<double>")
    queries = table.where("id < 40").withColumnRenamed("id", "qid")
    index = ivf.IvfIndex.build(table, metric, quant="usq4", cells=3)
    wanted = index.search(queries, 4, 3, width).toPandas()
    judged, blocks = [], ivf.CodeSearch.rescored
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 10)
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 30)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ivf.CodeSearch, "rescored", lambda *a: judged.append(1) or blocks(*a))
    found = index.search(queries, 4, 3, width).toPandas()
    by = ["qid", "rank"]
    wanted, found = (f.sort_values(by).reset_index(drop=True) for f in (wanted, found))
    assert judged and np.allclose(wanted["distance"], found["distance"], equal_nan=True)
    assert (wanted[["qid", "rank"]] == found[["qid", "rank"]]).all().all()
