import math

import numpy as np
import pytest

from conftest import SF
from trawl.llm.ann import ProjectedTree, chi_square_cdf, chi_square_quantile, projected_neighbours
from trawl.llm.queries import QUERIES


def exact(vectors, query, k):
    best = sorted({(float(np.sqrt(((np.array(v) - np.array(vectors[query])) ** 2).sum())), i)
                   for i, v in vectors.items() if i != query})
    return best[:k]


def test_chi_square_law():
    assert chi_square_cdf(2 * math.log(2), 2) == pytest.approx(0.5)
    assert chi_square_quantile(0.95, 16) == pytest.approx(26.296, abs=1e-3)


def test_query_recall_and_scores(spark):
    table = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    found = {}
    for r in QUERIES["op1_projected_neighbours"](spark, SF).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in table if i % 100 == 0}
    hits = 0
    for q, rows in found.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        wanted = exact(table, q, 10)
        hits += len({i for _, i in wanted} & {i for _, i, _ in rows})
        for _, i, score in rows:
            assert score == pytest.approx(math.dist(table[q], table[i]), abs=1e-12)
    assert hits >= 0.9 * 10 * len(found)


def test_ties_repeats_and_unfit_vectors(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0]), (4, [0.0, 2.0]),
            (5, None), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]),
            (9, [float("inf"), 1.0]), (10, [1.0]), (None, [0.0, 1.0]), (11, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    found = projected_neighbours(df, df.where("vec_id in (1, 5, 6, 8)"), k=2).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 1, 2, 1.0), (1, 2, 3, 1.0)]
    assert projected_neighbours(df, df.where("vec_id = 1"), k=10).count() == 3


def test_waves_do_not_change_the_answer(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rnd.standard_normal(8).tolist()) for i in range(400)],
                               "vec_id long, embedding array<double>").repartition(3)
    whole = sorted(projected_neighbours(df, df.where("vec_id % 20 = 0"), k=5).collect())
    monkeypatch.setattr("trawl.llm.ann.WAVE_BYTES", 8 * 8 * 5)
    assert sorted(projected_neighbours(df, df.where("vec_id % 20 = 0"), k=5).collect()) == whole


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert projected_neighbours(empty, empty).count() == 0
    assert projected_neighbours(one, one).count() == 0


def test_copies_of_the_query_are_ranked_by_id_whatever_the_rounding():
    rnd = np.random.default_rng(11)
    vector, directions = rnd.standard_normal(64), rnd.standard_normal((64, 16))
    ids = rnd.permutation(700)
    tree = ProjectedTree(ids, np.concatenate([np.tile(vector, (600, 1)), rnd.standard_normal((100, 64))]),
                             directions)
    for point in (np.nextafter(vector @ directions, np.inf), np.nextafter(vector @ directions, -np.inf)):
        found, distances = tree.search(-1, vector, point, 10, chi_square_quantile(0.95, 16))
        assert found.tolist() == sorted(ids[:600])[:10] and not distances.any()
