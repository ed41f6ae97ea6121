"""Exact and approximate search against brute force, ties, odd vectors and uneven cells."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl import (
    Fusion, GraphIndex, HashModel, HybridConfig, IvfIndex, LexicalIndex, boolean_match, embed,
    filtered_search, hash_embedding, knn_join, lexical_topk, mmr, topk, web_match, with_relevance,
)
from trawl.functions.distance import distance, relevance, vector_literal
from trawl.operators import dense, ivf, quant
from trawl.operators.hybrid import fuse
from trawl.schema import Metric
from trawl.sources.storage import Folder

VECTOR = T.ArrayType(T.FloatType())


def frame(spark, vectors, key="id", kind=T.LongType(), names=None):
    shape = T.StructType([T.StructField(key, kind), T.StructField("embedding", VECTOR)])
    names = range(len(vectors)) if names is None else names
    return spark.createDataFrame([(n, [float(x) for x in v]) for n, v in zip(names, vectors)], shape)


def brute(metric, q, x):
    if metric == "l1":
        return np.abs(q[:, None, :] - x[None]).sum(-1)
    if metric == "l2":
        return np.sqrt(((q[:, None, :] - x[None]) ** 2).sum(-1))
    if metric == "ip":
        return -(q @ x.T)
    return 1 - (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None])


def hits(df):
    return sorted((r["qid"], r["rank"], r["id"]) for r in df.collect())


def expected(metric, q, x, k):
    d = brute(metric, q, x)
    out = []
    for i in range(len(q)):
        order = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:k]
        out += [(i, n + 1, j) for n, j in enumerate(order)]
    return sorted(out)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)).astype(np.float32).astype(float)
    return rng.normal(size=(30, 12)).astype(np.float32).astype(float), x


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
@pytest.mark.parametrize("layout", ["auto", "grid"])
def test_knn_join(spark, data, metric, layout, monkeypatch):
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 64)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 8)
    q, x = data
    found = knn_join(frame(spark, q, "qid"), frame(spark, x).repartition(5), 7, metric, layout=layout)
    assert hits(found) == expected(metric, q, x, 7)


def test_large_query_tables_leave_the_broadcast(spark, data, monkeypatch):
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 10)
    q, x = data
    found = knn_join(frame(spark, q, "qid"), frame(spark, x), 3, "l2")
    assert hits(found) == expected("l2", q, x, 3)
    with pytest.raises(ValueError):
        knn_join(frame(spark, q, "qid"), frame(spark, x), 3, "l2", layout="broadcast")


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_equal_vectors_rank_by_id(spark, scale):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 9)).astype(np.float32) * np.float32(scale)
    x = np.repeat(base, 40, axis=0)[rng.permutation(240)].astype(float)
    q = base[:2].astype(float)
    for metric in ("l2", "cosine", "ip"):
        found = knn_join(frame(spark, q, "qid"), frame(spark, x).repartition(7), 50, metric)
        groups = {}
        for qid, _, id in hits(found):
            groups.setdefault(qid, []).append(id)
        for qid, ids in groups.items():
            kinds = [tuple(x[i]) for i in ids]
            first = [i for i, kind in zip(ids, kinds) if kind == kinds[0]]
            assert first == sorted(first) and len(first) == 40


def test_string_ids_and_short_corpus(spark):
    x, names = [[1, 0], [0, 1], [1, 1]], ["b", "a", "c"]
    corpus = frame(spark, x, kind=T.StringType(), names=names)
    q = frame(spark, [[1, 1]], "qid", T.StringType(), ["q"])
    assert [h[2] for h in hits(knn_join(q, corpus, 10, "cosine"))] == ["c", "a", "b"]


def test_zero_vectors_come_last_without_distance(spark):
    corpus = frame(spark, [[0, 0], [1, 0], [-1, 0]])
    q = frame(spark, [[1, 0]], "qid")
    rows = sorted(knn_join(q, corpus, 3).collect(), key=lambda r: r["rank"])
    assert [r["id"] for r in rows] == [1, 2, 0] and rows[2]["distance"] is None
    for method in ("block", "expression"):
        rows = topk(corpus, [1, 0], 3, "cosine", method=method).collect()
        assert [r["id"] for r in rows] == [1, 2, 0] and rows[2]["distance"] is None


def test_uneven_vectors_are_refused(spark):
    with pytest.raises(Exception, match="one length"):
        knn_join(frame(spark, [[1, 0]], "qid"), frame(spark, [[1, 0], [1, 0, 0]]), 1).collect()


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
@pytest.mark.parametrize("method", ["block", "expression"])
def test_topk(spark, data, metric, method):
    q, x = data
    rows = topk(frame(spark, x).repartition(3), q[0], 9, metric, method=method).collect()
    assert [(0, i + 1, r["id"]) for i, r in enumerate(rows)] == expected(metric, q[:1], x, 9)


def test_knn_plan_cuts_before_the_shuffle(spark, data):
    q, x = data
    plan = knn_join(frame(spark, q, "qid"), frame(spark, x), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning(qid")
    assert "Partial" in text[exchange:] and text.count("Exchange hashpartitioning") == 1


def test_relevance(spark):
    row = spark.range(1).select(
        relevance("cosine", F.lit(0.0)).alias("a"), relevance("l2", F.lit(0.0)).alias("b"),
        relevance("l1", F.lit(0.0)).alias("c"), relevance("ip", F.lit(-1.0)).alias("d"),
        relevance("cosine", F.lit(-1e-6)).alias("e"), relevance("cosine", F.lit(2.0)).alias("f"),
        relevance("l2", F.lit(math.sqrt(2) / 2)).alias("g"), relevance("ip", F.lit(0.25)).alias("h"),
    ).first()
    assert list(row) == pytest.approx([1, 1, 1, 1, 1, 0, 0.5, 0.75])
    with pytest.raises(NotImplementedError):
        relevance("hamming", F.lit(0.0))


def test_distances(spark):
    a, b = vector_literal([1, 2]), vector_literal([4, 6])
    row = spark.range(1).select(*[distance(m, a, b) for m in ("l2", "ip", "l1")]).first()
    assert list(row) == [5.0, -16.0, 7.0]


def test_mmr_prefers_variety(spark):
    corpus = frame(spark, [[1, 0], [0.99, 0.01], [0.7, 0.7], [0, 1]])
    q = frame(spark, [[1, 0.05]], "qid")
    found = hits(mmr(q, corpus, 2, 4, 0.3))
    assert {h[2] for h in found} != {0, 1} and len(found) == 2
    assert [h[2] for h in hits(mmr(q, corpus, 2, 4, 1.0))] == [
        h[2] for h in hits(knn_join(q, corpus, 2))]


# -- approximate -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed():
    """A third of all vectors in one tight cluster."""
    rng = np.random.default_rng(11)
    tight = rng.normal(size=(200, 8)) * 0.05 + 3.0
    rest = rng.normal(size=(400, 8)) * 2.0
    x = np.concatenate([tight, rest]).astype(np.float32).astype(float)
    return x[rng.choice(600, 40, replace=False)] + 0.01, x


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
@pytest.mark.parametrize("layout", ["auto", "grid"])
def test_ivf_full_probe_and_partial_probe(spark, skewed, metric, layout, monkeypatch):
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 50)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    q, x = skewed
    index = IvfIndex.build(frame(spark, x), metric, cells=8)
    asked = frame(spark, q, "qid")
    assert hits(index.search(asked, 5, 100, layout=layout)) == expected(metric, q, x, 5)
    cells = {r["id"]: r["cell"] for r in index.cells.select("id", "cell").collect()}
    near = ivf.nearest_cells(q, index.centroids, 3, Metric(metric))
    d = brute(metric, q, x)
    wanted = []
    for i in range(len(q)):
        pool = [j for j in range(len(x)) if cells[j] in near[i]]
        pool.sort(key=lambda j: (d[i, j], j))
        wanted += [(i, n + 1, j) for n, j in enumerate(pool[:5])]
    assert hits(index.search(asked, 5, 3, layout=layout)) == sorted(wanted)


@pytest.mark.parametrize("kind, options", [
    ("fp16", {}), ("bf16", {}), ("sq8", {}), ("sq4", {}), ("usq8", {}), ("usq4", {}),
    ("pq", {"pq_m": 4}), ("rabitq", {}), ("rabitq", {"nb_bits": 3}), ("bq", {}),
    ("bq", {"nb_bits": 1.5, "query_bits": 4}), ("tq", {"nb_bits": 1.5}), ("tq", {"nb_bits": 4}),
    ("osq", {"nb_bits": 2, "query_bits": 6}),
])
def test_rescored_codes_equal_exact(spark, skewed, kind, options):
    q, x = skewed
    index = IvfIndex.build(frame(spark, x), "l2", cells=4, quant=kind, **options)
    asked = frame(spark, q, "qid")
    assert hits(index.search(asked, 5, 100, 1)) == expected("l2", q, x, 5)
    assert len(hits(index.search(asked, 5, 100, 0))) == 5 * len(q)


@pytest.mark.parametrize("metric", ["cosine", "ip"])
def test_rescored_blocks_and_partial_probes(spark, skewed, metric, monkeypatch):
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 50)
    q, x = skewed
    index = IvfIndex.build(frame(spark, x), metric, cells=6, quant="sq8")
    asked = frame(spark, q, "qid")
    assert hits(index.search(asked, 5, 100, 1, layout="grid")) == expected(metric, q, x, 5)
    plain = IvfIndex(index.metric, index.centroids, index.cells)
    wanted = hits(plain.search(asked, 5, 2))
    assert hits(index.search(asked, 5, 2, 1)) == wanted
    assert hits(index.search(asked, 5, 2, 1, layout="grid")) == wanted


def test_coarse_codes_in_blocks_are_rescored_where_they_meet(spark, skewed, monkeypatch):
    """Coarse codes leave most pairs alive: none of them is shuffled, and no query is copied to each cell."""
    monkeypatch.setattr(dense, "CORPUS_BLOCK", 100)
    monkeypatch.setattr(dense, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ivf.CodeSearch, "alive", None)
    monkeypatch.setattr(ivf, "probe_table", None)
    q, x = skewed
    for kind, options in (("pq", {"pq_m": 2}), ("bq", {"nb_bits": 1, "query_bits": 4})):
        index = IvfIndex.build(frame(spark, x), "cosine", cells=6, quant=kind, **options)
        asked = frame(spark, q, "qid")
        assert hits(index.search(asked, 5, 100, 1, layout="grid")) == expected("cosine", q, x, 5)


def test_repeated_queries_in_blocks_count_as_in_probed_cells(spark, skewed):
    q, x = skewed
    index = IvfIndex.build(frame(spark, x), "l2", cells=1)
    again = frame(spark, np.concatenate([q[:2], q[:1]]), "qid", names=[0, 1, 0])
    found = hits(index.search(again, 6, 1, layout="grid"))
    near = [j for _, _, j in expected("l2", q[:2], x, 6)]
    assert [h[2] for h in found] == [near[0]] * 4 + [near[1]] * 2 + near[6:]


def test_best_is_exact_far_from_the_origin(monkeypatch):
    """Fast keys tell little where lengths are far above distances, or beyond single precision."""
    rng = np.random.default_rng(4)
    for scale, shift in ((1.0, 1e4), (1e-20, 0.0), (1e30, 0.0), (1.0, 0.0)):
        x, q = (rng.normal(size=(n, 6)) * scale + shift for n in (3000, 9))
        for metric in ("l2", "l1", "cosine", "ip"):
            best = dense.Best(Metric(metric), q, 4)
            best.add(np.arange(1500), x[:1500])
            best.add(np.arange(1500, 3000), x[1500:], np.arange(9))
            d = np.array([dense.precise(Metric(metric), np.broadcast_to(r, x.shape), x) for r in q])
            wanted = [sorted(range(3000), key=lambda j: (d[i, j], j))[:4] for i in range(9)]
            assert best.ids.reshape(9, 4).tolist() == wanted, (metric, scale)


def test_stored_index(spark, skewed, tmp_path):
    q, x = skewed
    built = IvfIndex.build(frame(spark, x), "cosine", cells=5, quant="tq", nb_bits=4)
    store = Folder(spark, str(tmp_path))
    built.write(store)
    again = IvfIndex.read(store)
    asked = frame(spark, q, "qid")
    assert hits(again.search(asked, 5, 100, 1)) == expected("cosine", q, x, 5)
    # Equal codes tie up to rounding, so code distances are compared rather than ids.
    def by_code(ix):
        rows = ix.search(asked, 5, 2, 0).orderBy("qid", "rank").collect()
        return [r["distance"] for r in rows]
    assert by_code(again) == pytest.approx(by_code(built), abs=1e-9)


def test_filtered_search_returns_k(spark, skewed):
    q, x = skewed
    corpus = frame(spark, x).withColumn("tag", F.col("id") % 50)
    index = IvfIndex.build(corpus, "l2", cells=8)
    asked = frame(spark, q, "qid")
    where = F.col("tag") == 7
    exact = hits(knn_join(asked, corpus, 4, "l2", where=where))
    for mode in ("auto", "scan"):
        assert hits(filtered_search(index, asked, 4, where, mode, nprobe=1)) == exact
    walked = filtered_search(index, asked, 4, where, "walk", nprobe=1)
    rows = walked.collect()
    assert len(rows) == 4 * len(q) and all(r["id"] % 50 == 7 for r in rows)


def test_graph(spark, skewed):
    q, x = skewed
    index = GraphIndex.build(frame(spark, x), "l2", m=8, ef_construction=24, cells=8)
    asked = frame(spark, q, "qid")
    exact = set(expected("l2", q, x, 5))
    assert set(hits(index.search(asked, 5, ef_search=1000))) == exact
    found = {(a, c) for a, _, c in hits(index.search(asked, 5, ef_search=40))}
    assert len(found & {(a, c) for a, _, c in exact}) / len(exact) > 0.9
    degree = index.edges.agg(F.max(F.size("neighbours"))).first()[0]
    assert degree <= 8
    where = F.col("id") % 2 == 0
    rows = filtered_search(index, asked, 5, where, "walk", ef_search=20).collect()
    assert len(rows) == 5 * len(q) and all(r["id"] % 2 == 0 for r in rows)


def test_quantizer_round_trip(spark, skewed):
    _, x = skewed
    for kind in quant.QUANTIZERS:
        model = quant.fit(frame(spark, x), kind, "l2")
        back = quant.Quantizer.from_json(model.to_json())
        raw = model.encode(x)
        assert raw.dtype == np.uint8 and (back.encode(x) == raw).all()
        miss = np.linalg.norm(x - model.decode(raw), axis=1) / np.linalg.norm(x, axis=1)
        assert miss.mean() < (0.01 if kind in ("none", "fp16", "bf16", "sq8", "usq8") else 0.7)


# -- text --------------------------------------------------------------------------------

DOCS = [(0, "the loud grey gull"), (1, "a slow grey seal, the end"), (2, "granite cliffs"),
        (3, "The gull. The seal! the GULL"), (4, ""), (5, None)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    built = LexicalIndex.build(docs, "id", "text", positions=True, buckets=4)
    return built.write(Folder(spark, str(tmp_path_factory.mktemp("index"))))


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid int, text string")


def test_index_tables(index):
    assert index.sums() == (5, 4 + 6 + 2 + 6)
    stats = {r["term"]: (r["df"], r["ttf"]) for r in index.terms.collect()}
    assert stats["the"] == (3, 5) and stats["gull"] == (2, 3)
    row = index.postings.where("term = 'gull' and id = 3").first()
    assert (row["tf"], row["dl"], row["positions"]) == (2, 6, [1, 5])


@pytest.mark.parametrize("limit", [500_000, 0])
def test_modes(spark, index, limit, monkeypatch):
    monkeypatch.setattr("trawl.operators.lexical.MAX_BROADCAST_TERMS", limit)
    queries = asked(spark, "grey the", "gull nothing", "the seal", "", "gull the")
    def found(mode):
        return {(r["qid"], r["id"]) for r in lexical_topk(index, queries, 10, mode=mode).collect()}
    assert found("all") == {(0, 0), (0, 1), (2, 1), (2, 3), (4, 0), (4, 3)}
    assert found("phrase") == {(2, 3), (4, 3)}
    assert {p for p in found("any") if p[0] == 1} == {(1, 0), (1, 3)}
    with pytest.raises(ValueError):
        lexical_topk(index, queries, 1, mode="none")
    with pytest.raises(ValueError):
        lexical_topk(index, queries, 1, scorer="none")


def test_bm25_by_hand(spark, index):
    row = lexical_topk(index, asked(spark, "gull"), 1).first()
    idf = math.log(1 + (5 - 2 + 0.5) / 2.5)
    def score(tf, dl):
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (18 / 5)))
    best = max((score(1, 4), 0), (score(2, 6), 3))
    assert (row["id"], row["score"]) == (best[1], pytest.approx(best[0]))


def test_keep_restricts_documents(spark, index):
    keep = spark.createDataFrame([(0,), (2,)], "id long")
    rows = lexical_topk(index, asked(spark, "the", "granite"), 5, keep=keep).collect()
    assert {(r["qid"], r["id"]) for r in rows} == {(0, 0), (1, 2)}


def test_small_query_tables_do_not_move_postings(spark, index):
    found = lexical_topk(index, asked(spark, "gull the"), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "positions" not in line]
    assert scans and "Exchange hashpartitioning(term" not in plan


@pytest.mark.parametrize("limit", [500_000, 0])
def test_web_queries(spark, index, limit, monkeypatch):
    monkeypatch.setattr("trawl.operators.lexical.MAX_BROADCAST_TERMS", limit)
    rows = [
        (0, ["the"], ["gull"], ["slow"], []),
        (1, [], ["slow", "granite"], None, None),
        (2, [], [], ["the"], [["grey", "gull"]]),
        (3, ["the"], [], [], [["the", "gull"], ["the", "seal"]]),
        (4, [], [], ["the"], []),
        (5, [], ["cliffs"], [], [["grey", "seal"]]),
    ]
    shape = ("qid int, must array<string>, should array<string>, must_not array<string>, "
             "phrases array<array<string>>")
    got = web_match(index, spark.createDataFrame(rows, shape))
    found = {(r["qid"], r["id"]) for r in got.collect()}
    assert found == {(0, 0), (0, 3), (1, 1), (1, 2), (3, 3), (5, 1)}


def test_boolean_expressions(spark, index):
    ids = spark.createDataFrame([(i,) for i in range(6)], "id long")
    def found(expr, documents=None):
        return {r["id"] for r in boolean_match(index, expr, documents).collect()}
    assert found({"and": ["the", {"not": "slow"}]}) == {0, 3}
    assert found({"or": ["cliffs", {"phrase": ["the", "gull"]}]}) == {2, 3}
    assert found({"not": "the"}, ids) == {2, 4, 5}
    assert found("seal") == {1, 3}
    with pytest.raises(ValueError):
        boolean_match(index, {"not": "the"})
    with pytest.raises(ValueError):
        boolean_match(index, {"xor": ["the", "gull"]})


def test_fusion_formulas(spark):
    lex = spark.createDataFrame([(0, "a", 4.0), (0, "b", 2.0), (0, "c", 2.0)],
                                "qid int, id string, score double")
    vec = spark.createDataFrame([(0, "b", 0.1), (0, "d", 0.5)], "qid int, id string, distance double")
    def scores(fusion):
        config = HybridConfig(fusion=fusion, primary_results_weight=0.3, secondary_results_weight=0.7)
        return {r["id"]: r["score"] for r in fuse(lex, vec, config).collect()}
    assert scores(Fusion.RRF) == pytest.approx(
        {"a": 1 / 61, "b": 1 / 62 + 1 / 61, "c": 1 / 62, "d": 1 / 62})
    assert scores(Fusion.NORMALIZED) == pytest.approx({"a": 0.7, "b": 0.3, "c": 0.0, "d": 0.0})
    assert scores(Fusion.WEIGHTED_SUM) == pytest.approx(
        {"a": 2.8, "b": 1.4 - 0.03, "c": 1.4, "d": -0.15})
    single = spark.createDataFrame([(0, "z", 9.0)], "qid int, id string, score double")
    config = HybridConfig(fusion=Fusion.NORMALIZED)
    assert {r["id"]: r["score"] for r in fuse(single, vec.limit(0), config).collect()} == {"z": 0.5}


def test_structured_tsquery_needs_columns():
    with pytest.raises(ValueError):
        HybridConfig(tsquery_function="websearch_to_tsquery").mode


# -- embedding ---------------------------------------------------------------------------


def test_hash_embedding(spark):
    import hashlib

    text = "the loud grey gull"
    raw = np.array([hashlib.sha256(f"{i}:{text}".encode()).digest()[0] / 255 for i in range(8)])
    df = spark.createDataFrame([(text,), (None,)], "content string")
    rows = embed(df, HashModel(8)).collect()
    assert rows[0]["embedding"] == pytest.approx(list(raw / np.linalg.norm(raw)), rel=1e-6)
    assert rows[1]["embedding"] is None
    assert df.select(F.size(hash_embedding(F.col("content"), 5))).first()[0] == 5


def test_user_model_is_made_once_per_task(spark):
    def factory():
        made = np.random.default_rng().integers(1 << 30)

        def encode(texts):
            return [[float(len(t)), float(made)] for t in texts]

        return encode

    df = spark.createDataFrame([("x" * i,) for i in range(10)], "content string").coalesce(1)
    rows = embed(df, factory, batch=3).collect()
    assert sorted(r["embedding"][0] for r in rows) == [float(i) for i in range(10)]
    assert len({r["embedding"][1] for r in rows}) == 1


def test_threshold(spark):
    q = frame(spark, [[1, 0]], "qid")
    found = with_relevance(knn_join(q, frame(spark, [[1, 0], [1, 1], [0, 1]]), 3), "cosine", 0.5)
    assert [h[2] for h in hits(found)] == [0, 1]


def test_terms_reach_the_scan(spark, tmp_path):
    from trawl.sources.storage import Folder

    docs = spark.createDataFrame(DOCS, "id long, text string")
    index = LexicalIndex.build(docs, "id", "text", positions=True, buckets=4).write(
        Folder(spark, str(tmp_path)))
    for found in (lexical_topk(index, asked(spark, "gull"), 3), boolean_match(index, "gull"),
                  boolean_match(index, {"and": ["the", {"not": "seal"}]})):
        plan = found._jdf.queryExecution().toString()
        physical = plan[plan.index("== Physical Plan =="):]
        assert "PartitionFilters" in physical and "bucket" in physical
        assert "EqualTo(term,gull)" in physical or "In(term" in physical


def test_many_terms_take_the_join(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    index = LexicalIndex.build(docs, "id", "text", positions=True, buckets=4)
    words = asked(spark, "grey the", "gull the", "seal")
    few = sorted(map(tuple, lexical_topk(index, words, 5).collect()))
    monkeypatch.setattr("trawl.operators.lexical.MAX_PUSHED_TERMS", 1)
    assert sorted(map(tuple, lexical_topk(index, words, 5).collect())) == few and few
