"""Exact vector search, relevance, diversity and hash embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions.embed import embed, hash_embedding
from trawl.operators.dense import knn_join, topk, with_relevance
from trawl.operators.filters import compile_filter
from trawl.operators.mmr import mmr
from trawl.plans.common import (
    DIM, METRICS, PROBE, embedded_documents, embeddings, sql_distance, sql_hash_embedding,
    sql_knn, sql_relevance, sql_tidy, table, text_queries, tidy, vector_queries,
)
from trawl.schema import CollectionSchema

K = 5
VECTORS = CollectionSchema(id_column="id", metadata_columns={"label": "INT"}, json_column=None)
LABELS = {"$or": [{"label": {"$in": [1, 3, 5]}}, {"label": {"$gt": 7}}]}
VECTOR = "[" + ", ".join(str(x) for x in PROBE) + "]::DOUBLE[]"

QUERIES: dict = {}
ORACLES: dict = {}


def _topk(metric, method="block"):
    def run(spark, sf):
        found = topk(embeddings(spark, sf), PROBE, 10, metric, method=method)
        return found.select("id", "label", tidy("distance"))
    return run


def _knn(metric, layout="auto"):
    def run(spark, sf):
        hits = knn_join(vector_queries(spark, sf), embeddings(spark, sf), K, metric, layout=layout)
        return hits.select("qid", "id", "rank", tidy("distance"))
    return run


def _relevance(metric):
    def run(spark, sf):
        hits = knn_join(vector_queries(spark, sf), embeddings(spark, sf), K, metric)
        return with_relevance(hits, metric).select("qid", "id", "rank", tidy("relevance"))
    return run


for _m in METRICS:
    QUERIES[f"dense_{_m}"] = _topk(_m)
    ORACLES[f"dense_{_m}"] = f"""
SELECT id, label, {sql_tidy('distance')} AS distance FROM (
  SELECT vec_id AS id, label, {sql_distance(_m, 'embedding::DOUBLE[]', VECTOR)} AS distance
  FROM embeddings) ORDER BY distance, id LIMIT 10"""
    QUERIES[f"dense_expression_{_m}"] = _topk(_m, "expression")
    ORACLES[f"dense_expression_{_m}"] = ORACLES[f"dense_{_m}"]
    QUERIES[f"knn_join_{_m}"] = _knn(_m)
    ORACLES[f"knn_join_{_m}"] = f"""
WITH {sql_knn(_m, K)}
SELECT qid, id, rank, {sql_tidy('distance')} AS distance FROM hits"""
    QUERIES[f"relevance_{_m}"] = _relevance(_m)
    ORACLES[f"relevance_{_m}"] = f"""
WITH {sql_knn(_m, K)}
SELECT qid, id, rank, {sql_tidy(sql_relevance(_m))} AS relevance FROM hits"""

QUERIES["knn_join_blocks"] = _knn("cosine", "grid")
ORACLES["knn_join_blocks"] = ORACLES["knn_join_cosine"]
for _name, _m in (("knn_join_pruned", "l2"), ("knn_join_pruned_cosine", "cosine"), ("knn_join_pruned_l1", "l1")):
    QUERIES[_name] = _knn(_m, "pruned")
    ORACLES[_name] = ORACLES[f"knn_join_{_m}"]


def dense_filtered(spark, sf):
    where = compile_filter(LABELS, VECTORS)
    hits = knn_join(vector_queries(spark, sf), embeddings(spark, sf), K, "cosine", where=where)
    return hits.select("qid", "id", "rank", tidy("distance"))


QUERIES["dense_filtered"] = dense_filtered
ORACLES["dense_filtered"] = f"""
WITH {sql_knn('cosine', K, 'c.label IN (1, 3, 5) OR c.label > 7')}
SELECT qid, id, rank, {sql_tidy('distance')} AS distance FROM hits"""


def threshold(spark, sf):
    hits = knn_join(vector_queries(spark, sf), embeddings(spark, sf), K, "cosine")
    return with_relevance(hits, "cosine", 0.45).select("qid", "id", "rank", tidy("relevance"))


QUERIES["threshold"] = threshold
ORACLES["threshold"] = f"""
WITH {sql_knn('cosine', K)}
SELECT qid, id, rank, {sql_tidy(sql_relevance('cosine'))} AS relevance FROM hits
WHERE {sql_relevance('cosine')} >= 0.45"""


def search_text(spark, sf):
    """Text queries embedded and answered by distance over the embedded documents."""
    hits = knn_join(text_queries(spark, sf, True), embedded_documents(spark, sf), 4, "cosine")
    return hits.select("qid", "id", "rank", tidy("distance", 5))


QUERIES["search_text"] = search_text
ORACLES["search_text"] = f"""
WITH d AS (SELECT doc_id AS id, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM documents),
q AS (SELECT item_id AS qid, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM benchmark)
SELECT qid, id, rank, {sql_tidy('distance', 5)} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM (
    SELECT qid, id, list_cosine_distance(q.e, d.e) AS distance FROM q, d)
) WHERE rank <= 4"""


def _mmr(balance, metric="cosine"):
    def run(spark, sf):
        hits = mmr(vector_queries(spark, sf), embeddings(spark, sf), 3, 10, balance, metric)
        return hits.select("qid", "id", "rank", tidy("distance"))
    return run


def _sql_mmr(balance, metric="cosine"):
    """Three greedy picks over ten candidates, one CTE per pick."""
    return f"""
WITH {sql_knn(metric, 10)},
c AS (SELECT h.*, x.e AS e, list_cosine_similarity(x.e, y.e) AS s
      FROM hits h JOIN v x ON x.vec_id = h.id JOIN v y ON y.vec_id = h.qid),
p1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, rank) AS turn FROM c) WHERE turn = 1),
c2 AS (SELECT c.*, list_cosine_similarity(c.e, p1.e) AS r1 FROM c JOIN p1 USING (qid) WHERE c.id <> p1.id),
p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {balance} * s - (1 - {balance}) * r1 DESC, rank) AS turn FROM c2) WHERE turn = 1),
c3 AS (SELECT c2.*, greatest(c2.r1, list_cosine_similarity(c2.e, p2.e)) AS r2 FROM c2 JOIN p2 USING (qid) WHERE c2.id <> p2.id),
p3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {balance} * s - (1 - {balance}) * r2 DESC, rank) AS turn FROM c3) WHERE turn = 1),
chosen AS (SELECT qid, id, distance FROM p1 UNION ALL SELECT qid, id, distance FROM p2 UNION ALL SELECT qid, id, distance FROM p3)
SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank, {sql_tidy('distance')} AS distance
FROM chosen"""


QUERIES["mmr"] = _mmr(0.5)
ORACLES["mmr"] = _sql_mmr("0.5::DOUBLE")
QUERIES["mmr_diverse_l2"] = _mmr(0.1, "l2")
ORACLES["mmr_diverse_l2"] = _sql_mmr("0.1::DOUBLE", "l2")


def _embed(name, key, text):
    def run(spark, sf):
        vector = hash_embedding(F.col(text), DIM)
        cells = F.transform(vector, lambda x: F.round(x.cast("double"), 5).cast("string"))
        return table(spark, sf, name).select(F.col(key).alias("id"),
                                             F.array_join(cells, ",").alias("vector"))
    return run


for _name, _key, _text in (("part", "p_partkey", "p_name"), ("documents", "doc_id", "text")):
    QUERIES[f"embed_hash_{_name}"] = _embed(_name, _key, _text)
    ORACLES[f"embed_hash_{_name}"] = f"""
SELECT {_key} AS id, array_to_string(list_transform({sql_hash_embedding(_text)},
  lambda x: round(x::DOUBLE, 5)::VARCHAR), ',') AS vector FROM {_name}"""


# -- models of the user's -------------------------------------------------------------------

def embed_user_models(spark, sf):
    """Documents and queries, each embedded by a model of its own that runs in batches."""
    def of_documents():
        return lambda texts: [[len(t) % 89, t.count("e"), t.count(" ")] for t in texts]

    def of_queries():
        return lambda texts: [[len(t) % 97, 2 * t.count("e"), 1 + t.count(" ")] for t in texts]

    asked = embed(text_queries(spark, sf), of_queries, "text")
    rows = embed(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), of_documents, "text")
    return knn_join(asked, rows, K, "l2").select("qid", "id", "rank", tidy("distance"))


QUERIES["embed_user_models"] = embed_user_models
ORACLES["embed_user_models"] = f"""
WITH d AS (SELECT doc_id AS id, length(text) % 89 AS a, length(text) - length(replace(text, 'e', '')) AS b,
           length(text) - length(replace(text, ' ', '')) AS c FROM documents),
q AS (SELECT item_id AS qid, length(text) % 97 AS a, 2 * (length(text) - length(replace(text, 'e', ''))) AS b,
      1 + length(text) - length(replace(text, ' ', '')) AS c FROM benchmark),
near AS (SELECT qid, id, sqrt(((q.a - d.a) ** 2 + (q.b - d.b) ** 2 + (q.c - d.c) ** 2)::DOUBLE) AS distance FROM q, d)
SELECT qid, id, rank, {sql_tidy('distance')} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM near) WHERE rank <= {K}"""
