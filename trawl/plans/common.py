"""Shared pieces of the registered queries."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.embed import hash_embedding
from trawl.functions.text import Analyzer
from trawl.operators.lexical import LexicalIndex
from trawl.session import scratch_path
from trawl.sources.storage import Folder

DIM = 8
# The query vector of the one-query searches: a parameter, the same in both engines.
PROBE = [round(math.sin(i + 1), 4) for i in range(64)]
METRICS = ("cosine", "l2", "ip", "l1")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector of the table is also a query."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "id")


def embedded_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("embedding", hash_embedding(F.col("text"), DIM))


def text_queries(spark: SparkSession, sf: str, embedded: bool = False) -> DataFrame:
    """Every benchmark passage is a query."""
    out = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    if embedded:
        out = out.withColumn("embedding", hash_embedding(F.col("text"), DIM))
    return out


def tidy(column: str, digits: int = 6):
    """Rounded, without a negative zero."""
    return (F.round(F.col(column), digits) + F.lit(0.0)).alias(column)


_BUILT: dict[tuple, LexicalIndex] = {}


def document_index(spark: SparkSession, sf: str, analyzer: Analyzer = Analyzer("split")) -> LexicalIndex:
    """The text index of the documents, built once per application and then read."""
    key = (spark.sparkContext.applicationId, sf, analyzer)
    if key not in _BUILT:
        path = scratch_path(spark, f"text-index-{uuid.uuid4().hex}")
        built = LexicalIndex.build(documents(spark, sf), "id", "text", analyzer, positions=True,
                                   buckets=8)
        _BUILT[key] = built.write(Folder(spark, path), bounds=True)
    return _BUILT[key]


# -- SQL fragments -----------------------------------------------------------------------


def sql_distance(metric: str, a: str, b: str) -> str:
    if metric == "l1":
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2])))"
    name = {"cosine": "list_cosine_distance", "l2": "list_distance",
            "ip": "list_negative_inner_product"}[metric]
    return f"{name}({a}, {b})"


def sql_tidy(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def sql_relevance(metric: str, d: str = "distance") -> str:
    raw = {
        "cosine": f"1 - {d}",
        "l2": f"1 - {d} / sqrt(2.0::DOUBLE)",
        "ip": f"CASE WHEN {d} > 0 THEN 1 - {d} ELSE -{d} END",
        "l1": f"1 - {d} / 2",
    }[metric]
    return f"greatest(0.0, least(1.0, {raw}))"


def sql_knn(metric: str, k: int, corpus_where: str = "true") -> str:
    """CTE ``hits(qid, id, rank, distance)`` of all embeddings against all embeddings."""
    return f"""
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
hits AS (
  SELECT qid, id, rank, distance FROM (
    SELECT qid, id, distance,
           row_number() OVER (PARTITION BY qid ORDER BY distance NULLS LAST, id) AS rank
    FROM (SELECT q.vec_id AS qid, c.vec_id AS id, {sql_distance(metric, 'q.e', 'c.e')} AS distance
          FROM v q, v c WHERE {corpus_where})
  ) WHERE rank <= {k})"""


def sql_hash_embedding(text: str, dim: int = DIM) -> str:
    """The hash embedding as FLOAT[]; ``raw`` values are scaled by their length."""
    raw = ", ".join(
        f"('0x' || substr(sha256('{i}:' || {text}), 1, 2))::INTEGER / 255.0::DOUBLE"
        for i in range(dim)
    )
    return (
        f"list_transform([[{raw}]], lambda r: list_transform(r, lambda x: (x / "
        "CASE WHEN list_sum(list_transform(r, lambda y: y * y)) = 0 THEN 1.0::DOUBLE "
        "ELSE sqrt(list_sum(list_transform(r, lambda y: y * y))) END)::FLOAT))[1]"
    )


SQL_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"

SQL_POSTINGS = f"""
docs AS (SELECT doc_id AS id, {SQL_TOKENS} AS toks FROM documents),
occ AS (SELECT id, len(toks) AS dl, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM docs),
post AS (SELECT term, id, dl, count(*) AS tf FROM occ GROUP BY term, id, dl),
stats AS (SELECT term, count(*) AS df, sum(tf) AS ttf FROM post GROUP BY term),
tot AS (SELECT count(*)::DOUBLE AS n, sum(len(toks))::DOUBLE AS t FROM docs),
q AS (SELECT item_id AS qid, text, {SQL_TOKENS} AS toks FROM benchmark),
qt AS (SELECT qid, len(list_distinct(toks)) AS n_terms, unnest(list_distinct(toks)) AS term FROM q)"""

SQL_SCORES = {
    "bm25": "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE"
            " / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (t / n)))",
    "tfidf": "sqrt(tf::DOUBLE) * (1 + ln((n + 1) / (df + 1)))",
    "dfi": "CASE WHEN tf <= ttf * dl / t THEN 0.0::DOUBLE"
           " ELSE log2(1 + (tf - ttf * dl / t) / sqrt(ttf * dl / t)) END",
    "lm_dirichlet": "greatest(0.0::DOUBLE, ln(1 + tf / (2000.0::DOUBLE * (ttf / t)))"
                    " + ln(2000.0::DOUBLE / (dl + 2000.0::DOUBLE)))",
    "lm_jm": "ln(1 + (0.9::DOUBLE * tf / dl) / (0.1::DOUBLE * (ttf / t)))",
}


def sql_scored(scorer: str, every: bool) -> str:
    """CTE ``scored(qid, id, score)`` for terms all required or any."""
    having = "HAVING count(*) = max(n_terms)" if every else ""
    return f"""
scored AS (
  SELECT qid, id, round(sum({SQL_SCORES[scorer]}), 9) AS score
  FROM qt JOIN post USING (term) JOIN stats USING (term), tot
  GROUP BY qid, id {having})"""


def sql_best(k: int, source: str = "scored") -> str:
    return f"""
SELECT qid, id, rank, {sql_tidy('score')} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM {source}
) WHERE rank <= {k}"""
