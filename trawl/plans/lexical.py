"""Postings, statistics, full-text ranking, Boolean queries and hybrid fusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions.text import SPLIT_LOWER
from trawl.operators.filters import compile_filter
from trawl.operators.hybrid import Fusion, HybridConfig, hybrid_search
from trawl.operators.lexical import (
    best_scores, boolean_match, build_postings, corpus_totals, lexical_topk, score_hits,
    term_stats, web_match, web_topk,
)
from trawl.plans.common import (
    SQL_POSTINGS, SQL_TOKENS, document_index, documents, embedded_documents, sql_best,
    sql_hash_embedding, sql_scored, sql_tidy, text_queries, tidy,
)
from trawl.schema import CollectionSchema

K = 10
QUERIES: dict = {}
ORACLES: dict = {}


def analyze(spark, sf):
    tokens = SPLIT_LOWER.tokens(F.col("text"))
    return documents(spark, sf).select("id", F.size(tokens).alias("n_tokens"),
                                       F.md5(F.array_join(tokens, " ")).alias("tokens_md5"))


QUERIES["analyze_split"] = analyze
ORACLES["analyze_split"] = f"""
SELECT doc_id AS id, len({SQL_TOKENS}) AS n_tokens,
       md5(array_to_string({SQL_TOKENS}, ' ')) AS tokens_md5 FROM documents"""


def postings(spark, sf):
    rows = build_postings(documents(spark, sf), "id", "text", positions=True)
    return rows.withColumn("positions", F.md5(F.array_join("positions", ",")))


QUERIES["postings"] = postings
ORACLES["postings"] = f"""
WITH {SQL_POSTINGS}
SELECT term, id, count(*) AS tf, dl, md5(string_agg(pos::VARCHAR, ',' ORDER BY pos)) AS positions
FROM occ GROUP BY term, id, dl"""

QUERIES["term_stats"] = lambda spark, sf: term_stats(build_postings(documents(spark, sf), "id", "text"))
ORACLES["term_stats"] = f"WITH {SQL_POSTINGS} SELECT term, df, ttf::BIGINT AS ttf FROM stats"

QUERIES["corpus_totals"] = lambda spark, sf: corpus_totals(documents(spark, sf), "text")
ORACLES["corpus_totals"] = f"""
WITH {SQL_POSTINGS} SELECT n::BIGINT AS n_docs, t::BIGINT AS n_tokens FROM tot"""


def _ranked(scorer, mode, prune=None):
    def run(spark, sf):
        found = lexical_topk(document_index(spark, sf), text_queries(spark, sf), K, scorer, mode, prune=prune)
        return found.select("qid", "id", "rank", tidy("score"))
    return run


for _name, _scorer, _mode in (
    ("bm25", "bm25", "all"), ("bm25_any", "bm25", "any"), ("tfidf", "tfidf", "any"),
    ("tfidf_all", "TFIDF", "all"), ("dfi", "dfi", "any"), ("lm_dirichlet", "lm_dirichlet", "any"),
    ("lm_jm", "lm_jm", "any"),
):
    QUERIES[_name] = _ranked(_scorer, _mode)
    ORACLES[_name] = (
        f"WITH {SQL_POSTINGS}, {sql_scored(_scorer.lower(), _mode == 'all')} {sql_best(K)}"
    )


for _name, _scorer, _mode in (("bm25_any", "bm25", "any"), ("bm25", "bm25", "all"), ("dfi", "dfi", "any")):
    QUERIES[f"{_name}_pruned"] = _ranked(_scorer, _mode, True)
    ORACLES[f"{_name}_pruned"] = ORACLES[_name]


def tsquery_plain(spark, sf):
    """All matches of every query, ranked without a cut."""
    found = lexical_topk(document_index(spark, sf), text_queries(spark, sf), None)
    return found.select("qid", "id", "rank", tidy("score"))


QUERIES["tsquery_plain"] = tsquery_plain
ORACLES["tsquery_plain"] = (
    f"WITH {SQL_POSTINGS}, {sql_scored('bm25', True)} {sql_best(1 << 40)}"
)

QUERIES["tsquery_phrase"] = _ranked("bm25", "phrase")
ORACLES["tsquery_phrase"] = f"""
WITH {SQL_POSTINGS}, {sql_scored('bm25', True).replace('scored AS', 'every AS')},
scored AS (
  SELECT e.qid, e.id, e.score FROM every e JOIN docs d ON d.id = e.id JOIN q ON q.qid = e.qid
  WHERE contains(' ' || array_to_string(d.toks, ' ') || ' ', ' ' || array_to_string(q.toks, ' ') || ' '))
{sql_best(K)}"""


def tsquery_web(spark, sf):
    """Structured web queries: the last word in dictionary order must, the first must not occur."""
    tokens = SPLIT_LOWER.tokens(F.col("text"))
    asked = text_queries(spark, sf).select(
        "qid", F.array(F.array_max(tokens)).alias("must"), F.array_distinct(tokens).alias("should"),
        F.array(F.array_min(tokens)).alias("must_not"),
        F.array().cast("array<array<string>>").alias("phrases"),
    )
    index = document_index(spark, sf)
    found = web_topk(index, asked, K)
    return found.select("qid", "id", "rank", tidy("score"))


QUERIES["tsquery_web"] = tsquery_web
ORACLES["tsquery_web"] = f"""
WITH {SQL_POSTINGS},
shape AS (SELECT qid, list_max(toks) AS must, list_min(toks) AS banned FROM q),
good AS (SELECT qid, id FROM shape JOIN post ON term = must
         EXCEPT SELECT qid, id FROM shape JOIN post ON term = banned),
{sql_scored('bm25', False).replace('scored AS', 'every AS')},
scored AS (SELECT every.* FROM every SEMI JOIN good USING (qid, id))
{sql_best(K)}"""


def tsquery_web_phrase(spark, sf):
    """Every benchmark passage as a quoted phrase."""
    empty = F.array().cast("array<string>")
    asked = text_queries(spark, sf).select(
        "qid", empty.alias("must"), empty.alias("should"), empty.alias("must_not"),
        F.array(SPLIT_LOWER.tokens(F.col("text"))).alias("phrases"),
    )
    index = document_index(spark, sf)
    found = web_topk(index, asked, K)
    return found.select("qid", "id", "rank", tidy("score"))


QUERIES["tsquery_web_phrase"] = tsquery_web_phrase
ORACLES["tsquery_web_phrase"] = ORACLES["tsquery_phrase"]

EXPRESSION = {"or": [
    {"and": ["the", "of", {"not": "is"}]},
    {"and": [{"phrase": ["in", "the"]}, {"not": {"or": ["and", "that"]}}]},
    {"and": ["der", "die"]},
]}


def tsquery_bool(spark, sf):
    return boolean_match(document_index(spark, sf), EXPRESSION)


def tsquery_bool_negative(spark, sf):
    ids = documents(spark, sf).select("id")
    return boolean_match(document_index(spark, sf), {"not": {"or": ["the", "les"]}}, ids)


QUERIES["tsquery_bool"] = tsquery_bool
ORACLES["tsquery_bool"] = f"""
WITH {SQL_POSTINGS}, s AS (SELECT id, toks, ' ' || array_to_string(toks, ' ') || ' ' AS line FROM docs)
SELECT id FROM s
WHERE (list_contains(toks, 'the') AND list_contains(toks, 'of') AND NOT list_contains(toks, 'is'))
   OR (contains(line, ' in the ') AND NOT (list_contains(toks, 'and') OR list_contains(toks, 'that')))
   OR (list_contains(toks, 'der') AND list_contains(toks, 'die'))"""
QUERIES["tsquery_bool_negative"] = tsquery_bool_negative
ORACLES["tsquery_bool_negative"] = f"""
WITH {SQL_POSTINGS} SELECT id FROM docs WHERE NOT list_has_any(toks, ['the', 'les'])"""

# -- hybrid ------------------------------------------------------------------------------

WINDOW = 10
PLACES = CollectionSchema(id_column="id", content_column="text",
                          metadata_columns={"lang": "TEXT", "n_chars": "BIGINT"}, json_column=None)
HYBRID_FILTER = {"lang": {"$in": ["en", "de"]}, "n_chars": {"$gte": 300}}


def _hybrid(fusion, spec=None, scorer="bm25", k=K):
    def run(spark, sf):
        config = HybridConfig(fusion=fusion, scorer=scorer, primary_top_k=WINDOW,
                              secondary_top_k=WINDOW, primary_results_weight=0.3,
                              secondary_results_weight=0.7)
        where = compile_filter(spec, PLACES) if spec else None
        found = hybrid_search(
            text_queries(spark, sf, True), embedded_documents(spark, sf),
            document_index(spark, sf), k, config, "cosine", where=where,
        )
        return found.select("qid", "id", "rank", tidy("score", 5))
    return run


# Both rankings side by side, one row per document: text score ``t``, distance ``d``.
_BOTH = """
pair AS (SELECT qid, id, t, d FROM (SELECT qid, id, sc AS t FROM lex)
  FULL JOIN (SELECT qid, id, sc AS d FROM vec) USING (qid, id))"""
_FUSED = {
    "rrf": f"""{_BOTH},
fused AS (SELECT qid, id,
    coalesce(1.0::DOUBLE / (60 + CASE WHEN t IS NOT NULL THEN (
      SELECT count(*) + 1 FROM lex WHERE lex.qid = pair.qid AND lex.sc > pair.t) END), 0)
  + coalesce(1.0::DOUBLE / (60 + CASE WHEN d IS NOT NULL THEN (
      SELECT count(*) + 1 FROM vec WHERE vec.qid = pair.qid AND vec.sc < pair.d) END), 0) AS score FROM pair)""",
    "normalized": f"""{_BOTH},
span AS (SELECT qid, min(t) AS t0, max(t) - min(t) AS dt, max(d) AS d1, max(d) - min(d) AS dd
         FROM pair GROUP BY qid),
fused AS (SELECT qid, id,
    0.7::DOUBLE * coalesce(if(dt = 0, t - t + 1, (t - t0) / dt), 0)
  + 0.3::DOUBLE * coalesce(if(dd = 0, d - d + 1, (d1 - d) / dd), 0) AS score FROM pair JOIN span USING (qid))""",
    "weighted_sum": f"""{_BOTH},
fused AS (SELECT qid, id, 0.7::DOUBLE * coalesce(t, 0) - 0.3::DOUBLE * coalesce(d, 0) AS score FROM pair)""",
}


def _sql_hybrid(fusion, where="true", scorer="bm25"):
    return f"""
WITH {SQL_POSTINGS}, {sql_scored(scorer, True).replace('scored AS', 'every AS')},
allowed AS (SELECT doc_id AS id, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM documents WHERE {where}),
lex AS (SELECT qid, id, sc FROM (
  SELECT qid, id, score AS sc, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS n
  FROM every SEMI JOIN allowed USING (id)) WHERE n <= {WINDOW}),
qe AS (SELECT item_id AS qid, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM benchmark),
vec AS (SELECT qid, id, sc FROM (
  SELECT qid, id, sc, row_number() OVER (PARTITION BY qid ORDER BY sc, id) AS n
  FROM (SELECT qid, id, list_cosine_distance(qe.e, allowed.e) AS sc FROM qe, allowed)) WHERE n <= {WINDOW}),
{_FUSED[fusion]}
SELECT qid, id, rank, {sql_tidy('score', 5)} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM fused
) WHERE rank <= {K}"""


for _fusion in Fusion:
    QUERIES[f"hybrid_{_fusion.value}"] = _hybrid(_fusion)
    ORACLES[f"hybrid_{_fusion.value}"] = _sql_hybrid(_fusion.value)
QUERIES["hybrid_filtered"] = _hybrid(Fusion.RRF, HYBRID_FILTER)
ORACLES["hybrid_filtered"] = _sql_hybrid("rrf", "lang IN ('en', 'de') AND n_chars >= 300")
QUERIES["hybrid_tfidf"] = _hybrid(Fusion.NORMALIZED, scorer="TFIDF")
ORACLES["hybrid_tfidf"] = _sql_hybrid("normalized", scorer="tfidf")


def hybrid_web(spark, sf):
    """Text branch by structured web queries, those of ``tsquery_web``."""
    tokens = SPLIT_LOWER.tokens(F.col("text"))
    asked = text_queries(spark, sf, True).select(
        "qid", "embedding", F.array(F.array_max(tokens)).alias("must"), F.array_distinct(tokens).alias("should"),
        F.array(F.array_min(tokens)).alias("must_not"), F.array().cast("array<array<string>>").alias("phrases"))
    config = HybridConfig(tsquery_function="websearch_to_tsquery", primary_top_k=WINDOW, secondary_top_k=WINDOW)
    found = hybrid_search(asked, embedded_documents(spark, sf), document_index(spark, sf), K, config, "cosine")
    return found.select("qid", "id", "rank", tidy("score", 5))


QUERIES["hybrid_web"] = hybrid_web
ORACLES["hybrid_web"] = _sql_hybrid("rrf").replace(sql_scored("bm25", True).replace("scored AS", "every AS"), f"""
shape AS (SELECT qid, list_max(toks) AS must, list_min(toks) AS banned FROM q),
good AS (SELECT qid, id FROM shape JOIN post ON term = must
         EXCEPT SELECT qid, id FROM shape JOIN post ON term = banned),
{sql_scored('bm25', False).replace('scored AS', 'loose AS')},
every AS (SELECT loose.* FROM loose SEMI JOIN good USING (qid, id))""")


def hybrid_rows(spark, sf):
    """Fused hits joined back to the columns of their documents."""
    found = hybrid_search(
        text_queries(spark, sf, True), embedded_documents(spark, sf), document_index(spark, sf),
        4, HybridConfig(), "cosine", columns=["lang", "source", "n_chars"],
    )
    return found.select("qid", "id", "rank", tidy("score"), "lang", "source", "n_chars")


QUERIES["hybrid_rows"] = hybrid_rows
ORACLES["hybrid_rows"] = (
    _sql_hybrid("rrf").replace(f"n <= {WINDOW}", "n <= 4").replace(f"rank <= {K}", "rank <= 4")
    .replace(sql_tidy("score", 5), sql_tidy("score"))
    .replace(f"SELECT qid, id, rank, {sql_tidy('score')} AS score FROM",
             f"SELECT qid, id, rank, {sql_tidy('score')} AS score, lang, source, n_chars FROM", 1)
    + " AND true"
).replace("rank FROM fused", "rank, lang, source, n_chars FROM fused JOIN documents ON doc_id = id")

