"""Fusion of a full-text ranking and a vector ranking, for whole tables of queries."""

from __future__ import annotations

import enum
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.dense import join_hits, knn_join
from trawl.operators.lexical import LexicalIndex, best_scores, lexical_topk, web_topk
from trawl.schema import Metric


class Fusion(str, enum.Enum):
    """How the two branch rankings become one score (higher is better)."""

    RRF = "rrf"
    NORMALIZED = "normalized"
    WEIGHTED_SUM = "weighted_sum"


# The query constructors a configuration may name, and how each matches.
TSQUERY_MODES = {"plainto_tsquery": "all", "phraseto_tsquery": "phrase"}
#: The constructor whose queries are columns.
STRUCTURED = "websearch_to_tsquery"
#: Columns of a structured query, as ``web_match`` reads them.
WEB_COLUMNS = ("must", "should", "must_not", "phrases")


@dataclass(frozen=True)
class HybridConfig:
    """Windows, weights and scorer of a hybrid search; the defaults are published ones."""

    fusion: Fusion = Fusion.RRF
    rrf_k: int = 60
    primary_results_weight: float = 0.5
    secondary_results_weight: float = 0.5
    primary_top_k: int = 4
    secondary_top_k: int = 4
    scorer: str = "bm25"
    tsquery_function: str = "plainto_tsquery"

    @property
    def mode(self) -> str:
        if self.tsquery_function not in TSQUERY_MODES:
            raise ValueError(
                f"{self.tsquery_function} does not read a text: it needs a structured query"
            )
        return TSQUERY_MODES[self.tsquery_function]

    @property
    def structured(self) -> bool:
        """Whether queries are columns ``must, should, must_not, phrases`` and not a text."""
        return self.tsquery_function == STRUCTURED


def asks_words(queries: DataFrame) -> Column:
    """Whether a structured query has anything that a document must or should hold."""
    missing = [c for c in WEB_COLUMNS if c not in queries.columns]
    if missing:
        raise ValueError(f"structured queries need the columns {', '.join(missing)}")
    sizes = [F.size(F.coalesce(F.col(c), F.array().cast(queries.schema[c].dataType)))
             for c in ("must", "should", "phrases")]
    return sizes[0] + sizes[1] + sizes[2] > 0


def fuse(lexical: DataFrame, vector: DataFrame, config: HybridConfig) -> DataFrame:
    """``qid, id, score`` from ``(qid, id, score)`` and ``(qid, id, distance)`` rankings.

    Each branch is already cut to its window.  A document in one branch only gets that
    branch's part; for the weighted sum that means a missing distance counts as zero.
    """
    hits = lexical.select("qid", "id", F.lit(1).alias("branch"), F.col("score").alias("sc"))
    hits = hits.unionByName(
        vector.select("qid", "id", F.lit(2).alias("branch"), F.col("distance").alias("sc"))
    )
    is_vector = F.col("branch") == 2
    weight = F.when(is_vector, F.lit(float(config.primary_results_weight))).otherwise(
        F.lit(float(config.secondary_results_weight))
    )
    branch = Window.partitionBy("qid", "branch")
    fusion = Fusion(config.fusion)
    if fusion is Fusion.RRF:
        better = F.when(is_vector, F.col("sc")).otherwise(-F.col("sc"))
        hits = hits.withColumn("better", better)
        place = F.rank().over(branch.orderBy(F.col("better").asc_nulls_last()))
        part = F.lit(1.0) / (F.lit(float(config.rrf_k)) + place)
    elif fusion is Fusion.NORMALIZED:
        low, high = F.min("sc").over(branch), F.max("sc").over(branch)
        rise = F.when(is_vector, high - F.col("sc")).otherwise(F.col("sc") - low)
        part = F.when(high == low, F.lit(1.0)).otherwise(F.try_divide(rise, high - low)) * weight
    else:
        part = F.when(is_vector, -F.col("sc")).otherwise(F.col("sc")) * weight
    parts = hits.select("qid", "id", part.alias("part"))
    return parts.groupBy("qid", "id").agg(F.sum("part").alias("score"))


def hybrid_search(
    queries: DataFrame,
    corpus: DataFrame,
    index: LexicalIndex,
    k: int,
    config: HybridConfig = HybridConfig(),
    metric: Metric | str = Metric.COSINE,
    *,
    qid: str = "qid",
    text: str = "text",
    qvec: str = "embedding",
    id: str = "id",
    vec: str = "embedding",
    where: Column | None = None,
    vector_search: Callable[[DataFrame, int, Column | None], DataFrame] | None = None,
    columns: list[str] | None = None,
    alias: str = "score",
) -> DataFrame:
    """Best ``k`` documents per query by fused score: ``qid, id, rank, score[, columns]``.

    ``text`` is read as the configuration says; with ``websearch_to_tsquery`` the queries have the columns
    of ``web_match`` instead.  ``where`` filters the documents inside both branches.  ``vector_search(queries, k, where)``
    replaces the exact vector branch, e.g. by an approximate index.
    """
    keep = None
    if where is not None:
        keep = corpus.where(where).select(F.col(id).alias("id"))
    if config.structured:
        lexical = web_topk(index, queries.where(asks_words(queries)), config.secondary_top_k, config.scorer,
                           qid=qid, keep=keep)
    else:
        lexical = lexical_topk(
            index, queries, config.secondary_top_k, config.scorer, config.mode,
            qid=qid, text=text, keep=keep,
        )
    if vector_search is not None:
        vector = vector_search(queries, config.primary_top_k, where)
    else:
        vector = knn_join(queries, corpus, config.primary_top_k, metric, qid=qid, qvec=qvec,
                          id=id, vec=vec, where=where)
    best = best_scores(fuse(lexical, vector, config), k)
    best = best.withColumnRenamed("score", alias) if alias != "score" else best
    if not columns:
        return best
    extra = corpus.select(F.col(id).alias("id"), *[c for c in columns if c != id])
    return join_hits(best, extra, queries, k)


def refuse_fused_scores(fts_query=None, config: HybridConfig | None = None) -> None:
    """Scored search is by distance only: fused scores are rankings."""
    if fts_query or config:
        raise NotImplementedError(
            "a fused score is no distance; search() ranks by it"
        )
