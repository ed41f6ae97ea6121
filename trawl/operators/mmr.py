"""Diversity re-ranking (maximal marginal relevance) of each query's nearest candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators.dense import arrow_schema, join_hits, knn_join, matrix_of, rank_best
from trawl.schema import Metric


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(length > 0, length, 1.0)


def pick(query: np.ndarray, candidates: np.ndarray, k: int, balance: float) -> list[int]:
    """Greedy choice: nearest first, then the best of relevance minus redundancy.

    Similarity is cosine whatever the search metric; the earliest candidate wins a tie.
    """
    unit = _unit(candidates)
    wanted = (unit * _unit(query[None, :])).sum(axis=1)
    chosen: list[int] = []
    redundancy = np.full(len(unit), -np.inf)
    for _ in range(min(k, len(unit))):
        score = balance * wanted - (1.0 - balance) * redundancy if chosen else wanted.copy()
        score[chosen] = -np.inf
        best = int(np.argmax(score))
        chosen.append(best)
        redundancy = np.maximum(redundancy, (unit * unit[best]).sum(axis=1))
    return chosen


def mmr(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    fetch_k: int = 20,
    lambda_mult: float = 0.5,
    metric: Metric | str = Metric.COSINE,
    *,
    qid: str = "qid",
    qvec: str = "embedding",
    id: str = "id",
    vec: str = "embedding",
    where: Column | None = None,
    hits: DataFrame | None = None,
) -> DataFrame:
    """``qid, id, rank, distance`` of the selected rows, in distance order.

    A group is one query's candidates, so it never holds more than ``fetch_k`` rows.
    ``hits`` supplies the candidates when a search has already found them.
    """
    pool = corpus if where is None else corpus.where(where)
    if hits is None:
        hits = knn_join(queries, pool, fetch_k, metric, qid=qid, qvec=qvec, id=id, vec=vec)
    vectors = pool.select(F.col(id).alias("id"), F.col(vec).alias("v"))
    asked = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv"))
    rows = join_hits(hits, vectors, queries, fetch_k).join(asked, "qid")
    out = T.StructType([
        T.StructField("qid", rows.schema["qid"].dataType),
        T.StructField("id", rows.schema["id"].dataType),
        T.StructField("distance", T.DoubleType()),
    ])
    wire = arrow_schema(out)

    def choose(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        query = matrix_of(group.column("qv").slice(0, 1))[0]
        picked = pick(query, matrix_of(group.column("v")), k, lambda_mult)
        return group.take(pa.array(sorted(picked))).select(["qid", "id", "distance"]).cast(wire)

    chosen = rows.groupBy("qid").applyInArrow(choose, out)
    return rank_best(chosen, k)
