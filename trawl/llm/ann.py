"""Approximate nearest neighbours by stable projections and an incremental kd-tree search.

Vectors are projected onto a few Gaussian directions. The squared length of a projected difference,
divided by the squared true distance, follows a chi-square law with as many degrees of freedom, so
that projected neighbours, taken nearest first and verified one after another, can stop as soon as
a vector closer than the k-th verified one would, with the wanted probability, have come up already.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import batch_of

#: Rows under one kd-tree, rows in a leaf, and bytes of the queries that are sent out at a time.
BLOCK_ROWS, LEAF_ROWS, WAVE_BYTES = 16_384, 128, 16 << 20


def chi_square_cdf(x: float, dims: int) -> float:
    """The lower regularised incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    a, half = dims / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-15 and n < 10_000:
        n += 1
        term *= half / (a + n)
        total += term
    return min(1.0, math.exp(a * math.log(half) - half - math.lgamma(a)) * total)


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, float(dims)
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < p else (low, mid)
    return high


class ProjectedTree:
    """A kd-tree over the projections of one block of vectors, kept as its leaves and their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: np.ndarray):
        points = vectors @ directions
        # Products of the same vector in two matrices may differ by this much of its length.
        self.rounding = 4 * len(directions) * np.finfo(float).eps * np.linalg.norm(directions)
        leaves, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF_ROWS:
                leaves.append(rows)
                continue
            axis = int(np.ptp(points[rows], axis=0).argmax())
            rows = rows[np.argsort(points[rows, axis], kind="stable")]
            todo += [rows[len(rows) // 2:], rows[:len(rows) // 2]]
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.ends = np.cumsum([len(x) for x in leaves])
        self.starts = self.ends - [len(x) for x in leaves]
        self.low = np.stack([points[x].min(axis=0) for x in leaves])
        self.high = np.stack([points[x].max(axis=0) for x in leaves])

    def search(self, query_id, vector: np.ndarray, point: np.ndarray, k: int, stop: float):
        """(ids, distances) of the k nearest verified vectors, nearest first, ties to smaller ids.

        Leaves come up in the order of their boxes' projected distance. A leaf or point is passed
        over, and the search over, once its squared projected distance is more than ``stop`` times the
        square of the k-th best, beyond rounding; so copies of the query are all verified.
        """
        length = np.linalg.norm(vector)
        gap = np.maximum(self.low - point, 0) + np.maximum(point - self.high, 0)
        near = np.einsum("ij,ij->i", gap, gap)
        ids, best, most = np.zeros(0, self.ids.dtype), np.zeros(0), np.inf
        for leaf in np.argsort(near, kind="stable"):
            if near[leaf] > most:
                break
            at = slice(self.starts[leaf], self.ends[leaf])
            apart = self.points[at] - point
            take = np.flatnonzero((np.einsum("ij,ij->i", apart, apart) <= most)
                                  & (self.ids[at] != query_id)) + self.starts[leaf]
            if not len(take):
                continue
            exact = np.sqrt(((self.vectors[take] - vector) ** 2).sum(axis=1))
            ids, best = np.concatenate([ids, self.ids[take]]), np.concatenate([best, exact])
            order = np.lexsort((ids, best))
            ids, best = ids[order], best[order]
            # A repeated id counts once, at its smallest distance.
            first = np.sort(np.unique(ids, return_index=True)[1])[:k]
            ids, best = ids[first], best[first]
            kth = best[-1] if len(best) == k else np.inf
            most = (math.sqrt(stop) * kth + self.rounding * (length + kth)) ** 2
        return ids, best


def _clean(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite components that are not all zero."""
    values = F.col(vector).cast("array<double>")
    df = df.select(F.col(id_column).cast("long").alias("id"), values.alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return df.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite
                    & F.exists("v", lambda x: x != 0))


def projected_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
                         vector: str = "embedding", dims: int = 16, certainty: float = 0.95,
                         seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query, by Euclidean distance.

    Ranks go from 1, ties to the smaller id; a query's own id is no candidate of it. Every true
    neighbour is found with at least probability ``certainty``: the bound is held in each block of
    rows against the block's own k-th best, which is never closer than that of the whole table.

    Null vectors, zero ones and those holding null or non-finite components take no part, nor do
    vectors of another width than the commonest among the queries (the smaller on a tie). A repeated
    id counts once, at its nearest; of a repeated query id the smallest vector asks. With fewer than
    k candidates all are returned; without queries or candidates the result is empty.

    The queries go out in waves of bounded size, and the vectors are read in place: what is shuffled
    is k rows for each query and block.
    """
    spark = vectors.sparkSession
    rows = _clean(vectors, id_column, vector)
    asked = _clean(queries, id_column, vector).groupBy("id").agg(F.min("v").alias("v"))
    widths = asked.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    schema = "query_id long, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = widths["width"], widths["count"]
    asked, rows = asked.where(F.size("v") == width), rows.where(F.size("v") == width)
    wave = max(1, WAVE_BYTES // (8 * width + 8))
    waves = -(-total // wave)
    directions = np.random.default_rng(seed).standard_normal((width, dims))
    stop = chi_square_quantile(certainty, dims)
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def searcher(shared):
        def run(batches):
            query_ids, query_vectors = shared.value
            points = query_vectors @ directions

            def block(ids, parts):
                tree = ProjectedTree(np.concatenate(ids), np.concatenate(parts), directions)
                found = [tree.search(q, v, p, k, stop) for q, v, p in zip(query_ids, query_vectors, points)]
                counts = [len(x) for x, _ in found]
                return batch_of(out, np.repeat(query_ids, counts), np.concatenate([x for x, _ in found]),
                                np.concatenate([d for _, d in found]))

            ids, parts, held = [], [], 0
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    piece = batch.slice(start, BLOCK_ROWS)
                    ids.append(piece.column(0).to_numpy())
                    parts.append(piece.column(1).flatten().to_numpy().reshape(-1, width))
                    held += piece.num_rows
                    if held >= BLOCK_ROWS:
                        yield block(ids, parts)
                        ids, parts, held = [], [], 0
            if held:
                yield block(ids, parts)

        return run

    found = None
    for n in range(waves):
        part = asked if waves == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == n)
        sent = part.orderBy("id").toArrow()  # about WAVE_BYTES
        if not sent.num_rows:
            continue
        flat = sent["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        shared = spark.sparkContext.broadcast((sent["id"].to_numpy(), flat))
        hits = rows.mapInArrow(searcher(shared), schema)
        found = hits if found is None else found.unionAll(hits)
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(nearest)).where(f"rank <= {k}")
            .select("query_id", "rank", "vec_id", "score"))
