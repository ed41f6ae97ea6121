"""Neighbour-graph search as rounds of joins.

The graph links every vector to its nearest neighbours (found within the nearest inverted-file
cells) and back.  A search keeps a beam of the ``ef_search`` best rows per query; each round joins
the beam's unexpanded rows with the graph, scores the new rows, and stops when no beam changes.
Rounds are cut by reliable checkpoints, so neither the plan nor the lineage grows.  Query tables too
large to broadcast walk in ``walk``, which ships no vectors of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.distance import distance
from trawl.operators.dense import knn_join, rank_best, small_queries
from trawl.operators.ivf import IvfIndex, check_search, probe_table, score_joined, score_pairs
from trawl.operators.quant import decode_table
from trawl.operators.walk import walk_beams
from trawl.schema import Metric
from trawl.session import cut_lineage

# Documented defaults of the graph and its search.
DEFAULT_M = 32
DEFAULT_EF_CONSTRUCTION = 200
FILTER_MODES = ("auto", "scan", "walk", "prune", "twohop", "bridge")
COLUMN_FILTERS = ("auto", "fold", "read")

ENTRY_CELLS = 8


def check_graph(m: int, ef_construction: int) -> None:
    if m < 2:
        raise ValueError(f"m must be at least 2, got {m}")
    if ef_construction < m:
        raise ValueError(f"ef_construction must be at least m={m}, got {ef_construction}")


@dataclass
class GraphIndex:
    """``edges`` (id, neighbours) over an inverted file that supplies entries and vectors."""

    ivf: IvfIndex
    edges: DataFrame
    entries: DataFrame
    m: int
    ef_construction: int

    index_type = "hnsw"

    @property
    def metric(self) -> Metric:
        return self.ivf.metric

    @property
    def cells(self) -> DataFrame:
        return self.ivf.cells

    @property
    def id(self) -> str:
        return self.ivf.id

    @property
    def vec(self) -> str:
        return self.ivf.vec

    @classmethod
    def build(cls, corpus: DataFrame, metric: Metric | str = Metric.COSINE, *, id: str = "id",
              vec: str = "embedding", m: int = DEFAULT_M,
              ef_construction: int = DEFAULT_EF_CONSTRUCTION, cells: int | None = None,
              **quantizer) -> "GraphIndex":
        check_graph(m, ef_construction)
        ivf = IvfIndex.build(corpus, metric, id=id, vec=vec, cells=cells, **quantizer)
        return cls.link(ivf, m, ef_construction)

    @classmethod
    def link(cls, ivf: IvfIndex, m: int = DEFAULT_M,
             ef_construction: int = DEFAULT_EF_CONSTRUCTION) -> "GraphIndex":
        check_graph(m, ef_construction)
        edges, entries = neighbour_edges(ivf, m, ef_construction), cell_entries(ivf)
        return cls(ivf, cut_lineage(edges), cut_lineage(entries), m, ef_construction)

    def search(self, queries: DataFrame, k: int, ef_search: int = -1, rescore_width: float = -1,
               *, qid: str = "qid", qvec: str = "embedding", where: Column | None = None) -> DataFrame:
        """``qid, id, rank, distance`` of the best ``k`` rows the walk reaches.

        The walk crosses rows that fail ``where`` but never returns them.  A beam as wide as
        the collection cannot miss a row, and is answered by the exact join.
        """
        check_search(ef_search=ef_search, rescore_width=rescore_width)
        ef = max(self.ef_construction, k) if ef_search == -1 else max(ef_search, k)
        if self.cells.limit(ef + 1).count() <= ef:
            return knn_join(queries, self.cells, k, self.metric, qid=qid, qvec=qvec, id=self.id,
                            vec=self.vec, where=where)
        asked = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv"))
        exact = self.cells.select(F.col(self.id).alias("id"), F.col(self.vec).alias("v"))
        coded = self.ivf.quantizer is not None
        vectors = exact
        if coded:
            vectors = decode_table(self.ivf.codes, self.ivf.quantizer)
            vectors = vectors.withColumnRenamed("embedding", "v")
        block = small_queries(queries, qid, qvec)
        allowed = None
        if where is not None:
            allowed = self.cells.where(where).select(F.col(self.id).alias("id"))
        if block is None:
            hits = walk_beams(asked, vectors, self.ivf, self.edges, self.entries, ef, ENTRY_CELLS, allowed)
        else:
            hits = self._walk(asked, vectors, ef, block, allowed)
        if coded and rescore_width != 0:
            hits = self._score(hits.select("qid", "id"), asked, exact, block)
        return rank_best(hits, k)

    def _score(self, pairs: DataFrame, asked: DataFrame, vectors: DataFrame, block) -> DataFrame:
        if block is None:
            return score_joined(pairs, vectors, asked, self.metric)
        out = T.StructType([
            T.StructField("qid", asked.schema["qid"].dataType),
            T.StructField("id", vectors.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ])
        return score_pairs(pairs, vectors, block, self.metric, out)

    def _walk(self, asked: DataFrame, vectors: DataFrame, ef: int, block,
              allowed: DataFrame | None) -> DataFrame:
        """The best ``ef`` rows per query the walk meets: ``qid, id, distance``.

        The state is the beam, never more than ``ef`` rows per query.  A row that left it may
        be met and scored again, but cannot return, as the beam only improves.  Under a filter
        the best ``ef`` allowed rows are kept beside it.
        """
        probes = probe_table(asked, self.ivf.centroids, ENTRY_CELLS, self.metric)
        first = probes.join(self.entries, "cell").select("qid", "id").distinct()
        fresh = self._score(first, asked, vectors, block)
        beam = cut_lineage(fresh.withColumn("open", F.lit(True)))
        found = None if allowed is None else self._keep(beam, None, allowed, ef)
        # Every round that opens a row improves some beam, so the walk ends by itself.
        while not (frontier := beam.where("open").select("qid", "id")).isEmpty():
            reached = (
                frontier.join(self.edges, "id")
                .select("qid", F.explode("neighbours").alias("id")).distinct()
                .join(beam.select("qid", "id"), ["qid", "id"], "left_anti")
            )
            fresh = self._score(reached, asked, vectors, block).withColumn("open", F.lit(True))
            if allowed is not None:
                fresh = cut_lineage(fresh)
                found = self._keep(fresh, found, allowed, ef)
            beam = cut_lineage(_best_rows(beam.withColumn("open", F.lit(False)).unionByName(fresh), ef))
        return beam.drop("open") if found is None else found

    @staticmethod
    def _keep(fresh: DataFrame, found: DataFrame | None, allowed: DataFrame, ef: int) -> DataFrame:
        passing = fresh.select("qid", "id", "distance").join(allowed, "id", "left_semi")
        passing = passing.select("qid", "id", "distance")
        if found is not None:
            passing = found.unionByName(passing).distinct()
        return cut_lineage(_best_rows(passing, ef))


def _best_rows(rows: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.col("distance").asc_nulls_last(), "id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def neighbour_edges(ivf: IvfIndex, m: int, ef_construction: int) -> DataFrame:
    """``id, neighbours``: the ``m`` nearest of the candidates in both directions.

    Candidates come from as many cells as it takes to see about ``ef_construction`` rows.
    """
    rows = ivf.cells.count()
    per_cell = max(1.0, rows / len(ivf.centroids))
    nprobe = min(len(ivf.centroids), 1 + math.ceil(ef_construction / per_cell))
    plain = IvfIndex(ivf.metric, ivf.centroids, ivf.cells, None, None, ivf.id, ivf.vec)
    asked = ivf.cells.select(F.col(ivf.id).alias("qid"), F.col(ivf.vec).alias("embedding"))
    near = plain.search(asked, m + 1, nprobe).where(F.col("qid") != F.col("id"))
    near = cut_lineage(near.select("qid", "id", "distance"))
    back = near.select(F.col("id").alias("qid"), F.col("qid").alias("id"), "distance")
    # Half of the links may lead back, so that rows nobody is nearest to stay reachable.
    forward = rank_best(near, m - m // 2)
    backward = rank_best(back, m // 2)
    links = forward.unionByName(backward).select("qid", "id").distinct()
    return links.groupBy(F.col("qid").alias("id")).agg(F.collect_list("id").alias("neighbours"))


def cell_entries(ivf: IvfIndex) -> DataFrame:
    """``cell, id``: the row nearest to each centroid, where walks begin."""
    spark = ivf.cells.sparkSession
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(ivf.centroids)]
    centres = spark.createDataFrame(rows, "cell int, centre array<double>")
    scored = ivf.cells.join(F.broadcast(centres), "cell").select(
        "cell", F.col(ivf.id).alias("id"),
        distance(Metric.L2, F.col(ivf.vec), F.col("centre")).alias("d"),
    )
    return scored.groupBy("cell").agg(F.min(F.struct("d", "id"))["id"].alias("id"))


def check_filter_modes(filter_mode: str | None, column_filter: str | None) -> None:
    if filter_mode is not None and filter_mode not in FILTER_MODES:
        raise ValueError(f"Invalid filter_mode: {filter_mode!r}")
    if column_filter is not None and column_filter not in COLUMN_FILTERS:
        raise ValueError(f"Invalid column_filter: {column_filter!r}")
