"""Exact answers from few cells of an IVF index.

Each cell keeps the greatest distance of its vectors from its centroid. A cell whose centroid is further
from a query than that and the query's k-th distance holds none of its neighbours. So a query first reads
the nearest cells that together have ``k`` rows (those that pass the filter are counted beforehand,
from the filter's own columns), and then whichever others its k-th distance does not rule out.

Query tables too large to broadcast are dealt to their nearest centroids. Cells, and queries, are packed
into bounded blocks, and a block of queries meets those blocks of cells that one of its queries wants.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators import dense
from trawl.operators.dense import (
    Best, arrow_schema, coarse, id_values, matrix_of, rank_best, result_schema, small_queries,
)
from trawl.operators.voronoi import METRICS, in_space
from trawl.schema import Metric
from trawl.session import cut_lineage


def cell_radii(cells: DataFrame, centroids: np.ndarray, metric: Metric, vec: str) -> DataFrame:
    """``cell, n, radius``: rows of each cell, and the greatest distance of one from the centroid."""
    shared = cells.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(1).to_numpy()
            points, _ = in_space(metric, matrix_of(batch.column(0)))
            far = np.sqrt(((points - shared.value[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(far)], names=["cell", "far"])

    return (cells.select(vec, "cell").mapInArrow(run, "cell int, far double")
            .groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")))


@dataclass
class Proven:
    """Hits, and how many cells were read of how many there are, by query on average and in all."""

    hits: DataFrame
    cells_read: float
    cells: int


def proven_search(index, queries: DataFrame, k: int, *, where: Column | None = None, qid: str = "qid",
                  qvec: str = "embedding") -> Proven | None:
    """``qid, id, rank, distance`` of the exact ``k`` nearest rows that pass; None where cells prove
    nothing: inner products, or an index without radii."""
    if index.metric not in METRICS or index.metric is Metric.L1 or getattr(index, "radii", None) is None or k < 1:
        return None
    block = small_queries(queries, qid, qvec)
    many = len(index.centroids)
    radius, rows = np.full(many, -np.inf), np.zeros(many, np.int64)
    for r in index.radii.collect():  # one row for each cell
        radius[r["cell"]], rows[r["cell"]] = r["radius"], r["n"]
    if where is not None:
        rows[:] = 0
        for r in index.cells.where(where).groupBy("cell").count().collect():
            rows[r["cell"]] = r["count"]
    if block is None:
        return _in_blocks(index, queries, k, radius, rows, where, qid, qvec)
    points, defined = in_space(index.metric, block.vectors)
    if not len(points):
        return Proven(index.search(queries, k, qid=qid, qvec=qvec, where=where), 0.0, many)
    apart = coarse(Metric.L2, points, index.centroids)
    first = _first_cells(apart, rows, k)
    found = cut_lineage(rank_best(_read(index, queries, block, k, first, qid, where), k))
    place = {q: i for i, q in enumerate(block.ids.tolist())}
    kth = np.full(len(points), np.inf)
    for r in found.where(F.col("rank") == k).select("qid", "distance").collect():  # one row for each query
        if r["distance"] is not None:
            kth[place[r["qid"]]] = r["distance"]
    later = _later_cells(index, points, defined, apart, kth, radius, rows) & ~first
    hits = found
    if later.any():
        more = _read(index, queries, block, k, later, qid, where)
        hits = rank_best(found.select("qid", "id", "distance").unionByName(more), k)
    return Proven(hits, float((first | later).sum(axis=1).mean()), many)


def _first_cells(apart: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """(queries, cells): the nearest cells up to the one that completes k rows; empty ones are never read."""
    near = np.argsort(apart, axis=1, kind="stable")
    held = np.cumsum(rows[near], axis=1)
    first = np.zeros(apart.shape, bool)
    np.put_along_axis(first, near, np.concatenate([np.zeros((len(apart), 1)), held[:, :-1]], axis=1) < k, axis=1)
    return first & (rows > 0)


def _later_cells(index, points, defined, apart, kth, radius, rows) -> np.ndarray:
    """(queries, cells): cells that the k-th distance does not rule out."""
    if index.metric is Metric.COSINE:
        kth = np.sqrt(2 * np.maximum(kth, 0.0))
    reach = np.sqrt((points * points).sum(axis=1)).max(initial=0.0) + np.abs(index.centroids).max() + np.where(radius > 0, radius, 0).max()
    return ((apart - radius <= (kth + 4e-6 * reach)[:, None]) | ~defined[:, None]) & (rows > 0)


def _packed(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and in how many it is cut: neighbouring small cells share one, of at most
    ``most`` rows together."""
    cuts = np.maximum(1, -(-sizes // most))
    place, used, start = 0, 0, np.zeros(len(sizes), np.int64)
    for cell, n in enumerate(sizes.tolist()):
        if used and used + n > most:
            place, used = place + 1, 0
        start[cell] = place
        used += n
        if cuts[cell] > 1:
            place, used = place + cuts[cell], 0
    return start, cuts


@dataclass
class _Plan:
    """What tasks need to know of an index: ``MAX_CELLS`` numbers and centroids at most."""

    metric: Metric
    centroids: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    cuts: np.ndarray

    def wanted(self, x: np.ndarray, kth: np.ndarray | None, k: int) -> np.ndarray:
        points, defined = in_space(self.metric, x)
        apart = coarse(Metric.L2, points, self.centroids)
        first = _first_cells(apart, self.rows, k)
        if kth is None:
            return first
        return _later_cells(self, points, defined, apart, kth, self.radius, self.rows) & ~first

    def home(self, x: np.ndarray) -> np.ndarray:
        return coarse(Metric.L2, in_space(self.metric, x)[0], self.centroids).argmin(axis=1)


def _pieces(batch: pa.RecordBatch, cells: int) -> Iterator[pa.RecordBatch]:
    step = max(1, (1 << 21) // cells)
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _in_blocks(index, queries: DataFrame, k: int, radius: np.ndarray, rows: np.ndarray, where: Column | None,
               qid: str, qvec: str) -> Proven:
    """The search for query tables of any size."""
    many = len(index.centroids)
    starts, cuts = _packed(rows, dense.CORPUS_BLOCK)
    plan = _Plan(index.metric, index.centroids, radius, rows, starts, cuts)
    shared = queries.sparkSession.sparkContext.broadcast(plan)
    asked = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv"))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, many):
                home = shared.value.home(matrix_of(part.column(1)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int32())], names=["qid", "qv", "home"])

    placed = asked.mapInArrow(homes, T.StructType([*asked.schema, T.StructField("home", T.IntegerType())]))
    counts = np.zeros(many, np.int64)
    for r in placed.groupBy("home").count().collect():  # one row for each cell
        counts[r["home"]] = r["count"]
    q_starts, q_cuts = _packed(counts, dense.QUERY_BLOCK)

    def number(column: str, values: np.ndarray) -> Column:
        return F.get(F.lit(values.tolist()), F.col(column))

    placed = placed.withColumn("qb", (number("home", q_starts) + F.pmod(F.xxhash64("qid"), number("home", q_cuts))).cast("int"))
    placed = placed.drop("home")
    table = index.cells if where is None else index.cells.where(where)
    right = table.select(
        F.col(index.id).alias("id"), F.col(index.vec).alias("v"), "cell",
        (number("cell", starts) + F.pmod(F.xxhash64(index.id), number("cell", cuts))).cast("int").alias("cb"))
    out = result_schema(queries, qid, index.cells, index.id)
    found, read = _wave(shared, placed, right, k, out)
    found = cut_lineage(rank_best(found, k))
    kth = found.where(F.col("rank") == k).select("qid", F.col("distance").alias("kth"))
    more, again = _wave(shared, placed.join(kth, "qid", "left"), right, k, out)
    hits = rank_best(found.select("qid", "id", "distance").unionByName(more), k)
    return Proven(hits, (read + again) / max(1, int(counts.sum())), many)


def _wave(shared, asked: DataFrame, right: DataFrame, k: int, out: T.StructType) -> tuple[DataFrame, int]:
    """The best ``k`` of every query in each block of cells it wants, and how many cells queries want in all."""
    wire, judged = arrow_schema(out), "kth" in asked.columns
    names = ["qid", "qv", "qb", "cb", "cells"]
    schema = T.StructType([asked.schema["qid"], asked.schema["qv"], T.StructField("qb", T.IntegerType()),
                           T.StructField("cb", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def wishes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        many, blocks = len(plan.centroids), int((plan.starts + plan.cuts).max())
        for batch in batches:
            for part in _pieces(batch, many):
                kth = None
                if judged:
                    kth = part.column(3).to_numpy(zero_copy_only=False).astype(float)
                    kth = np.where(np.isnan(kth), np.inf, kth)
                q, cell = np.nonzero(plan.wanted(matrix_of(part.column(1)), kth, k))
                # Cells are packed in order, so a query's cells of one block follow one another.
                cuts = plan.cuts[cell]
                q, cell = np.repeat(q, cuts), np.repeat(cell, cuts)
                block = plan.starts[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                fresh = np.flatnonzero(np.diff(q * blocks + block, prepend=-1))
                lists = pa.ListArray.from_arrays(pa.array(np.append(fresh, len(cell)), pa.int32()), pa.array(cell, pa.int32()))
                at = pa.array(q[fresh])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), part.column(2).take(at),
                     pa.array(block[fresh], pa.int32()), lists], names=names)

    left = asked.select("qid", "qv", "qb", *(["kth"] if judged else [])).mapInArrow(wishes, schema)
    # One row for each pair of blocks; a cell in several blocks is one cell.
    pairs = left.groupBy("qb", "cb").agg(F.sum(F.size("cells")).alias("n"))
    pairs = cut_lineage(pairs)
    read = pairs.agg(F.sum("n")).first()[0] or 0
    metric = shared.value.metric

    def kernel(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return wire.empty_table()
        best = Best(metric, matrix_of(queries.column("qv")), k)
        lists = queries.column("cells").combine_chunks()
        cells, asks = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        order = np.argsort(cells, kind="stable")
        cells, asks = cells[order], asks[order]
        ids, x, own = id_values(rows.column("id")), matrix_of(rows.column("v")), rows.column("cell").to_numpy()
        for cell in np.unique(own):
            some = asks[np.searchsorted(cells, cell):np.searchsorted(cells, cell, side="right")]
            if len(some):
                here = own == cell
                best.add(ids[here], x[here], some)
        return pa.Table.from_batches([best.batch(id_values(queries.column("qid")), wire)])

    copies = right.join(pairs.select("qb", "cb"), "cb")
    return dense.pair_blocks(left, copies, ["qb", "cb"], kernel, out), int(read)


def _read(index, queries: DataFrame, block, k: int, wanted: np.ndarray, qid: str, where: Column | None) -> DataFrame:
    """The best ``k`` of every query and task among the cells it wants."""
    probes = {int(c): np.flatnonzero(wanted[:, c]) for c in np.flatnonzero(wanted.any(axis=0))}
    return index.scan(queries, block, k, probes, qid, where, result_schema(queries, qid, index.cells, index.id))
