"""Exact nearest-neighbour join of two large tables over the Voronoi cells of pivots.

Both tables are dealt to the nearest of a bounded number of pivots.  For a cell of queries, the ``k``
corpus rows nearest to each pivot bound how far a k-th neighbour can be, and the triangle inequality
tells from a corpus row's distance to the cell's pivot whether it can be that near to any query of
the cell.  A row is copied to those cells only, in place of to every block of queries.  Cells with
many rows are cut into blocks, so one cell may hold a third of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators import dense
from trawl.schema import Metric

#: Pivots at most, and corpus rows per pivot below that.
MAX_PIVOTS, ROWS_PER_PIVOT = 1024, 2048
#: Rows the pivots are settled on, at most.  Any pivots give the same result.
PIVOT_ROWS = 8192
#: Distances to pivots kept on the driver, at most.
MAX_NEAREST = 1_000_000
#: Metrics with a triangle inequality; cosine has one between unit vectors.
METRICS = (Metric.L2, Metric.L1, Metric.COSINE)


def in_space(metric: Metric, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points between which distances obey the triangle inequality, and which rows have any."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if metric is Metric.COSINE:
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        defined = np.isfinite(x).all(axis=1)
    return np.where(defined[:, None], x, 0.0), defined


def apart(metric: Metric, x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return dense.coarse(Metric.L1 if metric is Metric.L1 else Metric.L2, x, pivots)


def settle(metric: Metric, x: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """``count`` pivots at most: evenly taken rows, moved to the middle of their cells."""
    pivots = np.unique(x, axis=0)
    if len(pivots) > count:
        pivots = pivots[np.linspace(0, len(pivots) - 1, count).astype(int)]
        for _ in range(rounds if metric is not Metric.L1 else 0):
            cell = apart(metric, x, pivots).argmin(axis=1)
            sizes = np.bincount(cell, minlength=len(pivots))
            sums = np.zeros_like(pivots)
            np.add.at(sums, cell, x)
            pivots = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], pivots)
    return pivots


@dataclass
class Cells:
    """Where queries lie and which corpus rows they need."""

    metric: Metric
    pivots: np.ndarray
    #: Per cell: queries, and how far a needed row may be from the pivot, and half as far again
    #: as from its own pivot; -1 for cells without queries.
    queries: np.ndarray
    reach: np.ndarray
    lead: np.ndarray
    #: Corpus rows copied to each cell.
    copies: np.ndarray

    def needed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every copy of the rows ``x``; rows without a distance have none."""
        points, defined = in_space(self.metric, x)
        d = apart(self.metric, points, self.pivots)
        nearest = d.min(axis=1)[:, None]
        take = (d <= self.reach) & ((d - nearest) / 2 <= self.lead) & defined[:, None]
        return np.nonzero(take)

    @property
    def query_blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.queries // dense.QUERY_BLOCK))

    @property
    def corpus_blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.copies // dense.CORPUS_BLOCK))

    @property
    def pairs(self) -> int:
        """Pairs of blocks to compare."""
        return int((self.query_blocks * self.corpus_blocks)[self.queries > 0].sum())

    @property
    def shipped(self) -> int:
        """Rows of both tables that are shuffled."""
        return int((self.queries * self.corpus_blocks + self.copies * self.query_blocks)[self.queries > 0].sum())


def plan_cells(queries: DataFrame, corpus: DataFrame, k: int, metric: Metric, pivots: int | None = None) -> Cells | None:
    """Cells for ``queries`` (``qid, qv``) and ``corpus`` (``id, v``); None if fewer than ``k`` corpus
    rows have a distance to anything."""
    rows = corpus.count()
    count = pivots or int(np.clip(rows // ROWS_PER_PIVOT, 1, MAX_PIVOTS))
    count = max(1, min(count, MAX_NEAREST // max(1, k)))
    taken = (corpus.select("v").orderBy(F.xxhash64("id"), "id").limit(PIVOT_ROWS).toArrow()["v"])
    points, defined = in_space(metric, dense.matrix_of(taken))
    if not defined.any():
        return None
    where = settle(metric, points[defined], count)
    near, n, longest = _nearest(corpus, metric, where, k)
    if n < k:
        return None
    asked = _asked(queries, metric, where)
    between = apart(metric, where, where)
    longest = max(longest, asked[:, 2].max(initial=0.0), np.sqrt((where * where).sum(axis=1)).max())
    slack = 4e-6 * longest
    reach, lead = np.full(len(where), -1.0), np.full(len(where), -1.0)
    for cell, _, _, far in asked:
        cell = int(cell)
        # Queries of the cell have k rows within their own distance to the pivot and this.
        bound = np.partition((between[cell][near[:, 0].astype(int)] + near[:, 1]), k - 1)[k - 1]
        reach[cell] = 2 * far + bound + slack
        lead[cell] = far + bound + slack
    sizes = np.zeros(len(where), np.int64)
    sizes[asked[:, 0].astype(int)] = asked[:, 1].astype(np.int64)
    cells = Cells(metric, where, sizes, reach, lead, np.zeros(len(where), np.int64))
    cells.copies = _copies(corpus, cells)
    return cells


def _nearest(corpus: DataFrame, metric: Metric, pivots: np.ndarray, k: int) -> tuple[np.ndarray, int, float]:
    """(cell, distance) of the ``k`` rows of each cell nearest to its pivot, the number of rows with a
    distance, and the greatest length."""
    shared = corpus.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, far, n, longest = np.empty(0, int), np.empty(0), 0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            points, defined = in_space(metric, dense.matrix_of(batch.column(0)))
            points = points[defined]
            if not len(points):
                continue
            d = apart(metric, points, shared.value)
            n += len(points)
            longest = max(longest, float(np.sqrt((points * points).sum(axis=1)).max()))
            cells, far = np.append(cells, d.argmin(axis=1)), np.append(far, d.min(axis=1))
            order = np.lexsort((far, cells))
            cells, far = cells[order], far[order]
            keep = np.arange(len(cells)) - np.searchsorted(cells, cells) < k
            cells, far = cells[keep], far[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*cells.tolist(), -1], pa.int32()), pa.array([*far.tolist(), longest]),
             pa.array([0] * len(cells) + [n], pa.int64())], names=["cell", "d", "n"])

    found = corpus.select("v").mapInArrow(run, "cell int, d double, n long")
    order = Window.partitionBy("cell").orderBy("d")
    best = (found.where("cell >= 0").withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= k).select("cell", "d"))
    total = found.where("cell < 0").agg(F.sum("n").alias("n"), F.max("d").alias("d")).first()
    table = best.toArrow()
    return (np.column_stack([table["cell"].to_numpy(), table["d"].to_numpy()]).astype(float),
            int(total["n"] or 0), float(total["d"] or 0.0))


def _asked(queries: DataFrame, metric: Metric, pivots: np.ndarray) -> np.ndarray:
    """(cell, queries, greatest length, greatest distance to the pivot) of every cell with queries."""
    dealt = deal(queries, "qv", metric, pivots).where("cell >= 0")
    found = dealt.groupBy("cell").agg(F.count("*"), F.max("length"), F.max("d")).collect()
    return np.array([tuple(r) for r in found], float).reshape(-1, 4)


def deal(rows: DataFrame, vec: str, metric: Metric, pivots: np.ndarray) -> DataFrame:
    """Adds ``cell`` (-1 without a distance), ``d`` to its pivot and ``length`` to rows with a vector."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*rows.schema, T.StructField("cell", T.IntegerType()),
                           T.StructField("d", T.DoubleType()), T.StructField("length", T.DoubleType())])
    place = rows.columns.index(vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, defined = in_space(metric, dense.matrix_of(batch.column(place)))
            d = apart(metric, points, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.where(defined, d.argmin(axis=1), -1).astype(np.int32)),
                 pa.array(d.min(axis=1)), pa.array(np.sqrt((points * points).sum(axis=1)))],
                names=[*batch.schema.names, "cell", "d", "length"])

    return rows.mapInArrow(run, schema)


def _copies(corpus: DataFrame, cells: Cells) -> np.ndarray:
    """How many corpus rows each cell needs: a scan without a shuffle of vectors."""
    shared = corpus.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(shared.value.pivots)
        total = np.zeros(many, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(shared.value.needed(dense.matrix_of(batch.column(0)))[1], minlength=many)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(many, dtype=np.int32)), pa.array(total)],
                                         names=["cell", "n"])

    counts = corpus.select("v").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(cells.pivots), np.int64)
    for row in counts.collect():
        out[row["cell"]] = row["n"]
    return out


def voronoi_topk(queries: DataFrame, corpus: DataFrame, out: T.StructType, k: int, cells: Cells) -> DataFrame:
    """Best ``k`` candidates of every query (``qid, qv``) in each block of its cell's corpus rows.

    A query without a distance to anything has the ``k`` smallest ids, as in the other layouts.
    """
    shared = corpus.sparkSession.sparkContext.broadcast(cells)
    copied = T.StructType([T.StructField("cell", T.IntegerType()), *corpus.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, cell = shared.value.needed(dense.matrix_of(batch.column(1)))
                # A wide batch of copies is passed on in pieces.
                for start in range(0, len(rows), dense.CORPUS_BLOCK):
                    part = slice(start, start + dense.CORPUS_BLOCK)
                    picked = pa.array(rows[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[part].astype(np.int32)), *(c.take(picked) for c in batch.columns)],
                        names=copied.names)

    def blocks(of: np.ndarray):
        return F.get(F.array(*[F.lit(int(n)) for n in of]), F.col("cell"))

    def dealt(rows: DataFrame, key: str, own: str, n_own: np.ndarray, other: str, n_other: np.ndarray) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), blocks(n_own)).cast("int")
        return (rows.withColumn(own, mine)
                .withColumn(other, F.explode(F.sequence(F.lit(0), blocks(n_other) - 1))))

    placed = deal(queries, "qv", cells.metric, cells.pivots).drop("d", "length")
    left = dealt(placed.where("cell >= 0"), "qid", "qb", cells.query_blocks, "cb", cells.corpus_blocks)
    right = dealt(corpus.mapInArrow(run, copied), "id", "cb", cells.corpus_blocks, "qb", cells.query_blocks)
    kernel = dense.topk_kernel(cells.metric, k, dense.arrow_schema(out))
    hits = dense.pair_blocks(left, right, ["cell", "qb", "cb"], kernel, out)
    first = [r["id"] for r in corpus.select("id").orderBy("id").limit(k).collect()]
    lost = placed.where("cell < 0").select(
        "qid", F.explode(F.lit(first).cast(T.ArrayType(out["id"].dataType))).alias("id"),
        F.lit(None).cast("double").alias("distance"))
    return hits.unionByName(lost)
