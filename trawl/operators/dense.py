"""Exact nearest-neighbour search: one vector, or a whole table of queries, per job.

``topk`` answers one query vector.  ``knn_join`` answers a table of queries.  Both score whole
Arrow batches with matrix products inside Spark tasks and keep only the best ``k`` per query and
task before anything is shuffled.  When the query table is small (checked), it is broadcast and
the corpus is never shuffled.  Beyond that, both tables are cut into bounded blocks and every
block pair is one task-sized group, so neither side has to fit in one place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.distance import distance, relevance, vector_literal
from trawl.schema import Metric

MAX_BROADCAST_QUERIES = 8192
MAX_BROADCAST_BYTES = 64 << 20
CORPUS_BLOCK = 32768
QUERY_BLOCK = 16384
MAX_BROADCAST_HITS = 1_000_000
_PRODUCT_CELLS = 1 << 22
#: Rows whose absolute differences are taken at once, so that they stay in a core's cache.
_DIFFERENCE_VALUES = 1 << 16
#: Parts of a row of distances whose least values bound the k-th.
_PARTS = 256


# -- block kernel ------------------------------------------------------------------------


def matrix_of(column: pa.Array) -> np.ndarray:
    """Arrow list column -> (rows, dim) doubles; every vector must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if rows == 0:
        return flat.reshape(0, 0)
    if column.null_count or flat.size % rows or not _even(column, flat.size // rows):
        raise ValueError("vectors must be non-null and of one length")
    return flat.reshape(rows, -1)


def _even(column: pa.Array, dim: int) -> bool:
    return bool((np.diff(column.offsets.to_numpy()) == dim).all())


def coarse(metric: Metric, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All distances of a block pair, fast; NaN where undefined."""
    if metric is Metric.L1:
        return differences(q, x)
    prod = q @ x.T
    if metric is Metric.IP:
        return -prod
    if metric is Metric.L2:
        square = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * prod
        return np.sqrt(np.maximum(square, 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - prod / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1))


def differences(q: np.ndarray, x: np.ndarray, kind: type = np.float64) -> np.ndarray:
    """Sums of absolute differences of a block pair, piece by piece."""
    q, x = q.astype(kind), x.astype(kind)
    out = np.empty((len(q), len(x)), kind)
    step, ones = max(1, _DIFFERENCE_VALUES // max(1, x.shape[1])), np.ones(x.shape[1], kind)
    gap = np.empty((min(step, len(x)), x.shape[1]), kind)
    for start in range(0, len(x), step):
        part = x[start:start + step]
        here = gap[:len(part)]
        for row, sums in zip(q, out):
            np.subtract(part, row, out=here)
            np.abs(here, out=here)
            np.dot(here, ones, out=sums[start:start + step])
    return out


def _defined(d: np.ndarray) -> np.ndarray:
    d[np.isnan(d)] = np.inf
    return d


def _unit(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return x / np.sqrt((x * x).sum(axis=1))[:, None]


def bound_of_kth(d: np.ndarray, k: int) -> np.ndarray:
    """At least the ``k``-th smallest value of each row: that of the least values of its parts."""
    width = d.shape[1] // max(_PARTS, 4 * k)
    if width > 1:
        # Parts are taken across the row, so that neighbouring rows alike fall into several.
        many = d.shape[1] // width
        d = d[:, :many * width].reshape(len(d), width, many).min(axis=1)
    return np.partition(d, k - 1, axis=1)[:, k - 1]


def precise(metric: Metric, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of aligned rows, computed row by row: equal rows give equal distances."""
    if metric is Metric.L1:
        return np.abs(q - x).sum(axis=1)
    if metric is Metric.L2:
        return np.sqrt(((q - x) ** 2).sum(axis=1))
    prod = (q * x).sum(axis=1)
    if metric is Metric.IP:
        return -prod
    with np.errstate(divide="ignore", invalid="ignore"):
        lengths = np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1))
        return np.where(lengths > 0, 1.0 - prod / lengths, np.nan)


class Best:
    """The best ``k`` (distance, id) per query over the blocks one task has seen."""

    def __init__(self, metric: Metric, queries: np.ndarray, k: int) -> None:
        self.metric, self.queries, self.k = metric, queries, k
        self.limit = np.full(len(queries), np.inf)
        self.reach = float(np.sqrt((queries * queries).sum(axis=1).max(initial=0.0)))
        self.q = np.empty(0, np.int64)
        self.d = np.empty(0)
        self.ids: np.ndarray | None = None

    def _slack(self, x: np.ndarray) -> float:
        """How far the distances of ``coarse`` may be off."""
        if self.metric is Metric.COSINE:
            return 1e-9
        reach = float(np.sqrt((x * x).sum(axis=1).max(initial=0.0)))
        return 1e-6 * (self.reach + reach) + 1e-12 * self.reach * reach

    def _fast(self, x: np.ndarray) -> tuple[Callable, Callable, float]:
        """Keys of ``x`` for given queries that order like distances, the key of a distance, and how far
        a key may be off; rows within that are scored again.

        Keys are in single precision where the values allow, and squared for L2.
        """
        metric, asked = self.metric, self.queries
        reach = float(np.sqrt((x * x).sum(axis=1).max(initial=0.0)))
        most = max(reach, self.reach)
        if not 1e-12 < most < 1e15:
            return lambda rows: coarse(metric, asked[rows], x), lambda d: d, self._slack(x)
        unit = (x.shape[1] + 8) * 2.0**-23
        if metric is Metric.L1:
            wide = float(np.abs(x).sum(axis=1).max(initial=0.0) + np.abs(asked).sum(axis=1).max(initial=0.0))
            return lambda rows: differences(asked[rows], x, np.float32), lambda d: d, wide * unit
        q = asked
        if metric is Metric.COSINE:
            q, x = _unit(q), _unit(x)
        low, wide = q.astype(np.float32), np.ascontiguousarray(x.astype(np.float32).T)
        if metric is Metric.COSINE:
            return lambda rows: -low[rows] @ wide, lambda d: d - 1.0, unit
        if metric is Metric.IP:
            return lambda rows: -low[rows] @ wide, lambda d: d, most * most * unit
        own, other = (q * q).sum(1).astype(np.float32), (x * x).sum(1).astype(np.float32)

        def squares(rows: np.ndarray) -> np.ndarray:
            out = (-2 * low[rows]) @ wide
            out += other
            out += own[rows][:, None]
            return out

        return squares, lambda d: d * d, 8 * most * most * unit

    def plain(self, x: np.ndarray) -> bool:
        """Whether every distance to a row of ``x`` is defined."""
        found = bool(np.isfinite(x).all() and np.isfinite(self.queries).all())
        if self.metric is Metric.COSINE:
            found = found and bool((x != 0).any(axis=1).all() and (self.queries != 0).any(axis=1).all())
        return found

    def add(self, ids: np.ndarray, x: np.ndarray, which: np.ndarray | None = None, only=None, keep=None) -> None:
        """Score rows ``x`` against the queries ``which`` (default: all); ``only(rows)`` tells for
        queries, if given, which rows of ``x`` each may have, and ``keep(queries, rows)`` for single pairs,
        where it would not refuse any within the limit."""
        if not len(x) or not len(self.queries):
            return
        if x.shape[1] != self.queries.shape[1]:
            raise ValueError("vectors and queries must be of one length")
        which = np.arange(len(self.queries)) if which is None else which
        key, key_of, off = self._fast(x)
        wide = self._slack(x)
        plain = self.plain(x)
        step = max(1, _PRODUCT_CELLS // max(1, len(x)))
        found, size = [], 0
        for start in range(0, len(which), step):
            rows = which[start:start + step]
            allowed = None if only is None else only(rows)
            if allowed is None or allowed.sum() * x.shape[1] > allowed.size:
                d = key(rows) if plain else _defined(key(rows))
                qi, xi = self._near(key_of(self.limit[rows]) + off, d, allowed, off)
                if len(qi) > 32 * self.k * len(rows) and d.dtype != np.float64:
                    # Lengths far above the distances: single precision told too little.
                    qi, xi = self._near(self.limit[rows] + wide, _defined(coarse(self.metric, self.queries[rows], x)), allowed, wide)
            else:
                # Few pairs: to score them one by one is cheaper than all.
                qi, xi = np.nonzero(allowed)
            if keep is not None:
                kept = keep(rows[qi], xi)
                qi, xi = qi[kept], xi[kept]
            found.append((rows[qi], self._exact(rows[qi], x, xi), ids[xi]))
            size += len(qi)
            if size > _PRODUCT_CELLS:
                self._merge(*map(np.concatenate, zip(*found)))
                found, size = [], 0
        if found:
            self._merge(*map(np.concatenate, zip(*found)))

    def _exact(self, q: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
        step = max(1, _PRODUCT_CELLS // max(1, x.shape[1]))
        parts = [precise(self.metric, self.queries[q[i:i + step]], x[xi[i:i + step]]) for i in range(0, len(q), step)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _near(self, bound: np.ndarray, d: np.ndarray, allowed: np.ndarray | None, off: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) numbers that may be among the best, by their keys ``d``."""
        if allowed is not None:
            d[~allowed] = np.inf
        elif np.isfinite(bound).all():
            # The limit alone mostly leaves few rows, and the k-th of these need not be found.
            near = np.flatnonzero(d <= np.nextafter(bound.astype(d.dtype), d.dtype.type(np.inf))[:, None])
            if len(near) <= 4 * self.k * len(d):
                return np.divmod(near, d.shape[1])
        if d.shape[1] > self.k:
            bound = np.minimum(bound, bound_of_kth(d, self.k) + 2 * off)
        # Up to the next number of the keys' own precision.
        near = d <= np.nextafter(bound.astype(d.dtype), d.dtype.type(np.inf))[:, None]
        if allowed is not None:
            near &= allowed
        return np.divmod(np.flatnonzero(near), d.shape[1])

    def _merge(self, q: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        q = np.concatenate([self.q, q])
        d = np.concatenate([self.d, np.where(np.isnan(d), np.inf, d)])
        ids = ids if self.ids is None else np.concatenate([self.ids, ids])
        order = np.lexsort((ids, d, q))
        q, d, ids = q[order], d[order], ids[order]
        first = np.searchsorted(q, q, side="left")
        place = np.arange(len(q)) - first
        keep = place < self.k
        self.q, self.d, self.ids = q[keep], d[keep], ids[keep]
        last = place[keep] == self.k - 1
        self.limit[self.q[last]] = self.d[last]

    def batch(self, qids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch | pa.Table:
        ids = np.empty(0, np.int64) if self.ids is None else self.ids
        d = pa.array(self.d, pa.float64(), mask=~np.isfinite(self.d))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(qids[self.q].tolist(), schema.field(0).type),
                pa.array(ids.tolist(), schema.field(1).type),
                d,
            ],
            schema=schema,
        )


def id_values(column: pa.Array) -> np.ndarray:
    """Ids as a sortable numpy array (integers, or text in code-point order)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.array(column.to_pylist(), dtype=np.str_)


# -- block layouts -----------------------------------------------------------------------


@dataclass
class QueryBlock:
    """A query table that passed the size check, as arrays ready for broadcasting."""

    ids: np.ndarray
    vectors: np.ndarray


def small_queries(queries: DataFrame, qid: str, vec: str) -> QueryBlock | None:
    """Fetch the queries when they are few enough to broadcast, else ``None``."""
    table = queries.select(qid, vec).limit(MAX_BROADCAST_QUERIES + 1).toArrow()
    if table.num_rows > MAX_BROADCAST_QUERIES or table.nbytes > MAX_BROADCAST_BYTES:
        return None
    return QueryBlock(id_values(table.column(0)), matrix_of(table.column(1)))


def result_schema(queries: DataFrame, qid: str, corpus: DataFrame, id: str) -> T.StructType:
    return T.StructType([
        T.StructField("qid", queries.schema[qid].dataType),
        T.StructField("id", corpus.schema[id].dataType),
        T.StructField("distance", T.DoubleType()),
    ])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """Arrow types of a (qid, id, distance) result."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(),
        "double": pa.float64(),
    }
    return pa.schema([(f.name, kinds.get(f.dataType.simpleString(), pa.string())) for f in schema])


def rank_best(hits: DataFrame, k: int) -> DataFrame:
    """Global best ``k`` per query: (distance, id) order, undefined distances last."""
    window = Window.partitionBy("qid").orderBy(F.col("distance").asc_nulls_last(), "id")
    return (
        hits.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .select("qid", "id", "rank", "distance")
    )


def scan_topk(corpus: DataFrame, out: T.StructType, block: QueryBlock, k: int, metric: Metric,
              id: str, vec: str) -> DataFrame:
    """Best ``k`` per query and task, with the queries broadcast and the corpus in place."""
    shared = corpus.sparkSession.sparkContext.broadcast((block.ids, block.vectors))
    wire = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, vectors = shared.value
        best = Best(metric, vectors, k)
        for batch in batches:
            best.add(id_values(batch.column(0)), matrix_of(batch.column(1)))
        yield best.batch(qids, wire)

    return corpus.select(id, vec).mapInArrow(run, out)


def pair_blocks(
    queries: DataFrame,
    corpus: DataFrame,
    keys: list[str],
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    out: T.StructType,
) -> DataFrame:
    """Run ``kernel`` once per block pair; blocks are bounded by how ``keys`` were assigned."""
    left = queries.groupBy(*keys)
    return left.cogroup(corpus.groupBy(*keys)).applyInArrow(kernel, out)


def block_count(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def spread(df: DataFrame, key: str, blocks: int, name: str) -> DataFrame:
    """Assign rows to ``blocks`` even blocks by a hash of their key."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))


def replicate(df: DataFrame, blocks: int, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def block_grid(queries: DataFrame, corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every block of ``queries`` (``qid``, ...) beside every block of ``corpus`` (``id``, ...), by ``qb, cb``."""
    q_blocks = block_count(queries.count(), QUERY_BLOCK)
    c_blocks = block_count(corpus.count(), CORPUS_BLOCK)
    left = replicate(spread(queries, "qid", q_blocks, "qb"), c_blocks, "cb")
    right = replicate(spread(corpus, "id", c_blocks, "cb"), q_blocks, "qb")
    return left, right


def grid_topk(queries: DataFrame, corpus: DataFrame, out: T.StructType, k: int, metric: Metric,
              qid: str, qvec: str, id: str, vec: str) -> DataFrame:
    """Block-pair form of the exact join, for query tables too large to broadcast."""
    left, right = block_grid(queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv")),
                             corpus.select(F.col(id).alias("id"), F.col(vec).alias("v")))
    return pair_blocks(left, right, ["qb", "cb"], topk_kernel(metric, k, arrow_schema(out)), out)


def pruned_topk(queries: DataFrame, corpus: DataFrame, out: T.StructType, k: int, metric: Metric,
                qid: str, qvec: str, id: str, vec: str, always: bool = False) -> DataFrame | None:
    """The join over Voronoi cells, or ``None`` where it does not apply or ships more than the grid."""
    from trawl.operators import voronoi

    if metric not in voronoi.METRICS or k < 1:
        return None
    left = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv"))
    right = corpus.select(F.col(id).alias("id"), F.col(vec).alias("v"))
    cells = voronoi.plan_cells(left, right, k, metric)
    if cells is None:
        return None
    n_queries, n_rows = int(cells.queries.sum()), corpus.count()
    q_blocks, c_blocks = block_count(n_queries, QUERY_BLOCK), block_count(n_rows, CORPUS_BLOCK)
    if not always and cells.shipped >= n_queries * c_blocks + n_rows * q_blocks:
        return None
    return voronoi.voronoi_topk(left, right, out, k, cells)


def topk_kernel(metric: Metric, k: int, wire: pa.Schema):
    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return wire.empty_table()
        best = Best(metric, matrix_of(left.column("qv")), k)
        best.add(id_values(right.column("id")), matrix_of(right.column("v")))
        return pa.Table.from_batches([best.batch(id_values(left.column("qid")), wire)])

    return kernel


# -- public operators --------------------------------------------------------------------


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: Metric | str = Metric.COSINE,
    *,
    qid: str = "qid",
    qvec: str = "embedding",
    id: str = "id",
    vec: str = "embedding",
    where: Column | None = None,
    layout: str = "auto",
) -> DataFrame:
    """Exact ``k`` nearest rows of ``corpus`` per query: ``qid, id, rank, distance``.

    ``where`` filters the corpus first.  ``layout`` forces ``broadcast``, ``grid`` or ``pruned``.
    Query tables too large to broadcast are joined over Voronoi cells where that ships fewer rows
    than the grid of blocks; inner products have no triangle inequality and keep the grid.
    """
    metric = Metric(metric)
    if where is not None:
        corpus = corpus.where(where)
    out = result_schema(queries, qid, corpus, id)
    block = small_queries(queries, qid, qvec) if layout in ("auto", "broadcast") else None
    if block is not None:
        return rank_best(scan_topk(corpus, out, block, k, metric, id, vec), k)
    if layout == "broadcast":
        raise ValueError("the query table is too large to broadcast")
    hits = None if layout == "grid" else pruned_topk(
        queries, corpus, out, k, metric, qid, qvec, id, vec, always=layout == "pruned")
    if hits is None:
        hits = grid_topk(queries, corpus, out, k, metric, qid, qvec, id, vec)
    return rank_best(hits, k)


def topk(
    corpus: DataFrame,
    vector,
    k: int,
    metric: Metric | str = Metric.COSINE,
    *,
    id: str = "id",
    vec: str = "embedding",
    where: Column | None = None,
    alias: str = "distance",
    keep: list[str] | None = None,
    method: str = "block",
) -> DataFrame:
    """Exact top ``k`` rows for one query vector, with the columns ``keep`` (default: all others).

    ``block`` scores Arrow batches and passes on at most ``k`` rows (and ties) of each;
    ``expression`` stays in the JVM.  Both end in ``TakeOrderedAndProject``.
    """
    metric = Metric(metric)
    if where is not None:
        corpus = corpus.where(where)
    cols = keep if keep is not None else [c for c in corpus.columns if c != vec]
    if method == "expression":
        scored = corpus.select(
            *cols, distance(metric, F.col(vec), vector_literal(vector)).alias(alias)
        )
    else:
        scored = _score_batches(corpus.select(vec, *cols), cols, vector, k, metric, alias)
    return scored.orderBy(F.col(alias).asc_nulls_last(), id).limit(k)


def _score_batches(source: DataFrame, cols: list[str], vector, k: int, metric: Metric,
                   alias: str) -> DataFrame:
    query = np.array([float(x) for x in vector])
    out = T.StructType([*(source.schema[c] for c in cols), T.StructField(alias, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.inf
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column(0))
            d = precise(metric, np.broadcast_to(query, x.shape), x)
            order = np.where(np.isnan(d), np.inf, d)
            if len(order) > k:
                limit = min(limit, np.partition(order, k - 1)[k - 1])
            rows = pa.array(np.nonzero(order <= limit)[0])
            scored = pa.array(d, mask=np.isnan(d))
            picked = [c.take(rows) for c in (*batch.columns[1:], scored)]
            yield pa.RecordBatch.from_arrays(picked, names=[*cols, alias])

    return source.mapInArrow(run, out)


def join_hits(hits: DataFrame, rows: DataFrame, queries: DataFrame, per_query: int,
              on: str = "id") -> DataFrame:
    """Join hits with the rows they point to.

    There are at most ``per_query`` hits per query, so when the query table is small the hits
    are broadcast and the rows stay where they are; otherwise both sides are shuffled.
    """
    most = MAX_BROADCAST_HITS // max(1, per_query)
    few = queries.limit(most + 1).count() <= most
    return rows.join(F.broadcast(hits) if few else hits, on)


def with_relevance(hits: DataFrame, metric: Metric | str, threshold: float | None = None,
                   alias: str = "distance") -> DataFrame:
    """Add the relevance of each hit; a threshold is applied after the top ``k``."""
    out = hits.withColumn("relevance", relevance(metric, F.col(alias)))
    return out if threshold is None else out.where(F.col("relevance") >= threshold)
