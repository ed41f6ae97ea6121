"""Inverted-file search: vectors grouped into cells, each query reading only its nearest cells.

Cells are uneven, and one may hold a third of all vectors.  The stored table is therefore ranged
by (cell, id), which cuts a large cell over many files, and a search either scans in place with the
queries broadcast (no shuffle of vectors) or, for query tables too large for that, shuffles bounded
(cell, salt) blocks.  With ``nprobe`` at the number of cells the result is the exact one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.distance import distance
from trawl.operators import dense
from trawl.operators.dense import (
    Best, QueryBlock, arrow_schema, coarse, id_values, matrix_of, rank_best, result_schema,
    small_queries,
)
from trawl.operators import proven
from trawl.operators.quant import Quantizer, codes_of, encode_table, fit, unit_vectors
from trawl.schema import Metric
from trawl.session import cut_lineage

MAX_CELLS = 16384
MAX_CENTROID_BYTES = 64 << 20
MAX_PROBES = 1 << 22
KMEANS_SEED = 17
BLOCK_KEYS = ["cell", "qb", "cb"]
MODEL_SCHEMA = "metric string, centroids array<array<double>>, quantizer string, id string, vec string"


def default_cells(rows: int, dim: int) -> int:
    """About the square root of the row count, bounded so centroids stay broadcastable."""
    most = min(MAX_CELLS, MAX_CENTROID_BYTES // (8 * max(1, dim)))
    return max(1, min(most, round(math.sqrt(rows))))


def train_centroids(corpus: DataFrame, cells: int, metric: Metric, vec: str = "embedding",
                    train_rows: int | None = None) -> np.ndarray:
    """k-means over every vector, unit vectors for cosine; one cell is their mean.

    ``train_rows`` asks for a sample of about so many rows instead.
    """
    rows = corpus.count()
    train = corpus.select(vec)
    if train_rows is not None and train_rows < rows:
        train = train.sample(train_rows / rows, seed=KMEANS_SEED)
    if metric is Metric.COSINE:
        train = unit_vectors(train, vec)
    train = train.select(array_to_vector(vec).alias("features"))
    if min(cells, rows) < 2:
        center = train.select(Summarizer.mean(F.col("features")).alias("c")).first()["c"]
        return np.array([center.toArray()])
    model = KMeans(k=min(cells, rows), seed=KMEANS_SEED, maxIter=10).fit(train)
    return np.array(model.clusterCenters(), float)


def _prepare(x: np.ndarray, metric: Metric) -> np.ndarray:
    if metric is not Metric.COSINE:
        return x
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


def assign_cells(corpus: DataFrame, centroids: np.ndarray, metric: Metric, vec: str = "embedding") -> DataFrame:
    """Add ``cell``, the nearest centroid of each vector; a narrow pass over the corpus."""
    shared = corpus.sparkSession.sparkContext.broadcast(centroids)
    names = [c for c in corpus.columns if c != "cell"]
    source = corpus.select(*names)
    place = names.index(vec)
    out = T.StructType([*source.schema.fields, T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _prepare(matrix_of(batch.column(place)), metric)
            step = max(1, (1 << 22) // len(shared.value))
            near = [
                coarse(Metric.L2, x[i:i + step], shared.value).argmin(axis=1)
                for i in range(0, len(x), step)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(near), pa.int32())], names=[*names, "cell"]
            )

    return source.mapInArrow(run, out)


def nearest_cells(q: np.ndarray, centroids: np.ndarray, nprobe: int, metric: Metric) -> np.ndarray:
    """(queries, nprobe) cells to read, nearest first; equal distances in cell order."""
    by = Metric.IP if metric is Metric.IP else Metric.L2
    q, out = _prepare(q, metric), []
    step = max(1, (1 << 22) // len(centroids))
    for start in range(0, len(q), step):
        d = coarse(by, q[start:start + step], centroids)
        out.append(np.argsort(d, axis=1, kind="stable")[:, :nprobe])
    return np.concatenate(out) if out else np.empty((0, nprobe), int)


@dataclass
class IvfIndex:
    """Centroids, the vectors with their cell and, when quantized, their codes.

    ``cells`` holds ``id, cell`` and every other corpus column, so filters apply to it directly.
    """

    metric: Metric
    centroids: np.ndarray
    cells: DataFrame
    quantizer: Quantizer | None = None
    codes: DataFrame | None = None
    id: str = "id"
    vec: str = "embedding"
    #: ``cell, n, radius`` of the cells as they were written (``proven``).
    radii: DataFrame | None = None

    index_type = "ivf"

    @classmethod
    def build(cls, corpus: DataFrame, metric: Metric | str = Metric.COSINE, *, id: str = "id",
              vec: str = "embedding", cells: int | None = None, quant: str = "none",
              pq_m: int | None = None, nb_bits: float | None = None,
              query_bits: int | None = None, train_rows: int | None = None) -> "IvfIndex":
        metric = Metric(metric)
        quantizer = None
        if quant != "none":
            quantizer = fit(corpus, quant, metric, vec=vec, pq_m=pq_m, nb_bits=nb_bits,
                            query_bits=query_bits)
        if cells is None:
            size = corpus.agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
            cells = default_cells(size[0], size[1] or 1)
        centroids = train_centroids(corpus, cells, metric, vec, train_rows)
        return cls.assign(corpus, metric, centroids, quantizer, id=id, vec=vec)

    @classmethod
    def assign(cls, corpus: DataFrame, metric: Metric, centroids: np.ndarray,
               quantizer: Quantizer | None = None, *, id: str = "id",
               vec: str = "embedding") -> "IvfIndex":
        """Index rows with already trained centroids and quantizer."""
        table = assign_cells(corpus, centroids, metric, vec)
        extra = tuple(c for c in table.columns if c not in (id, vec))
        codes = encode_table(table, quantizer, id, vec, extra) if quantizer else None
        return cls(metric, centroids, table, quantizer, codes, id, vec)

    def ranged(self, table: DataFrame, id: str) -> DataFrame:
        """Layout for writing: sorted cells, a large cell spread over several files."""
        return table.repartitionByRange("cell", id).sortWithinPartitions("cell", id)

    def write(self, store) -> "IvfIndex":
        """Save cells, codes and model in a ``Folder`` or ``Tables`` store."""
        cells = store.save("cells", self.ranged(self.cells, self.id))
        codes = None
        if self.codes is not None:
            codes = store.save("codes", self.ranged(self.codes, "id"))
        spark = self.cells.sparkSession
        model = self.quantizer.to_json() if self.quantizer else None
        row = [(self.metric.value, self.centroids.tolist(), model, self.id, self.vec)]
        store.save("model", spark.createDataFrame(row, MODEL_SCHEMA).coalesce(1))
        radii = proven.cell_radii(cells, self.centroids, self.metric, self.vec).coalesce(1)
        radii = store.save("radii", radii)
        return IvfIndex(self.metric, self.centroids, cells, self.quantizer, codes, self.id, self.vec, radii)

    @classmethod
    def read(cls, store) -> "IvfIndex":
        row = store.load("model").first()
        quantizer = Quantizer.from_json(row["quantizer"]) if row["quantizer"] else None
        codes = store.load("codes") if quantizer else None
        return cls(Metric(row["metric"]), np.array(row["centroids"], float), store.load("cells"),
                   quantizer, codes, row["id"], row["vec"], store.load("radii") if store.has("radii") else None)

    # -- search ---------------------------------------------------------------------------

    def search(self, queries: DataFrame, k: int, nprobe: int = 8, rescore_width: float = -1,
               *, qid: str = "qid", qvec: str = "embedding", where: Column | None = None,
               layout: str = "auto") -> DataFrame:
        """``qid, id, rank, distance`` of the best ``k`` rows in the ``nprobe`` nearest cells.

        On a quantized index, codes are scored first; a row is read at full precision while
        its code distance minus ``rescore_width`` times the code's error could still be among
        the best.  ``1`` cannot miss a row of the probed cells, ``0`` answers from the codes,
        ``-1`` means ``1``; only a caller's own smaller width can lose a row.
        """
        check_search(nprobe=nprobe, rescore_width=rescore_width)
        nprobe = min(nprobe, len(self.centroids))
        block = None if layout == "grid" else small_queries(queries, qid, qvec)
        if block is not None and nprobe < len(self.centroids):
            if len(block.ids) * nprobe > MAX_PROBES:
                block = None
        if self.quantizer is None:
            if block is None:
                return rank_best(self._grid(queries, k, nprobe, qid, qvec, where), k)
            return rank_best(self._scan(queries, block, k, nprobe, qid, where), k)
        ask = CodeSearch(self, queries, block, nprobe, qid, qvec, where)
        by_code = rank_best(ask.nearest(k), k)
        if rescore_width == 0:
            return by_code
        width = 1.0 if rescore_width == -1 else float(rescore_width)
        by_code = cut_lineage(by_code.select("qid", "id"))
        cut = (
            ask.exact(by_code).groupBy("qid")
            .agg(F.max("distance").alias("cut"), F.count("distance").alias("n"))
            .select("qid", F.when(F.col("n") >= k, F.col("cut")).alias("cut"))
        )
        if block is None:
            return rank_best(ask.rescored(cut_lineage(cut), width, k), k)
        return rank_best(ask.exact(cut_lineage(ask.alive(cut, width)), k), k)

    def _probes(self, vectors: np.ndarray, nprobe: int) -> dict[int, np.ndarray] | None:
        """Cell -> rows of the queries that read it; ``None`` when every query reads all."""
        if nprobe >= len(self.centroids):
            return None
        near = nearest_cells(vectors, self.centroids, nprobe, self.metric)
        asked: dict[int, list[int]] = {}
        for row, cells in enumerate(near):
            for cell in cells:
                asked.setdefault(int(cell), []).append(row)
        return {cell: np.array(rows) for cell, rows in asked.items()}

    def _probed(self, table: DataFrame, probes: dict[int, np.ndarray] | None, where) -> DataFrame:
        """Rows of the probed cells; the list reaches the scan as a pushed filter."""
        if probes is not None and len(probes) < len(self.centroids):
            table = table.where(F.col("cell").isin(sorted(probes)))
        return table if where is None else table.where(where)

    def _scan(self, queries, block, k, nprobe, qid, where) -> DataFrame:
        out = result_schema(queries, qid, self.cells, self.id)
        return self.scan(queries, block, k, self._probes(block.vectors, nprobe), qid, where, out)

    def scan(self, queries, block, k, probes, qid, where, out) -> DataFrame:
        """The best ``k`` of every query and task among the cells that ``probes`` names for it."""
        metric, wire = self.metric, arrow_schema(out)
        shared = self.cells.sparkSession.sparkContext.broadcast((block, probes))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, probes = shared.value
            best = Best(metric, block.vectors, k)
            for batch in batches:
                ids, x = id_values(batch.column(0)), matrix_of(batch.column(1))
                for rows, which in probed_rows(batch.column(2), probes):
                    best.add(ids[rows], x[rows], which)
            yield best.batch(block.ids, wire)

        table = self._probed(self.cells, probes, where)
        return table.select(self.id, self.vec, "cell").mapInArrow(run, out)

    def _grid(self, queries, k, nprobe, qid, qvec, where) -> DataFrame:
        """Large query tables: bounded blocks of each cell against blocks of its queries."""
        out = result_schema(queries, qid, self.cells, self.id)
        left, right = self._blocks(queries, self.cells, self.id, [F.col(self.vec).alias("v")],
                                   nprobe, qid, qvec, where)
        kernel = dense.topk_kernel(self.metric, k, arrow_schema(out))
        return dense.pair_blocks(left, right, BLOCK_KEYS, kernel, out)

    def _blocks(self, queries, table, id, payload, nprobe, qid, qvec, where, extra=()):
        """Queries and rows cut by (cell, query block, row block), each block bounded.

        Queries that read every cell need not be copied to each: their blocks cut across the cells.
        """
        table = table if where is None else table.where(where)
        asked = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv"), *extra)
        if nprobe >= len(self.centroids):
            rows = table.select(F.col(id).alias("id"), *payload, F.lit(0).alias("cell"))
            # As with probes: rows of one qid are asked once for each of them, rows without one never.
            asked = asked.select("qid").join(asked, "qid")
            return dense.block_grid(asked.withColumn("cell", F.lit(0)), rows)
        probes = probe_table(asked, self.centroids, nprobe, self.metric)
        rows = table.groupBy("cell").count().withColumnRenamed("count", "rows")
        hits = probes.groupBy("cell").count().withColumnRenamed("count", "asked")
        cuts = rows.join(hits, "cell").select(
            "cell",
            F.ceil(F.col("rows") / dense.CORPUS_BLOCK).cast("int").alias("cbs"),
            F.ceil(F.col("asked") / dense.QUERY_BLOCK).cast("int").alias("qbs"),
        )
        # One row per cell: at most MAX_CELLS rows, so broadcasting it is bounded.
        cuts = F.broadcast(cuts)
        left = probes.join(cuts, "cell").join(asked, "qid").select(
            "qid", "qv", "cell", *extra,
            F.pmod(F.xxhash64("qid"), F.col("qbs").cast("bigint")).cast("int").alias("qb"),
            F.explode(F.sequence(F.lit(0), F.col("cbs") - 1)).alias("cb"),
        )
        right = table.join(cuts, "cell").select(
            F.col(id).alias("id"), *payload, "cell",
            F.pmod(F.xxhash64(id), F.col("cbs").cast("bigint")).cast("int").alias("cb"),
            F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)).alias("qb"),
        )
        return left, right


def probe_table(asked: DataFrame, centroids: np.ndarray, nprobe: int, metric: Metric) -> DataFrame:
    """``qid, cell`` rows for a query table of any size."""
    shared = asked.sparkSession.sparkContext.broadcast(centroids)
    out = T.StructType([asked.schema["qid"], T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = nearest_cells(matrix_of(batch.column(1)), shared.value, nprobe, metric)
            spots = np.repeat(np.arange(len(near)), near.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(spots)), pa.array(near.ravel(), pa.int32())],
                names=["qid", "cell"],
            )

    return asked.select("qid", "qv").mapInArrow(run, out)


def probed_rows(column: pa.Array, probes: dict[int, np.ndarray] | None):
    """(row numbers, queries) of a batch, cell by cell; all rows and queries without probes."""
    if probes is None:
        yield slice(None), None
        return
    cells = column.to_numpy(zero_copy_only=False)
    order = np.argsort(cells, kind="stable")
    values, starts = np.unique(cells[order], return_index=True)
    for i, cell in enumerate(values):
        stop = starts[i + 1] if i + 1 < len(starts) else len(cells)
        if int(cell) in probes:
            yield order[starts[i]:stop], probes[int(cell)]


@dataclass
class CodeSearch:
    """The passes of a quantized search, for broadcast queries or in blocks."""

    index: IvfIndex
    queries: DataFrame
    block: QueryBlock | None
    nprobe: int
    qid: str
    qvec: str
    where: Column | None

    def _schema(self) -> T.StructType:
        return T.StructType([
            T.StructField("qid", self.queries.schema[self.qid].dataType),
            T.StructField("id", self.index.codes.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ])

    def nearest(self, k: int) -> DataFrame:
        """Best ``k`` per query and task by code distance: ``qid, id, distance``."""
        out = self._schema()
        wire, quantizer = arrow_schema(out), self.index.quantizer
        scored, lift = _code_metric(quantizer.metric)

        def finish(best: Best, qids: np.ndarray) -> pa.RecordBatch:
            best.d = best.d + lift
            return best.batch(qids, wire)

        if self.block is None:
            def kernel(asked: pa.Table, rows: pa.Table) -> pa.Table:
                if not asked.num_rows or not rows.num_rows:
                    return wire.empty_table()
                seen, _ = quantizer.quantize_queries(matrix_of(asked.column("qv")))
                best = Best(scored, seen, k)
                best.add(id_values(rows.column("id")), quantizer.decode(codes_of(rows.column("code"))))
                return pa.Table.from_batches([finish(best, id_values(asked.column("qid")))])

            return dense.pair_blocks(*self._blocks(), BLOCK_KEYS, kernel, out)

        shared, probes = self._shared()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, seen, _, probes, quantizer = shared.value
            best = Best(scored, seen, k)
            for batch in batches:
                if batch.num_rows:
                    ids, x = id_values(batch.column(0)), quantizer.decode(codes_of(batch.column(1)))
                    for rows, which in probed_rows(batch.column(3), probes):
                        best.add(ids[rows], x[rows], which)
            yield finish(best, qids)

        return self._codes(probes).mapInArrow(run, out)

    def alive(self, cut: DataFrame, width: float) -> DataFrame:
        """``qid, id`` of all rows whose code distance, less its error, is within the cut."""
        out = T.StructType(self._schema().fields[:2])
        wire, quantizer = arrow_schema(out), self.index.quantizer
        # One value per broadcast query: as bounded as the queries themselves.
        table = cut.select("qid", "cut").toArrow()
        cuts = np.full(len(self.block.ids), np.inf)
        cuts[_places(self.block.ids, id_values(table.column(0)))] = _cuts(table.column(1))
        shared, probes = self._shared()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, seen, moved, probes, quantizer = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, err = id_values(batch.column(0)), batch.column(2).to_numpy()
                x = quantizer.decode(codes_of(batch.column(1)))
                for rows, which in probed_rows(batch.column(3), probes):
                    found = within(quantizer.metric, seen, moved, cuts, width, x[rows], err[rows], which)
                    yield from _pairs(found, qids, ids[rows], wire).to_batches()

        return self._codes(probes).mapInArrow(run, out)

    def rescored(self, cut: DataFrame, width: float, k: int) -> DataFrame:
        """``qid, id, distance``: of the rows of each block that ``alive`` would name, the best ``k`` at
        full precision.

        Coarse codes leave nearly every pair alive; pairs are scored where they are found, and none is
        shuffled. With a width of one or more, codes rule out no row within the cut, and rows beyond it are not
        among the best ``k``: then only pairs within the cut are held against the codes.
        """
        out = self._schema()
        wire, metric, quantizer = arrow_schema(out), self.index.metric, self.index.quantizer

        def kernel(asked: pa.Table, rows: pa.Table) -> pa.Table:
            if not asked.num_rows or not rows.num_rows:
                return wire.empty_table()
            queries = matrix_of(asked.column("qv"))
            seen, moved = quantizer.quantize_queries(queries)
            codes, err, cuts = quantizer.decode(codes_of(rows.column("code"))), rows.column("err").to_numpy(), _cuts(asked.column("cut"))
            best, ids, x = Best(metric, queries, k), id_values(rows.column("id")), matrix_of(rows.column("v"))
            if width >= 1 and best.plain(x):
                best.limit = cuts.copy()
                best.add(ids, x, keep=lambda q, r: pair_may_be_within(
                    quantizer.metric, seen[q], moved[q], cuts[q], width, codes[r], err[r]))
            else:
                best.add(ids, x, only=lambda which: may_be_within(
                    quantizer.metric, seen[which], moved[which], cuts[which], width, codes, err))
            return pa.Table.from_batches([best.batch(id_values(asked.column("qid")), wire)])

        hits = dense.pair_blocks(*self._blocks(cut), BLOCK_KEYS, kernel, out)
        # As ``exact`` counts them, whose pairs meet every query of their qid.
        return hits.join(self.queries.select(F.col(self.qid).alias("qid")), "qid")

    def exact(self, pairs: DataFrame, k: int | None = None) -> DataFrame:
        """Full-precision distances of ``qid, id`` pairs; with ``k``, the best of each task."""
        index = self.index
        vectors = index.cells.select(F.col(index.id).alias("id"), F.col(index.vec).alias("v"))
        if self.block is not None:
            return score_pairs(pairs, vectors, self.block, index.metric, self._schema(), k)
        asked = self.queries.select(F.col(self.qid).alias("qid"), F.col(self.qvec).alias("qv"))
        return score_joined(pairs, vectors, asked, index.metric)

    def _codes(self, probes) -> DataFrame:
        table = self.index._probed(self.index.codes, probes, self.where)
        return table.select("id", "code", "err", "cell")

    def _shared(self):
        index, block = self.index, self.block
        probes = index._probes(block.vectors, self.nprobe)
        seen, moved = index.quantizer.quantize_queries(block.vectors)
        spark = index.codes.sparkSession
        payload = (block.ids, seen, moved, probes, index.quantizer)
        return spark.sparkContext.broadcast(payload), probes

    def _blocks(self, cut: DataFrame | None = None):
        queries, codes, payload, extra = self.queries, self.index.codes, ["code", "err"], []
        if cut is not None:
            queries = queries.join(cut.withColumnRenamed("qid", self.qid), self.qid, "left")
            index, extra = self.index, ["cut"]
            vectors = index.cells.select(F.col(index.id).alias("id"), F.col(index.vec).alias("v"))
            codes, payload = codes.join(vectors, "id"), [*payload, "v"]
        return self.index._blocks(queries, codes, "id", payload, self.nprobe,
                                  self.qid, self.qvec, self.where, extra)


def _code_metric(metric: Metric) -> tuple[Metric, float]:
    """Codes of unit vectors: cosine is one plus the negative inner product."""
    if metric is Metric.L2:
        return Metric.L2, 0.0
    return Metric.IP, 1.0 if metric is Metric.COSINE else 0.0


def _cuts(column) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return np.where(np.isnan(values.astype(float)), np.inf, values.astype(float))


def _places(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row numbers of ``wanted`` in ``ids``."""
    order = np.argsort(ids, kind="stable")
    return order[np.searchsorted(ids[order], wanted)]


def _pairs(found, qids: np.ndarray, ids: np.ndarray, wire: pa.Schema) -> pa.Table:
    qi, xi = found
    return pa.table([
        pa.array(qids[qi].tolist(), wire.field(0).type), pa.array(ids[xi].tolist(), wire.field(1).type)
    ], schema=wire)


def may_be_within(metric, seen, moved, cuts, width, x, err) -> np.ndarray:
    """(queries, rows): whether a distance may be at most the query's cut.

    A code distance is off by at most the row's error and the query's, scaled for inner
    products by the other side's length; ``width`` scales that margin.
    """
    scored, lift = _code_metric(metric)
    reach = np.sqrt((seen * seen).sum(axis=1)) + moved
    least = coarse(scored, seen, x)
    if metric is Metric.L2:
        least -= (width * err)[None, :]
        most = cuts + width * moved
    else:
        least -= (width * reach)[:, None] * err[None, :]
        if moved.any():
            least -= (width * moved)[:, None] * np.sqrt((x * x).sum(axis=1))[None, :]
        most = cuts
    return least <= (most - lift + 1e-6 * (1.0 + reach))[:, None]


def pair_may_be_within(metric, seen, moved, cuts, width, x, err) -> np.ndarray:
    """The same for aligned queries and rows."""
    scored, lift = _code_metric(metric)
    reach = np.sqrt((seen * seen).sum(axis=1)) + moved
    least = dense.precise(scored, seen, x)
    if metric is Metric.L2:
        return least - width * err <= cuts + width * moved + 1e-6 * (1.0 + reach)
    margin = reach * err + moved * np.sqrt((x * x).sum(axis=1))
    return least - width * margin <= cuts - lift + 1e-6 * (1.0 + reach)


def within(metric, seen, moved, cuts, width, x, err, which=None):
    """(query, row) numbers whose distance may be at most the query's cut."""
    which = np.arange(len(seen)) if which is None else which
    step, found = max(1, (1 << 22) // max(1, len(x))), []
    for start in range(0, len(which), step):
        rows = which[start:start + step]
        qi, xi = np.nonzero(may_be_within(metric, seen[rows], moved[rows], cuts[rows], width, x, err))
        found.append((rows[qi], xi))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def score_pairs(pairs: DataFrame, vectors: DataFrame, block: QueryBlock, metric: Metric,
                out: T.StructType, k: int | None = None) -> DataFrame:
    """``qid, id, distance`` of given pairs, each vector read once with all its queries.

    A row's list of queries is bounded by the broadcast query block.
    """
    spark = vectors.sparkSession
    shared, wire = spark.sparkContext.broadcast((block.ids, block.vectors)), arrow_schema(out)
    lists = pairs.groupBy("id").agg(F.collect_list("qid").alias("qids"))
    rows = vectors.join(lists, "id").select("id", "v", "qids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, asked = shared.value
        best = Best(metric, asked, k or 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x, lists = id_values(batch.column(0)), matrix_of(batch.column(1)), batch.column(2)
            ri = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            qi = _places(qids, id_values(lists.flatten()))
            for start in range(0, len(ri), 1 << 16):
                q, r = qi[start:start + (1 << 16)], ri[start:start + (1 << 16)]
                d = dense.precise(metric, asked[q], x[r])
                if k:
                    best._merge(q, d, ids[r])
                else:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(qids[q].tolist(), wire.field(0).type),
                        pa.array(ids[r].tolist(), wire.field(1).type),
                        pa.array(d, mask=np.isnan(d)),
                    ], schema=wire)
        if k:
            yield best.batch(qids, wire)

    return rows.mapInArrow(run, out)


def score_joined(pairs: DataFrame, vectors: DataFrame, asked: DataFrame, metric: Metric) -> DataFrame:
    """The same by joins alone, for query tables too large to broadcast."""
    scored = pairs.join(vectors, "id").join(asked, "qid")
    return scored.select("qid", "id", distance(metric, F.col("qv"), F.col("v")).alias("distance"))


def check_search(nprobe: int | None = None, ef_search: int | None = None,
                 rescore_width: float | None = None) -> None:
    """Out-of-range search knobs are refused (ValueError)."""
    if nprobe is not None and nprobe < 1:
        raise ValueError(f"nprobe must be at least 1, got {nprobe}")
    if ef_search is not None and ef_search != -1 and ef_search < 1:
        raise ValueError(f"ef_search must be -1 or at least 1, got {ef_search}")
    if rescore_width is not None and rescore_width < 0 and rescore_width != -1:
        raise ValueError(f"rescore_width must be -1 or at least 0, got {rescore_width}")


def filtered_search(index, queries: DataFrame, k: int, where: Column, mode: str = "auto",
                    *, qid: str = "qid", qvec: str = "embedding", **knobs) -> DataFrame:
    """Search under a filter that returns ``k`` rows when there are ``k``, whatever their number.

    ``scan`` is exact over the filtered rows, and so is ``auto``, which reads the cells that may hold
    a neighbour where the index proves which these are (``proven``).  In any other mode the filter applies
    inside the index search, and queries left short are answered exactly.
    """
    passing = index.cells.where(where)
    exact = mode in ("scan", "auto")
    knn = dict(qid=qid, qvec=qvec, id=index.id, vec=index.vec)
    if mode == "auto":
        found = proven.proven_search(index, queries, k, where=where, qid=qid, qvec=qvec)
        if found is not None:
            return found.hits
    if exact:
        return dense.knn_join(queries, passing, k, index.metric, **knn)
    found = cut_lineage(index.search(queries, k, qid=qid, qvec=qvec, where=where, **knobs))
    full = found.groupBy("qid").count().where(F.col("count") == k).select(F.col("qid").alias(qid))
    short = queries.join(full, qid, "left_anti")
    if short.isEmpty():
        return found
    again = dense.knn_join(short, passing, k, index.metric, **knn)
    return found.join(again.select("qid").distinct(), "qid", "left_anti").unionByName(again)


__all__ = [
    "IvfIndex", "assign_cells", "check_search", "default_cells", "filtered_search",
    "nearest_cells", "probe_table", "score_joined", "score_pairs", "train_centroids",
]
