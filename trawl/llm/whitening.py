"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

The scatter is summed up by Spark, block by block of rows centred first. On the driver lies nothing but
a square of the vectors' width: ``P'AP = LL'`` with the largest remaining diagonal entry as pivot shows
the rank, plane rotations from the right make the columns of ``L`` orthogonal, and then ``A``'s
eigenvalues are the squared norms of the columns and its eigenvectors the columns, normalised and with
their rows put back in place. No scatter is squared again and no small eigenvalue drowns in a large one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.session import scratch_path

#: Entries become ``floor(SCALE * c) + SHIFT``; an entry that does not fit a long so is no entry.
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0 ** 56
#: Components returned, at most.
COMPONENTS = 16
#: A remaining diagonal entry under this share of the largest first one ends the factoring.
RANK_TOLERANCE = 1e-14
#: Columns count as orthogonal from this cosine on.
COSINE_TOLERANCE = 1e-15


def pivoted_cholesky(a: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """``L`` (width by rank, lower trapezoidal) and the order of rows, with ``a[order][:, order] = LL'``."""
    a = np.array(a, float)
    width, order = len(a), np.arange(len(a))
    factor = np.zeros((width, width))
    least = tolerance * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(width):
        pivot = k + int(np.argmax(a.diagonal()[k:]))
        if not a[pivot, pivot] > least:
            return factor[:, :k], order
        swap = [k, pivot]
        a[swap] = a[swap[::-1]]
        a[:, swap] = a[:, swap[::-1]]
        factor[swap] = factor[swap[::-1]]
        order[swap] = order[swap[::-1]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``n`` columns once, in rounds of disjoint pairs; an odd one out rests."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(min(p), max(p)) for p in zip(ring[:half], ring[:half - 1:-1]) if max(p) < n]
        yield np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times a rotation, with orthogonal columns of falling norm."""
    columns = np.array(factor, float)
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(columns.shape[1]):
            x, y = columns[:, p], columns[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > COSINE_TOLERANCE * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            tan = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = np.where(turn, 1 / np.hypot(1.0, tan), 1.0)
            sin = np.where(turn, cos * tan, 0.0)
            columns[:, p], columns[:, q] = cos * x - sin * y, sin * x + cos * y
        if not turned:
            break
    return columns[:, np.argsort(-(columns ** 2).sum(0), kind="stable")]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a positive semi-definite matrix, falling, and unit eigenvectors (columns)."""
    factor, order = pivoted_cholesky(a)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated ** 2).sum(0))
    vectors = np.zeros_like(rotated)
    vectors[order] = rotated / norms
    return norms ** 2, vectors


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype)


def _summed(rows: DataFrame, blocks, width: int) -> np.ndarray:
    """The matrix of ``width`` rows that the blocks of ``rows`` give, added up by Spark.

    Each task emits one matrix, cut into entries; the driver receives one row of the sum for each
    row of the matrix.
    """
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = blocks(_matrix(batch.column(0), np.int64))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
                                             schema=schema)

    found = (rows.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
             .groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "v"))), lambda e: e["v"]).alias("row"))
             .orderBy("i").toArrow())
    return _matrix(found["row"].combine_chunks(), float) if found.num_rows else np.zeros((width, width))


def _long_or_null(values) -> list:
    return [v if v < 2 ** 63 else None for v in values]


class Whitening:
    """``n``, sums, eigenvalues and components of a fit list, and how far whitened rows are from white."""

    def __init__(self, n: int, sums: list[int], trace: float, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.trace, self.values, self.vectors = n, sums, trace, values, vectors
        self.identity_error = 0.0

    @property
    def mean(self) -> np.ndarray:
        # The whole part apart from the rest, so that large sums lose nothing.
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums], float)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list:
        """Exact sums of ``(n x - S)^2``; null where a long cannot hold it."""
        low, high = (int(f(initial=0)) for f in (x.min, x.max))
        most = max(self.n * max(abs(low), abs(high)), *map(abs, self.sums), 0) * 2
        if most < 2 ** 63:
            apart = self.n * x - np.array(self.sums, np.int64)
            widest = int(np.abs(apart).max(initial=0))
            if widest * widest * max(1, x.shape[1]) < 2 ** 63:
                return (apart * apart).sum(1).tolist()
        return _long_or_null(sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())

    @staticmethod
    def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
        """From ``x``, vectors of one width (``integral_vectors``); each distinct vector counts once.

        None without vectors. The distinct vectors are written once to the shared folder, and passed
        over three times: for the sums, for the scatter around the mean, and for the covariance of
        what comes out.
        """
        spark = vectors.sparkSession
        path = scratch_path(spark, f"whitening-{uuid.uuid4().hex}")
        vectors.select("x").distinct().write.parquet(path)
        fit = spark.read.schema("x array<bigint>").parquet(path)
        places = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
            F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("i").collect()
        if not places:
            return None
        n, sums = int(places[0]["n"]), [int(r["s"]) for r in places]
        width = len(sums)
        self = Whitening(n, sums, 0.0, np.ones(0), np.zeros((width, 0)))
        mean = self.mean

        def scatter(x):
            apart = x - mean
            return apart.T @ apart

        covariance = _summed(fit, scatter, width) / n
        covariance = (covariance + covariance.T) / 2
        values, directions = eigen(covariance)
        self = Whitening(n, sums, float(covariance.trace()), values[:components], directions[:, :components])
        kept = len(self.values)
        if kept:
            def whitened(x):
                z = self.whiten(x)
                return np.vstack([z.T @ z, z.sum(0)])

            found = _summed(fit, whitened, kept + 1)
            middle = found[-1] / n
            self.identity_error = float(np.abs(found[:-1] / n - np.outer(middle, middle) - np.eye(kept)).max())
        return self


def integral_vectors(rows: DataFrame, vector: str = "embedding", name: str = "x") -> DataFrame:
    """``rows`` with a usable vector, and that vector as longs ``floor(64 c) + 1000000``.

    Rows go whose vector is null or empty, or holds a null or non-finite entry or one beyond ``2^56``,
    whose long would not fit. If vectors of several widths remain, those of the commonest width stay
    (the largest of equally common ones): vectors of different widths have no covariance.
    """
    entry = F.col(vector)
    usable = F.coalesce(F.size(entry) > 0, F.lit(False)) & F.coalesce(
        F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST)), F.lit(False))
    rows = rows.where(usable)
    widths = (rows.groupBy(F.size(entry).alias("width")).count()
              .orderBy(F.desc("count"), F.desc("width")).limit(1).collect())
    if widths:
        rows = rows.where(F.size(entry) == widths[0]["width"])
    return rows.withColumn(name, F.transform(
        entry, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(SHIFT).cast("bigint")))


def whiten(rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``, a row for each row and component.

    Every row with a usable vector (``integral_vectors``) is returned, copies too; the model is fitted to
    each distinct vector once. Components are numbered from 1 by falling variance; those without
    variance have no scale and are left out, so vectors that are all alike give no rows, and neither does
    an empty table. ``deviation`` is null where it exceeds a long. Other columns play no part.
    """
    narrow = integral_vectors(rows.select(F.col(id_column).alias("id"), F.col(vector).alias("v")), "v").select("id", "x")
    model = Whitening.fit(narrow, components)
    id_type = rows.schema[id_column].dataType.simpleString()
    schema = (f"`{id_column}` {id_type}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    numbers = np.arange(1, len(model.values) + 1, dtype=np.int32)

    def run(batches):
        fitted = shared.value
        kept = len(numbers)
        for batch in batches:
            many = batch.num_rows
            if not many:
                continue
            x = _matrix(batch.column(1), np.int64)
            each = np.repeat(np.arange(many), kept)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(numbers, many)),
                pa.array(np.full(many * kept, fitted.n)),
                pa.array(fitted.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(fitted.whiten(x).ravel()), pa.array(np.tile(fitted.values / fitted.trace, many)),
                pa.array(np.full(many * kept, fitted.identity_error))],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return narrow.mapInArrow(run, schema)
