"""Vector quantizers: fitted by Spark aggregates, applied to Arrow batches inside tasks.

A quantizer turns a vector into a short code and back into an approximation.  The length of what
is lost is stored next to each code, which gives a bound on the error of every code distance and
lets a search decide exactly which rows must be read again at full precision.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators.dense import matrix_of
from trawl.schema import Metric

# The quantizers, and the options each of them takes.
QUANTIZERS = {
    "none": set(),
    "fp16": set(),
    "bf16": set(),
    "sq8": set(),
    "sq4": set(),
    "usq8": set(),
    "usq4": set(),
    "pq": {"pq_m"},
    "rabitq": {"nb_bits"},
    "bq": {"nb_bits", "query_bits"},
    "tq": {"nb_bits"},
    "osq": {"nb_bits", "query_bits"},
}
DEFAULT_BITS = {"rabitq": 0, "bq": 1, "tq": 4, "osq": 4}
PQ_CENTROIDS = 256
PQ_SAMPLE = 65536
ROTATION_SEED = 20240229


def check_options(kind: str, metric: Metric, dim: int | None, *, pq_m: int | None = None,
                  nb_bits: float | None = None, query_bits: int | None = None) -> None:
    """Refuse impossible combinations before any job starts (ValueError)."""
    if kind not in QUANTIZERS:
        raise ValueError(f"unknown quantizer {kind!r}; use one of {sorted(QUANTIZERS)}")
    given = {"pq_m": pq_m, "nb_bits": nb_bits, "query_bits": query_bits}
    for name, value in given.items():
        if value is not None and name not in QUANTIZERS[kind]:
            raise ValueError(f"{name} cannot go with quant={kind!r}")
    if kind != "none" and metric is Metric.L1:
        raise ValueError("the l1 metric supports only quant='none'")
    if pq_m is not None and (pq_m < 1 or (dim is not None and dim % pq_m)):
        raise ValueError(f"pq_m={pq_m} must divide the vector dimension")
    if nb_bits is not None:
        whole = float(nb_bits).is_integer()
        low = 0 if kind == "rabitq" else 1
        if not (low <= nb_bits <= 8) or not (whole or (nb_bits == 1.5 and kind in ("tq", "bq"))):
            raise ValueError(f"nb_bits={nb_bits:g} is not valid for quant={kind!r}")
    if query_bits is not None and not 1 <= query_bits <= 8:
        raise ValueError("query_bits must be between 1 and 8")


def _pack(codes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, dim) small integers -> (rows, bytes)."""
    if bits == 8:
        return codes.astype(np.uint8)
    planes = (codes[:, :, None] >> np.arange(bits)) & 1
    return np.packbits(planes.astype(np.uint8).reshape(len(codes), -1), axis=1)


def _unpack(raw: np.ndarray, bits: int, dim: int) -> np.ndarray:
    if bits == 8:
        return raw[:, :dim].astype(np.int64)
    planes = np.unpackbits(raw, axis=1)[:, : dim * bits].reshape(len(raw), dim, bits)
    return (planes.astype(np.int64) << np.arange(bits)).sum(axis=2)


def _uniform(x: np.ndarray, lo, hi, levels: int) -> np.ndarray:
    """Nearest of ``levels`` even steps between ``lo`` and ``hi``."""
    span = np.where(hi > lo, hi - lo, 1.0)
    return np.clip(np.rint((x - lo) / span * (levels - 1)), 0, levels - 1).astype(np.int64)


def _from_uniform(codes: np.ndarray, lo, hi, levels: int) -> np.ndarray:
    return lo + codes * np.where(hi > lo, hi - lo, 0.0) / (levels - 1)


def gaussian_codebook(levels: int) -> np.ndarray:
    """Least-squares levels for a standard normal value, by fixed-point iteration."""
    grid = np.linspace(-6.0, 6.0, 24001)
    weight = np.exp(-grid * grid / 2.0)
    book = np.linspace(-2.0, 2.0, levels)
    for _ in range(200):
        cell = np.searchsorted((book[1:] + book[:-1]) / 2.0, grid)
        mass = np.bincount(cell, weight, levels)
        book = np.bincount(cell, weight * grid, levels) / np.maximum(mass, 1e-300)
    return book


@dataclass
class Quantizer:
    """A fitted quantizer; small enough to travel with every task."""

    kind: str
    dim: int
    metric: Metric
    nb_bits: float | None = None
    query_bits: int | None = None
    params: dict[str, np.ndarray] = field(default_factory=dict)

    # -- preparation: cosine codes describe unit vectors ----------------------------------

    def prepare(self, x: np.ndarray) -> np.ndarray:
        if self.metric is not Metric.COSINE:
            return x
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(length > 0, length, 1.0)

    def to_json(self) -> str:
        plain = {**vars(self), "metric": self.metric.value}
        plain["params"] = {k: v.tolist() for k, v in self.params.items()}
        return json.dumps(plain)

    @classmethod
    def from_json(cls, text: str) -> "Quantizer":
        plain = json.loads(text)
        plain["metric"] = Metric(plain["metric"])
        plain["params"] = {k: np.array(v, float) for k, v in plain["params"].items()}
        return cls(**plain)

    def _levels(self) -> tuple[int, int]:
        """Levels per dimension and the bits that hold them."""
        bits = self.nb_bits if self.nb_bits is not None else DEFAULT_BITS[self.kind]
        if self.kind == "rabitq":
            bits += 1
        levels = 3 if bits == 1.5 else 2 ** int(bits)
        return levels, math.ceil(math.log2(levels))

    def _scalar_bits(self) -> int:
        return 4 if self.kind.endswith("4") else 8

    # -- codes ----------------------------------------------------------------------------

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Prepared vectors -> (rows, bytes); per-vector numbers come first."""
        if self.kind == "none":
            return x.astype("<f4").view(np.uint8)
        if self.kind == "fp16":
            return x.astype("<f2").view(np.uint8)
        if self.kind == "bf16":
            word = x.astype("<f4").view("<u4")
            return ((word + 0x7FFF + ((word >> 16) & 1)) >> 16).astype("<u2").view(np.uint8)
        if "sq" in self.kind and self.kind != "osq":
            bits = self._scalar_bits()
            return _pack(_uniform(x, self.params["lo"], self.params["hi"], 2**bits), bits)
        if self.kind == "pq":
            parts = x.reshape(len(x), len(self.params["books"]), -1)
            near = [
                ((parts[:, j, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
                for j, book in enumerate(self.params["books"])
            ]
            return np.stack(near, axis=1).astype(np.uint8)
        head, codes = self._encode_levels(x)
        return np.hstack([head.astype("<f4").view(np.uint8), _pack(codes, self._levels()[1])])

    def decode(self, raw: np.ndarray) -> np.ndarray:
        if self.kind == "none":
            return np.ascontiguousarray(raw).view("<f4").astype(np.float64)
        if self.kind == "fp16":
            return np.ascontiguousarray(raw).view("<f2").astype(np.float64)
        if self.kind == "bf16":
            word = np.ascontiguousarray(raw).view("<u2").astype("<u4") << 16
            return word.view("<f4").astype(np.float64)
        if "sq" in self.kind and self.kind != "osq":
            bits = self._scalar_bits()
            codes = _unpack(raw, bits, self.dim)
            return _from_uniform(codes, self.params["lo"], self.params["hi"], 2**bits)
        if self.kind == "pq":
            books = self.params["books"]
            return np.hstack([book[raw[:, j]] for j, book in enumerate(books)])
        width = 8
        head = np.ascontiguousarray(raw[:, :width]).view("<f4").astype(np.float64)
        return self._decode_levels(head, _unpack(raw[:, width:], self._levels()[1], self.dim))

    def _encode_levels(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers per vector, and one small integer per dimension."""
        levels, _ = self._levels()
        if "rotation" in self.params:
            x = x @ self.params["rotation"]
        if self.kind == "tq":
            scale = np.sqrt((x * x).mean(axis=1, keepdims=True))
            book = self.params["book"]
            unit = x / np.where(scale > 0, scale, 1.0)
            codes = np.searchsorted((book[1:] + book[:-1]) / 2.0, unit)
            return np.hstack([scale, scale]), codes
        if self.kind == "osq":
            lo, hi = self._best_interval(x, levels)
            return np.hstack([lo, hi]), _uniform(x, lo, hi, levels)
        size = np.abs(x)
        if levels == 2:
            reach = size.mean(axis=1, keepdims=True)
        else:
            reach = size.max(axis=1, keepdims=True) * (levels - 1) / levels
        return np.hstack([-reach, reach]), _uniform(x, -reach, reach, levels)

    def _decode_levels(self, head: np.ndarray, codes: np.ndarray) -> np.ndarray:
        levels, _ = self._levels()
        lo, hi = head[:, :1], head[:, 1:2]
        if self.kind == "tq":
            x = self.params["book"][codes] * lo
        else:
            x = _from_uniform(codes, lo, hi, levels)
        return x @ self.params["rotation"].T if "rotation" in self.params else x

    @staticmethod
    def _best_interval(x: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
        """Per vector, the symmetric shrink of [min, max] that loses least."""
        lo, hi = x.min(axis=1, keepdims=True), x.max(axis=1, keepdims=True)
        middle, half = (lo + hi) / 2.0, (hi - lo) / 2.0
        best, loss = (lo, hi), np.full((len(x), 1), np.inf)
        for shrink in np.linspace(0.3, 1.0, 15):
            a, b = middle - half * shrink, middle + half * shrink
            back = _from_uniform(_uniform(x, a, b, levels), a, b, levels)
            miss = ((x - back) ** 2).sum(axis=1, keepdims=True)
            better = miss < loss
            loss = np.where(better, miss, loss)
            best = (np.where(better, a, best[0]), np.where(better, b, best[1]))
        return best

    def quantize_queries(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries as the codes see them, and how far each was moved."""
        q = self.prepare(q)
        if self.query_bits is None:
            return q, np.zeros(len(q))
        lo, hi = q.min(axis=1, keepdims=True), q.max(axis=1, keepdims=True)
        levels = 2**self.query_bits
        seen = _from_uniform(_uniform(q, lo, hi, levels), lo, hi, levels)
        return seen, np.sqrt(((q - seen) ** 2).sum(axis=1))


# -- fitting -----------------------------------------------------------------------------


def _ranges(corpus: DataFrame, vec: str) -> tuple[np.ndarray, np.ndarray]:
    """Per-dimension minimum and maximum: one row per dimension comes back."""
    parts = corpus.select(F.posexplode(vec).alias("pos", "x"))
    rows = parts.groupBy("pos").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rows = sorted(rows.collect())
    return np.array([r["lo"] for r in rows], float), np.array([r["hi"] for r in rows], float)


def unit_vectors(corpus: DataFrame, vec: str) -> DataFrame:
    """Replace ``vec`` by its unit vector (zero vectors stay)."""
    length = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    corpus = corpus.withColumn("__length", length)
    scaled = F.transform(vec, lambda x: x / F.when(F.col("__length") > 0, F.col("__length")).otherwise(1.0))
    return corpus.withColumn(vec, scaled).drop("__length")


def _codebooks(corpus: DataFrame, vec: str, dim: int, pq_m: int) -> np.ndarray:
    """One small k-means per sub-vector, in parallel, on a bounded training sample."""
    sub = dim // pq_m
    rows = corpus.count()
    train = corpus.select(vec)
    if rows > PQ_SAMPLE:
        train = train.sample(PQ_SAMPLE / rows, seed=ROTATION_SEED)
    parts = train.select(F.posexplode(F.array(*[
        F.slice(vec, j * sub + 1, sub) for j in range(pq_m)
    ])).alias("part", "v"))
    out = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("book", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ])

    def fit(group: pa.Table) -> pa.Table:
        x = matrix_of(group.column("v"))
        x = x[np.lexsort(x.T)]
        rng = np.random.default_rng(ROTATION_SEED)
        book = x[np.sort(rng.choice(len(x), min(PQ_CENTROIDS, len(x)), replace=False))]
        for _ in range(10):
            near = ((x * x).sum(1)[:, None] - 2.0 * x @ book.T + (book * book).sum(1)).argmin(1)
            size = np.bincount(near, minlength=len(book))
            total = np.zeros_like(book)
            np.add.at(total, near, x)
            book = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], book)
        return pa.table({
            "part": pa.array([group.column("part")[0].as_py()], pa.int32()),
            "book": pa.array([book.tolist()], pa.list_(pa.list_(pa.float64()))),
        })

    found = parts.groupBy("part").applyInArrow(fit, out).orderBy("part").collect()
    return np.array([r["book"] for r in found], float)


def fit(corpus: DataFrame, kind: str, metric: Metric | str = Metric.L2, *, vec: str = "embedding",
        dim: int | None = None, pq_m: int | None = None, nb_bits: float | None = None,
        query_bits: int | None = None) -> Quantizer:
    """Fit a quantizer; only per-dimension statistics and codebooks reach the driver."""
    metric = Metric(metric)
    if dim is None:
        dim = int(corpus.select(F.size(vec)).first()[0])
    check_options(kind, metric, dim, pq_m=pq_m, nb_bits=nb_bits, query_bits=query_bits)
    params: dict[str, np.ndarray] = {}
    prepared = unit_vectors(corpus, vec) if metric is Metric.COSINE else corpus
    if kind in ("sq8", "sq4", "usq8", "usq4"):
        lo, hi = _ranges(prepared, vec)
        if kind.startswith("u"):
            lo, hi = np.full(dim, lo.min()), np.full(dim, hi.max())
        params = {"lo": lo, "hi": hi}
    elif kind == "pq":
        if pq_m is None:
            pq_m = next(m for m in range(max(1, dim // 4), 0, -1) if dim % m == 0)
        params = {"books": _codebooks(prepared, vec, dim, pq_m)}
    elif kind in ("rabitq", "tq"):
        noise = np.random.default_rng(ROTATION_SEED).normal(size=(dim, dim))
        params = {"rotation": np.linalg.qr(noise)[0]}
    out = Quantizer(kind, dim, metric, nb_bits, query_bits, params)
    if kind == "tq":
        out.params["book"] = gaussian_codebook(out._levels()[0])
    return out


def encode_table(corpus: DataFrame, quantizer: Quantizer, id: str = "id", vec: str = "embedding",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, code, err[, keep]``: ``err`` is the length of what the code loses."""
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(quantizer)
    source = corpus.select(id, vec, *keep)
    out = T.StructType([
        T.StructField("id", corpus.schema[id].dataType),
        T.StructField("code", T.BinaryType()),
        T.StructField("err", T.DoubleType()),
        *[corpus.schema[c] for c in keep],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantizer = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = quantizer.prepare(matrix_of(batch.column(1)))
            raw = quantizer.encode(x)
            miss = np.sqrt(((x - quantizer.decode(raw)) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in raw], pa.binary()),
                 pa.array(miss), *batch.columns[2:]],
                names=["id", "code", "err", *keep],
            )

    return source.mapInArrow(run, out)


def codes_of(column: pa.Array) -> np.ndarray:
    """Arrow binary column of equal-length codes -> (rows, bytes)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), -1)


def decode_table(codes: DataFrame, quantizer: Quantizer) -> DataFrame:
    """``id, embedding``: the approximations the codes stand for."""
    shared = codes.sparkSession.sparkContext.broadcast(quantizer)
    out = T.StructType([
        codes.schema["id"], T.StructField("embedding", T.ArrayType(T.DoubleType()))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = shared.value.decode(codes_of(batch.column(1)))
            offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            vectors = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["id", "embedding"])

    return codes.select("id", "code").mapInArrow(run, out)
