"""Graph walks of query tables too large to broadcast.

A walk is one row: its beam, the rows to open next, and the query's vectors.  Each round sends the
query's vector to every row it opens; there the neighbours' vectors lie beside the row, so distances
come back instead of vectors, and only those that can still enter the beam.  The rows of the graph
stay where they were dealt, and finished walks leave the rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators import dense
from trawl.operators.dense import block_count, id_values, matrix_of, pair_blocks
from trawl.operators.ivf import IvfIndex, probe_table
from trawl.schema import Metric
from trawl.session import cut_lineage, scratch_path
from trawl.sources.storage import Folder

#: Walks that are brought forward together, and rows of the graph in a partition.
WALK_BLOCK = 1024
NODE_BLOCK = 8192
#: Opened rows scored at once, each with all its neighbours.
_HOP_ROWS = 1024
#: Lists of finished walks before they are written as one.
_PARTS = 16


def walk_beams(asked: DataFrame, vectors: DataFrame, ivf: IvfIndex, edges: DataFrame,
               entries: DataFrame, ef: int, entry_cells: int, allowed: DataFrame | None) -> DataFrame:
    """The best ``ef`` rows per query the walk meets, among ``allowed`` if given: ``qid, id, distance``."""
    if allowed is None:
        vectors = vectors.withColumn("ok", F.lit(False))
    else:
        passing = allowed.select("id", F.lit(True).alias("passes")).distinct()
        vectors = vectors.join(passing, "id", "left").withColumn("ok", F.col("passes").isNotNull())
    links = edges.select(F.col("id").alias("src"), F.explode("neighbours").alias("id"))
    spark = vectors.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffles, block_count(edges.count(), NODE_BLOCK))
    nodes = _nodes(links.join(vectors, "id").repartition(parts, "src")).sortWithinPartitions("src")
    # Rows of a round are many more than the bytes of its walks tell, so they are never broadcast.
    nodes = cut_lineage(nodes, dealt=True).hint("merge")
    # One row per cell, so as bounded as the centroids.
    starts = _nodes(entries.select(F.col("cell").alias("src"), "id").join(vectors, "id"))
    # Written, not checkpointed: a checkpoint keeps the estimated size, here a product that squares
    # with every round, until Spark is busy multiplying it.
    rounds = Folder(spark, scratch_path(spark, f"walks-{uuid.uuid4().hex}"))
    filtered, number = allowed is not None, 1
    walks = rounds.save("begun", _begin(asked, vectors.schema["id"].dataType, ivf, entry_cells))
    blocks = block_count(walks.count(), WALK_BLOCK)
    reached = _hop(walks, F.broadcast(starts), ivf.metric, ef)
    walks = rounds.save("round-0", _merge(walks, reached, blocks, ef, filtered, first=True))
    found = [_beam(walks.where(_ended()), filtered)]
    # Every round that opens a row improves some beam, so the walks end by themselves.
    while not (going := walks.where(~_ended())).isEmpty():
        reached = _hop(going, nodes, ivf.metric, ef)
        walks = rounds.save(f"round-{number}", _merge(going, reached, blocks, ef, filtered))
        number += 1
        found.append(_beam(walks.where(_ended()), filtered))
        if len(found) == _PARTS:
            found = [rounds.save(f"found-{number}", reduce(DataFrame.unionByName, found))]
    return reduce(DataFrame.unionByName, found)


def _nodes(links: DataFrame) -> DataFrame:
    """``src`` with the ids, vectors and marks of the rows it leads to."""
    to = links.groupBy("src").agg(F.collect_list(F.struct("id", "v", "ok")).alias("to"))
    return to.select("src", *[F.col(f"to.{name}").alias(f"{name}s") for name in ("id", "v", "ok")])


def _begin(asked: DataFrame, id_type: T.DataType, ivf: IvfIndex, entry_cells: int) -> DataFrame:
    """Empty beams; what is opened first are cells.  A repeated ``qid`` is one walk with several vectors."""
    probes = probe_table(asked, ivf.centroids, entry_cells, ivf.metric)
    cells = probes.groupBy("qid").agg(F.collect_set("cell").alias("open"))
    none, nowhere = F.array().cast(T.ArrayType(id_type)), F.array().cast("array<double>")
    return asked.groupBy("qid").agg(F.collect_list("qv").alias("qvs")).join(cells, "qid").select(
        "qid", F.col("qvs").cast(T.ArrayType(asked.schema["qv"].dataType)).alias("qvs"),
        none.alias("ids"), nowhere.alias("distances"),
        none.alias("kept_ids"), nowhere.alias("kept_distances"), "open",
    )


def _ended() -> Column:
    return F.size("open") == 0


def _beam(walks: DataFrame, kept: bool) -> DataFrame:
    ids, distances = ("kept_ids", "kept_distances") if kept else ("ids", "distances")
    rows = walks.select("qid", F.explode(F.arrays_zip(F.col(ids).alias("id"), F.col(distances).alias("distance"))).alias("r"))
    return rows.select("qid", "r.id", "r.distance")


def _hop(walks: DataFrame, nodes: DataFrame, metric: Metric, ef: int) -> DataFrame:
    """``qid, src, id, distance, ok``: what the opened rows lead to, if it may be among the best ``ef``."""
    def bound(ids: str, distances: str) -> Column:
        return F.when(F.size(ids) >= ef, F.element_at(distances, ef))

    asks = walks.select("qid", F.explode("open").alias("src"), "qvs", bound("ids", "distances").alias("bound"),
                        bound("kept_ids", "kept_distances").alias("kept_bound"))
    asks = asks.select("qid", "src", F.explode("qvs").alias("qv"), "bound", "kept_bound")
    rows = asks.join(nodes, "src").select("qid", "src", "qv", "bound", "kept_bound", "ids", "vs", "oks")
    out = T.StructType([
        rows.schema["qid"], rows.schema["src"],
        T.StructField("id", rows.schema["ids"].dataType.elementType),
        T.StructField("distance", T.DoubleType()), T.StructField("ok", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _HOP_ROWS):
                yield _scored(metric, batch.slice(start, _HOP_ROWS), out.names)

    return rows.mapInArrow(run, out)


def _scored(metric: Metric, batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    qid, src, qv, bound, kept_bound, ids, vs, oks = batch.columns
    row, vs, ok = _owners(ids), vs.flatten(), oks.flatten().to_numpy(zero_copy_only=False)
    q, x = matrix_of(qv), matrix_of(vs)
    d = dense.precise(metric, q[row], x)
    none = np.zeros(len(d), bool)
    if len(odd := np.flatnonzero(np.isnan(d))):
        # As ``distance`` has it: NULL with a missing value or without a length, else NaN.
        none[odd] = _lacking(qv, q)[row[odd]] | _lacking(vs, x)[odd]
        if metric is Metric.COSINE:
            none[odd] |= np.linalg.norm(q[row[odd]], axis=1) * np.linalg.norm(x[odd], axis=1) == 0
    may = _may_enter(bound, d, row) | (ok & _may_enter(kept_bound, d, row))
    at = pa.array(np.flatnonzero(may))
    rows = pa.array(row[may])
    return pa.RecordBatch.from_arrays([
        qid.take(rows), src.take(rows), ids.flatten().take(at), pa.array(d[may], mask=none[may]),
        pa.array(ok[may]),
    ], names=names)


def _may_enter(bound: pa.Array, d: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Undefined distances come last, so they enter only while there is no bound."""
    most = bound.to_numpy(zero_copy_only=False).astype(float)[row]
    return np.isnan(most) | (d <= most)


def _lacking(column: pa.Array, x: np.ndarray) -> np.ndarray:
    values = column.flatten()
    if not values.null_count:
        return np.zeros(len(x), bool)
    return values.is_null().to_numpy(zero_copy_only=False).reshape(x.shape).any(axis=1)


def _merge(walks: DataFrame, reached: DataFrame, blocks: int, ef: int, filtered: bool,
           first: bool = False) -> DataFrame:
    """The walks with their beams brought up to date, block by block."""
    id_list = walks.schema["ids"].dataType
    out = T.StructType([*walks.schema.fields[:-1], T.StructField("open", id_list)])
    qb = F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("qb")

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        wire = pa.schema([left.schema.field(name) for name in out.names[:-1]]
                         + [pa.field("open", left.schema.field("ids").type)])
        return _advanced(left, right, wire, ef, filtered, first) if left.num_rows else wire.empty_table()

    return pair_blocks(walks.select("*", qb), reached.select("*", qb), ["qb"], kernel, out)


def _advanced(left: pa.Table, right: pa.Table, wire: pa.Schema, ef: int, filtered: bool, first: bool) -> pa.Table:
    lists = {name: _whole(left.column(name)) for name in ("ids", "distances", "kept_ids", "kept_distances")}
    names = pa.concat_arrays([lists["ids"].flatten(), lists["kept_ids"].flatten(), _whole(right.column("id"))])
    d, none = _numbers(pa.concat_arrays([lists["distances"].flatten(), lists["kept_distances"].flatten(),
                                         _whole(right.column("distance"))]))
    own = id_values(left.column("qid"))
    order = np.argsort(own, kind="stable")
    asked = order[np.searchsorted(own[order], id_values(right.column("qid")))]
    q = np.concatenate([_owners(lists["ids"]), _owners(lists["kept_ids"]), asked])
    code = np.unique(id_values(names), return_inverse=True)[1]
    key = q * (len(code) + 1) + code
    beam, kept, new = np.split(np.arange(len(q)), np.cumsum([len(lists["ids"].flatten()), len(lists["kept_ids"].flatten())]))
    new = _met_once(new, key, id_values(right.column("src")))
    new = new[~np.isin(key[new], key[beam])]
    rows = np.concatenate([beam, new])
    # What a walk begins with is opened whole, however small the beam.
    best = rows[_best(q[rows], code[rows], d[rows], none[rows], len(rows) if first else ef)]
    fresh = best[np.isin(best, new)]
    opened = fresh[np.unique(key[fresh], return_index=True)[1]]
    if filtered:
        ok = np.zeros(len(q), bool)
        ok[len(q) - right.num_rows:] = _whole(right.column("ok")).to_numpy(zero_copy_only=False)
        kept = np.concatenate([kept, new[ok[new]]])
        if not first:
            kept = kept[_distinct(key[kept], d[kept], none[kept])]
        kept = kept[_best(q[kept], code[kept], d[kept], none[kept], ef)]

    def column(at: np.ndarray, values: pa.Array, name: str) -> pa.Array:
        ends = np.cumsum(np.bincount(q[at], minlength=left.num_rows))
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, values.take(pa.array(at))).cast(wire.field(name).type)

    far = pa.array(d, mask=none)
    return pa.table([
        left.column("qid"), left.column("qvs"), column(best, names, "ids"), column(best, far, "distances"),
        column(kept, names, "kept_ids"), column(kept, far, "kept_distances"), column(opened, names, "open"),
    ], schema=wire)


def _met_once(rows: np.ndarray, key: np.ndarray, src: np.ndarray) -> np.ndarray:
    """The rows of each key from its first source: every copy of a repeated id, whoever led to it."""
    source = np.unique(src, return_inverse=True)[1]
    order = np.lexsort((source, key[rows]))
    keys, source = key[rows][order], source[order]
    return rows[order[source == source[np.searchsorted(keys, keys)]]]


def _best(q: np.ndarray, code: np.ndarray, d: np.ndarray, none: np.ndarray, n: int) -> np.ndarray:
    """Places of the best ``n`` of each query, query by query: (distance, id) order, NaN and then NULL last."""
    order = np.lexsort((code, d, none, q))
    q = q[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < n]


def _distinct(key: np.ndarray, d: np.ndarray, none: np.ndarray) -> np.ndarray:
    order = np.lexsort((none, d, key))
    key, d, none = key[order], d[order], none[order]
    same = (key[1:] == key[:-1]) & (none[1:] == none[:-1]) & ((d[1:] == d[:-1]) | (np.isnan(d[1:]) & np.isnan(d[:-1])))
    return order[np.concatenate([np.ones(min(1, len(key)), bool), ~same])]


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    none = column.is_null().to_numpy(zero_copy_only=False)
    return np.where(none, 0.0, column.to_numpy(zero_copy_only=False)), none


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _owners(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
