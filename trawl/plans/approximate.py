"""Approximate search: with the knobs fully open it must equal the exact answer."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.dense import knn_join
from trawl.operators.filters import compile_filter
from trawl.operators.graph import GraphIndex
from trawl.operators.ivf import IvfIndex, assign_cells, filtered_search
from trawl.operators.proven import proven_search
from trawl.operators.quant import encode_table, fit
from trawl.plans.common import embeddings, sql_knn, sql_tidy, tidy, vector_queries
from trawl.plans.dense import LABELS, VECTORS
from trawl.schema import Metric
from trawl.session import cut_lineage, scratch_path
from trawl.sources.storage import Folder

K = 5
OPEN = 1 << 20
QUERIES: dict = {}
ORACLES: dict = {}

# Quantizers with the options their rescored answers are checked with.
RESCORED = {
    "none": {}, "fp16": {}, "bf16": {}, "sq8": {}, "sq4": {}, "usq8": {}, "usq4": {},
    "pq": {"pq_m": 16}, "rabitq": {"nb_bits": 4}, "bq": {"nb_bits": 4, "query_bits": 8},
    "tq": {"nb_bits": 4}, "osq": {"nb_bits": 4, "query_bits": 8},
}


def _exact(metric: str, where: str = "true") -> str:
    return f"""
WITH {sql_knn(metric, K, where)}
SELECT qid, id, rank, {sql_tidy('distance')} AS distance FROM hits"""


def _out(hits: DataFrame) -> DataFrame:
    return hits.select("qid", "id", "rank", tidy("distance"))


def _ivf(metric, layout="auto"):
    def run(spark, sf):
        index = IvfIndex.build(embeddings(spark, sf), metric)
        return _out(index.search(vector_queries(spark, sf), K, OPEN, layout=layout))
    return run


for _m in ("cosine", "l2", "ip", "l1"):
    QUERIES[f"ivf_full_probe_{_m}"] = _ivf(_m)
    ORACLES[f"ivf_full_probe_{_m}"] = _exact(_m)
QUERIES["ivf_full_probe_blocks"] = _ivf("cosine", "grid")
ORACLES["ivf_full_probe_blocks"] = _exact("cosine")


def _rescored(kind, options, metric):
    def run(spark, sf):
        index = IvfIndex.build(embeddings(spark, sf), metric, quant=kind, **options)
        return _out(index.search(vector_queries(spark, sf), K, OPEN, rescore_width=1))
    return run


for _kind, _options in RESCORED.items():
    if _kind != "none":
        QUERIES[f"{_kind}_rescored"] = _rescored(_kind, _options, "cosine")
        ORACLES[f"{_kind}_rescored"] = _exact("cosine")
for _m in ("l2", "ip"):
    QUERIES[f"sq8_rescored_{_m}"] = _rescored("sq8", {}, _m)
    ORACLES[f"sq8_rescored_{_m}"] = _exact(_m)


def _label_means(rows: DataFrame) -> np.ndarray:
    parts = rows.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x")).orderBy("label", "pos")
    # One value per label and dimension comes back: the size of a centroid table.
    return np.array([r["x"] for r in means.collect()]).reshape(-1, 64)


def ivf_cells(spark, sf):
    """Rows per cell when the centroids are the label means: a fixed, checkable model."""
    rows = embeddings(spark, sf)
    return assign_cells(rows, _label_means(rows), Metric.L2).groupBy("cell").agg(F.count("*").alias("n"))


QUERIES["ivf_assign"] = ivf_cells
ORACLES["ivf_assign"] = """
WITH parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY label, pos) GROUP BY label),
near AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS n FROM (
  SELECT vec_id, means.label, list_distance(embedding::DOUBLE[], c) AS d FROM embeddings, means))
SELECT label AS cell, count(*) AS n FROM near WHERE n = 1 GROUP BY label"""


def _partial(nprobe):
    def run(spark, sf):
        rows = embeddings(spark, sf)
        index = IvfIndex.assign(rows, Metric.L2, _label_means(rows))
        return _out(index.search(vector_queries(spark, sf), K, nprobe))
    return run


def _sql_partial(nprobe):
    return f"""
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
parts AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM v),
means AS (SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY label, pos) GROUP BY label),
near AS (SELECT vec_id, e, m.label AS cell, row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(e, c), m.label) AS n
         FROM v, means m),
hits AS (SELECT q.vec_id AS qid, r.vec_id AS id, list_distance(q.e, r.e) AS distance,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, r.e), r.vec_id) AS rank
         FROM near q JOIN near r ON q.cell = r.cell WHERE q.n <= {nprobe} AND r.n = 1)
SELECT qid, id, rank, {sql_tidy('distance')} AS distance FROM hits WHERE rank <= {K}"""


for _n in (1, 3):
    QUERIES[f"ivf_probe_{_n}"] = _partial(_n)
    ORACLES[f"ivf_probe_{_n}"] = _sql_partial(_n)


def sq_ranges(spark, sf):
    """The fitted per-dimension ranges of the scalar quantizer."""
    model = fit(embeddings(spark, sf), "sq8", Metric.L2)
    codes = encode_table(embeddings(spark, sf), model)
    return codes.select("id", F.lower(F.hex("code")).alias("code"))


QUERIES["sq8_codes"] = sq_ranges
ORACLES["sq8_codes"] = """
WITH parts AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
ranges AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM parts GROUP BY pos),
codes AS (SELECT vec_id, pos, round_even((x - lo) / (hi - lo) * 255, 0)::INTEGER AS c FROM parts JOIN ranges USING (pos))
SELECT vec_id AS id, lower(string_agg(printf('%02x', c), '' ORDER BY pos)) AS code FROM codes GROUP BY vec_id"""


def graph_full_beam(spark, sf):
    index = GraphIndex.build(embeddings(spark, sf), "cosine", m=16, ef_construction=48)
    return _out(index.search(vector_queries(spark, sf), K, ef_search=OPEN))


QUERIES["graph_full_beam"] = graph_full_beam
ORACLES["graph_full_beam"] = _exact("cosine")


def graph_walk(spark, sf):
    """What a narrow beam finds."""
    index = GraphIndex.build(embeddings(spark, sf), "cosine", m=16, ef_construction=48)
    return _out(index.search(vector_queries(spark, sf), K, ef_search=32))


QUERIES["graph_walk"] = graph_walk


def _filtered(mode, nprobe):
    def run(spark, sf):
        index = IvfIndex.build(embeddings(spark, sf), "cosine")
        where = compile_filter(LABELS, VECTORS)
        return _out(filtered_search(index, vector_queries(spark, sf), K, where, mode, nprobe=nprobe))
    return run


def _proven(metric, spec=None):
    """Only cells that can hold a neighbour are read, and the answer is exact."""
    def run(spark, sf):
        folder = Folder(spark, scratch_path(spark, f"ivf-{uuid.uuid4().hex}"))
        index = IvfIndex.build(embeddings(spark, sf), metric).write(folder)
        where = compile_filter(spec, VECTORS) if spec else None
        return _out(proven_search(index, vector_queries(spark, sf), K, where=where).hits)
    return run


for _m in ("cosine", "l2"):
    QUERIES[f"ivf_exact_probe_{_m}"] = _proven(_m)
    ORACLES[f"ivf_exact_probe_{_m}"] = _exact(_m)
QUERIES["ann_filtered_proven"] = _proven("cosine", LABELS)
ORACLES["ann_filtered_proven"] = _exact("cosine", "c.label IN (1, 3, 5) OR c.label > 7")
QUERIES["ann_filtered_scan"] = _filtered("scan", 1)
ORACLES["ann_filtered_scan"] = _exact("cosine", "c.label IN (1, 3, 5) OR c.label > 7")
QUERIES["ann_filtered_auto"] = _filtered("auto", 1)
ORACLES["ann_filtered_auto"] = ORACLES["ann_filtered_scan"]
QUERIES["ann_filtered_walk"] = _filtered("walk", OPEN)
ORACLES["ann_filtered_walk"] = ORACLES["ann_filtered_scan"]


def recall_of(hits: DataFrame, exact: DataFrame, name: str) -> DataFrame:
    """``method, recall``: share of the exact hits that were found."""
    found = exact.join(hits.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left")
    return found.agg(F.lit(name).alias("method"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def ivf_recall(spark, sf):
    rows, asked = embeddings(spark, sf), vector_queries(spark, sf)
    exact, index = knn_join(asked, rows, 10, "cosine"), IvfIndex.build(rows, "cosine")
    parts = [recall_of(index.search(asked, 10, n), exact, f"ivf_nprobe_{n}") for n in (1, 4, 8, 16)]
    return reduce(DataFrame.unionByName, parts)


def quant_recall(spark, sf):
    """Recall at 10 of every quantizer answering from its codes alone."""
    rows, asked = embeddings(spark, sf), vector_queries(spark, sf)
    # Compared with every quantizer, so found once.
    exact, plain = cut_lineage(knn_join(asked, rows, 10, "cosine")), IvfIndex.build(rows, "cosine")
    parts = []
    for kind, options in RESCORED.items():
        index = IvfIndex.assign(rows, plain.metric, plain.centroids,
                                fit(rows, kind, "cosine", **options))
        parts.append(recall_of(index.search(asked, 10, OPEN, 0), exact, kind))
    return reduce(DataFrame.unionByName, parts)


QUERIES["ivf_recall"] = ivf_recall
QUERIES["quant_recall"] = quant_recall
