"""Row preparation, mutation, lookup and continuous ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trawl.functions.embed import HashModel
from trawl.functions.text import Analyzer
from trawl.operators import mutate
from trawl.operators.filters import compile_filter
from trawl.plans.common import (
    SQL_POSTINGS, documents, sql_hash_embedding, sql_scored, sql_tidy, table, text_queries, tidy,
)
from trawl.schema import CollectionSchema, Column, IndexedJsonField, MetadataIndex
from trawl.session import cut_lineage, scratch_path
from trawl.operators.hybrid import HybridConfig
from trawl.operators.lexical import lexical_topk
from trawl.sources.collection import Collection
from trawl.sources.options import IvfOptions, IvfQuery, TextIndexOptions
from trawl.streaming.ingest import ingest, write_batch

QUERIES: dict = {}
ORACLES: dict = {}

CUSTOMERS = CollectionSchema(id_column="id", metadata_columns={"content": "TEXT", "value": "DOUBLE"},
                             json_column=None)


def _customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("content"),
        F.col("c_acctbal").alias("value"))


def _updates(spark, sf):
    """Orders as writes to their customer: many per id, the highest order key is the last."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("content"),
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("_pos"))


_SQL_CUSTOMERS = "SELECT c_custkey AS id, c_mktsegment AS content, c_acctbal AS value FROM customer"
_SQL_LAST = """
SELECT id, content, value FROM (
  SELECT o_custkey AS id, o_orderpriority AS content, o_totalprice AS value,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS turn FROM orders
) WHERE turn = 1"""

QUERIES["last_write_wins"] = lambda spark, sf: mutate.last_per_id(_updates(spark, sf)).drop("_pos")
ORACLES["last_write_wins"] = _SQL_LAST

QUERIES["upsert_lww"] = lambda spark, sf: mutate.upsert(_customers(spark, sf), _updates(spark, sf))
ORACLES["upsert_lww"] = f"""
WITH fresh AS ({_SQL_LAST}), old AS ({_SQL_CUSTOMERS})
SELECT * FROM fresh UNION ALL SELECT * FROM old ANTI JOIN fresh USING (id)"""


def upsert_mixed(spark, sf):
    """Supplier rows replace customers of the same key; the other suppliers' keys are new."""
    batch = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 7).alias("id"), F.col("s_name").alias("content"),
        F.lit(None).cast("double").alias("value"), F.col("s_suppkey").alias("_pos"))
    return mutate.upsert(_customers(spark, sf), batch)


QUERIES["upsert_mixed"] = upsert_mixed
ORACLES["upsert_mixed"] = f"""
WITH fresh AS (SELECT s_suppkey * 7 AS id, s_name AS content, NULL::DOUBLE AS value FROM supplier),
old AS ({_SQL_CUSTOMERS})
SELECT * FROM fresh UNION ALL SELECT * FROM old ANTI JOIN fresh USING (id)"""

_BUYERS = "SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'"


def _buyers(spark, sf):
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return orders.select(F.col("o_custkey").alias("id"))


def delete_ids(spark, sf):
    return mutate.delete(_customers(spark, sf), ids=_buyers(spark, sf))


def delete_filter(spark, sf):
    where = compile_filter({"value": {"$lt": 2500.0}}, CUSTOMERS)
    return mutate.delete(_customers(spark, sf), where=where)


def delete_both(spark, sf):
    where = compile_filter({"content": {"$in": ["BUILDING", "MACHINERY"]}}, CUSTOMERS)
    return mutate.delete(_customers(spark, sf), ids=_buyers(spark, sf), where=where)


QUERIES["delete_ids"] = delete_ids
ORACLES["delete_ids"] = f"""
WITH old AS ({_SQL_CUSTOMERS}), gone AS ({_BUYERS}) SELECT * FROM old ANTI JOIN gone USING (id)"""
QUERIES["delete_filter"] = delete_filter
ORACLES["delete_filter"] = (
    f"WITH old AS ({_SQL_CUSTOMERS}) SELECT * FROM old WHERE NOT coalesce(value < 2500, false)"
)
QUERIES["delete_both"] = delete_both
ORACLES["delete_both"] = f"""
WITH old AS ({_SQL_CUSTOMERS}), gone AS ({_BUYERS})
SELECT * FROM old WHERE NOT (content IN ('BUILDING', 'MACHINERY') AND id IN (SELECT id FROM gone))"""


def get_by_ids(spark, sf):
    """Every event asks for its user: repeats repeat, unknown users are skipped."""
    asked = table(spark, sf, "events").select(F.col("event_id").alias("pos"),
                                              F.col("user_id").alias("id"))
    return mutate.get_by_ids(_customers(spark, sf), asked)


QUERIES["get_by_ids"] = get_by_ids
ORACLES["get_by_ids"] = f"""
WITH old AS ({_SQL_CUSTOMERS})
SELECT event_id AS pos, old.* FROM events JOIN old ON old.id = user_id"""


def metadata_split(spark, sf):
    """Two keys become typed columns; what is left stays JSON."""
    schema = CollectionSchema(id_column="id", metadata_columns={
        "event_type": "TEXT", "value": "DOUBLE", "missing": "INTEGER"})
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.to_json(F.struct("event_type", "value", "user_id",
                           F.from_json("props", "k int").alias("props"))).alias("metadata"))
    return mutate.split_metadata(events, schema)


QUERIES["metadata_split"] = metadata_split
ORACLES["metadata_split"] = """
SELECT event_id AS id, event_type, value, NULL::INTEGER AS missing,
       '{"user_id":' || user_id || ',"props":{"k":' || (props->>'k') || '}}' AS metadata
FROM events"""


def documents_out(spark, sf):
    """Typed columns overwrite keys of the JSON column in the documents handed out."""
    schema = CollectionSchema(id_column="doc_id", content_column="text",
                              metadata_columns={"lang": "TEXT", "source": "TEXT"})
    rows = table(spark, sf, "documents").withColumn(
        "metadata", F.to_json(F.struct("n_chars", F.lit("old").alias("lang"))))
    out = mutate.to_documents(rows, schema)
    return out.select("id", F.md5("content").alias("content"), "metadata")


QUERIES["documents_out"] = documents_out
ORACLES["documents_out"] = """
SELECT doc_id::VARCHAR AS id, md5(text) AS content,
       '{"n_chars":' || n_chars || ',"lang":"' || lang || '","source":"' || source || '"}' AS metadata
FROM documents"""


def assign_ids(spark, sf):
    """Ids derived from the content where a row has none."""
    rows = documents(spark, sf).select(
        F.when(F.col("lang") == "en", F.col("id").cast("string")).alias("id"), "text")
    return mutate.assign_ids(rows, "id", "text").groupBy("id").agg(F.count("*").alias("n"))


QUERIES["assign_ids"] = assign_ids
ORACLES["assign_ids"] = """
SELECT coalesce(CASE WHEN lang = 'en' THEN doc_id::VARCHAR END, sha256(text)) AS id, count(*) AS n
FROM documents GROUP BY 1"""


# -- a collection at rest ----------------------------------------------------------------

_SQL_ROWS = "SELECT doc_id::VARCHAR AS id, md5(text) AS content, lang FROM documents"


def _collection(spark, **options) -> Collection:
    name = "registered_" + uuid.uuid4().hex[:10]
    schema = CollectionSchema.declare(
        8, metadata_columns=[Column("lang", "TEXT")], id_column=Column("id", "TEXT"))
    return Collection.create(spark, name, schema, embedder=HashModel(8), sync_load=False, **options)


def _dropping(target: Collection, out):
    """The rows of ``out``, kept apart from the collection, which is dropped."""
    kept = cut_lineage(out)
    target.drop()
    return kept


def _batch(spark, sf):
    return documents(spark, sf).select(
        F.col("id").cast("string").alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("lang", "source")).alias("metadata"))


def continuous_ingest(spark, sf):
    """The documents as a stream into a collection, one write per micro-batch."""
    target = _collection(spark)
    shape = table(spark, sf, "documents").schema
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(
        f"{sf}/documents*.parquet")
    stream = stream.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("lang", "source")).alias("metadata"))
    checkpoint = scratch_path(spark, "ingest-" + uuid.uuid4().hex)
    ingest(stream, target, checkpoint, refresh_every=1).awaitTermination()
    return _dropping(target, target.rows().select("id", F.md5("content").alias("content"), "lang"))


def collection_writes(spark, sf):
    """Add, refresh, delete by filter, write again: the current rows see all of it."""
    target = _collection(spark)
    target.add_texts(_batch(spark, sf))
    target.refresh()
    target.delete(filter={"lang": "fr", "source": {"$like": "src1%"}})
    again = _batch(spark, sf).withColumn("content", F.lower("content"))
    target.add_texts(again.where(F.get_json_object("metadata", "$['lang']") == "es"))
    return _dropping(target, target.rows().select("id", F.md5("content").alias("content"), "lang"))


def collection_search(spark, sf):
    """Text queries against a published index with every cell probed."""
    target = _collection(spark, vector_index=IvfOptions(quant="sq8"),
                         query_options=IvfQuery(nprobe=1 << 20, rescore_width=1))
    target.add_texts(_batch(spark, sf))
    target.refresh()
    found = target.search_with_score(text_queries(spark, sf), 4, {"lang": {"$ne": "fr"}})
    return _dropping(target, found.select(
        "qid", "rank", "id", F.md5("content").alias("content"), tidy("distance", 5)))


QUERIES["continuous_ingest"] = continuous_ingest
ORACLES["continuous_ingest"] = _SQL_ROWS
QUERIES["collection_writes"] = collection_writes
ORACLES["collection_writes"] = """
SELECT doc_id::VARCHAR AS id, md5(CASE WHEN lang = 'es' THEN lower(text) ELSE text END) AS content, lang
FROM documents WHERE NOT (lang = 'fr' AND source LIKE 'src1%')"""
QUERIES["collection_search"] = collection_search
ORACLES["collection_search"] = f"""
WITH d AS (SELECT doc_id::VARCHAR AS id, md5(text) AS content, {sql_hash_embedding('text')}::DOUBLE[] AS e
           FROM documents WHERE lang <> 'fr'),
q AS (SELECT item_id AS qid, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM benchmark)
SELECT qid, rank, id, content, {sql_tidy('distance', 5)} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM (
    SELECT qid, id, content, list_cosine_distance(q.e, d.e) AS distance FROM q, d)
) WHERE rank <= 4"""


# -- collections that live on ----------------------------------------------------------------

_EVERY_CELL = IvfQuery(nprobe=1 << 20)


def _nearest(target: Collection, spark, sf, k: int, spec=None):
    found = target.search_with_score(text_queries(spark, sf), k, spec)
    return _dropping(target, found.select("qid", "rank", "id", tidy("distance", 5)))


def _sql_nearest(k: int, where: str) -> str:
    return f"""
WITH d AS (SELECT doc_id, doc_id::VARCHAR AS id, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM documents WHERE {where}),
q AS (SELECT item_id AS qid, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM benchmark),
best AS (SELECT qid, doc_id, id, list_cosine_distance(q.e, d.e) AS distance FROM q, d)
SELECT qid, rank, id, {sql_tidy('distance', 5)} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, {{order}}) AS rank FROM best)
WHERE rank <= {k}"""


def collection_reopen(spark, sf):
    """Half of the rows before, half after an ``open`` that is told nothing but the name."""
    schema = CollectionSchema.declare(
        8, id_column=Column("key", "BIGINT"), metadata_columns=[Column("lang", "TEXT", False)],
        metadata_index=MetadataIndex(json_fields=[IndexedJsonField("n_chars", "INTEGER")]))
    name = "registered_" + uuid.uuid4().hex[:10]
    made = Collection.create(spark, name, schema, embedder=HashModel(8), sync_load=False,
                             text_index=TextIndexOptions(Analyzer("split", lower=False)))
    batch = documents(spark, sf).select(
        F.col("id").cast("string").alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata"))
    even = F.col("id").cast("long") % 2 == 0
    made.add_texts(batch.where(even))
    made.refresh()
    again = Collection.open(spark, name, embedder=HashModel(8), sync_load=False,
                            query_options=_EVERY_CELL)
    again.add_texts(batch.where(~even))
    again.refresh()
    return _nearest(again, spark, sf, 3, {"n_chars": {"$gte": 500}, "lang": {"$ne": "es"}})


def collection_small_index(spark, sf):
    """An index begun with a single row, and then given all others."""
    target = _collection(spark, vector_index=IvfOptions(), query_options=_EVERY_CELL)
    batch = _batch(spark, sf)
    first = batch.orderBy("id").limit(1)
    target.add_texts(first)
    target.refresh()
    target.add_texts(batch.join(first.select("id"), "id", "left_anti"))
    target.refresh()
    return _nearest(target, spark, sf, 3)


def collection_pending_delete(spark, sf):
    """A published index, and deletions that are not: no result is shorter for them."""
    target = _collection(spark, vector_index=IvfOptions(quant="none"), query_options=_EVERY_CELL)
    target.add_texts(_batch(spark, sf))
    target.refresh()
    target.delete(filter={"lang": {"$in": ["es", "de"]}})
    return _nearest(target, spark, sf, 4)


QUERIES["collection_reopen"] = collection_reopen
ORACLES["collection_reopen"] = _sql_nearest(3, "n_chars >= 500 AND lang <> 'es'").format(order="doc_id")
QUERIES["collection_small_index"] = collection_small_index
ORACLES["collection_small_index"] = _sql_nearest(3, "true").format(order="id")
QUERIES["collection_pending_delete"] = collection_pending_delete
ORACLES["collection_pending_delete"] = _sql_nearest(4, "lang NOT IN ('es', 'de')").format(order="id")


def collection_incremental(spark, sf):
    """Three publishes, two of them additions to the first: updates, deletions, then three searches."""
    target = _collection(spark, vector_index=IvfOptions(quant="none"), text_index=TextIndexOptions(),
                         query_options=_EVERY_CELL,
                         hybrid=HybridConfig(primary_top_k=10, secondary_top_k=10))
    batch, last = _batch(spark, sf), F.col("id").cast("long")
    target.add_texts(batch)
    target.refresh()
    target.add_texts(batch.where(last % 10 == 3).withColumn("content", F.concat(F.lit("renewed "), "content")))
    target.refresh()
    target.delete(ids=batch.where(last % 10 == 7).select("id"))
    target.add_texts(batch.where(last % 20 == 3).withColumn("content", F.concat(F.lit("twice renewed "), "content")))
    target.refresh()
    state = target.state()
    if state.base == state.version:
        raise AssertionError("the last publish was to be an addition")
    asked = text_queries(spark, sf)
    asked = asked.withColumn("text", F.concat(F.lit("renewed "), F.array_join(F.slice(F.split("text", " "), 1, 3), " ")))
    text = lexical_topk(target.text_index(), asked, 5, mode="any").select("qid", "rank", "id")
    dense = target.search_with_score(asked, 5).select("qid", "rank", "id")
    fused = target.search(asked, 5).select("qid", "rank", "id")
    return _dropping(target, text.withColumn("kind", F.lit("text")).unionByName(dense.withColumn("kind", F.lit("dense")))
                     .unionByName(fused.withColumn("kind", F.lit("hybrid"))))


QUERIES["collection_incremental"] = collection_incremental
ORACLES["collection_incremental"] = f"""
WITH now AS (
  SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 20 = 3 THEN 'twice renewed ' || text
    WHEN doc_id % 10 = 3 THEN 'renewed ' || text ELSE text END AS text FROM documents WHERE doc_id % 10 <> 7),
asked AS (SELECT item_id, 'renewed ' || array_to_string(string_split(text, ' ')[1:3], ' ') AS text FROM benchmark),
{SQL_POSTINGS.replace('FROM documents', 'FROM now').replace('doc_id AS id', 'id').replace('FROM benchmark', 'FROM asked')},
{sql_scored('bm25', False).replace('scored AS', 'any_term AS')},
{sql_scored('bm25', True).replace('scored AS', 'every_term AS')},
d AS (SELECT id, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM now),
qe AS (SELECT item_id AS qid, {sql_hash_embedding('text')}::DOUBLE[] AS e FROM asked),
near AS (SELECT qid, id, rank() OVER (PARTITION BY qid ORDER BY distance) AS place,
    row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank
  FROM (SELECT qid, id, list_cosine_distance(qe.e, d.e) AS distance FROM qe, d)),
lex AS (SELECT qid, id, rank() OVER (PARTITION BY qid ORDER BY score DESC) AS place,
    row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM every_term),
fused AS (SELECT qid, id, sum(1.0::DOUBLE / (60 + place)) AS score
  FROM (SELECT * FROM near WHERE rank <= 10 UNION ALL SELECT * FROM lex WHERE rank <= 10) GROUP BY qid, id)
SELECT qid, rank, id, 'text' AS kind FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM any_term) WHERE rank <= 5
UNION ALL SELECT qid, rank, id, 'dense' FROM near WHERE rank <= 5
UNION ALL SELECT qid, rank, id, 'hybrid' FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM fused) WHERE rank <= 5"""


def continuous_ingest_replay(spark, sf):
    """Three micro-batches that repeat ids, each after a restart from the checkpoint; then the first
    arrives again, takes its old place, and changes nothing."""
    target, run = _collection(spark), uuid.uuid4().hex
    source, checkpoint = scratch_path(spark, f"arriving-{run}"), scratch_path(spark, f"ingest-{run}")
    batch, number = _batch(spark, sf), F.col("id").cast("long")
    renamed = lambda mark: F.concat(F.lit(mark), "content")
    parts = [batch, batch.where(number % 4 == 1).withColumn("content", renamed("second ")),
             batch.where(number % 8 == 1).withColumn("content", renamed("third "))]
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        ingest(stream, target, checkpoint, refresh_every=2).awaitTermination()
    write_batch(parts[0], target, target.stream_seq(checkpoint, 0))
    return _dropping(target, target.rows().select("id", F.md5("content").alias("content"), "lang"))


QUERIES["continuous_ingest_replay"] = continuous_ingest_replay
ORACLES["continuous_ingest_replay"] = """
SELECT doc_id::VARCHAR AS id, md5(CASE WHEN doc_id % 8 = 1 THEN 'third ' WHEN doc_id % 4 = 1 THEN 'second '
  ELSE '' END || text) AS content, lang FROM documents"""
