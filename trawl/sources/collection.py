"""A collection at rest: create, open, write, refresh, search and drop.

Every piece is a managed Parquet table of the session catalog, so a namespace is a database and
dropping is ``DROP TABLE``:

``<name>__rows_<b>``      the rows of base version ``b``, one per id
``<name>__log``           writes since then, partitioned by write number ``seq``
``<name>__state``         one appended row per published version
``<name>__streams``       the write number of every streamed micro-batch
``<name>__ix_<b>_<part>`` full-text and vector tables derived from version ``b``; contents stay in the rows
``<name>__ix_<b>_new_<part>``  entries of later versions, partitioned by the version ``gen``
``<name>__ix_<b>_field_<tag>_<part>`` terms of an analyzed metadata column or JSON field
``<name>__ix_<b>_changes`` ids changed in later versions, partitioned likewise

A write appends to the log and touches nothing else.  The current rows are those of the base whose
id is not in the log, plus the last logged row of each id, so only the log is ever deduplicated.
``refresh`` adds one partition of changed ids and one of their new index entries, and then appends
the state row which makes the version visible; an entry counts if its id has not changed since.  No
other file is written.  Once the changes since the base come to ``REWRITE_SHARE`` of its rows, or an
index is built anew, the next version is written whole, as a new base.  ``vacuum`` drops older bases
and the log they were made of; nothing else does.  Exact search sees every write; index search sees
published ones, and never a deleted one.

The state row keeps the collection's definition, so that ``open`` needs no declaration.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.embed import embed
from trawl.functions.text import Analyzer
from trawl.operators import dense, mutate
from trawl.operators.fieldterms import FieldTerms
from trawl.operators.filters import apply_filter, compile_filter
from trawl.operators.graph import GraphIndex
from trawl.operators.hybrid import HybridConfig, asks_words, hybrid_search, refuse_fused_scores
from trawl.operators.ivf import IvfIndex, filtered_search
from trawl.operators.layout import can_order, cluster
from trawl.operators.lexical import LexicalIndex, boolean_match, build_postings, term_stats
from trawl.operators.mmr import mmr
from trawl.schema import CollectionSchema, MetadataIndex, Metric
from trawl.session import cut_lineage, ship_package
from trawl.sources.options import (
    GraphOptions, GraphQuery, IvfOptions, IvfQuery, TextIndexOptions, check_query_type,
)
from trawl.sources.storage import Tables

STATE = ("version int, upto bigint, index string, text_index boolean, trained bigint, "
         "definition string, base int, base_upto bigint, base_rows bigint, changed bigint")
#: Changed rows, as a share of the base's rows, from which on a version is written whole: every row
#: is then rewritten a bounded number of times, however many versions there are.
REWRITE_SHARE = 0.5
#: Rows from which on a base is laid out along a curve over its indexed columns; fewer fill few
#: row groups, of which none could be left out.
CLUSTER_FROM = 1_000_000
#: Changed ids that are broadcast, at most.
MAX_BROADCAST_CHANGES = 1_000_000
STREAMS = "stream string, batch bigint, seq bigint"
MAX_PUSHED_IDS = 1000
MAX_PENDING_DELETES = 10_000
NAME = re.compile(r"(?!.*__)[A-Za-z0-9_]+")


@dataclass
class State:
    version: int = 0
    upto: int = -1
    index: str | None = None
    text_index: bool = False
    trained: int = 0
    definition: str = ""
    #: The version last written whole, the last write in it, its rows, and changes of rows since.
    base: int = 0
    base_upto: int = -1
    base_rows: int = 0
    changed: int = 0


def _plain(options) -> str | None:
    if options is None:
        return None
    spec = {k: v for k, v in vars(options).items() if k != "rabitq_bits"}
    return json.dumps({"type": options.index_type, **spec})


def _options(text: str | None):
    if not text:
        return None
    spec = json.loads(text)
    kind = {"ivf": IvfOptions, "hnsw": GraphOptions}[spec.pop("type")]
    return kind(**spec)


def _without(rows: DataFrame, gone: DataFrame | None, key: str, column: str | None = None) -> DataFrame:
    """The rows but those of the ids that are gone; ``column`` is what the rows call the ids."""
    if gone is None:
        return rows
    return rows.join(gone.withColumnRenamed(key, column or key), column or key, "left_anti")


def _named(filter: Any) -> set[str]:
    """Columns that a filter names, among other words."""
    if isinstance(filter, dict):
        return {str(k).partition(".")[0] for k in filter}.union(*map(_named, filter.values()))
    return set().union(*map(_named, filter)) if isinstance(filter, (list, tuple)) else set()


class Collection:
    """A named collection; DataFrames in and out, one job per call for any number of queries."""

    def __init__(self, spark: SparkSession, name: str, schema: CollectionSchema, *,
                 database: str = "default", embedder: Any = None,
                 hybrid: HybridConfig | None = None,
                 query_options: IvfQuery | GraphQuery | None = None,
                 sync_load: bool = True, query_embedder: Any = None,
                 cluster_from: int = CLUSTER_FROM) -> None:
        if not NAME.fullmatch(name) or name.endswith("_"):
            raise ValueError("a collection's name holds letters, digits and single underscores")
        ship_package(spark)
        self.spark, self.name, self.schema, self.database = spark, name, schema, database
        self.embedder, self.hybrid, self.query_options = embedder, hybrid, query_options
        self.sync_load = sync_load
        # A model may read queries in another way than documents.
        self.query_embedder = embedder if query_embedder is None else query_embedder
        self.cluster_from = cluster_from

    # -- lifecycle ------------------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, name: str, schema: CollectionSchema, *,
               database: str = "default", overwrite: bool = False, if_not_exists: bool = False,
               vector_index: IvfOptions | GraphOptions | None = None,
               text_index: TextIndexOptions | None = None, **options: Any) -> "Collection":
        """Create the collection's tables, optionally declaring its indexes."""
        if overwrite and if_not_exists:
            raise ValueError("use only one of overwrite and if_not_exists")
        if text_index is not None:
            schema = replace(schema, content_analyzer=text_index.analyzer)
            vector_index = vector_index or IvfOptions()
        schema.indexed_columns()
        if vector_index is not None:
            vector_index.check(schema.metric, schema.dim)
        self = cls(spark, name, schema, database=database, **options)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        if self.exists():
            if if_not_exists:
                return cls.open(spark, name, database=database, **options)
            if not overwrite:
                raise ValueError(f"{database}.{name} is taken; overwrite it or open it")
            self.drop()
        rows = spark.createDataFrame([], schema.struct())
        Tables(spark, self._name("")).save("rows_0", schema.promote(rows))
        log = T.StructType([T.StructField(f.name, f.dataType) for f in schema.struct()])
        log = log.add("_op", T.StringType()).add("_pos", T.LongType()).add("seq", T.LongType())
        Tables(spark, self._name("")).save("log", spark.createDataFrame([], log), "seq")
        Tables(spark, self._name("")).save("streams", spark.createDataFrame([], STREAMS))
        self._publish(State(index=_plain(vector_index), text_index=text_index is not None,
                            definition=schema.to_json()))
        return self

    @classmethod
    def open(cls, spark: SparkSession, name: str, *, database: str = "default",
             embedder: Any = None, hybrid: HybridConfig | None = None,
             query_options: IvfQuery | GraphQuery | None = None, sync_load: bool = True,
             query_embedder: Any = None, cluster_from: int = CLUSTER_FROM,
             metadata_index: MetadataIndex | None = None, **columns: Any) -> "Collection":
        """Open an existing collection as it was defined.

        Named columns are checked against the stored definition; ``metadata_columns`` or
        ``ignore_metadata_columns`` choose which of its metadata columns are returned, and
        ``metadata_index`` is for rows not yet published with another one.
        """
        probe = cls(spark, name, CollectionSchema(), database=database)
        if not probe.exists():
            raise ValueError(f"there is no collection {database}.{name}")
        state = probe.state()
        schema = CollectionSchema.from_json(state.definition)
        names = dict(id_column=schema.id_column, content_column=schema.content_column,
                     embedding_column=schema.embedding_column, json_column=schema.json_column)
        rows = spark.table(probe._name(f"rows_{state.base}"))
        asked = CollectionSchema.inspect(rows, **{**names, **columns})
        for what, kept in names.items():
            if what in columns and columns[what] != kept:
                raise ValueError(f"{what} of {database}.{name} is {kept}, not {columns[what]}")
        if columns.get("metadata_columns") or columns.get("ignore_metadata_columns"):
            schema = replace(schema, returned=tuple(asked.metadata_columns))
        if metadata_index is not None:
            schema = schema.with_index(metadata_index)
        return cls(spark, name, schema, database=database, embedder=embedder, hybrid=hybrid,
                   query_options=query_options, sync_load=sync_load,
                   query_embedder=query_embedder, cluster_from=cluster_from)

    def _name(self, part: str) -> str:
        return f"`{self.database}`.{self.name}__{part}"

    def exists(self) -> bool:
        found = self.spark.catalog.databaseExists(self.database)
        return found and self.spark.catalog.tableExists(f"{self.database}.{self.name}__state")

    def drop(self) -> None:
        """Drop every table of the collection; nothing happens when there is none."""
        if not self.spark.catalog.databaseExists(self.database):
            return
        self._drop_tables(lambda part: True)

    def _drop_tables(self, chosen) -> None:
        prefix = f"{self.name}__".lower()
        for table in self.spark.catalog.listTables(self.database):
            if table.name.lower().startswith(prefix) and chosen(table.name[len(prefix):]):
                self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{table.name}`")

    def state(self) -> State:
        row = self.spark.table(self._name("state")).orderBy(F.desc("version")).first()
        return State(**row.asDict())

    def _publish(self, state: State) -> None:
        row = self.spark.createDataFrame([tuple(vars(state).values())], STATE).coalesce(1)
        row.write.mode("append").format("parquet").saveAsTable(self._name("state"))

    # -- rows -----------------------------------------------------------------------------

    def _log(self, after: int) -> DataFrame:
        return self.spark.table(self._name("log")).where(F.col("seq") > after)

    def _latest(self, after: int, upto: int | None = None, once: bool = False) -> DataFrame:
        """The last logged row of each id among the writes after one, up to another; ``once`` says that
        no id is there twice."""
        log = self._log(after)
        log = log if upto is None else log.where(F.col("seq") <= upto)
        return log if once else mutate.last_per_id(log, self.schema.id_column, ("seq", "_pos"))

    def _once(self, after: int, upto: int) -> bool:
        """Whether no id was written twice among the writes after one, up to another."""
        ids = self._log(after).where(F.col("seq") <= upto).select(self.schema.id_column)
        return ids.count() == ids.distinct().count()

    def _held(self, held: DataFrame, changed: DataFrame) -> DataFrame | None:
        """The changed ids that ``held`` has, to be left out of it; ``None`` if it has none of them.

        Only ids are shuffled; where most are new, what is left out of a large table is broadcast or nothing.
        """
        key = self.schema.id_column
        both = cut_lineage(held.select(key).join(changed.select(key), key, "left_semi"))
        number = both.count()
        if not number:
            return None
        return F.broadcast(both) if number <= MAX_BROADCAST_CHANGES else both

    def published(self) -> DataFrame:
        """The rows of the published version."""
        state = self.state()
        return self._current(state, state.upto)

    def rows(self) -> DataFrame:
        """Every current row, published or not."""
        return self._current(self.state())

    def _current(self, state: State, upto: int | None = None) -> DataFrame:
        kept, fresh = self._parts(state, upto)
        return kept.unionByName(fresh)

    def _parts(self, state: State, upto: int | None = None, written: bool = False) -> tuple[DataFrame, DataFrame]:
        """The rows of the base that have not changed since, and those that have.

        For rows to be ``written`` it is first looked up which ids repeat; so rows are not shuffled for others.
        """
        key = self.schema.id_column
        base = self.spark.table(self._name(f"rows_{state.base}"))
        latest = self._latest(state.base_upto, upto, written and self._once(state.base_upto, upto))
        gone = self._held(base, latest) if written else latest.select(key)
        kept = _without(base, gone, key)
        fresh = latest.where(F.col("_op") == "upsert").drop("_op", "_pos", "seq")
        promoted = {f.physical for f in self._json_fields()}
        plain = [c for c in base.columns if not c.startswith("json__")]
        if promoted <= set(base.columns):
            # Promoted fields are stored, and filters on them reach the scan.
            columns = [*plain, *sorted(promoted)]
            return kept.select(*columns), self.schema.promote(fresh).select(*columns)
        return self.schema.promote(kept.select(*plain)), self.schema.promote(fresh.select(*plain))

    def find(self, filter: dict | None) -> DataFrame:
        """Every current row a filter holds for, in the collection's own columns.

        Term predicates on fields declared with an analyzer are looked up in the field's own postings, but
        for rows that changed since the base, which are analyzed in place. Long lists are joined.
        """
        state = self.state()
        kept, fresh = self._parts(state)
        terms = {}
        for name, analyzer in self.schema.analyzed_fields().items():
            store = self._field_store(state.base, name, analyzer)
            if store.has("postings"):
                terms[name] = FieldTerms.read(store, analyzer)
        return (apply_filter(kept, filter, self.schema, terms)
                .unionByName(apply_filter(fresh, filter, self.schema)))

    def _field_store(self, version: int, field: str, analyzer: Analyzer) -> Tables:
        tag = hashlib.md5(repr((field, analyzer)).encode()).hexdigest()[:10]
        return Tables(self.spark, self._name(f"ix_{version}_field_{tag}_"))

    def _derive_fields(self, version: int, rows: DataFrame) -> None:
        """Terms of every analyzed metadata column and JSON field, for ``find``."""
        for name, analyzer in self.schema.analyzed_fields().items():
            declared = self.schema.json_field(name)
            value = F.col(declared.physical) if declared else F.col(f"`{name}`")
            FieldTerms.build(rows, self.schema.id_column, value, analyzer).write(
                self._field_store(version, name, analyzer))

    def _json_fields(self):
        index = self.schema.metadata_index
        return index.json_fields if index else ()

    # -- writes ---------------------------------------------------------------------------

    def add_embeddings(self, batch: DataFrame | None = None, *, texts: Sequence[str] | None = None,
                       embeddings: Sequence[Sequence[float]] | None = None,
                       metadatas: Sequence[dict] | None = None,
                       ids: Sequence | None = None) -> DataFrame:
        """Upsert rows ``[id,] content, embedding, metadata`` (JSON); returns ``_pos, id``.

        Lists are accepted for small batches and cut to the shortest of them.
        """
        if batch is None:
            batch = self._from_lists(texts, metadatas, ids, embeddings)
            if batch is None:
                return self.spark.createDataFrame([], "_pos bigint, id string")
        return self._append(batch)

    def add_texts(self, batch: DataFrame | None = None, **lists: Any) -> DataFrame:
        """Embed ``content`` and upsert."""
        if batch is None:
            batch = self._from_lists(lists.get("texts"), lists.get("metadatas"), lists.get("ids"))
            if batch is None:
                return self.spark.createDataFrame([], "_pos bigint, id string")
        return self._append(self._embedded(batch))

    add_documents = add_texts

    def _embedded(self, batch: DataFrame) -> DataFrame:
        if self.embedder is None:
            raise ValueError("this collection was opened without an embedder")
        batch = mutate.number_rows(batch)
        return embed(batch, self.embedder, "content", "embedding")

    def _from_lists(self, texts, metadatas, ids, embeddings=None) -> DataFrame | None:
        texts = list(texts or [])
        if not texts:
            return None
        metadatas = [{} for _ in texts] if not metadatas else metadatas
        ids = [None for _ in texts] if not ids else [None if i is None else str(i) for i in ids]
        vectors = [None for _ in texts] if embeddings is None else [
            [float(x) for x in v] for v in embeddings
        ]
        rows = [
            (pos, id, text, vector, json.dumps(meta, default=str))
            for pos, (id, text, vector, meta) in enumerate(zip(ids, texts, vectors, metadatas))
        ]
        shape = "_pos bigint, id string, content string, embedding array<float>, metadata string"
        return self.spark.createDataFrame(rows, shape)

    def prepare(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch in the collection's columns, with ``_op`` and ``_pos``."""
        s, target = self.schema, self.schema.struct()
        batch = mutate.assign_ids(mutate.number_rows(batch), "id")
        batch = mutate.split_metadata(batch, s)
        vector = mutate.to_vector(F.col("embedding"), s.dim)
        fixed = {
            s.id_column: F.col("id").cast(target[s.id_column].dataType),
            s.content_column: F.col("content"),
            s.embedding_column: vector,
        }
        required = {s.content_column, *s.not_null}
        cols = []
        for f in target:
            col = fixed.get(f.name, F.col(f"`{f.name}`"))
            if f.name in required:
                empty = F.raise_error(F.lit(f"column {f.name} must not be null"))
                col = F.when(col.isNull(), empty).otherwise(col)
            cols.append(col.alias(f.name))
        return batch.select(*cols, F.lit("upsert").alias("_op"), F.col("_pos").cast("bigint"))

    def _append(self, batch: DataFrame) -> DataFrame:
        # Fresh ids are random: write once, and read the ids back from what was written.
        seq = self._write_log(self.prepare(batch))
        written = self.spark.table(self._name("log")).where(F.col("seq") == seq)
        ids = written.select("_pos", F.col(self.schema.id_column).cast("string").alias("id"))
        self._synchronize()
        return ids.orderBy("_pos")

    def _synchronize(self) -> None:
        """With ``sync_load`` indexes see a write at once; exact search does anyway."""
        state = self.state()
        if self.sync_load and (state.index or state.text_index):
            self._advance(state)

    def _next_seq(self) -> int:
        used = [self.state().upto]
        for table in ("log", "streams"):
            last = self.spark.table(self._name(table)).agg(F.max("seq")).first()[0]
            used.append(-1 if last is None else last)
        return max(used) + 1

    def stream_seq(self, stream: str, batch: int) -> int:
        """Write number of a stream's micro-batch; the same one when the batch is replayed."""
        table = self.spark.table(self._name("streams"))
        known = table.where((F.col("stream") == stream) & (F.col("batch") == batch)).first()
        if known is not None:
            return known["seq"]
        seq = self._next_seq()
        row = self.spark.createDataFrame([(stream, batch, seq)], STREAMS).coalesce(1)
        row.write.mode("append").insertInto(self._name("streams"))
        return seq

    def _write_log(self, rows: DataFrame, seq: int | None = None) -> int:
        seq = self._next_seq() if seq is None else seq
        table = self.spark.table(self._name("log"))
        rows = rows.withColumn("seq", F.lit(seq).cast("bigint")).select(*table.columns)
        rows.write.mode("append").insertInto(self._name("log"))
        return seq

    def replace_log(self, rows: DataFrame, seq: int) -> None:
        """Write log partition ``seq``, replacing whatever an earlier attempt left there."""
        columns = [c for c in self.spark.table(self._name("log")).columns if c != "seq"]
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self._name('log')} PARTITION (seq = {int(seq)}) "
            "SELECT * FROM {rows}",
            rows=rows.select(*columns),
        )

    def delete(self, ids: Sequence | DataFrame | None = None, filter: dict | None = None) -> bool:
        """Delete by ids and/or filter (both must hold); False when neither is given."""
        if (ids is None or (not isinstance(ids, DataFrame) and not ids)) and not filter:
            return False
        key, rows = self.schema.id_column, self.find(filter) if filter else self.rows()
        if ids is not None and (isinstance(ids, DataFrame) or ids):
            rows = rows.join(self._id_frame(ids).select(key), key, "left_semi")
        struct = self.schema.struct()
        blank = [
            F.col(f.name) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name)
            for f in struct
        ]
        gone = rows.select(*blank, F.lit("delete").alias("_op"), F.lit(0).cast("bigint").alias("_pos"))
        self._write_log(cut_lineage(gone))
        self._synchronize()
        return True

    def _id_frame(self, ids: Sequence | DataFrame) -> DataFrame:
        if isinstance(ids, DataFrame):
            return ids
        dtype = self.schema.struct()[self.schema.id_column].dataType
        return mutate.id_table(self.spark, ids, dtype, self.schema.id_column)

    def get_by_ids(self, ids: Sequence | DataFrame) -> DataFrame:
        """Documents of the requested ids in request order; missing ids are skipped."""
        rows, key = self.rows(), self.schema.id_column
        if not isinstance(ids, DataFrame) and len(ids) <= MAX_PUSHED_IDS:
            dtype = rows.schema[key].dataType
            rows = rows.where(F.col(key).isin([F.lit(str(i)).cast(dtype) for i in ids]))
        rows = mutate.get_by_ids(rows, self._id_frame(ids), key)
        return mutate.to_documents(rows, self.schema, ["pos"]).orderBy("pos").drop("pos")

    # -- index ----------------------------------------------------------------------------

    def _tables(self, version: int) -> Tables:
        return Tables(self.spark, self._name(f"ix_{version}_"))

    def index_type(self) -> str | None:
        options = _options(self.state().index)
        return options.index_type if options else None

    def is_valid_index(self) -> bool:
        return self.index_type() is not None

    def apply_vector_index(self, options: IvfOptions | GraphOptions) -> None:
        """Create the collection's vector index; its metric is the collection's."""
        if self.is_valid_index():
            raise ValueError(f"collection '{self.name}' already has an index; drop it first")
        options.check(self.schema.metric, self.schema.dim)
        self.schema.indexed_columns()
        self._advance(replace(self.state(), index=_plain(options), trained=0))

    def apply_hybrid_index(self, options: IvfOptions | GraphOptions | None = None,
                           text: TextIndexOptions | None = None) -> None:
        """Create the combined text and vector index; an existing vector index is kept."""
        state = self.state()
        if text is not None:
            self.schema = replace(self.schema, content_analyzer=text.analyzer)
        if state.index is None:
            options = options or IvfOptions()
            options.check(self.schema.metric, self.schema.dim)
            state = replace(state, index=_plain(options), trained=0)
        self.schema.indexed_columns()
        self._advance(replace(state, text_index=True))

    def drop_index(self) -> None:
        state = self.state()
        self._advance(replace(state, index=None, text_index=False, trained=0))

    def refresh(self) -> None:
        """Publish the writes since the last version, so that index search sees them."""
        self._advance(self.state())

    def rebuild_index(self) -> None:
        """Train the vector index anew on the current rows, as after much growth."""
        self._advance(replace(self.state(), trained=0))

    def vacuum(self, keep: int = 1) -> None:
        """Drop what the last ``keep`` versions do not need: older bases, and the writes their bases include.

        No reader may still be on an older version.
        """
        if keep < 1:
            raise ValueError("at least the current version is kept")
        states = self.spark.table(self._name("state")).orderBy(F.desc("version")).limit(keep).collect()
        oldest = states[-1]
        self._drop_tables(lambda part: re.match(r"(rows|ix)_\d+", part)
                          and int(part.split("_")[1]) < oldest["base"])
        logged = [int(r[0].removeprefix("seq=")) for r in self.spark.sql(
            f"SHOW PARTITIONS {self._name('log')}").collect()]  # one short row for each write
        done = ", ".join(f"PARTITION (seq = {n})" for n in sorted(logged) if n <= oldest["base_upto"])
        if done:
            self.spark.sql(f"ALTER TABLE {self._name('log')} DROP IF EXISTS {done}")

    def compact(self) -> None:
        """Publish a version written whole, and drop everything that it replaces."""
        self._advance(self.state(), whole=True)
        self.vacuum()

    def _advance(self, state: State, whole: bool = False) -> None:
        """Write what the next version needs, then make it visible.

        The definition is published with it, so a later ``open`` sees changed analyzers and indexes.
        """
        state = replace(state, definition=self.schema.to_json())
        before = self.state()
        pending = self._log(before.upto)
        upto = pending.agg(F.max("seq")).first()[0]
        changed = upto is not None
        if not changed and state == before and not (whole and before.version > before.base):
            return
        # The log may grow meanwhile; rows up to ``upto`` belong to this version.
        upto = before.upto if upto is None else upto
        dirty = pending.where(F.col("seq") <= upto).select(self.schema.id_column).distinct() if changed else None
        number = dirty.count() if changed else 0
        few = before.changed + number < REWRITE_SHARE * before.base_rows
        if changed and state == before and few and not whole and self._grows(state):
            self._publish(self._extend(state, dirty, number, upto))
        else:
            self._rewrite(before, state, dirty, upto, before.base_rows + before.changed + number)

    def _grows(self, state: State) -> bool:
        """Whether new entries can be added to the indexes; a graph has to be linked again."""
        options = _options(state.index)
        return options is None or (state.trained > 0 and options.index_type == "ivf")

    def _rewrite(self, before: State, state: State, dirty: DataFrame | None, upto: int, most: int) -> None:
        """The next version, of at most ``most`` rows, as a new base."""
        version = before.version + 1
        kept, fresh = self._parts(before, upto, written=True)
        rows = kept.unionByName(fresh)
        filters, along = self._bloom_filters(rows), self._curve_columns(rows)
        if along and most >= self.cluster_from:
            rows = cluster(rows, along, self.schema.id_column)
        store = Tables(self.spark, self._name(""))
        stored = store.save(f"rows_{version}", rows, options=filters)
        state = replace(state, version=version, upto=upto, base=version, base_upto=upto,
                        base_rows=stored.count(), changed=0)
        self._derive_fields(version, stored)
        gone = new = None
        if dirty is not None and (state.text_index or state.index):
            # Ids that the indexes hold otherwise, and the rows that are new to them.
            gone = self._held(self._current(before, before.upto), dirty)
            new = self._latest(before.upto, upto, self._once(before.upto, upto)).where(F.col("_op") == "upsert")
        if state.text_index:
            self._derive_text(before, state, stored, new, gone)
        if state.index:
            state = self._derive_vectors(before, state, stored, new, gone)
        self._publish(state)

    def _extend(self, before: State, dirty: DataFrame, number: int, upto: int) -> State:
        """The next version as additions to the base of ``before``: one partition of each table.

        A version that was not published is written over by the next attempt.
        """
        s, gen, store = self.schema, before.version + 1, self._tables(before.base)
        ids = dirty.select(F.col(s.id_column).alias("id"))
        fresh = self._latest(before.upto, upto).where(F.col("_op") == "upsert").drop("_op", "_pos", "seq")
        store.put("changes", ids, "gen", gen)
        if before.text_index:
            analyzer = s.content_analyzer
            new = build_postings(fresh, s.id_column, s.content_column, analyzer, True)
            new = self._base_text(before).with_bucket(new)
            store.put("new_postings", new, "gen", gen)
            # What the changed ids held before is taken off the statistics.
            old = self._current(before, before.upto).join(F.broadcast(dirty) if number <= MAX_BROADCAST_CHANGES
                                                          else dirty, s.id_column, "left_semi")
            gone = term_stats(build_postings(old, s.id_column, s.content_column, analyzer)).select(
                "term", (-F.col("df")).alias("df"), (-F.col("ttf")).alias("ttf"))
            terms = term_stats(new).unionByName(gone).groupBy("term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))
            store.put("new_terms", terms.where("df <> 0 OR ttf <> 0"), "gen", gen)
            count = fresh.select(F.lit(1).alias("n")).unionAll(old.select(F.lit(-1).alias("n")))
            store.put("new_docs", count.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_docs")), "gen", gen)
        if before.index:
            base = IvfIndex.read(store)
            new = IvfIndex.assign(self._indexed(self.schema.promote(fresh), base), s.metric, base.centroids,
                                  base.quantizer, id=s.id_column, vec=s.embedding_column)
            store.put("new_cells", new.cells.select(*base.cells.columns), "gen", gen)
            if new.codes is not None:
                store.put("new_codes", new.codes.select(*base.codes.columns), "gen", gen)
        return replace(before, version=gen, upto=upto, changed=before.changed + number)

    def _newest(self, state: State, base: DataFrame, part: str, key: str) -> DataFrame:
        """Entries of the base whose id has not changed since, and the newest of those that have."""
        store = self._tables(state.base)
        if state.version == state.base:
            return base
        last = (store.load("changes").where(F.col("gen") <= state.version)
                .groupBy(F.col("id").alias(key)).agg(F.max("gen").alias("gen")))
        last = F.broadcast(last) if state.changed <= MAX_BROADCAST_CHANGES else last
        new = store.load(f"new_{part}").where(F.col("gen") <= state.version)
        return (base.join(last.drop("gen"), key, "left_anti")
                .unionByName(new.join(last, [key, "gen"], "left_semi").select(*base.columns)))

    def _base_text(self, state: State) -> LexicalIndex:
        return LexicalIndex.read(self._tables(state.base), self.schema.content_analyzer)

    def _text_view(self, state: State) -> LexicalIndex:
        """The text index of a version."""
        base, store = self._base_text(state), self._tables(state.base)
        if state.version == state.base:
            return base
        until = F.col("gen") <= state.version
        terms = (base.terms.unionByName(store.load("new_terms").where(until).drop("gen"))
                 .groupBy("term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf")).where("df > 0"))
        tokens = store.load("new_terms").where(until).agg(F.coalesce(F.sum("ttf"), F.lit(0)).alias("more_tokens"))
        docs = store.load("new_docs").where(until).agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("more_docs"))
        more = (docs.first()[0], tokens.first()[0])
        totals = base.totals.withColumns({"n_docs": F.col("n_docs") + more[0], "n_tokens": F.col("n_tokens") + more[1]})
        postings = self._newest(state, base.postings, "postings", "id")
        return LexicalIndex(postings, terms, totals, base.analyzer, base.buckets)

    def _indexed(self, rows: DataFrame, index: IvfIndex) -> DataFrame:
        """The rows in the columns of an index at rest, as far as they have them."""
        return rows.select(*(c for c in index.cells.columns if c in rows.columns))

    def _vector_view(self, state: State) -> IvfIndex:
        """The cells and codes of a version."""
        index = IvfIndex.read(self._tables(state.base))
        index.cells = self._newest(state, index.cells, "cells", self.schema.id_column)
        if state.version != state.base:
            index.radii = None  # those of the base's own rows
        if index.codes is not None:
            index.codes = self._newest(state, index.codes, "codes", "id")
        return index

    def _curve_columns(self, rows: DataFrame) -> list[str]:
        """Indexed columns and promoted fields by whose ranges row groups can be left out."""
        wanted = [*(n for n, analyzer in self.schema.indexed_columns().items() if analyzer is None),
                  *(f.physical for f in self._json_fields() if f.analyzer is None)]
        return [c for c in wanted if can_order(rows.schema[c].dataType)]

    def _bloom_filters(self, rows: DataFrame) -> dict[str, str]:
        """Parquet Bloom filters on the id and the indexed columns, for equality filters."""
        wanted = [self.schema.id_column, *self.schema.indexed_columns(),
                  *(f.physical for f in self._json_fields())]
        kinds = (T.StringType, T.IntegerType, T.LongType)
        return {
            f"parquet.bloom.filter.enabled#{c}": "true"
            for c in wanted if isinstance(rows.schema[c].dataType, kinds)
        }

    def _derive_text(self, before: State, state: State, rows: DataFrame, new, gone) -> None:
        s, analyzer = self.schema, self.schema.content_analyzer
        fresh, filed = LexicalIndex.build(rows, s.id_column, s.content_column, analyzer, positions=True), None
        same = CollectionSchema.from_json(before.definition).content_analyzer == analyzer
        if before.text_index and before.version > 0 and new is not None and same:
            old = self._text_view(before)
            kept = _without(old.postings, gone, s.id_column, "id")
            new = build_postings(new, s.id_column, s.content_column, analyzer, True)
            new = fresh.with_bucket(new).select(*fresh.postings.columns)
            few = gone is None or gone.count() <= MAX_BROADCAST_CHANGES
            if few and before.version == before.base and old.buckets == fresh.buckets:
                # The base's files hold the postings of a bucket each, and keep them where they lie.
                fresh.postings, filed = new, kept
            else:
                fresh.postings = kept.select(*new.columns).unionByName(new)
        fresh.write(self._tables(state.version), filed=filed)

    def _derive_vectors(self, before: State, state: State, rows: DataFrame, new, gone) -> State:
        s, options = self.schema, _options(state.index)
        n_rows = rows.count()
        if n_rows == 0:
            return replace(state, trained=0)
        spec = options.quantizer(s.metric)
        kind = spec.pop("kind")
        names = dict(id=s.id_column, vec=s.embedding_column)
        keep = before.index == state.index and min(before.trained, state.trained) > 0
        if keep and new is not None:
            old = self._vector_view(before)
            new = IvfIndex.assign(self._indexed(self.schema.promote(new), old), s.metric, old.centroids, old.quantizer, **names)
            old.cells = _without(old.cells, gone, s.id_column).unionByName(new.cells)
            if old.codes is not None:
                old.codes = _without(old.codes, gone, s.id_column, "id").unionByName(new.codes)
            index, trained = old, before.trained
        elif keep:
            index, trained = self._vector_view(before), before.trained
        else:
            index = IvfIndex.build(rows.drop(s.content_column), s.metric, cells=options.cells, quant=kind, **names, **spec)
            trained = n_rows
        index = index.write(self._tables(state.version))
        if options.index_type == "hnsw":
            graph = GraphIndex.link(index, options.m, options.ef_construction)
            self._tables(state.version).save("edges", graph.edges)
            self._tables(state.version).save("entries", graph.entries)
        return replace(state, trained=trained)

    def vector_index(self) -> IvfIndex | GraphIndex | None:
        state = self.state()
        options = _options(state.index)
        if options is None or state.trained == 0:
            return None
        tables = self._tables(state.base)
        ivf = self._vector_view(state)
        if options.index_type == "ivf":
            return ivf
        return GraphIndex(ivf, tables.load("edges"), tables.load("entries"), options.m,
                          options.ef_construction)

    def text_index(self) -> LexicalIndex:
        state = self.state()
        if not state.text_index or state.version == 0:
            raise ValueError(f"collection '{self.name}' has no text index")
        return self._text_view(state)

    # -- search ---------------------------------------------------------------------------

    def _queries(self, query: Any) -> DataFrame:
        """``qid, text, embedding`` of a text, a vector, lists of them, or a DataFrame."""
        if not isinstance(query, DataFrame):
            values = [query] if isinstance(query, str) or isinstance(query[0], (int, float)) else query
            if isinstance(values[0], str):
                rows = list(enumerate(values))
                query = self.spark.createDataFrame(rows, "qid int, text string")
            else:
                rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
                query = self.spark.createDataFrame(rows, "qid int, embedding array<float>")
        if "embedding" not in query.columns:
            if self.query_embedder is None:
                raise ValueError("text queries need an embedder")
            # The model runs once, however often the search reads its queries.
            query = cut_lineage(embed(query, self.query_embedder, "text", "embedding"))
        return query

    def _dense(self, queries: DataFrame, k: int, filter: dict | None) -> DataFrame:
        """Hits by distance, through the index when there is one."""
        s = self.schema
        check_query_type(self.query_options, self.index_type(), self.name)
        index = self.vector_index()
        if index is None:
            return dense.knn_join(queries, self.find(filter), k, s.metric, id=s.id_column,
                                  vec=s.embedding_column)
        knobs = self.query_options.knobs() if self.query_options else {}
        mode = self.query_options.filter_mode_or_auto() if self.query_options else "auto"

        def through_index(k: int) -> DataFrame:
            if not filter:
                return index.search(queries, k, **knobs)
            # Fields promoted since the index was written are read from the JSON there.
            inside = self._where(filter, index.cells.columns)
            if s.content_column in _named(filter) and s.content_column not in index.cells.columns:
                self._add_content(index.ivf if isinstance(index, GraphIndex) else index)
            return filtered_search(index, queries, k, inside, mode, **knobs)

        gone = self._pending_deletes()
        number = gone.limit(MAX_PENDING_DELETES + 1).count()
        if not number:
            return through_index(k)
        if number > MAX_PENDING_DELETES:
            return dense.knn_join(queries, self.find(filter), k, s.metric, id=s.id_column,
                                  vec=s.embedding_column)
        # Each deleted row can take one place at most.
        left = through_index(k + number).join(F.broadcast(gone), "id", "left_anti")
        return dense.rank_best(left.select("qid", "id", "distance"), k)

    def _add_content(self, index: IvfIndex) -> None:
        """Contents beside the index's entries, for filters that read them."""
        key = self.schema.id_column
        texts = self.published().select(key, self.schema.content_column)
        index.cells = index.cells.join(texts, key)
        if index.codes is not None:
            index.codes = index.codes.join(texts.withColumnRenamed(key, "id"), "id")

    def _pending_deletes(self) -> DataFrame:
        """Ids that the published version holds and a later write deleted."""
        latest = self._latest(self.state().upto).where(F.col("_op") == "delete")
        return latest.select(F.col(self.schema.id_column).alias("id"))

    def _where(self, filter: dict | None, columns: Sequence[str] | None = None):
        """The filter's condition; over a table with these columns, if they are given."""
        if not filter:
            return None
        schema, index = self.schema, self.schema.metadata_index
        if columns is not None and index:
            there = tuple(f for f in index.json_fields if f.physical in columns)
            schema = replace(schema, metadata_index=replace(index, json_fields=there))
        return compile_filter(filter, schema)

    def _documents(self, hits: DataFrame, queries: DataFrame, k: int, scored: bool,
                   extra: Sequence[str] = ()) -> DataFrame:
        s, alias = self.schema, "__distance"
        rows = self.rows().select(F.col(s.id_column).alias("__id"), *s.columns())
        hits = hits.withColumnRenamed("distance", alias).withColumnRenamed("id", "__id")
        joined = dense.join_hits(hits, rows, queries, k, "__id")
        cols = ["qid", "rank", *([alias] if scored else []), *extra]
        out = mutate.to_documents(joined, s, cols)
        out = out.withColumnRenamed(alias, s.distance_alias) if scored else out
        return out.select("qid", "rank", *[c for c in out.columns if c not in ("qid", "rank")])

    def search(self, query: Any, k: int | None = None, filter: dict | None = None,
               **options: Any) -> DataFrame:
        """Best documents per text query: hybrid when configured, else by distance.

        The full-text query defaults to the query text; ``fts_query`` (a text, or the name of
        a column) overrides it, and an empty one means a dense search. Where the hybrid configuration
        names ``websearch_to_tsquery``, it is the columns ``must, should, must_not, phrases`` of ``query``,
        in terms of the content's analyzer; a query with none but banned terms is a dense search.
        """
        queries = self._queries(query)
        if "fts_query" not in options and "text" in queries.columns:
            options["fts_query"] = F.col("text")
        return self.search_by_vector(queries, k, filter, **options)

    def search_by_vector(self, query: Any, k: int | None = None, filter: dict | None = None,
                         **options: Any) -> DataFrame:
        """As ``search``, but hybrid only with an explicit ``fts_query``."""
        queries, k = self._queries(query), self.schema.k if k is None else k
        config = options.get("hybrid", self.hybrid)
        fts, structured = options.get("fts_query"), config is not None and config.structured
        if config is None or not structured and (fts is None or isinstance(fts, str) and not fts):
            return self._documents(self._dense(queries, k, filter), queries, k, False)
        if structured:
            asks = asks_words(queries)
        else:
            fts = F.lit(fts) if isinstance(fts, str) else fts
            queries, asks = queries.withColumn("__fts", fts), F.coalesce(F.col("__fts"), F.lit("")) != ""
        worded, s = queries.where(asks), self.schema
        check_query_type(self.query_options, self.index_type(), self.name)
        where = self._where(filter)
        hits = hybrid_search(
            worded, self.rows(), self.text_index(), k, config, s.metric, text="__fts",
            id=s.id_column, vec=s.embedding_column, where=where,
            vector_search=lambda asked, n, _: self._dense(asked, n, filter),
        ).select("qid", "id", "rank")
        if structured or not isinstance(options.get("fts_query"), str):
            plain = queries.where(~asks)
            if not plain.isEmpty():
                rest = self._dense(plain, k, filter).select("qid", "id", "rank")
                hits = hits.unionByName(rest)
        return self._documents(hits, queries, k, False)

    def match(self, expression: Any, filter: dict | None = None) -> DataFrame:
        """Documents whose content satisfies a tree of ``and, or, not, phrase`` over its terms, unranked.

        Terms are those of the content's analyzer. The published text index answers, over every document;
        rows deleted since are left out.
        """
        key = self.schema.id_column
        known = self.published().select(F.col(key).alias("id"))
        ids = boolean_match(self.text_index(), expression, known).withColumnRenamed("id", key)
        return mutate.to_documents(self.find(filter).join(ids, key, "left_semi"), self.schema, [])

    def search_with_score(self, query: Any, k: int | None = None, filter: dict | None = None,
                          fts_query: Any = None, hybrid: HybridConfig | None = None) -> DataFrame:
        """Documents with their distance; always by vector."""
        refuse_fused_scores(fts_query, hybrid)
        queries, k = self._queries(query), self.schema.k if k is None else k
        return self._documents(self._dense(queries, k, filter), queries, k, True)

    def search_with_relevance(self, query: Any, k: int | None = None, filter: dict | None = None,
                              threshold: float | None = None) -> DataFrame:
        """Documents with relevance in [0, 1], best first; a threshold applies after the cut."""
        queries, k = self._queries(query), self.schema.k if k is None else k
        hits = dense.with_relevance(self._dense(queries, k, filter), self.schema.metric, threshold)
        return self._documents(hits, queries, k, False, ["relevance"])

    def mmr(self, query: Any, k: int | None = None, fetch_k: int | None = None,
            lambda_mult: float | None = None, filter: dict | None = None,
            scored: bool = False) -> DataFrame:
        """Diverse documents out of the ``fetch_k`` nearest, in distance order."""
        s, queries = self.schema, self._queries(query)
        k = s.k if k is None else k
        fetch_k = s.fetch_k if fetch_k is None else fetch_k
        balance = s.lambda_mult if lambda_mult is None else lambda_mult
        near = self._dense(queries, fetch_k, filter)
        hits = mmr(queries, self.rows(), k, fetch_k, balance, s.metric, id=s.id_column,
                   vec=s.embedding_column, hits=near)
        return self._documents(hits, queries, k, scored)


def from_texts(spark: SparkSession, name: str, texts: Sequence[str], embedder: Any, *,
               metadatas: Sequence[dict] | None = None, ids: Sequence | None = None,
               **options: Any) -> Collection:
    """Open an existing collection and load texts into it."""
    found = Collection.open(spark, name, embedder=embedder, **options)
    found.add_texts(texts=texts, metadatas=metadatas, ids=ids)
    return found


def from_documents(spark: SparkSession, name: str, documents: DataFrame, embedder: Any,
                   **options: Any) -> Collection:
    """Open an existing collection and load ``content, metadata`` rows under fresh ids."""
    found = Collection.open(spark, name, embedder=embedder, **options)
    found.add_documents(documents.drop("id"))
    return found


__all__ = ["Analyzer", "Collection", "Metric", "from_documents", "from_texts"]
