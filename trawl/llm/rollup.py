"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch of inserts, deletes and revisions is turned into signed entries: what a document counts from
now on, less what it counted before. The entries are stored, and so are their sums by group. A total
is the sum of these sums, so batches can be added without reading the documents again.

A batch is committed by one small marker, written last. A batch that failed half way has no marker:
nothing reads what it left, and repeating it writes a new attempt. A batch that is committed is not
applied again.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import texts_of
from trawl.session import cut_lineage

GROUP = ("source", "lang", "version")
COUNTS = ("documents", "tokens", "bytes")
_ENTRY = "doc_id long, source string, lang string, version string, documents long, tokens long, bytes long"
_MARK = "batch string, attempt string, entries long"


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds ``tokens`` by a ``tokenizers`` file, whole texts; a null text has none."""
    from trawl.llm.packing import text_encoder

    docs = docs.drop("tokens")

    def run(batches):
        encode = text_encoder(tokenizer)
        for batch in batches:
            found = [len(encode(t)) if t else 0 for t in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())],
                                             names=[*batch.schema.names, "tokens"])

    return docs.mapInArrow(run, docs.select("*", F.lit(0).cast("long").alias("tokens")).schema)


class TokenRollup:
    """The entries, group sums and markers of one rollup under a folder that all machines share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, kind: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")

    def _marks(self) -> DataFrame:
        """One attempt of every committed batch, should two writers have raced."""
        return self._read("marks", _MARK).groupBy("batch").agg(F.min("attempt").alias("attempt"))

    def batches(self) -> list[str]:
        return sorted(r["batch"] for r in self._marks().select("batch").collect())

    def _committed(self, kind: str, columns: str) -> DataFrame:
        marks = F.broadcast(self._marks())  # one short row for each batch
        return self._read(kind, f"{columns}, batch string, attempt string").join(marks, ["batch", "attempt"])

    def entries(self) -> DataFrame:
        return self._committed("entries", _ENTRY)

    def current(self) -> DataFrame:
        """What every document counts now, by tokenizer version: entries summed up, zeros left out."""
        sums = self.entries().groupBy("doc_id", *GROUP).agg(*(F.sum(c).alias(c) for c in COUNTS))
        return sums.where(" OR ".join(f"{c} <> 0" for c in COUNTS))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch once; False if it was committed before.

        ``changes``: ``op`` (``insert``, ``revise`` or ``delete``), ``doc_id, version`` and, but for a
        deletion, ``source, lang, tokens, bytes``. A revision replaces what the document counted under
        that version, whatever group it was in; an insertion of a document that is there replaces it
        too; a deletion or revision of an unknown one adds nothing, or the new count. Of several
        changes to one document in a batch the largest by (op, counts) holds, so the order of rows
        does not matter: ``revise`` over ``insert`` over ``delete``. Changes without a document, a
        version or one of these three ops name nothing and are left out; null sources, languages and
        counts are kept as null groups and zeros.
        """
        if self._marks().where(F.col("batch") == batch).limit(1).count():
            return False
        changes = changes.select(
            F.col("op").cast("string").alias("op"), F.col("doc_id").cast("long").alias("doc_id"),
            F.col("version").cast("string").alias("version"),
            *(F.col(c).cast("string").alias(c) for c in ("source", "lang")),
            *(F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("tokens", "bytes")))
        changes = changes.where("doc_id IS NOT NULL AND version IS NOT NULL "
                                "AND op IN ('insert', 'revise', 'delete')")
        last = changes.groupBy("doc_id", "version").agg(
            F.max(F.struct("op", "tokens", "bytes", "source", "lang")).alias("c"))
        last = cut_lineage(last)  # read twice, and counting tokens is dear
        plus = last.where("c.op <> 'delete'").select(
            "doc_id", "c.source", "c.lang", "version", F.lit(1).cast("long").alias("documents"), "c.tokens", "c.bytes")
        minus = (self.current().join(last.select("doc_id", "version"), ["doc_id", "version"], "left_semi")
                 .select("doc_id", *GROUP, *((-F.col(c)).alias(c) for c in COUNTS)))
        signed = (plus.unionByName(minus).groupBy("doc_id", *GROUP)
                  .agg(*(F.sum(c).alias(c) for c in COUNTS))
                  .where(" OR ".join(f"{c} <> 0" for c in COUNTS)))
        attempt = uuid.uuid4().hex
        tags = {"batch": F.lit(batch), "attempt": F.lit(attempt)}
        signed.withColumns(tags).write.mode("append").parquet(f"{self.root}/entries")
        own = self._read("entries", f"{_ENTRY}, batch string, attempt string").where(
            (F.col("attempt") == attempt) & (F.col("batch") == batch))
        sums = own.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in COUNTS))
        sums.withColumns(tags).write.mode("append").parquet(f"{self.root}/sums")
        self.spark.createDataFrame([(batch, attempt, own.count())], _MARK).coalesce(1).write.mode(
            "append").parquet(f"{self.root}/marks")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, version, documents, tokens, bytes``; groups that went empty are left out."""
        sums = self._committed("sums", _ENTRY.replace("doc_id long, ", ""))
        return (sums.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in COUNTS))
                .where(" OR ".join(f"{c} <> 0" for c in COUNTS)))
