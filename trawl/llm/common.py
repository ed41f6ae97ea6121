"""Small pieces the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows and bytes that go to a Python worker at once. Texts may be long, and a worker holds a batch
#: several times over, as texts, hashes and results.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Gives the session Arrow batches of this size, unless it has sizes of its own."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(labels: DataFrame, label: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold, drawn by a hash of the id.

    Ids that are null, or labelled in two ways, are left out; the draw does not depend on the
    order of the rows.
    """
    return (labels.where(F.col(label).isin(0, 1) & (id_remainder("doc_id", modulus) != held_out))
            .groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("label"))
            .where("lo = label").select("doc_id", F.col("label").cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)
