"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.session import cut_lineage

#: Bytes a row takes beside its text.
ROW_OVERHEAD = 16


def assign_shards(docs: DataFrame, shards: int, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row, in shards of nearly equal ``size``.

    Rows are taken in order of id, then text checksum (nulls first). They are dealt into sorted
    ranges, each range is summed up, and the prefix sums of these totals give every row its place
    in the whole. The bytes are cut at equal targets; a row belongs to the shard in which its
    middle byte lies, so that a shard misses its target by no more than half a row at either end.
    ``slot`` counts the rows of a shard from 0. Only ids, sizes and checksums are shuffled.

    A null text has no bytes; repeated rows are kept, each with a slot of its own; an empty table
    gives no rows; other columns play no part.
    """
    text = F.encode(F.col(text_column), "UTF-8")
    narrow = docs.select(
        F.col(id_column).alias("id"),
        (F.coalesce(F.octet_length(text_column), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        # Rows alike in all else: told apart so that they need not share a range.
        F.monotonically_increasing_id().alias("arrival"))
    order = ["id", "text_crc32", "size", "arrival"]
    # Sampled ranges may fall differently in each job, so they are fixed before they are summed.
    dealt = cut_lineage(narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("part")
    starts, byte_start, row_start = [], 0, 0
    for part, size, rows in totals.collect():  # one row for each range
        starts.append((part, byte_start, row_start))
        byte_start, row_start = byte_start + size, row_start + rows
    before = docs.sparkSession.createDataFrame(starts, "part int, bytes_before long, rows_before long")
    here = Window.partitionBy("part").orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (dealt.withColumns({"upto": F.sum("size").over(upto), "nth": F.row_number().over(here)})
              .join(F.broadcast(before), "part")
              .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
              .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
              .withColumn("shard", F.least(F.expr(f"middle2 * {shards} div {max(2 * byte_start, 1)}"),
                                           F.lit(shards - 1)).cast("int")))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
