"""Rows along a space-filling curve: nothing lost, and row groups left out by any of the columns."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trawl import CollectionSchema, Column, HashModel, Metric
from trawl.operators.layout import cluster
from trawl.sources.collection import Collection

PARTS = 64


def _rows(spark, n=20_000):
    """Two unrelated numbers, a text with a prefix that all share, nulls, and a third with one value."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        "id", F.when(hot, 7).otherwise(F.xxhash64("id") % 1000).alias("a"),
        F.when(F.col("id") % 50 != 0, F.xxhash64(F.col("id") + 1_000_000) % 1000).alias("b"),
        F.concat(F.lit("item/"), F.lpad((F.crc32(F.col("id").cast("string").cast("binary")) % 900).cast("string"), 4, "0"))
        .alias("c"))


def _touched(path, column, low, high):
    """Row groups whose range of the column meets the given one, and all."""
    groups = [pq.ParquetFile(f).metadata.row_group(g).column(i).statistics
              for f in glob.glob(f"{path}/*.parquet") for meta in [pq.ParquetFile(f).metadata]
              for g in range(meta.num_row_groups) for i in range(meta.num_columns)
              if meta.row_group(g).column(i).path_in_schema == column]
    return sum(s.has_min_max and s.min <= high and s.max >= low for s in groups), len(groups)


@pytest.mark.parametrize("column, low, high", [("a", 600, 610), ("b", 500, 510), ("c", "item/0300", "item/0310")])
def test_every_column_rules_row_groups_out(spark, tmp_path, column, low, high):
    rows = _rows(spark)
    path = f"{tmp_path}/laid"
    cluster(rows, ["a", "b", "c"], "id", PARTS).write.parquet(path)
    touched, all_groups = _touched(path, column, low, high)
    assert all_groups >= PARTS and touched <= all_groups // 2
    back = spark.read.parquet(path)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    inside = F.col(column).between(low, high)
    assert back.where(inside).count() == rows.where(inside).count() > 0


def test_one_hot_value_fills_several_ranges(spark):
    rows = spark.range(8_000).select("id", F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    sizes = [r["count"] for r in cluster(rows, ["a", "b"], "id", 8)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8_000 and max(sizes) < 3_000


def test_empty_table_clashing_name_and_columns_without_order(spark):
    rows = _rows(spark, 10).withColumn("__curve", F.lit("mine"))
    assert cluster(rows.limit(0), ["a", "c"], "id").collect() == []
    assert {r["__curve"] for r in cluster(rows, ["a", "c"], "id").collect()} == {"mine"}
    odd = rows.withColumn("v", F.array("a"))
    with pytest.raises(ValueError, match="no order"):
        cluster(odd, ["v"], "id")


def test_collection_lays_large_bases_out(spark):
    schema = CollectionSchema.declare(4, id_column="id", metadata_columns=[
        Column("year", "INT"), Column("lang", "TEXT")])
    texts = [f"text {i}" for i in range(60)]
    made = Collection.create(spark, "laid_out", schema, overwrite=True, embedder=HashModel(4), cluster_from=50)
    try:
        made.add_texts(texts=texts, metadatas=[{"year": 1900 + i % 30, "lang": "en" if i % 2 else "de"} for i in range(60)])
        made.compact()
        found = made.find({"year": {"$gte": 1920}, "lang": "en"})
        assert made.rows().count() == 60 and found.count() == sum(i % 30 >= 20 and i % 2 for i in range(60))
        order = [r[0] for r in spark.table(made._name(f"rows_{made.state().base}")).select("year").collect()]
        assert sorted(order) != order and len(order) == 60
    finally:
        made.drop()


def test_queries_have_a_model_of_their_own(spark):
    def documents():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    def questions():
        return lambda texts: [[2.0 * len(t), 1.0] for t in texts]

    schema = CollectionSchema.declare(2, metric=Metric.L2)
    made = Collection.create(spark, "two_models", schema, overwrite=True, embedder=documents,
                             query_embedder=questions)
    try:
        made.add_texts(texts=["aaaa", "aa", "aaaaaaaa"])
        assert made.search_with_score("aa", k=1).first()["content"] == "aaaa"
        again = Collection.open(spark, "two_models", embedder=documents)
        assert again.search_with_score("aa", k=1).first()["content"] == "aa"
    finally:
        made.drop()
