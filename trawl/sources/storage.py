"""Where derived tables are kept: Parquet folders, or managed tables of the session catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import dropping_shuffles


@dataclass(frozen=True)
class Folder:
    """Parquet datasets under one path."""

    spark: SparkSession
    path: str

    def save(self, name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        writer = writer.partitionBy(partition) if partition else writer
        with dropping_shuffles(self.spark):
            writer.parquet(f"{self.path}/{name}")
        # The schema is known, so an empty dataset reads back as well.
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)


@dataclass(frozen=True)
class Tables:
    """Managed Parquet tables named ``prefix`` + name."""

    spark: SparkSession
    prefix: str

    def save(self, name: str, df: DataFrame, partition: str | None = None,
             options: dict[str, str] | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").format("parquet").options(**(options or {}))
        writer = writer.partitionBy(partition) if partition else writer
        with dropping_shuffles(self.spark):
            writer.saveAsTable(self.prefix + name)
        return self.load(name)

    def add(self, name: str, df: DataFrame, partition: str) -> DataFrame:
        """Write ``df`` beside what the table holds."""
        with dropping_shuffles(self.spark):
            df.write.mode("append").format("parquet").partitionBy(partition).saveAsTable(self.prefix + name)
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.prefix + name)

    def put(self, name: str, df: DataFrame, partition: str, value: int) -> None:
        """Write ``df`` as the one partition ``value``, replacing it alone; other files stay as they are."""
        df = df.withColumn(partition, F.lit(value))
        with dropping_shuffles(self.spark):
            if not self.has(name):
                df.write.format("parquet").partitionBy(partition).saveAsTable(self.prefix + name)
                return
            columns = [c for c in self.load(name).columns if c != partition]
            df.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.prefix}{name} PARTITION ({partition} = {int(value)}) SELECT * FROM {{rows}}",
                rows=df.select(*columns))
