"""Row preparation and mutation as pure DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.schema import CollectionSchema, json_text

OPEN_MAP = "map<string,variant>"


def assign_ids(df: DataFrame, id: str = "id", deterministic_from: str | None = None) -> DataFrame:
    """Fill absent ids with a fresh UUID, or with a hash of a column when one is named."""
    fresh = F.uuid() if deterministic_from is None else F.sha2(F.col(deterministic_from), 256)
    if id not in df.columns:
        return df.withColumn(id, fresh)
    return df.withColumn(id, F.coalesce(F.col(id).cast("string"), fresh))


def number_rows(df: DataFrame, pos: str = "_pos") -> DataFrame:
    """Add the input position, which decides between repeats of an id."""
    return df if pos in df.columns else df.withColumn(pos, F.monotonically_increasing_id())


def json_map(column: Column) -> Column:
    """A JSON object as a map of open values; NULL is the empty object."""
    return F.coalesce(F.from_json(column, OPEN_MAP), F.from_json(F.lit("{}"), OPEN_MAP))


def split_metadata(df: DataFrame, schema: CollectionSchema, metadata: str = "metadata") -> DataFrame:
    """Move typed keys out of the JSON object in ``metadata`` into their own columns.

    An absent key gives NULL.  What remains is the JSON column, or is dropped without one.
    """
    source = F.col(metadata) if metadata in df.columns else F.lit(None).cast("string")
    typed = [c for c in schema.metadata_columns if c != schema.json_column]
    target = schema.struct()
    cols = {c: json_text(source, c).try_cast(target[c].dataType) for c in typed}
    out = df.select(*[c for c in df.columns if c not in {*typed, metadata}],
                    *[v.alias(c) for c, v in cols.items()],
                    source.alias("__open"))
    if not schema.json_column:
        return out.drop("__open")
    rest = json_map(F.col("__open"))
    if typed:
        rest = F.map_filter(rest, lambda key, _: ~key.isin(typed))
    return out.withColumn(schema.json_column, F.to_json(rest)).drop("__open")


def to_vector(column: Column, dim: int | None) -> Column:
    """Cast to a float array and refuse a wrong length when it is used."""
    vector = column.cast("array<float>")
    if dim is None:
        return vector
    message = F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(vector).cast("string"))
    return F.when(F.size(vector) == dim, vector).otherwise(F.raise_error(message))


def last_per_id(batch: DataFrame, id: str = "id", order: Sequence[str] = ("_pos",)) -> DataFrame:
    """Keep the last row of each id; repeats are cut before the shuffle."""
    latest = Window.partitionBy(id).orderBy(*[F.col(c).desc() for c in order])
    return (
        batch.withColumn("__turn", F.row_number().over(latest))
        .where(F.col("__turn") == 1).drop("__turn")
    )


def upsert(table: DataFrame, batch: DataFrame, id: str = "id", pos: str = "_pos") -> DataFrame:
    """Replace or insert whole rows by id; the last row of a repeated id wins."""
    latest = last_per_id(number_rows(batch, pos), id, (pos,)).select(*table.columns)
    return table.join(latest.select(id), id, "left_anti").select(*table.columns).unionByName(latest)


def delete(table: DataFrame, ids: DataFrame | None = None, where: Column | None = None,
           id: str = "id") -> DataFrame:
    """Remove rows by id and/or predicate; both together must hold for a row to go."""
    if ids is None and where is None:
        return table
    if ids is None:
        return table.where(~F.coalesce(where, F.lit(False)))
    doomed = ids.select(id).distinct()
    if where is not None:
        doomed = table.where(where).select(id).join(doomed, id, "left_semi")
    return table.join(doomed, id, "left_anti").select(*table.columns)


def get_by_ids(table: DataFrame, ids: DataFrame, id: str = "id", pos: str = "pos") -> DataFrame:
    """Rows of the requested ids, one per request, carrying the request's ``pos``."""
    return ids.select(id, pos).join(table, id).select(pos, *table.columns)


def id_table(spark: SparkSession, ids: Sequence, dtype: T.DataType, id: str = "id") -> DataFrame:
    """``pos, id`` rows of a literal id list."""
    text = spark.createDataFrame([(i, str(v)) for i, v in enumerate(ids)], "pos int, v string")
    return text.select("pos", F.col("v").cast(dtype).alias(id))


def to_documents(df: DataFrame, schema: CollectionSchema, extra: Sequence[str] = ()) -> DataFrame:
    """``id, content, metadata[, extra]``: typed columns overwrite keys of the JSON object."""
    typed = [c for c in schema.shown if c != schema.json_column]
    parts = json_map(F.col(schema.json_column) if schema.json_column else F.lit(None).cast("string"))
    if typed:
        parts = F.map_filter(parts, lambda key, _: ~key.isin(typed))
        values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in typed]), {"ignoreNullFields": "false"})
        parts = F.map_concat(parts, F.from_json(values, OPEN_MAP))
    return df.select(
        F.col(schema.id_column).cast("string").alias("id"),
        F.col(schema.content_column).alias("content"),
        F.to_json(parts).alias("metadata"),
        *extra,
    )
