"""Embedding as a distributed column: user models in batches, and a deterministic hash model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.text import let


def hash_embedding(text: Column, dim: int = 8) -> Column:
    """First byte of sha256("i:text") / 255 per dimension, scaled to unit length."""
    raw = F.array(*[
        F.conv(F.substring(F.sha2(F.concat(F.lit(f"{i}:"), text), 256), 1, 2), 16, 10)
        .cast("double") / F.lit(255.0)
        for i in range(dim)
    ])

    def unit(v: Column) -> Column:
        length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return let(
            F.when(length == 0, F.lit(1.0)).otherwise(length),
            lambda n: F.transform(v, lambda x: (x / n).cast("float")),
        )

    return F.when(text.isNotNull(), let(raw, unit))


class HashModel:
    """The hash embedding as a model object usable wherever a user model is."""

    def __init__(self, dim: int = 8) -> None:
        self.dim = dim

    def column(self, text: Column) -> Column:
        return hash_embedding(text, self.dim)


def embed(
    df: DataFrame,
    model: "HashModel | Callable[[], Callable[[list[str]], list[list[float]]]]",
    text: str = "content",
    out: str = "embedding",
    batch: int = 256,
) -> DataFrame:
    """Add the vector of ``text`` as ``out``.

    ``model`` is a ``HashModel`` (pure SQL) or a factory: it is called once per Python task and
    returns a function from a list of texts to a list of vectors, called on whole batches.
    """
    if hasattr(model, "column"):
        return df.withColumn(out, model.column(F.col(text)))
    vector = T.ArrayType(T.FloatType())
    schema = T.StructType([f for f in df.schema.fields if f.name != out])
    schema.add(T.StructField(out, vector))
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model()
        for block in batches:
            for start in range(0, block.num_rows, batch):
                part = block.slice(start, batch)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                vectors = [[float(x) for x in v] for v in encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(vectors, pa.list_(pa.float32()))],
                    names=[*keep, out],
                )

    return df.select(*keep).mapInArrow(run, schema)
