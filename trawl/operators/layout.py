"""Rows in the order of a space-filling curve over several columns.

Files and row groups written in this order hold a small range of *each* column, so that their
minima and maxima rule them out for a filter on any of the columns, not on the first one only.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns a curve winds through, at most: every further one makes the ranges of all others wider.
MOST_COLUMNS = 8
#: Each column is cut at quantiles into 2 ** BITS buckets of about as many rows each.
BITS = 6
#: Accuracy of the quantiles; their summary has a size in proportion to it, whatever the rows.
ACCURACY = 1000
#: Bytes of a text, after what all texts of the column begin with, that tell its place.
TEXT_BYTES = 7


def can_order(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
                             T.TimestampNTZType))


def _places(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """A number for each value that rises with it, as Parquet orders the column's values."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    shared = {}
    if texts:
        ends = df.agg(*(f(F.encode(F.col(f"`{c}`"), "UTF-8")).alias(f"{f.__name__}_{i}")
                        for i, c in enumerate(texts) for f in (F.min, F.max))).first()
        for i, c in enumerate(texts):
            low, high = (bytes(ends[f"{f}_{i}"] or b"") for f in ("min", "max"))
            # What the smallest and the largest begin with, all begin with.
            shared[c] = len(os.path.commonprefix([low, high]))
    out = {}
    for c in columns:
        value, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if isinstance(kind, T.StringType):
            rest = F.hex(F.substring(F.encode(value, "UTF-8"), shared[c] + 1, TEXT_BYTES))
            out[c] = F.conv(F.rpad(rest, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
        elif isinstance(kind, T.DateType):
            out[c] = F.unix_date(value).cast("double")
        elif isinstance(kind, T.BooleanType):
            out[c] = value.cast("int").cast("double")
        elif isinstance(kind, T.TimestampNTZType):
            out[c] = value.cast("timestamp").cast("double")
        else:
            out[c] = value.cast("double")
    return out


def _bucket(place: Column, cuts: list[float]) -> Column:
    """How many of the cuts a value has reached; a frequent value is several cuts at once."""
    if not cuts:
        return F.lit(0)
    reached = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= place))
    return F.when(place.isNull(), F.lit(0)).otherwise(reached)


def curve_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """Place of a row on the curve; nulls come before every value, NaN after.

    The columns' quantiles are one aggregate over all rows, with a summary of bounded size.
    """
    columns = list(columns)[:MOST_COLUMNS]
    unordered = [c for c in columns if not can_order(df.schema[c].dataType)]
    if not columns or unordered:
        raise ValueError(f"these columns have no order to wind through: {unordered or 'none given'}")
    places = _places(df, columns)
    shares = [n / 2 ** BITS for n in range(1, 2 ** BITS)]
    cuts = df.agg(*(F.percentile_approx(places[c], shares, ACCURACY).alias(f"c{i}")
                    for i, c in enumerate(columns))).first()
    bits = []
    for i, c in enumerate(columns):
        bucket = _bucket(places[c], cuts[f"c{i}"] or [])
        for b in range(BITS):
            bit = F.shiftright(bucket, b).bitwiseAND(1).cast("bigint")
            bits.append(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    out = bits[0]
    for bit in bits[1:]:
        out = out + bit
    return out


def cluster(df: DataFrame, columns: Sequence[str], id: str, partitions: int | None = None) -> DataFrame:
    """The same rows, in ranges of the curve and sorted by it within each.

    Rows of one place on the curve, however many, are told apart by ``id`` and so spread over
    as many ranges as they fill.
    """
    name = "__curve"
    while name in df.columns:
        name += "_"
    placed = df.withColumn(name, curve_value(df, columns))
    by = [F.col(name), F.col(f"`{id}`")]
    ranged = placed.repartitionByRange(partitions, *by) if partitions else placed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop(name)


__all__ = ["MOST_COLUMNS", "can_order", "cluster", "curve_value"]
