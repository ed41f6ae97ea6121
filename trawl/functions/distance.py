"""The four distances and their relevance scores as Column expressions (no UDF).

Vectors are float arrays; all arithmetic is done in double.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.schema import Metric


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_distance(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_fold(F.zip_with(a, b, square)))


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos``; NULL when either vector has no length."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def negative_inner_product(a: Column, b: Column) -> Column:
    return -dot(a, b)


def l1_distance(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


_DISTANCES = {
    Metric.L2: l2_distance,
    Metric.COSINE: cosine_distance,
    Metric.IP: negative_inner_product,
    Metric.L1: l1_distance,
}


def distance(metric: Metric | str, a: Column, b: Column) -> Column:
    return _DISTANCES[Metric(metric)](a, b)


def vector_literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def relevance(metric: Metric | str, d: Column) -> Column:
    """Map a distance to a relevance score clamped to [0, 1]; NULL stays NULL."""
    try:
        metric = Metric(metric)
    except ValueError:
        raise NotImplementedError(f"no relevance score for {metric}") from None
    if metric is Metric.COSINE:
        raw = 1.0 - d
    elif metric is Metric.L2:
        raw = 1.0 - d / math.sqrt(2.0)
    elif metric is Metric.IP:
        raw = F.when(d > 0, 1.0 - d).otherwise(-d)
    else:
        raw = 1.0 - d / 2.0
    return F.when(d.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))
