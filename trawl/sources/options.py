"""Index and query options, checked when they are made or used, before any job."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from typing import ClassVar

from trawl.functions.text import SPLIT_LOWER, Analyzer
from trawl.operators.graph import (
    DEFAULT_EF_CONSTRUCTION, DEFAULT_M, check_filter_modes, check_graph,
)
from trawl.operators.ivf import check_search
from trawl.operators.quant import check_options
from trawl.schema import Metric


@dataclass
class VectorIndexOptions:
    """Quantizer options shared by both index types."""

    index_type: ClassVar[str] = ""

    quant: str | None = None
    pq_m: int | None = None
    nb_bits: float | None = None
    query_bits: int | None = None

    def quantizer(self, metric: Metric) -> dict:
        default = "none" if metric is Metric.L1 else "sq8"
        return {"kind": self.quant or default, "pq_m": self.pq_m, "nb_bits": self.nb_bits,
                "query_bits": self.query_bits}

    def check(self, metric: Metric, dim: int | None) -> None:
        spec = self.quantizer(metric)
        check_options(spec.pop("kind"), metric, dim, **spec)


@dataclass
class IvfOptions(VectorIndexOptions):
    """Inverted file; ``cells=None`` scales the number of lists with the row count."""

    index_type: ClassVar[str] = "ivf"

    cells: int | None = None
    rabitq_bits: int | None = None

    def __post_init__(self) -> None:
        if self.rabitq_bits is None:
            return
        warnings.warn("rabitq_bits is deprecated; use nb_bits instead", DeprecationWarning,
                      stacklevel=3)
        if self.nb_bits is not None and self.nb_bits != self.rabitq_bits:
            raise ValueError("rabitq_bits and nb_bits are the same setting; set only nb_bits")
        self.nb_bits = self.rabitq_bits


@dataclass
class GraphOptions(VectorIndexOptions):
    """Neighbour graph."""

    index_type: ClassVar[str] = "hnsw"

    m: int = DEFAULT_M
    ef_construction: int = DEFAULT_EF_CONSTRUCTION
    cells: int | None = None

    def check(self, metric: Metric, dim: int | None) -> None:
        super().check(metric, dim)
        check_graph(self.m, self.ef_construction)


@dataclass
class IvfQuery:
    """Search knobs of an inverted file."""

    index_type: ClassVar[str] = "ivf"

    nprobe: int | None = None
    rescore_width: float | None = None

    def knobs(self) -> dict:
        check_search(nprobe=self.nprobe, rescore_width=self.rescore_width)
        return {k: v for k, v in vars(self).items() if v is not None}

    def filter_mode_or_auto(self) -> str:
        return "auto"


@dataclass
class GraphQuery:
    """Search knobs of a neighbour graph.

    ``scan`` and ``auto`` answer filtered searches exactly; the other filter modes, and every
    ``column_filter``, mean the same here: the filter applies inside the walk.
    """

    index_type: ClassVar[str] = "hnsw"

    ef_search: int | None = None
    rescore_width: float | None = None
    filter_mode: str | None = None
    column_filter: str | None = None

    def knobs(self) -> dict:
        check_search(ef_search=self.ef_search, rescore_width=self.rescore_width)
        check_filter_modes(self.filter_mode, self.column_filter)
        given = {"ef_search": self.ef_search, "rescore_width": self.rescore_width}
        return {k: v for k, v in given.items() if v is not None}

    def filter_mode_or_auto(self) -> str:
        return self.filter_mode or "auto"


@dataclass(frozen=True)
class TextIndexOptions:
    """Analyzer of the content column in the combined index."""

    analyzer: Analyzer = field(default=SPLIT_LOWER)


def check_query_type(options, index_type: str | None, name: str) -> None:
    """Knobs of the other index type would be ignored silently, so they are refused."""
    if options is not None and index_type and options.index_type != index_type:
        raise ValueError(
            f"{name}: its index is {index_type.upper()}, which {type(options).__name__} "
            "has no settings for"
        )
