"""Document and vector retrieval as Spark jobs: ingest, filter, match, rank and fuse at corpus scale."""

from trawl.functions.embed import HashModel, embed, hash_embedding
from trawl.functions.text import Analyzer
from trawl.operators.dense import knn_join, topk, with_relevance
from trawl.operators.filters import apply_filter, compile_filter
from trawl.operators.graph import GraphIndex
from trawl.operators.hybrid import Fusion, HybridConfig, hybrid_search
from trawl.operators.ivf import IvfIndex, filtered_search
from trawl.operators.lexical import LexicalIndex, boolean_match, lexical_topk, web_match
from trawl.operators.mmr import mmr
from trawl.schema import (
    CollectionSchema, Column, IndexedColumn, IndexedJsonField, MetadataIndex, Metric,
)
from trawl.session import build_session
from trawl.sources.collection import Collection, from_documents, from_texts
from trawl.sources.options import GraphOptions, GraphQuery, IvfOptions, IvfQuery, TextIndexOptions
from trawl.streaming.ingest import ingest

__all__ = [
    "Analyzer", "Collection", "CollectionSchema", "Column", "Fusion", "GraphIndex", "GraphOptions",
    "GraphQuery", "HashModel", "HybridConfig", "IndexedColumn", "IndexedJsonField", "IvfIndex",
    "IvfOptions", "IvfQuery", "LexicalIndex", "MetadataIndex", "Metric", "TextIndexOptions",
    "apply_filter", "boolean_match", "build_session", "compile_filter", "embed", "filtered_search",
    "from_documents", "from_texts", "hash_embedding", "hybrid_search", "ingest", "knn_join",
    "lexical_topk", "mmr", "topk", "web_match", "with_relevance",
]
