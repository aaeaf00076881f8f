"""Vector and payload analytics over collections of points, on Spark."""

from .errors import CollectionNotFound, CollectionParamsMissing, DialectError, DimensionMismatch, InvalidSchema, MalformedVector, PointframeError, SnapshotConflict
from .functions.json_functions import register_json_functions
from .operators.fusion import fuse_dbsf, fuse_rrf
from .operators.recommend import discover, discover_weighted, recommend
from .operators.search import boosted, prefetch, random_sample, rerank, score, search, search_batch, search_by_id, sparse_search, top_k, weighted_search, within_radius
from .plans.dialect import sql
from .sources.collection import Collection
from .sources.config import CollectionConfig, VectorParams
from .sources.ingest import points, wire_to_columns

__all__ = [
    "Collection", "CollectionConfig", "CollectionNotFound", "CollectionParamsMissing", "DialectError", "DimensionMismatch", "InvalidSchema", "MalformedVector",
    "PointframeError", "SnapshotConflict", "VectorParams", "boosted", "discover", "discover_weighted", "fuse_dbsf", "fuse_rrf", "points", "prefetch", "random_sample", "recommend",
    "register_json_functions", "rerank", "score", "search", "search_batch", "search_by_id", "sparse_search", "sql", "top_k", "weighted_search", "wire_to_columns", "within_radius",
]
