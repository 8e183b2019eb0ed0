"""Filtered vector search, vector stores and retrieval as Spark jobs."""

from .api import VectorStore
from .errors import (
    CollisionError,
    ConfigurationError,
    RecallError,
    UnsupportedFilterError,
    ValidationError,
)
from .spec import IndexSpec, StoreSpec

__all__ = [
    "CollisionError",
    "ConfigurationError",
    "IndexSpec",
    "RecallError",
    "StoreSpec",
    "UnsupportedFilterError",
    "ValidationError",
    "VectorStore",
]
