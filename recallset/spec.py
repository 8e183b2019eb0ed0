"""Declarations that stay the same for the life of a store or an index."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Any

from pyspark.sql import types as T

from .errors import ConfigurationError, UnsupportedFilterError, ValidationError

SCHEMA_VERSION = 1

DEFAULT_DOCUMENT_TYPE = "vector_document"
DEFAULT_KEY_PREFIX = "recallset::vector::"
DEFAULT_INDEX_NAME = "vectors_ivf"

# Defaults and limits that callers rely on.
DEFAULT_FILTER_FIELDS = ("userId", "conversationId")
DEFAULT_LIMIT = 10
DEFAULT_THRESHOLD = 0.0
DEFAULT_TOP_K = 3
MAX_TRAIN_LIST = 1_000_000
INDEX_NAME_PATTERN = r"[A-Za-z][A-Za-z0-9#_]*"
DEFAULT_DESCRIPTION = "IVF,SQ8"
DESCRIPTION_PATTERN = r"IVF(\d*),SQ8"

# Spark types behind the three classes of scalar a filter may hold.
SCALAR_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def is_positive_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value > 0


def require_positive_int(name: str, value: Any) -> None:
    if not is_positive_int(value):
        raise ConfigurationError(f"{name} must be a positive integer")


def check_search_bounds(limit: Any, threshold: Any) -> None:
    if not is_positive_int(limit):
        raise ValidationError("limit must be a positive integer")
    number = isinstance(threshold, (int, float)) and not isinstance(threshold, bool)
    if not number or not math.isfinite(threshold) or not 0 <= threshold <= 1:
        raise ValidationError("threshold must be between 0 and 1")


def scalar_class(value: Any) -> str | None:
    """``string``, ``number`` or ``boolean``; None for anything a filter cannot compare with."""
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, str):
        return "string"
    if isinstance(value, (int, float)) and math.isfinite(value):
        return "number"
    return None


def _filter_types(fields: Any) -> Mapping[str, str]:
    if isinstance(fields, Mapping):
        pairs = list(fields.items())
    else:
        pairs = [(name, "string") for name in fields]
    names = [name for name, _ in pairs]
    if len(set(names)) != len(names) or any(not name for name in names):
        raise ConfigurationError("filter_fields must be unique and not empty")
    for name, kind in pairs:
        if kind not in SCALAR_TYPES:
            raise ConfigurationError(
                f'filter_fields: "{name}" must be one of {sorted(SCALAR_TYPES)}, not {kind!r}'
            )
    return MappingProxyType(dict(pairs))


@dataclass(frozen=True)
class StoreSpec:
    """What one store holds: vector length, ownership marker, key prefix, filter fields.

    ``filter_fields`` is a list of names (string fields) or a mapping of name to
    ``string`` / ``number`` / ``boolean``. The probe options are the defaults of indexed search. With
    ``key_buckets`` above 1 snapshots are partitioned by a hash of the key, so that looking up a few keys
    reads their buckets only.
    """

    dimensions: int
    document_type: str = DEFAULT_DOCUMENT_TYPE
    key_prefix: str = DEFAULT_KEY_PREFIX
    filter_fields: Any = DEFAULT_FILTER_FIELDS
    index_name: str = DEFAULT_INDEX_NAME
    n_probes: int | None = None
    rerank: bool | None = None
    top_n_scan: int | None = None
    search_scope: str = "document_type"
    key_buckets: int = 1
    filter_types: Mapping[str, str] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        require_positive_int("dimensions", self.dimensions)
        if not self.document_type:
            raise ConfigurationError("document_type must not be empty")
        if not self.key_prefix:
            raise ConfigurationError("key_prefix must not be empty")
        check_index_name(self.index_name)
        object.__setattr__(self, "filter_types", _filter_types(self.filter_fields))
        check_probe_options(self.n_probes, self.rerank, self.top_n_scan)
        require_positive_int("key_buckets", self.key_buckets)
        if self.search_scope not in ("document_type", "prefix"):
            raise ConfigurationError("search_scope must be document_type or prefix")

    @property
    def fields(self) -> list[str]:
        return list(self.filter_types)

    @property
    def metadata_type(self) -> T.StructType:
        """Typed columns for the declared fields and the two keys that retrieval reads."""
        out = T.StructType([T.StructField(n, SCALAR_TYPES[k]) for n, k in self.filter_types.items()])
        for name in ("title", "content"):
            if name not in self.filter_types:
                out = out.add(name, T.StringType())
        return out

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("doc_key", T.StringType()),
                T.StructField("document_type", T.StringType()),
                T.StructField("schema_version", T.IntegerType()),
                T.StructField("id", T.StringType()),
                T.StructField("vector", T.ArrayType(T.DoubleType())),
                T.StructField("dimensions", T.IntegerType()),
                T.StructField("metadata", self.metadata_type),
                T.StructField("metadata_json", T.StringType()),
                T.StructField("content", T.StringType()),
                T.StructField("created_at", T.TimestampType()),
                T.StructField("updated_at", T.TimestampType()),
            ]
        )

    def check_filter(self, filters: Mapping[str, Any] | None) -> dict[str, Any]:
        """Return the filter as a dict, or raise before any job has started."""
        out: dict[str, Any] = {}
        for name, value in (filters or {}).items():
            self.check_filter_field(name)
            if scalar_class(value) is None:
                raise UnsupportedFilterError(
                    f'filter field "{name}" needs a string, a boolean or a finite number'
                )
            out[name] = value
        return out

    def check_filter_field(self, name: str) -> None:
        if name not in self.filter_types:
            raise UnsupportedFilterError(f'"{name}" is not among the filter_fields of this store')


def check_index_name(name: Any) -> None:
    if not isinstance(name, str) or not re.fullmatch(INDEX_NAME_PATTERN, name):
        raise ConfigurationError(
            "index_name needs a letter first, then letters, digits, # or _"
        )


def check_probe_options(n_probes: Any, rerank: Any, top_n_scan: Any) -> None:
    """Reranking needs a probe count; a candidate cap needs both."""
    if rerank is not None and n_probes is None:
        raise ConfigurationError("rerank needs n_probes")
    if top_n_scan is not None and (n_probes is None or rerank is None):
        raise ConfigurationError("top_n_scan needs n_probes and rerank")
    if n_probes is not None:
        require_positive_int("n_probes", n_probes)
    if top_n_scan is not None:
        require_positive_int("top_n_scan", top_n_scan)


@dataclass(frozen=True)
class IndexSpec:
    """How to build an inverted-file index with 8-bit codes over one store.

    ``description`` is ``IVF,SQ8`` (list count chosen from the data) or ``IVF<n>,SQ8``. ``train_list`` is the number of
    vectors sampled for training; without it training reads all.
    """

    store: StoreSpec
    index_name: str | None = None
    description: str = DEFAULT_DESCRIPTION
    scan_n_probes: int | None = None
    train_list: int | None = None
    persist_full_vector: bool = True

    def __post_init__(self) -> None:
        if self.index_name is None:
            object.__setattr__(self, "index_name", self.store.index_name)
        check_index_name(self.index_name)
        if not self.description:
            raise ConfigurationError("description must not be empty")
        match = re.fullmatch(DESCRIPTION_PATTERN, self.description)
        if not match or match.group(1) and int(match.group(1)) == 0:
            raise ConfigurationError("description must be IVF,SQ8 or IVF<number of lists>,SQ8")
        if self.scan_n_probes is not None:
            require_positive_int("scan_n_probes", self.scan_n_probes)
        if self.train_list is not None:
            require_positive_int("train_list", self.train_list)
            if self.train_list > MAX_TRAIN_LIST:
                raise ConfigurationError(f"train_list must be at most {MAX_TRAIN_LIST}")
        if not isinstance(self.persist_full_vector, bool):
            raise ConfigurationError("persist_full_vector must be a boolean")
        if not self.persist_full_vector and self.store.rerank:
            raise ConfigurationError(
                "rerank reads full vectors: persist_full_vector must remain enabled"
            )

    @property
    def requested_lists(self) -> int | None:
        digits = re.fullmatch(DESCRIPTION_PATTERN, self.description).group(1)
        return int(digits) if digits else None
