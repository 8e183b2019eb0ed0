"""Ownership and metadata predicates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import UnsupportedFilterError
from ..functions.vectors import is_finite
from ..spec import SCHEMA_VERSION, StoreSpec, scalar_class


OWNED_COLUMN = "is_owned"
BUCKET_COLUMN = "key_bucket"
MAX_SENT_KEYS = 1_000_000
MAX_SENT_BYTES = 64 << 20


def owned(spec: StoreSpec, rows: DataFrame | None = None) -> Column:
    """True for rows this store may replace or remove; false, never NULL, for all others.

    Snapshots are partitioned by it. Where ``rows`` come from one, the partition value answers, and the
    vectors need not be read to see that they are there.
    """
    if rows is not None and OWNED_COLUMN in rows.columns:
        return F.col(OWNED_COLUMN)
    return F.coalesce(
        (F.col("document_type") == spec.document_type)
        & (F.col("schema_version") == SCHEMA_VERSION)
        & F.col("id").isNotNull()
        & F.col("vector").isNotNull(),
        F.lit(False),
    )


def key_bucket(spec: StoreSpec) -> Column:
    return F.pmod(F.xxhash64("doc_key"), F.lit(spec.key_buckets)).cast("int")


def on_keys(store: DataFrame, keys: DataFrame, spec: StoreSpec) -> tuple[DataFrame, list[str]]:
    """Keys with what else they can be joined on: where the store is partitioned by bucket, the bucket
    lets Spark prune the partitions of the scan by the keys it is joined with."""
    if BUCKET_COLUMN not in store.columns:
        return keys, ["doc_key"]
    return keys.withColumn(BUCKET_COLUMN, key_bucket(spec)), ["doc_key", BUCKET_COLUMN]


def sent_if_few(keys: DataFrame) -> DataFrame:
    """Keys to join a store with; broadcast only once their number and bytes are known to be small.

    Left to adaptive execution, the store would be shuffled before the keys turn out to be few.
    """
    # every task sums its own keys and sends one row
    n, size = keys.agg(F.count(F.lit(1)), F.sum(F.octet_length("doc_key"))).first()
    return F.broadcast(keys) if n <= MAX_SENT_KEYS and (size or 0) <= MAX_SENT_BYTES else keys


def under_prefix(spec: StoreSpec) -> Column:
    return F.col("doc_key").startswith(spec.key_prefix)


def in_search_scope(spec: StoreSpec) -> Column:
    """Rows a search sees: those of the document type, optionally under the prefix only."""
    of_type = F.col("document_type") == spec.document_type
    return of_type & under_prefix(spec) if spec.search_scope == "prefix" else of_type


def field(name: str) -> Column:
    """A metadata field by its literal name, which may hold dots."""
    return F.col("metadata").getField(name)


def comparable(name: str, spec: StoreSpec) -> Column:
    """A metadata field as queries are compared with it: numbers as doubles without a negative zero."""
    number = spec.filter_types[name] == "number"
    return field(name).cast("double") + F.lit(0.0) if number else field(name)


def equality(spec: StoreSpec, filters: Mapping[str, Any] | None) -> Column | None:
    """AND of field = value; None without conditions. A value of another class matches nothing."""
    conditions = []
    for name, value in spec.check_filter(filters).items():
        same_class = scalar_class(value) == spec.filter_types[name]
        literal = float(value) if scalar_class(value) == "number" else value
        conditions.append(field(name) == F.lit(literal) if same_class else F.lit(False))
    return reduce(lambda a, b: a & b, conditions) if conditions else None


def column_class(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.StringType):
        return "string"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.NumericType):
        return "number"
    return None


def query_conditions(queries: DataFrame, spec: StoreSpec) -> tuple[DataFrame, list[str]]:
    """Bring filter columns of a queries table to the declared types.

    Returns the queries that can have hits, and the filter fields they carry. A query that asks a field
    for a value of another class has none, so it is left out.
    """
    fields = [f for f in spec.fields if f in queries.columns]
    for name in fields:
        kind = column_class(queries.schema[name].dataType)
        if kind is None and not isinstance(queries.schema[name].dataType, T.NullType):
            raise UnsupportedFilterError(
                f'filter field "{name}" needs a string, a boolean or a finite number'
            )
        quoted = F.col(f"`{name}`")
        if kind != spec.filter_types[name]:
            queries = queries.filter(quoted.isNull()).withColumn(
                name, F.lit(None).cast(spec.metadata_type[name].dataType)
            )
        elif kind == "number":
            value = quoted.cast("double") + F.lit(0.0)
            message = f'filter field "{name}" needs a string, a boolean or a finite number'
            queries = queries.withColumn(
                name,
                F.when(value.isNull() | is_finite(value), value).otherwise(
                    F.raise_error(F.lit(message)).cast("double")
                ),
            )
    return queries, fields
