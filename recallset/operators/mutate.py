"""Upsert, get, delete, clear and count, as functions from tables to tables.

A mutation takes the current rows and returns the next ones; :mod:`recallset.sources.store` writes
them. Only the keys of a change travel: the store side is never grouped or fully joined, so with a
change small enough for Catalyst to broadcast the store is scanned without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CollisionError
from ..spec import SCHEMA_VERSION, StoreSpec
from . import filters as flt
from .validate import check_ids, check_items, require_valid


class Change(NamedTuple):
    """The rows after a change, and what stands in its way."""

    rows: DataFrame
    collisions: DataFrame
    rejects: DataFrame


def document_key(spec: StoreSpec, id_: Column) -> Column:
    return F.concat(F.lit(spec.key_prefix), id_)


def instant(as_of: dt.datetime | str) -> Column:
    return F.lit(as_of).cast("timestamp")


def typed_metadata(metadata: Column, kind: T.DataType, spec: StoreSpec) -> Column:
    """The declared fields of a struct, a map of strings or a JSON string, at their declared types.

    A value whose class differs from the declared one becomes NULL; nothing is converted across classes.
    """
    values = []
    parsed = F.try_parse_json(metadata) if isinstance(kind, T.StringType) else None
    for target in spec.metadata_type.fields:
        cls = flt.column_class(target.dataType)
        value = F.lit(None)
        if parsed is not None:
            value = _json_scalar(F.try_variant_get(parsed, f'$["{_escaped(target.name)}"]', "variant"), cls)
        elif isinstance(kind, T.StructType) and target.name in kind.names:
            if flt.column_class(kind[target.name].dataType) == cls:
                value = metadata.getField(target.name)
        elif isinstance(kind, T.MapType) and flt.column_class(kind.valueType) == cls:
            value = F.try_element_at(metadata, F.lit(target.name))
        values.append(value.cast(target.dataType).alias(target.name))
    return F.when(metadata.isNotNull(), F.struct(*values))


def _escaped(name: str) -> str:
    return name.replace("\\", "\\\\").replace('"', '\\"')


def _json_scalar(value: Column, cls: str | None) -> Column:
    kind = F.schema_of_variant(value)
    wanted = {
        "string": kind == "STRING",
        "boolean": kind == "BOOLEAN",
        "number": kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
    }[cls]
    target = {"string": "string", "boolean": "boolean", "number": "double"}[cls]
    return F.when(wanted, F.try_variant_get(value, "$", target))


def make_documents(
    items: DataFrame,
    spec: StoreSpec,
    created_at: Column,
    updated_at: Column,
    keep: tuple[str, ...] = (),
    key: Column | None = None,
) -> DataFrame:
    """Stored rows for items ``(id, vector[, metadata][, content])``; only columns to ``keep`` are added."""
    if "metadata" in items.columns:
        kind = items.schema["metadata"].dataType
        metadata = typed_metadata(F.col("metadata"), kind, spec)
        raw = F.col("metadata") if isinstance(kind, T.StringType) else F.to_json("metadata")
    else:
        metadata, raw = F.lit(None).cast(spec.metadata_type), F.lit(None).cast("string")
    content = F.col("content") if "content" in items.columns else F.lit(None).cast("string")
    return items.select(
        (document_key(spec, F.col("id")) if key is None else key).alias("doc_key"),
        F.lit(spec.document_type).alias("document_type"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "id",
        F.col("vector").cast("array<double>").alias("vector"),
        F.lit(spec.dimensions).alias("dimensions"),
        metadata.alias("metadata"),
        raw.alias("metadata_json"),
        content.alias("content"),
        created_at.alias("created_at"),
        updated_at.alias("updated_at"),
        *keep,
    )


def mirror_content(items: DataFrame) -> DataFrame:
    """Take ``content`` from the metadata where that is a string; an item's own content is ignored."""
    kind = items.schema["metadata"].dataType if "metadata" in items.columns else None
    value = F.lit(None).cast("string")
    if isinstance(kind, T.StringType):
        parsed = F.try_parse_json("metadata")
        value = _json_scalar(F.try_variant_get(parsed, "$.content", "variant"), "string")
    elif isinstance(kind, T.StructType) and "content" in kind.names:
        if isinstance(kind["content"].dataType, T.StringType):
            value = F.col("metadata").getField("content")
    elif isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        value = F.try_element_at("metadata", F.lit("content"))
    return items.withColumn("content", value)


def latest_items(items: DataFrame, by: str = "id") -> DataFrame:
    """One item per id: the one with the highest ``ord``. Partial aggregation, so a hot id is no hot task."""
    if "ord" not in items.columns:
        return items.dropDuplicates([by])
    others = [c for c in items.columns if c != by]
    return (
        items.groupBy(by)
        .agg(F.max_by(F.struct(*others), F.col("ord")).alias("item"))
        .select(by, "item.*")
    )


def change_keys(keys: DataFrame) -> DataFrame:
    return flt.sent_if_few(keys.select("doc_key"))


def occupied(store: DataFrame, keys: DataFrame, spec: StoreSpec) -> DataFrame:
    """``(doc_key, owned, created_at)`` of the stored rows under the given keys."""
    wanted, on = flt.on_keys(store, keys, spec)
    held = store.select(*on, flt.owned(spec, store).alias("owned"), "created_at")
    return held.join(wanted, on, "left_semi").select("doc_key", "owned", "created_at")


def without(store: DataFrame, keys: DataFrame, spec: StoreSpec) -> DataFrame:
    """The store less its owned rows under the given keys."""
    gone = keys.withColumnRenamed("doc_key", "gone_key")
    same = (F.col("doc_key") == F.col("gone_key")) & flt.owned(spec, store)
    return store.join(gone, same, "left_anti")


def upsert(store: DataFrame, items: DataFrame, spec: StoreSpec, as_of: dt.datetime | str) -> Change:
    """Insert items, or replace the owned rows under their keys as a whole.

    A replaced row keeps its ``created_at`` and nothing else. Items whose key is held by a foreign row are
    left out of ``rows`` and listed in ``collisions``. The items are read several times, so they should
    be a table or be persisted.
    """
    checked = check_items(items, spec)
    keyed = checked.valid.withColumn("doc_key", document_key(spec, F.col("id")))
    keys, now = change_keys(keyed), instant(as_of)
    # Grouped by the key itself, so that the join on it needs no further shuffle.
    fresh = make_documents(latest_items(keyed, "doc_key"), spec, now, now, key=F.col("doc_key"))
    held = occupied(store, keys, spec)
    written = (
        fresh.withColumnRenamed("created_at", "inserted_at")
        .join(held, "doc_key", "left")
        .filter(F.coalesce("owned", F.lit(True)))
        .withColumn(
            "created_at",
            F.when(F.col("owned").isNull(), F.col("inserted_at")).otherwise(F.col("created_at")),
        )
        .select(*fresh.columns)
    )
    rows = without(store, keys, spec).unionByName(_like(written, store, spec))
    return Change(rows, held.filter(~F.col("owned")).select("doc_key"), checked.rejects)


def _like(rows: DataFrame, store: DataFrame, spec: StoreSpec) -> DataFrame:
    """Own rows at the columns and types of a store, which may hold its vectors in single precision."""
    rows = rows.withColumn(flt.OWNED_COLUMN, F.lit(True)).withColumn(
        flt.BUCKET_COLUMN, flt.key_bucket(spec)
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in store.schema.fields])


def upsert_mirrored(store: DataFrame, items: DataFrame, spec: StoreSpec, as_of: dt.datetime | str) -> Change:
    """:func:`upsert` after :func:`mirror_content`."""
    return upsert(store, mirror_content(items), spec, as_of)


def get(store: DataFrame, ids: DataFrame, spec: StoreSpec) -> DataFrame:
    """One row per requested id with what is stored, or NULLs and ``found = false``.

    ``collision`` marks ids whose key is held by a foreign row. The content is the stored one only.
    """
    keys = ids.select("id", document_key(spec, F.col("id")).alias("doc_key"))
    wanted, on = flt.on_keys(store, change_keys(keys), spec)
    stored = (
        store.select(
            *on,
            flt.owned(spec, store).alias("owned"),
            "vector",
            "metadata",
            "metadata_json",
            "content",
        )
        .join(wanted, on, "left_semi")
        .drop(flt.BUCKET_COLUMN)
    )
    own = F.coalesce(F.col("owned"), F.lit(False))
    return keys.join(stored, "doc_key", "left").select(
        "id",
        *[F.when(own, F.col(c)).alias(c) for c in ("vector", "metadata", "metadata_json", "content")],
        own.alias("found"),
        F.coalesce(~F.col("owned"), F.lit(False)).alias("collision"),
    )


def delete(store: DataFrame, ids: DataFrame, spec: StoreSpec) -> Change:
    """Remove owned rows by id; a missing id changes nothing, a foreign row stays and is reported."""
    checked = check_ids(ids)
    keys = change_keys(checked.valid.select(document_key(spec, F.col("id")).alias("doc_key")))
    collisions = occupied(store, keys, spec).filter(~F.col("owned")).select("doc_key")
    return Change(without(store, keys, spec), collisions, checked.rejects)


def clear(store: DataFrame, spec: StoreSpec) -> DataFrame:
    """What is left after removing every owned row under the prefix."""
    return store.filter(~F.coalesce(flt.under_prefix(spec) & flt.owned(spec, store), F.lit(False)))


def count(store: DataFrame, spec: StoreSpec) -> DataFrame:
    """The number of owned rows under the prefix, as one row."""
    return store.filter(flt.under_prefix(spec) & flt.owned(spec, store)).agg(F.count(F.lit(1)).alias("n"))


def require_no_collision(collisions: DataFrame) -> None:
    first = collisions.select("doc_key").take(1)
    if first:
        raise CollisionError(
            f'key "{first[0]["doc_key"]}" is held by a row of another owner; choose another key_prefix'
        )


def require_clean(change: Change) -> None:
    """Raise on the first reject or collision; to be called before anything is written."""
    require_valid(change.rejects)
    require_no_collision(change.collisions)
