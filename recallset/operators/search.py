"""Filtered cosine search: one literal vector, or a table of queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ValidationError
from ..functions.vectors import (
    cosine_distance_to,
    distance_to_score,
    is_finite,
    vector_error,
)
from ..spec import DEFAULT_LIMIT, DEFAULT_THRESHOLD, StoreSpec, check_search_bounds
from . import filters as flt
from .nearest import BLOCK_HITS, Hits, nearest

PAYLOAD = ("vector", "metadata", "metadata_json", "content")


def resolved_content(content: Column, metadata: Column) -> Column:
    """The content, else the metadata's ``content``; an empty string counts as content."""
    return F.coalesce(content, metadata.getField("content"))


def search_corpus(
    store: DataFrame, spec: StoreSpec, filters: Mapping[str, Any] | None = None
) -> DataFrame:
    """Store rows a search may return. The conditions are plain predicates, so they reach the scan."""
    rows = store.filter(flt.in_search_scope(spec))
    condition = flt.equality(spec, filters)
    if condition is not None:
        rows = rows.filter(condition)
    return rows.filter(F.size("vector") == spec.dimensions)


def search_one(
    store: DataFrame,
    vector: Sequence[float],
    spec: StoreSpec,
    limit: int = DEFAULT_LIMIT,
    threshold: float = DEFAULT_THRESHOLD,
    filters: Mapping[str, Any] | None = None,
    strict: bool = True,
    columns: Sequence[str] = PAYLOAD,
    builtin: bool = False,
) -> DataFrame:
    """Hits of one vector, best first: filter, order by distance, limit, and only then the threshold.

    The threshold cannot fill up from further rows, so fewer than ``limit`` hits may come back. One scan
    finds the keys of the hits, another the ``columns``, so that no task passes on the payload of rows
    that lose. ``strict`` fails on a hit whose distance is undefined, else such rows are no candidates.

    Distances come from the Arrow batch helper, or with ``builtin`` from array functions and a top-k in the
    JVM. The result is the same; array functions are interpreted per element and take some three
    times as long at 64 dimensions.
    """
    check_vector(vector, spec)
    check_search_bounds(limit, threshold)
    best = ("distance", "id", "doc_key")
    rows = search_corpus(store, spec, filters)
    if builtin:
        rows = rows.withColumn("distance", cosine_distance_to(F.col("vector"), vector))
        if not strict:
            rows = rows.filter(is_finite(F.col("distance")))
        top, bounded = rows.select(*best).orderBy(*best).limit(limit), limit <= BLOCK_HITS
    else:
        query = store.sparkSession.createDataFrame(
            [(0, [float(v) for v in vector], limit)], "q_id int, qv array<double>, limit int"
        )
        top, bounded = nearest(rows, query, spec.dimensions, strict=strict)
        top = top.select(*best)
    found = Hits(scored(top, None, threshold), bounded)
    return with_payload(found, store, spec, columns).orderBy(*best).limit(limit)


def check_vector(vector: Sequence[float], spec: StoreSpec) -> None:
    if len(vector) != spec.dimensions:
        raise ValidationError(
            f"dimension mismatch: the vector has {len(vector)} values, the store {spec.dimensions}"
        )
    if any(v is None or v != v or v in (float("inf"), float("-inf")) for v in vector):
        raise ValidationError("every value of a vector must be a finite number")


def checked_queries(
    queries: DataFrame, spec: StoreSpec, limit: int, threshold: float
) -> DataFrame:
    """Queries with ``limit`` and ``threshold`` filled in; a bad vector or bound fails the job."""
    check_search_bounds(limit, threshold)
    for name, default in (("limit", limit), ("threshold", float(threshold))):
        value = F.coalesce(name, F.lit(default)) if name in queries.columns else F.lit(default)
        queries = queries.withColumn(name, value)
    error = F.coalesce(
        vector_error(F.col("qv"), spec.dimensions),
        bounds_error(F.col("limit"), F.col("threshold")),
    )
    return queries.withColumn(
        "qv",
        F.when(error.isNull(), F.col("qv").cast("array<double>")).otherwise(
            F.raise_error(error).cast("array<double>")
        ),
    )


def bounds_error(limit: Column, threshold: Column) -> Column:
    """NULL for usable search bounds, else what is wrong with them."""
    whole = (limit > 0) & (limit == F.floor(limit.cast("double")))
    inside = is_finite(threshold.cast("double")) & (threshold >= 0) & (threshold <= 1)
    return F.when(
        ~F.coalesce(whole, F.lit(False)), F.lit("limit must be a positive integer")
    ).when(
        ~F.coalesce(inside, F.lit(False)), F.lit("threshold must be between 0 and 1")
    )


def search_hits(
    store: DataFrame,
    queries: DataFrame,
    spec: StoreSpec,
    limit: int = DEFAULT_LIMIT,
    threshold: float = DEFAULT_THRESHOLD,
    filters: Mapping[str, Any] | None = None,
    strict: bool = True,
    **how: Any,
) -> Hits:
    """Scored hits ``(q_id, rank, doc_key, id, distance, score)`` without the stored payload.

    ``queries`` has ``q_id`` and ``qv``, optionally ``limit``, ``threshold`` and one column per filter
    field (NULL: no condition). ``filters`` holds conditions common to all queries.
    """
    own_threshold = "threshold" in queries.columns
    queries = checked_queries(queries, spec, limit, threshold)
    asked, fields = flt.query_conditions(queries, spec)
    corpus = search_corpus(store, spec, filters).select(
        "doc_key", "id", "vector", *[flt.comparable(f, spec).alias(f) for f in fields]
    )
    found = nearest(corpus, asked, spec.dimensions, fields, strict=strict, **how)
    return Hits(scored(found.rows, queries if own_threshold else None, threshold), found.bounded)


def scored(hits: DataFrame, queries: DataFrame | None, threshold: float) -> DataFrame:
    """Add the score and drop hits under their query's threshold, or under the common one."""
    rows = hits.withColumn("score", distance_to_score(F.col("distance")))
    if queries is None:
        return rows.filter(F.col("score") >= F.lit(float(threshold)))
    bounds = queries.select("q_id", F.col("threshold").cast("double").alias("threshold"))
    return (
        rows.join(bounds, "q_id").filter(F.col("score") >= F.col("threshold")).drop("threshold")
    )


def with_payload(found: Hits, store: DataFrame, spec: StoreSpec, columns: Sequence[str] = PAYLOAD) -> DataFrame:
    """Fetch stored columns of the hits. A bounded set of hits is sent to the scan, not the scan to it."""
    needed = {"doc_key", *columns} | ({"metadata"} if "content" in columns else set())
    rows, on = flt.on_keys(store, found.rows, spec)
    rows = F.broadcast(rows) if found.bounded else rows
    stored = store.filter(flt.in_search_scope(spec)).select(*sorted(needed | set(on)))
    if "content" in columns:
        stored = stored.withColumn(
            "content", resolved_content(F.col("content"), F.col("metadata"))
        )
    lead = [c for c in ("q_id", "rank") if c in rows.columns]
    return stored.select(*on, *columns).join(rows, on).select(
        *lead, "doc_key", "id", *columns, "distance", "score"
    )


def search(store: DataFrame, queries: DataFrame, spec: StoreSpec, *args: Any, columns: Sequence[str] = PAYLOAD, **kwargs: Any) -> DataFrame:
    """:func:`search_hits` with the stored columns: ``(q_id, rank, doc_key, id, …, distance, score)``."""
    return with_payload(search_hits(store, queries, spec, *args, **kwargs), store, spec, columns)
