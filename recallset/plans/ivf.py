"""Inverted-file index with 8-bit codes: train, assign, encode, store, probe, rerank.

Centroids and value ranges are the only things shared with every task, and their size is bounded when
the index is declared. Entries stay where they are; they move once, when they are written by list.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigurationError
from ..functions.vectors import has_direction
from ..operators import filters as flt
from ..operators import rerank as rr
from ..operators.nearest import Hits, nearest
from ..operators.quantize import closest_lists, encode, value_ranges
from ..operators.search import PAYLOAD, checked_queries, scored, search_corpus, with_payload
from ..session import checkpointed, ship_package
from ..sources.store import not_there
from ..spec import (
    DEFAULT_LIMIT,
    DEFAULT_THRESHOLD,
    IndexSpec,
    StoreSpec,
    check_probe_options,
)
from . import index_files as files

CENTROID_BYTES = 64 << 20
DEFAULT_N_PROBES = 1


@dataclass(frozen=True)
class Index:
    """Shared numbers of an index and its entries.

    ``entries`` has ``centroid_id, doc_key, id, code, metadata, updated_at`` and, if full vectors are
    persisted, ``vector``; ``metadata`` holds the filter fields only. A written index has a ``path``, the ``manifest`` it was read
    by, and ``counts`` of entries per list and filter values.
    """

    spec: IndexSpec
    centroids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    entries: DataFrame
    counts: DataFrame | None = None
    path: str | None = None
    manifest: files.Manifest | None = None


def index_rows(store: DataFrame, spec: StoreSpec) -> DataFrame:
    """Rows an index covers: those of the document type whose vectors have the right size and a direction."""
    return (
        store.filter(flt.in_search_scope(spec))
        .filter(F.size("vector") == spec.dimensions)
        .filter(has_direction(F.col("vector")))
    )


def list_count(spec: IndexSpec, rows: int) -> int:
    """Lists asked for, else about the square root of the rows, but no more than points to train with or CENTROID_BYTES hold."""
    most = CENTROID_BYTES // (8 * spec.store.dimensions)
    wanted = spec.requested_lists
    if wanted is not None:
        if wanted > most:
            raise ConfigurationError(f"description asks for more than {most} lists")
        return wanted
    trained = min(spec.train_list or rows, rows)
    return max(1, min(round(rows**0.5), trained, most))


def train_centroids(store: DataFrame, spec: IndexSpec, seed: int = 42) -> DataFrame:
    """``(centroid_id, centroid)`` from cosine k-means over all rows, or about ``train_list`` picked by a hash of the key.

    Fewer lists than the description asks for are refused.
    """
    rows = index_rows(store, spec.store)
    total = rows.count()
    if spec.train_list is not None and spec.train_list > total:
        raise ConfigurationError(f"train_list is {spec.train_list}, but there are {total} rows")
    if not total:
        raise ConfigurationError("there are no vectors to train an index with")
    lists = list_count(spec, total)
    sample = rows
    if spec.train_list is not None:
        size = 1 << 31
        cutoff = round(size * spec.train_list / total)
        sample = rows.filter(F.pmod(F.xxhash64("doc_key"), F.lit(size)) < cutoff)
    points = sample.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    # This initialisation ends with a local pass over several points per list.
    model = KMeans(
        k=max(lists, 2), distanceMeasure="cosine", initMode="k-means||", seed=seed, maxIter=20
    ).fit(points)
    found = [[float(x) for x in c] for c in model.clusterCenters()][:lists]
    if spec.requested_lists is not None and len(found) < lists:
        raise ConfigurationError(f"description asks for {lists} lists, but the vectors give {len(found)}")
    return store.sparkSession.createDataFrame(
        list(enumerate(found)), "centroid_id int, centroid array<double>"
    )


def as_matrix(centroids: DataFrame, dimensions: int) -> np.ndarray:
    """Centroids in the order of their numbers, which must be 0, 1, 2, …; refused beyond the size bound."""
    most = CENTROID_BYTES // (8 * dimensions)
    table = centroids.orderBy("centroid_id").limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ConfigurationError(f"centroids take more than {CENTROID_BYTES} bytes")
    if table.column("centroid_id").to_pylist() != list(range(table.num_rows)):
        raise ConfigurationError("centroid_id must count from 0 without gaps")
    points = np.array(table.column("centroid").to_pylist(), dtype=np.float64)
    if points.shape != (table.num_rows, dimensions):
        raise ConfigurationError(f"every centroid must have {dimensions} values")
    return points


def code_ranges(store: DataFrame, spec: StoreSpec) -> DataFrame:
    """``(i, low, high)``: per dimension the range of all unit vectors, folded per task before the shuffle."""
    ship_package(store.sparkSession)
    dimensions = spec.dimensions
    parts = index_rows(store, spec).select("vector").mapInArrow(
        lambda batches: value_ranges(batches, dimensions), "i int, low double, high double"
    )
    return parts.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def of_size(v: pa.Array, dimensions: int, measure: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``measure`` of the vectors of the right size, NULL for all others.

    Spark may ask for the result before the condition on the size has held, even for a literal NULL: it infers conditions from joins.
    """
    fits = pc.fill_null(pc.equal(pc.list_value_length(v), dimensions), False)
    if len(v) == fits.true_count:
        return measure(v)
    at = pc.subtract(pc.cumulative_sum(fits.cast(pa.int64())), 1)
    return measure(v.filter(fits)).take(pc.if_else(fits, at, None))


def closest(spark: SparkSession, centroids: np.ndarray, vector: Column, n: int) -> Column:
    """Array of the ``n`` nearest lists, nearest first; NULL for a vector of another size or without direction."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(centroids)
    n = min(n, len(centroids))

    def measure(v: pa.Array) -> pa.Array:
        found, usable = closest_lists(v, shared.value, n)
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * n, pa.int32())
        values = pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.int32()))
        return values if usable.all() else pa.array(
            [x if ok else None for x, ok in zip(values.to_pylist(), usable)], pa.list_(pa.int32())
        )

    @F.arrow_udf("array<int>")
    def lists(v: pa.Array) -> pa.Array:
        return of_size(v, shared.value.shape[1], measure)

    return lists(vector)


def encoded(spark: SparkSession, low: np.ndarray, high: np.ndarray, vector: Column) -> Column:
    ship_package(spark)

    @F.arrow_udf("binary")
    def codes(v: pa.Array) -> pa.Array:
        return of_size(v, len(low), lambda fit: encode(fit, low, high))

    return codes(vector)


def make_index(
    store: DataFrame, spec: IndexSpec, centroids: DataFrame | None = None, seed: int = 42
) -> Index:
    """Train unless centroids are given, measure the ranges, and plan the entries. Writes nothing."""
    spark = store.sparkSession
    dimensions = spec.store.dimensions
    if centroids is None:
        centroids = train_centroids(store, spec, seed)
    points = as_matrix(centroids, dimensions)
    table = code_ranges(store, spec.store).orderBy("i").toArrow()
    low = np.array(table.column("low").to_pylist() or [0.0] * dimensions)
    high = np.array(table.column("high").to_pylist() or [0.0] * dimensions)
    entries = planned_entries(store, spec, points, low, high)
    return Index(spec, points, low, high, entries)


def planned_entries(
    store: DataFrame, spec: IndexSpec, points: np.ndarray, low: np.ndarray, high: np.ndarray
) -> DataFrame:
    """The entries of the rows an index covers, with their lists and codes."""
    spark = store.sparkSession
    included = F.struct(*[flt.field(f).alias(f) for f in spec.store.fields]) if spec.store.fields else F.lit(None).cast("string")
    vector = [F.col("vector")] if spec.persist_full_vector else []
    return index_rows(store, spec.store).select(
        F.element_at(closest(spark, points, F.col("vector"), 1), 1).alias("centroid_id"),
        "doc_key",
        "id",
        encoded(spark, low, high, F.col("vector")).alias("code"),
        included.alias("metadata"),
        "updated_at",
        *vector,
    )


def build_index(
    store: DataFrame,
    spec: IndexSpec,
    path: str,
    seed: int = 42,
    centroids: DataFrame | None = None,
    log: tuple[str, int | None] | None = None,
) -> Index:
    """Write an index under ``path``, one folder per list, unless one is there already.

    An existing index is loaded as it is, even if the options differ. ``log`` says up to which batch of which change log
    ``store`` has been read.
    """
    spark = store.sparkSession
    existing = load_index(spark, path, spec.store)
    if existing is not None:
        return existing
    index = make_index(store, spec, centroids, seed)
    head = {
        "index_name": spec.index_name,
        "description": spec.description,
        "scan_n_probes": spec.scan_n_probes,
        "train_list": spec.train_list,
        "persist_full_vector": spec.persist_full_vector,
    }
    numbers = (json.dumps(head), index.entries.schema.json(), index.centroids.tolist(), index.low.tolist(), index.high.tolist())
    spark.createDataFrame(
        [numbers],
        "options string, entries string, centroids array<array<double>>, low array<double>, high array<double>",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/head")
    generation = files.token("base")
    files.write_entries(index.entries, path, generation)
    log_path, log_seq = log or (None, None)
    files.write_manifest(spark, path, files.Manifest(0, [generation], [0] * len(index.centroids), [], log_path, log_seq))
    return load_index(spark, path, spec.store)


def _head(spark: SparkSession, path: str) -> Row | None:
    try:
        return spark.read.parquet(f"{path}/head").first()
    except AnalysisException as error:
        if not_there(error):
            return None
        raise


def load_index(spark: SparkSession, path: str, store_spec: StoreSpec) -> Index | None:
    """The index under ``path`` as its newest manifest has it, or None. The first one is written last, so a broken build does not count."""
    manifest = files.read_manifest(spark, path)
    if manifest is None:
        return None
    head = _head(spark, path)
    schema = T.StructType.fromJson(json.loads(head["entries"]))
    return Index(
        IndexSpec(store_spec, **json.loads(head["options"])),
        np.array(head["centroids"], dtype=np.float64),
        np.array(head["low"]),
        np.array(head["high"]),
        files.live_entries(spark, path, manifest, schema),
        files.live_counts(spark, path, manifest, schema),
        path,
        manifest,
    )


class Changes(NamedTuple):
    """``keys`` (doc_key) whose entries no longer count, and the store's ``rows`` under them now."""

    keys: DataFrame
    rows: DataFrame


def changes(index: Index, store: DataFrame) -> Changes:
    """What differs between an index and a store: keys that only one of both has, or that the store has written since.

    Keys and instants of all rows are compared. Where a change log tells which keys were written after the index, take those instead.
    """
    keys = checkpointed(_drift(index, store).filter(F.col("indexed").isNull() | F.col("stored").isNull() | ~F.col("updated_at").eqNullSafe(F.col("now_at"))).select("doc_key"))
    return changed(store, keys, index.spec.store)


def changed(store: DataFrame, keys: DataFrame, spec: StoreSpec) -> Changes:
    """The changes of the given keys."""
    wanted, on = flt.on_keys(store, flt.sent_if_few(keys), spec)
    return Changes(keys, store.join(wanted, on, "left_semi"))


def _drift(index: Index, store: DataFrame) -> DataFrame:
    """``(doc_key, updated_at, indexed, now_at, stored)`` of all keys of the index and of the rows that it should cover."""
    current = store.filter(flt.in_search_scope(index.spec.store)).select(
        "doc_key", F.col("updated_at").alias("now_at"), F.lit(1).alias("stored")
    )
    return index.entries.select("doc_key", "updated_at", F.lit(1).alias("indexed")).join(
        current, "doc_key", "full_outer"
    )


def refresh_index(index: Index, since: Changes, log: tuple[str, int | None] | None = None) -> Index:
    """Write the changes as a delta segment: hidden keys, and the new entries by list. Centroids and ranges stay as trained.

    Costs follow the changes, but for a scan of the index's keys that finds which lists they leave. Values beyond the
    trained ranges are clipped in their codes; rerank measures full vectors.
    """
    path, manifest = _written(index)
    spark = index.entries.sparkSession
    keys = flt.sent_if_few(since.keys.select("doc_key").distinct())
    old = index.entries.select("doc_key", "centroid_id", "metadata").join(keys, "doc_key", "left_semi")
    hidden = since.keys.select("doc_key").distinct().join(old, "doc_key", "left")
    fresh = planned_entries(since.rows, index.spec, index.centroids, index.low, index.high)
    segment = files.token("segment")
    files.write_segment(hidden.select("doc_key", "centroid_id", "metadata"), fresh.select(*index.entries.columns), path, segment)
    log_path, log_seq = log or (manifest.log_path, manifest.log_seq)
    files.write_manifest(spark, path, manifest.next(segments=[*manifest.segments, segment], log_path=log_path, log_seq=log_seq))
    return load_index(spark, path, index.spec.store)


def compact_index(index: Index) -> Index:
    """Fold the segments into the lists they touch: those are written anew as a generation, folders of all other lists stay as they are."""
    path, manifest = _written(index)
    if not manifest.segments:
        return index
    spark, schema = index.entries.sparkSession, index.entries.schema
    hidden = files.hidden_keys(spark, path, manifest, schema).select("centroid_id")
    come = spark.read.schema(T.StructType([*schema.fields, T.StructField("segment", T.StringType())])).parquet(f"{path}/delta")
    come = come.filter(F.col("segment").isin(manifest.segments)).select("centroid_id")
    touched = sorted(r[0] for r in hidden.unionByName(come).filter("centroid_id IS NOT NULL").distinct().collect())  # at most the lists
    live, generations = list(manifest.live), list(manifest.generations)
    if touched:
        generation = files.token("compacted")
        files.write_entries(index.entries.filter(F.col("centroid_id").isin(touched)), path, generation)
        generations.append(generation)
        for number in touched:
            live[number] = len(generations) - 1
    used = sorted(set(live))
    files.write_manifest(
        spark, path, manifest.next(generations=[generations[g] for g in used], live=[used.index(g) for g in live], segments=[])
    )
    return load_index(spark, path, index.spec.store)


def _written(index: Index) -> tuple[str, files.Manifest]:
    if index.path is None or index.manifest is None:
        raise ConfigurationError("only an index that was written can be refreshed or compacted")
    return index.path, index.manifest


def index_status(spark: SparkSession, path: str, store_spec: StoreSpec, store: DataFrame | None = None) -> dict[str, Any] | None:
    """Name and state of the index under ``path``; None if there is none.

    ``building`` is an index of which no manifest has been written, by a build that still runs or has failed. With a ``store`` to compare
    with, an index that covers other rows than it is ``behind``, and the numbers of such rows are given. It is online and answers
    searches all the same.
    """
    index = load_index(spark, path, store_spec)
    if index is None:
        head = _head(spark, path)
        return head and {"name": json.loads(head["options"])["index_name"], "state": "building", "online": False}
    status = {"name": index.spec.index_name, "state": "online", "online": True}
    if store is None:
        return status
    drift = index_stats(index, store).select("missing_rows", "removed_rows", "changed_rows").first().asDict()
    return status | {"state": "behind" if any(drift.values()) else "online"} | drift


def index_stats(index: Index, store: DataFrame) -> DataFrame:
    """One row: sizes of the index and its lists, and how far the store has moved on since the build."""
    lists = index.entries.groupBy("centroid_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = lists.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("indexed_rows"),
        F.count(F.lit(1)).alias("used_lists"),
        F.coalesce(F.min("n"), F.lit(0)).alias("smallest_list"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest_list"),
    )
    drift = _drift(index, store).agg(
        F.count("stored").alias("store_rows"),
        F.count_if(F.col("indexed").isNull()).alias("missing_rows"),
        F.count_if(F.col("stored").isNull()).alias("removed_rows"),
        F.count_if(F.col("updated_at") < F.col("now_at")).alias("changed_rows"),
    )
    # Both sides are single rows.
    return sizes.withColumn("one", F.lit(1)).join(drift.withColumn("one", F.lit(1)), "one").select(
        F.lit(index.spec.index_name).alias("index_name"),
        F.lit(len(index.centroids)).cast("bigint").alias("lists"),
        "used_lists",
        "indexed_rows",
        "smallest_list",
        "largest_list",
        "store_rows",
        "missing_rows",
        "removed_rows",
        "changed_rows",
    )


def probe(index: Index, queries: DataFrame, n_probes: int, kept: bool = False) -> DataFrame:
    """Queries with one row per list to scan, the nearest lists first (``probe`` counts from 0).

    With ``kept``, the lists are written to the checkpoint folder, one row for each query.
    """
    lists = closest(queries.sparkSession, index.centroids, F.col("qv"), n_probes)
    found = queries.withColumn("probed_lists", lists)
    found = checkpointed(found) if kept else found
    return found.select("*", F.posexplode("probed_lists").alias("probe", "centroid_id")).drop("probed_lists")


def promised_probes(
    index: Index, queries: DataFrame, n_probes: int, fields: list[str], filters: Mapping[str, Any] | None, hidden: DataFrame | None
) -> DataFrame:
    """:func:`probe`, widened for each query until the lists hold as many matching rows as it wants, or there are no more.

    How many rows of a list match is read from the counts per list and filter values, less the entries that are ``hidden``. A
    query that is promised too few rows gets twice the lists in the next round.
    """
    spec = index.spec.store
    counts = index.counts
    if counts is None:
        counts = index.entries.groupBy("centroid_id", "metadata").agg(F.count(F.lit(1)).alias("n"))
    if hidden is not None:
        gone = index.entries.join(hidden, "doc_key", "left_semi").groupBy("centroid_id", "metadata").agg((-F.count(F.lit(1))).alias("n"))
        counts = counts.unionByName(gone)
    condition = flt.equality(spec, filters)
    if condition is not None:
        counts = counts.filter(condition)
    names = [f"value_{i}" for i in range(len(fields))]
    counts = checkpointed(counts.select("centroid_id", *[flt.comparable(f, spec).alias(v) for f, v in zip(fields, names)], "n").groupBy("centroid_id", *names).agg(F.sum("n").alias("n")))
    rest, done = queries, None
    while True:
        asked = checkpointed(probe(index, rest, n_probes))
        if n_probes >= len(index.centroids):
            return asked if done is None else done.unionByName(asked)
        same = reduce(
            lambda a, b: a & b,
            [F.col(f"q.`{f}`").isNull() | (F.col(f"q.`{f}`") == F.col(f"c.{v}")) for f, v in zip(fields, names)],
            F.col("q.centroid_id") == F.col("c.centroid_id"),
        )
        met = asked.alias("q").join(counts.alias("c"), same).groupBy("q.q_id").agg(F.sum("c.n").alias("n")).withColumnRenamed("q_id", "met_id")
        enough = checkpointed(queries.select("q_id", "limit").join(met, F.col("q_id") == F.col("met_id")).filter(F.col("n") >= F.col("limit")).select("q_id"))
        kept = asked.join(enough, "q_id", "left_semi")
        done = kept if done is None else done.unionByName(kept)
        rest = checkpointed(rest.join(enough, "q_id", "left_anti"))
        if rest.isEmpty():
            return done
        n_probes *= 2


def search_index_hits(
    index: Index,
    queries: DataFrame,
    limit: int = DEFAULT_LIMIT,
    threshold: float = DEFAULT_THRESHOLD,
    filters: Mapping[str, Any] | None = None,
    n_probes: int | None = None,
    rerank: bool | None = None,
    top_n_scan: int | None = None,
    strict: bool = True,
    since: Changes | None = None,
    fill: bool = False,
    **how: Any,
) -> Hits:
    """Like ``search_hits``, over the ``n_probes`` nearest lists of each query only.

    Distances come from the codes, unless ``rerank`` measures the best ``top_n_scan`` candidates (or all
    of the probed lists) again with full vectors. Filters hold before any cut; a selective one can
    still leave fewer than ``limit`` rows in the probed lists, unless ``fill`` lets a query probe further lists until they
    hold enough matching rows.

    Entries of keys that changed ``since`` the index was written are left out before any cut, and the rows under those keys are
    searched exactly; one ranking holds both. So an insert is found, an update is found by its new vector and filter values,
    and a deleted row takes no place.
    """
    spec = index.spec.store
    if n_probes is None and rerank is None and top_n_scan is None:
        n_probes, rerank, top_n_scan = spec.n_probes, spec.rerank, spec.top_n_scan
    check_probe_options(n_probes, rerank, top_n_scan)
    if rerank and not index.spec.persist_full_vector:
        raise ConfigurationError("rerank needs full vectors, and this index was built with persist_full_vector=False")
    n_probes = n_probes or index.spec.scan_n_probes or DEFAULT_N_PROBES

    own_threshold = queries if "threshold" in queries.columns else None
    queries = checked_queries(queries, spec, limit, threshold)
    if top_n_scan is not None and not rerank:
        queries = queries.withColumn("limit", F.least("limit", F.lit(top_n_scan)))
    asked, fields = flt.query_conditions(queries, spec)
    hidden = None if since is None else flt.sent_if_few(since.keys.select("doc_key").distinct())
    if fill:
        probes = promised_probes(index, asked, n_probes, fields, filters, hidden)
    else:
        probes = probe(index, asked, n_probes, kept=True)
    entries = index.entries
    if fill or n_probes < len(index.centroids):
        entries = pruned(entries, probes)
    condition = flt.equality(spec, filters)
    if condition is not None:
        entries = entries.filter(condition)
    if hidden is not None:
        entries = entries.join(hidden, "doc_key", "left_anti")
    exact_scan = bool(rerank) and top_n_scan is None
    corpus = entries.select(
        "doc_key",
        "id",
        F.col("vector" if exact_scan else "code").alias("vector"),
        "centroid_id",
        *[flt.comparable(f, spec).alias(f) for f in fields],
    )
    scanned = probes.withColumn("limit", F.lit(top_n_scan)) if rerank and top_n_scan is not None else probes
    ranges = None if exact_scan else (index.low, index.high)
    found = nearest(
        corpus, scanned, spec.dimensions, ["centroid_id", *fields], strict=strict, ranges=ranges, listed=bool(rerank) and not exact_scan, **how
    )
    limits = asked.select("q_id", F.col("limit").cast("int").alias("limit"))
    rows = found.rows
    if rerank and not exact_scan:
        measured = rr.measured(rows, entries, asked, spec.dimensions)
        rows = rr.ranked(measured) if since is None else measured.drop("limit")
    if since is not None:
        written = search_corpus(since.rows, spec, filters).select(
            "doc_key", "id", "vector", *[flt.comparable(f, spec).alias(f) for f in fields]
        )
        new = nearest(written, asked, spec.dimensions, fields, strict=strict, **how).rows
        columns = ["q_id", "doc_key", "id", "distance"]
        rows = rr.ranked(rows.select(*columns).unionByName(new.select(*columns)).join(limits, "q_id"))
    return Hits(scored(rows, own_threshold, threshold), found.bounded)


def pruned(entries: DataFrame, probes: DataFrame) -> DataFrame:
    """Entries of the probed lists. The join lets Spark skip the folders of all others at run time; it sends
    at most as many numbers as there are lists, whose centroids are bounded."""
    wanted = probes.filter(F.col("probe") >= 0).select(F.col("centroid_id").alias("probed_id")).distinct()
    return entries.join(F.broadcast(wanted), F.col("centroid_id") == F.col("probed_id"), "left_semi")


def search_index(
    index: Index, store: DataFrame, queries: DataFrame, *args: Any, columns: Any = PAYLOAD, **kwargs: Any
) -> DataFrame:
    """:func:`search_index_hits` with the stored columns."""
    hits = search_index_hits(index, queries, *args, **kwargs)
    return with_payload(hits, store, index.spec.store, columns)
