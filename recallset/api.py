"""One object per store, for callers who think in operations rather than in tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.vectors import id_error
from .operators import mutate
from .operators.search import search, search_one
from .operators.validate import require_valid
from .plans import ivf
from .plans.retrieve import Retrieved, retrieve
from .session import checkpointed
from .sources import store as src
from .spec import DEFAULT_LIMIT, DEFAULT_THRESHOLD, IndexSpec, StoreSpec
from .streaming.ingest import log_batch


class VectorStore:
    """A snapshot and its change log.

    Writes append to the log, so their cost follows the change and not the store. ``compact`` and ``clear``
    write a new snapshot at a path of the caller's choice and return the store that reads it.
    """

    def __init__(self, spark: SparkSession, path: str, spec: StoreSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, spec: StoreSpec, rows: DataFrame | None = None
    ) -> "VectorStore":
        """Start a store from existing rows, foreign ones included, or empty."""
        store = cls(spark, path, spec)
        src.write_snapshot(rows if rows is not None else src.empty_store(spark, spec), store._snapshot, spec)
        return store

    @property
    def _snapshot(self) -> str:
        return f"{self.path}/snapshot"

    @property
    def _log(self) -> str:
        return f"{self.path}/log"

    def log(self) -> DataFrame | None:
        if src.batches(self.spark, self._log, self.spec) is None:
            return None
        return src.read_log(self.spark, self._log, self.spec)

    def base(self) -> DataFrame:
        return src.read_store(self.spark, self._snapshot, self.spec)

    def rows(self) -> DataFrame:
        log = self.log()
        return self.base() if log is None else src.current(self.base(), log, self.spec)

    def _append(self, changes: DataFrame, as_of: dt.datetime | str) -> None:
        known = src.batches(self.spark, self._log, self.spec)
        own = None if known is None else known.filter(F.col("writer") == "direct").agg(F.max("batch_id")).first()[0]
        log_batch(changes, self.spec, as_of, 0 if own is None else own + 1, self._log, self.base())

    def store_batch(self, items: DataFrame, as_of: dt.datetime | str) -> None:
        """Insert or replace items; all are checked before any is written."""
        if "ord" not in items.columns:
            items = items.withColumn("ord", F.lit(0))
        self._append(items.drop("op"), as_of)

    def store(self, items: DataFrame, as_of: dt.datetime | str) -> None:
        """Like :meth:`store_batch`, with the content taken from ``metadata.content``."""
        self.store_batch(mutate.mirror_content(items), as_of)

    def delete_batch(self, ids: DataFrame, as_of: dt.datetime | str) -> None:
        self._append(
            ids.select(
                "id",
                F.lit(None).cast("array<double>").alias("vector"),
                F.lit(0).alias("ord"),
                F.lit(src.DELETE).alias("op"),
            ),
            as_of,
        )

    def get(self, ids: DataFrame) -> DataFrame:
        """One row per id; an empty id, or one whose key a foreign row holds, is an error."""
        require_valid(ids.select("id", id_error(F.col("id")).alias("reason")).filter(F.col("reason").isNotNull()))
        found = checkpointed(mutate.get(self.rows(), ids, self.spec))
        mutate.require_no_collision(found.filter("collision").select(mutate.document_key(self.spec, F.col("id")).alias("doc_key")))
        return found

    def count(self) -> int:
        return mutate.count(self.rows(), self.spec).first()["n"]

    def clear(self, new_path: str) -> "VectorStore":
        return VectorStore.create(self.spark, new_path, self.spec, mutate.clear(self.rows(), self.spec))

    def compact(self, new_path: str) -> "VectorStore":
        return VectorStore.create(self.spark, new_path, self.spec, self.rows())

    def search(self, queries: DataFrame, **options: Any) -> DataFrame:
        return search(self.rows(), queries, self.spec, **options)

    def search_one(
        self,
        vector: Sequence[float],
        limit: int = DEFAULT_LIMIT,
        threshold: float = DEFAULT_THRESHOLD,
        filters: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        return search_one(self.rows(), vector, self.spec, limit, threshold, filters)

    def retrieve(self, inputs: DataFrame, embed: Any, **options: Any) -> Retrieved:
        return retrieve(self.rows(), inputs, embed, self.spec, **options)

    def _read_to(self) -> tuple[str, int | None]:
        """The change log, and the number of its last batch (-1 without one): what was written up to now."""
        known = src.batches(self.spark, self._log, self.spec)
        last = None if known is None else known.agg(F.max("seq")).first()[0]
        return self._log, -1 if last is None else last

    def index_path(self, name: str | None = None) -> str:
        """Where an index of this store lies unless another path is given."""
        return f"{self.path}/indexes/{name or self.spec.index_name}"

    def build_index(self, path: str | None = None, **options: Any) -> ivf.Index:
        spec = IndexSpec(self.spec, **options)
        read_to = self._read_to()
        return ivf.build_index(self.rows(), spec, path or self.index_path(spec.index_name), log=read_to)

    def index_status(self, path: str | None = None, compare: bool = False) -> dict[str, Any] | None:
        """Name and state of an index; with ``compare`` also how many rows it has missed."""
        return ivf.index_status(self.spark, path or self.index_path(), self.spec, self.rows() if compare else None)

    def changes_since(self, index: ivf.Index) -> ivf.Changes | None:
        """What was written after an index, by the log if that is the one it was built from; None if nothing was."""
        log_path, seq = self._read_to()
        known = index.manifest
        if known is None or known.log_path != log_path or known.log_seq is None:
            return ivf.changes(index, self.rows())
        if seq <= known.log_seq:
            return None
        keys = self.log().filter(F.col("seq") > known.log_seq).select("doc_key").distinct()
        return ivf.changed(self.rows(), keys, self.spec)

    def refresh_index(self, index: ivf.Index) -> ivf.Index:
        """Take what was written since into the index, as a segment beside its lists."""
        read_to = self._read_to()
        since = self.changes_since(index)
        return index if since is None else ivf.refresh_index(index, since, read_to)

    def compact_index(self, index: ivf.Index) -> ivf.Index:
        return ivf.compact_index(index)

    def search_index(self, index: ivf.Index, queries: DataFrame, **options: Any) -> DataFrame:
        """Indexed search that sees all writes: rows written since the index are searched exactly beside it."""
        return ivf.search_index(index, self.rows(), queries, since=self.changes_since(index), **options)
