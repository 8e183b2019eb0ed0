"""Streaming ingest: checked item changes become batches of the change log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.vectors import id_error, vector_error
from ..operators.mutate import change_keys, instant, make_documents, occupied, require_no_collision
from ..operators.validate import require_valid
from ..sources.store import UPSERT, fold_changes, write_batch
from ..spec import StoreSpec


def log_batch(
    items: DataFrame,
    spec: StoreSpec,
    as_of: dt.datetime | str,
    batch_id: int,
    path: str,
    base: DataFrame | None = None,
    writer: str = "direct",
) -> None:
    """Log one batch of ``(id, vector[, metadata][, content], ord[, op])``, or raise and log nothing.

    ``op`` is ``upsert`` (the default) or ``delete``; of several changes to an id, the one with the highest
    ``ord`` counts. ``writer`` and ``batch_id`` name the batch: again under the same names it replaces itself. With ``base``, a change to a key held by a foreign row is an error.
    """
    op = F.coalesce("op", F.lit(UPSERT)) if "op" in items.columns else F.lit(UPSERT)
    items = items.withColumn("op", op).persist()
    try:
        wrong_vector = F.when(F.col("op") == UPSERT, vector_error(F.col("vector"), spec.dimensions))
        reason = F.coalesce(id_error(F.col("id")), wrong_vector)
        require_valid(items.withColumn("reason", reason).filter(F.col("reason").isNotNull()))
        now = instant(as_of)
        rows = make_documents(items, spec, now, now, keep=("op", "ord"))
        if base is not None:
            held = occupied(base, change_keys(rows), spec)
            require_no_collision(held.filter(~F.col("owned")))
        changes = rows.select("op", "ord", "doc_key", F.struct(*spec.schema.names).alias("item"))
        write_batch(fold_changes(changes, now), path, spec, writer, batch_id)
    finally:
        items.unpersist()


def ingest(
    items: DataFrame,
    spec: StoreSpec,
    log_path: str,
    checkpoint_path: str,
    base: DataFrame | None = None,
    clock: Callable[[int], dt.datetime | str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start logging a stream of items. ``clock`` gives the instant of a batch, by default the current time.

    A batch that runs again after a failure overwrites itself, so each counts once. Batches are logged under the query's
    id, which Spark keeps in the checkpoint: a stream with another checkpoint is another writer.
    """
    now = clock or (lambda batch_id: dt.datetime.now(dt.timezone.utc))

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.read.json(f"{checkpoint_path.rstrip('/')}/metadata").first()["id"]
        log_batch(batch, spec, now(batch_id), batch_id, log_path, base, f"stream-{query}")

    return (
        items.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
