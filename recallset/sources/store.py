"""A store on disk: one snapshot per version, plus a log of changes since."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import filters as flt
from ..spec import StoreSpec

UPSERT = "upsert"
DELETE = "delete"


def layout(spec: StoreSpec) -> list[T.StructField]:
    """The columns snapshots are partitioned by."""
    fields = [T.StructField(flt.OWNED_COLUMN, T.BooleanType())]
    if spec.key_buckets > 1:
        fields.append(T.StructField(flt.BUCKET_COLUMN, T.IntegerType()))
    return fields


def read_store(spark: SparkSession, path: str, spec: StoreSpec) -> DataFrame:
    """A snapshot as it was written; the schema is declared, so no file is opened to find it."""
    schema = T.StructType([*spec.schema.fields, *layout(spec)])
    return spark.read.schema(schema).parquet(path)


def scan_type(store: DataFrame, spec: StoreSpec) -> DataFrame:
    """Rows of the store's document type."""
    return store.filter(F.col("document_type") == spec.document_type)


def scan_prefix(store: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with a prefix; the condition reaches the scan."""
    return store.filter(F.col("doc_key").startswith(prefix))


def write_snapshot(rows: DataFrame, path: str, spec: StoreSpec) -> None:
    """Write rows to a new place. An existing one is an error: it may be what ``rows`` reads."""
    values = {flt.OWNED_COLUMN: flt.owned(spec, rows), flt.BUCKET_COLUMN: flt.key_bucket(spec)}
    partitions = layout(spec)
    out = rows.select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in [*spec.schema.fields, *partitions]
        ]
    )
    names = [f.name for f in partitions]
    if spec.key_buckets > 1:
        out = out.hint("rebalance", *[F.col(n) for n in names])
    out.write.mode("errorifexists").partitionBy(*names).parquet(path)


def log_schema(spec: StoreSpec) -> T.StructType:
    return (
        T.StructType([T.StructField("op", T.StringType()), T.StructField("reset", T.BooleanType())])
        .add("as_of", T.TimestampType())
        .add("item", spec.schema)
        .add("doc_key", T.StringType())
        .add("seq", T.LongType())
        .add("writer", T.StringType())
        .add("batch_id", T.LongType())
    )


def not_there(error: AnalysisException) -> bool:
    """Whether a path is missing; any other trouble with reading it is not the same as nothing being there."""
    return error.getCondition() == "PATH_NOT_FOUND"


def empty_store(spark: SparkSession, spec: StoreSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def fold_changes(changes: DataFrame, as_of: Column) -> DataFrame:
    """One log row per key of a batch of ``(op, ord, doc_key, item)``: the last change wins.

    ``reset`` says that the key was removed on the way, so what is stored now is a new row.
    """
    return (
        changes.groupBy("doc_key")
        .agg(
            F.max_by(F.struct("op", "item"), F.col("ord")).alias("last"),
            F.bool_or(F.col("op") == DELETE).alias("reset"),
        )
        .select(
            F.col("last.op").alias("op"),
            "reset",
            as_of.alias("as_of"),
            F.col("last.item").alias("item"),
            "doc_key",
        )
    )


def batches(spark: SparkSession, path: str, spec: StoreSpec) -> DataFrame | None:
    """``(seq, writer, batch_id)`` of each logged batch, or None if there is no log. Only folder names are read."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if not_there(error):
            return None
        raise
    return read_log(spark, path, spec).select("seq", "writer", "batch_id").distinct()


def write_batch(log: DataFrame, path: str, spec: StoreSpec, writer: str, batch_id: int) -> None:
    """Append a batch of a writer; the same writer's same batch again replaces itself, so a replay counts once.

    A batch is addressed by writer and number, so writers never touch each other's. Its place in the order of all
    writers' batches is ``seq``: one more than the largest so far, or for a replay the one it has.
    """
    known = batches(log.sparkSession, path, spec)
    own = F.when((F.col("writer") == writer) & (F.col("batch_id") == batch_id), F.col("seq"))
    held, last = (None, None) if known is None else known.agg(F.min(own), F.max("seq")).first()
    seq = held if held is not None else 0 if last is None else last + 1
    place = {"seq": F.lit(seq).cast("bigint"), "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")}
    log.withColumns(place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *place
    ).parquet(path)


def read_log(spark: SparkSession, path: str, spec: StoreSpec) -> DataFrame:
    return spark.read.schema(log_schema(spec)).parquet(path)


def current(base: DataFrame, log: DataFrame, spec: StoreSpec) -> DataFrame:
    """The rows after all logged batches.

    The newest item of a key is taken by an aggregate, so a key that changes in every batch carries no
    history of vectors; only its instants are ordered. Base rows are only filtered by the keys that changed.
    """
    by_key = Window.partitionBy("doc_key")
    times = log.select("doc_key", "op", "reset", "as_of", "seq").withColumn(
        "reset_at", F.max(F.when(F.col("reset"), F.col("seq"))).over(by_key)
    )
    since = (F.col("op") == UPSERT) & (F.col("seq") >= F.coalesce("reset_at", F.lit(-1)))
    times = times.groupBy("doc_key").agg(
        F.bool_and(F.col("reset_at").isNull()).alias("continues"),
        F.min(F.when(since, F.col("as_of"))).alias("first_at"),
    )
    newest = log.groupBy("doc_key").agg(F.max_by(F.struct("op", "item"), "seq").alias("last"))
    state = newest.join(times, "doc_key").select("doc_key", "last.op", "last.item", "continues", "first_at")
    keys = flt.sent_if_few(log.select("doc_key").distinct())
    changed, on = flt.on_keys(base, keys, spec)
    held = (
        base.select(
            *on, F.col("created_at").alias("base_created_at"), flt.owned(spec, base).alias("owned")
        )
        .join(changed, on, "left_semi")
        .drop(flt.BUCKET_COLUMN)
    )
    effective = state.join(held, "doc_key", "left").filter(F.coalesce("owned", F.lit(True)))
    created = F.when(
        F.col("continues") & F.col("owned").isNotNull(), F.col("base_created_at")
    ).otherwise(F.col("first_at"))
    values = {
        "created_at": created,
        flt.OWNED_COLUMN: F.lit(True),
        flt.BUCKET_COLUMN: flt.key_bucket(spec),
    }
    written = effective.filter(F.col("op") == UPSERT).select(
        *[
            values.get(f.name, F.col("item").getField(f.name)).cast(f.dataType).alias(f.name)
            for f in base.schema.fields
        ]
    )
    gone = keys.withColumnRenamed("doc_key", "gone_key")
    same = (F.col("doc_key") == F.col("gone_key")) & flt.owned(spec, base)
    return base.join(gone, same, "left_anti").select(*base.columns).unionByName(written)


def compact(base: DataFrame, log: DataFrame, spec: StoreSpec, path: str) -> None:
    """Write base and log together as a new snapshot."""
    write_snapshot(current(base, log, spec), path, spec)
