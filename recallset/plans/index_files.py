"""How an index lies on disk: generations of list folders, delta segments with hidden keys, and manifests that name what counts.

``entries/generation=G/centroid_id=L`` holds the entries of list L as generation G wrote them, ``delta/segment=S/centroid_id=L`` the
entries of keys that changed later, ``hidden/segment=S`` the keys whose older entries no longer count, and ``counts`` how many
entries of a list have which filter values. A manifest is written last and under a number of its own, so a writer that fails leaves
nothing that counts, and of two writers that start from one manifest the second one fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigurationError
from ..operators import filters as flt
from ..sources.store import not_there

MANIFEST = "version bigint, generations array<string>, live array<int>, segments array<string>, log_path string, log_seq bigint"


@dataclass(frozen=True)
class Manifest:
    """``live`` gives for each list the place of its generation in ``generations``; later ``segments`` hide what earlier ones hold."""

    version: int
    generations: list[str]
    live: list[int]
    segments: list[str]
    log_path: str | None = None
    log_seq: int | None = None

    def next(self, **changes: object) -> "Manifest":
        return replace(self, version=self.version + 1, **changes)


def token(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest under ``path``, or None."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/*")
    except AnalysisException as error:
        if not_there(error):
            return None
        raise
    row = rows.orderBy(F.desc("version")).first()
    return row and Manifest(**row.asDict())


def write_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a manifest the newest one; an error if another writer has taken its number."""
    table = spark.createDataFrame([tuple(getattr(manifest, f.name) for f in T._parse_datatype_string(MANIFEST).fields)], MANIFEST)
    try:
        table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version-{manifest.version:012d}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise ConfigurationError("the index was changed by another writer meanwhile; load it again") from error


def _list(values: list) -> Column:
    """A literal array that costs one constant in the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",")


def generation_of(manifest: Manifest, centroid_id: Column) -> Column:
    """The generation that counts for a list."""
    if len(manifest.generations) == 1:
        return F.lit(manifest.generations[0])
    return F.get(_list(manifest.generations), F.get(_list(manifest.live), centroid_id).cast("int"))


def place_of(manifest: Manifest, segment: Column) -> Column:
    """Number of a segment in the manifest, from 1; 0 for one that it does not name."""
    return F.array_position(_list(manifest.segments), segment).cast("int")


def _table(spark: SparkSession, path: str, name: str, schema: T.StructType, *partitions: str) -> DataFrame:
    whole = T.StructType(schema.fields)
    for p in partitions:
        whole = whole.add(p, T.StringType())
    return spark.read.schema(whole).parquet(f"{path}/{name}")


def hidden_schema(schema: T.StructType) -> T.StructType:
    """``doc_key`` with the list and the filter values of the entry that it hides, if there is one."""
    return T.StructType([schema[n] for n in ("doc_key", "centroid_id", "metadata")])


def counts_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([schema["centroid_id"], schema["metadata"], T.StructField("n", T.LongType())])


def live_entries(spark: SparkSession, path: str, manifest: Manifest, schema: T.StructType) -> DataFrame:
    """Entries that count. Without segments this is a plain scan of list folders, so conditions on lists prune it."""
    base = _table(spark, path, "entries", schema, "generation")
    base = base.filter(F.col("generation") == generation_of(manifest, F.col("centroid_id"))).select(*schema.names)
    if not manifest.segments:
        return base
    delta = _table(spark, path, "delta", schema, "segment").withColumn("at", place_of(manifest, F.col("segment"))).filter(F.col("segment").isin(manifest.segments))
    gone = hidden_keys(spark, path, manifest, schema).groupBy("doc_key").agg(F.max("at").alias("gone_at")).withColumnRenamed("doc_key", "gone_key")
    gone = _sent(gone)
    both = base.withColumn("at", F.lit(0)).unionByName(delta.select(*schema.names, "at"))
    return both.join(gone, (F.col("doc_key") == F.col("gone_key")) & (F.col("at") < F.col("gone_at")), "left_anti").select(*schema.names)


def _sent(gone: DataFrame) -> DataFrame:
    """Hidden keys are sent to the scan once they are known to be few."""
    n, size = gone.agg(F.count(F.lit(1)), F.sum(F.octet_length("gone_key"))).first()
    return F.broadcast(gone) if n <= flt.MAX_SENT_KEYS and (size or 0) <= flt.MAX_SENT_BYTES else gone


def hidden_keys(spark: SparkSession, path: str, manifest: Manifest, schema: T.StructType) -> DataFrame:
    """``(doc_key, centroid_id, metadata, at)`` of all segments, ``at`` being the number of the segment."""
    rows = _table(spark, path, "hidden", hidden_schema(schema), "segment").filter(F.col("segment").isin(manifest.segments))
    return rows.withColumn("at", place_of(manifest, F.col("segment"))).drop("segment")


def live_counts(spark: SparkSession, path: str, manifest: Manifest, schema: T.StructType) -> DataFrame:
    """``(centroid_id, metadata, n)``: entries per list and filter values, of what counts."""
    rows = _table(spark, path, "counts", counts_schema(schema), "part")
    names = [schema["metadata"].dataType.names, []][not isinstance(schema["metadata"].dataType, T.StructType)]
    of_list = F.col("part") == generation_of(manifest, F.col("centroid_id"))
    kept = rows.filter(of_list | F.col("part").isin(manifest.segments) if manifest.segments else of_list)
    values = F.struct(*[F.col("metadata").getField(n).alias(n) for n in names]) if names else F.lit(None).cast("string")
    return kept.groupBy("centroid_id", values.alias("metadata")).agg(F.sum("n").alias("n")).filter("n > 0")


def write_entries(entries: DataFrame, path: str, generation: str) -> None:
    """Entries of whole lists as folders of a generation, with their counts. The rebalance lets a crowded list spread over several
    tasks and files, and small lists share one."""
    place = f"{path}/entries/generation={generation}"
    entries.hint("rebalance", F.col("centroid_id")).write.mode("overwrite").partitionBy("centroid_id").parquet(place)
    written = entries.sparkSession.read.schema(entries.schema).parquet(place)
    write_counts(written.select("centroid_id", "metadata", F.lit(1).cast("bigint").alias("n")), path, generation)


def write_counts(rows: DataFrame, path: str, part: str) -> None:
    sums = rows.groupBy("centroid_id", "metadata").agg(F.sum("n").alias("n")).filter("n <> 0")
    sums.write.mode("overwrite").parquet(f"{path}/counts/part={part}")


def write_segment(hidden: DataFrame, entries: DataFrame, path: str, segment: str) -> None:
    """Keys that changed, with the entries they had and the entries they have now."""
    hidden.write.mode("overwrite").parquet(f"{path}/hidden/segment={segment}")
    entries.hint("rebalance", F.col("centroid_id")).write.mode("overwrite").partitionBy("centroid_id").parquet(f"{path}/delta/segment={segment}")
    spark = entries.sparkSession
    gone = spark.read.schema(hidden.schema).parquet(f"{path}/hidden/segment={segment}").filter("centroid_id IS NOT NULL")
    come = spark.read.schema(entries.schema).parquet(f"{path}/delta/segment={segment}")
    both = gone.select("centroid_id", "metadata", F.lit(-1).cast("bigint").alias("n")).unionByName(come.select("centroid_id", "metadata", F.lit(1).cast("bigint").alias("n")))
    write_counts(both, path, segment)
