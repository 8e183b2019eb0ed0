"""Stores, items and queries derived from the given tables, whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mutate import document_key
from ..spec import StoreSpec

DIMENSIONS = 64
SPEC = StoreSpec(
    DIMENSIONS,
    filter_fields={"userId": "string", "conversationId": "string", "label": "number"},
)
CREATED = "2026-01-01 00:00:00"
WRITTEN = "2026-02-01 00:00:00"

# Keyword groups for the embeddings of the given texts.
GROUPS = (("the", "tion", "ing"), ("der", "sch", "ung"), ("les", "ent", "eur"), ("del", "ado", "ion"))


# Declared, so that no job has to open the files to find them.
SCHEMAS = {
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _metadata(lang: Column) -> Column:
    """Metadata of a document; German ones come without text."""
    return F.struct(
        F.col("source").alias("userId"),
        lang.alias("conversationId"),
        F.col("label").cast("double").alias("label"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.when(lang != "de", F.col("text")).alias("content"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its document. Only English ones hold their text as content."""
    lang = F.col("lang")
    rows = table(spark, sf_dir, "embeddings").join(
        table(spark, sf_dir, "documents"), F.col("vec_id") == F.col("doc_id"), "left"
    )
    return rows.select(
        document_key(SPEC, F.col("vec_id").cast("string")).alias("doc_key"),
        F.lit(SPEC.document_type).alias("document_type"),
        F.lit(1).alias("schema_version"),
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("vector"),
        F.lit(DIMENSIONS).alias("dimensions"),
        _metadata(lang).alias("metadata"),
        F.lit(None).cast("string").alias("metadata_json"),
        F.when(lang == "en", F.col("text")).alias("content"),
        F.lit(CREATED).cast("timestamp").alias("created_at"),
        F.lit(CREATED).cast("timestamp").alias("updated_at"),
    )


def foreign(spark: SparkSession, sf_dir: str, like: DataFrame) -> DataFrame:
    """Suppliers as another application's rows under the same prefix, regions outside of it."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.lit(SPEC.key_prefix).alias("prefix"),
    )
    regions = table(spark, sf_dir, "region").select(
        F.concat(F.lit("r-"), F.col("r_regionkey").cast("string")).alias("id"),
        F.lit("orders::").alias("prefix"),
    )
    values = {
        "doc_key": F.concat("prefix", "id"),
        "document_type": F.lit("invoice"),
        "schema_version": F.lit(1),
        "id": F.col("id"),
    }
    return suppliers.unionByName(regions).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    )


def shared_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = store(spark, sf_dir)
    return own.unionByName(foreign(spark, sf_dir, own))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New items for all embeddings, and replacements for labelled ones, those of quality 1 twice."""
    embeddings = table(spark, sf_dir, "embeddings")
    labels = table(spark, sf_dir, "labels")
    new = embeddings.select(
        F.concat(F.lit("new-"), F.col("vec_id").cast("string")).alias("id"),
        F.col("embedding").alias("vector"),
        F.lit(None).cast("string").alias("content"),
        F.lit("fresh").alias("userId"),
        F.lit(0).alias("ord"),
    )
    labelled = embeddings.join(labels, F.col("vec_id") == F.col("doc_id"))
    replaced = labelled.select(
        F.col("vec_id").cast("string").alias("id"),
        F.reverse("embedding").alias("vector"),
        F.when(F.col("toxic") == 0, F.lit("first")).alias("content"),
        F.lit("once").alias("userId"),
        F.lit(1).alias("ord"),
    )
    again = labelled.filter("quality = 1").select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("vector"),
        F.when(F.col("toxic") == 1, F.lit("second")).alias("content"),
        F.lit("twice").alias("userId"),
        F.lit(2).alias("ord"),
    )
    return (
        new.unionByName(replaced)
        .unionByName(again)
        .withColumn(
            "metadata",
            F.struct("userId", F.concat(F.lit("text of "), F.col("id")).alias("content")),
        )
        .drop("userId")
    )


def colliding_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose keys the suppliers hold."""
    return (
        table(spark, sf_dir, "embeddings")
        .join(table(spark, sf_dir, "supplier"), F.col("vec_id") == F.col("s_suppkey"))
        .select(
            F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"),
            F.col("embedding").alias("vector"),
            F.lit("mine").alias("content"),
            F.lit(0).alias("ord"),
            F.struct(F.lit("fresh").alias("userId"), F.lit("mine").alias("content")).alias("metadata"),
        )
    )


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document numbers, many without an embedding, and all supplier ids."""
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").cast("string").alias("id"))
        .unionByName(
            table(spark, sf_dir, "supplier").select(
                F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id")
            )
        )
    )


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label, mean)``: the mean vector per label, averaged per dimension before anything is collected."""
    return (
        table(spark, sf_dir, "embeddings")
        .select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).getField("x").alias("mean"))
    )


def mean_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    means = (
        table(spark, sf_dir, "embeddings")
        .select(F.posexplode("embedding").alias("i", "x"))
        .groupBy("i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    return [row["x"] for row in means.orderBy("i").collect()]


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a query."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("q_id"), F.col("embedding").alias("qv"), F.col("label").alias("q_label")
    )


def mean_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_means(spark, sf_dir).select(
        F.col("label").cast("bigint").alias("q_id"), F.col("mean").alias("qv")
    )


def scoped_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a query for its own source, language, or both, depending on its label."""
    rows = table(spark, sf_dir, "embeddings").join(
        table(spark, sf_dir, "documents"), F.col("vec_id") == F.col("doc_id"), "left"
    )
    return rows.select(
        F.col("vec_id").alias("q_id"),
        F.col("embedding").alias("qv"),
        F.when(F.col("label") >= 3, F.col("source")).alias("userId"),
        F.when(F.col("label") <= 6, F.col("lang")).alias("conversationId"),
        (F.col("label") + 1).alias("limit"),
        (F.col("label") / 20.0).alias("threshold"),
    )
