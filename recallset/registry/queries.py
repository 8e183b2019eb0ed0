"""One runnable query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.vectors import cosine_distance, distance_to_score, id_error
from ..operators import filters as flt
from ..operators import mutate
from ..operators.search import bounds_error, search, search_corpus, search_hits, search_one
from ..operators.validate import check_items
from ..plans import ivf, memory
from ..plans import retrieve as rt
from ..session import checkpointed, scratch_path
from ..sources import store as src
from ..spec import IndexSpec
from ..streaming.ingest import ingest, log_batch
from . import fixtures as fx

SPEC = fx.SPEC
INDEX = IndexSpec(SPEC)
Query = Callable[[SparkSession, str], DataFrame]


def _six(name: str) -> Column:
    return F.round(name, 6).alias(name)


def _rank() -> Column:
    return F.col("rank").cast("bigint").alias("rank")


def _at(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _stored(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_key",
        "document_type",
        "id",
        F.round(F.element_at(F.col("vector"), 1).cast("double"), 6).alias("v1"),
        F.col("metadata").getField("userId").alias("user_id"),
        "content",
        _at("created_at"),
        _at("updated_at"),
    )


def _ranked(hits: DataFrame) -> DataFrame:
    return hits.select("q_id", _rank(), "id", _six("distance"))


# Scans, documents, ownership


def store_scan(spark: SparkSession, sf: str) -> DataFrame:
    return src.scan_type(fx.shared_store(spark, sf), SPEC).select(
        "doc_key",
        "id",
        F.size("vector").cast("bigint").alias("n_values"),
        F.col("metadata").getField("userId").alias("user_id"),
        "content",
    )


def prefix_scan(spark: SparkSession, sf: str) -> DataFrame:
    return src.scan_prefix(fx.shared_store(spark, sf), SPEC.key_prefix).select(
        "doc_key", "document_type"
    )


def make_documents(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.items(spark, sf)
    rows = mutate.make_documents(items, SPEC, mutate.instant(fx.CREATED), mutate.instant(fx.WRITTEN), keep=("ord",))
    return _stored(rows.withColumn("doc_key", F.concat_ws("@", "doc_key", "ord")))


def document_key(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select(
        "doc_id", mutate.document_key(SPEC, F.col("doc_id").cast("string")).alias("doc_key")
    )


def _spoilt(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings of which some labels got too short, not finite, holed or nameless."""
    v = F.col("embedding")
    nan, hole = F.lit(float("nan")).cast("float"), F.lit(None).cast("float")
    return fx.table(spark, sf, "embeddings").select(
        F.when(F.col("label") == 4, F.lit("")).otherwise(F.col("vec_id").cast("string")).alias("id"),
        F.when(F.col("label") == 1, F.slice(v, 1, fx.DIMENSIONS - 1))
        .when(F.col("label") == 2, F.transform(v, lambda x, i: F.when(i == 0, nan).otherwise(x)))
        .when(F.col("label") == 3, F.transform(v, lambda x, i: F.when(i == 5, hole).otherwise(x)))
        .otherwise(v)
        .alias("vector"),
        "vec_id",
    )


def validate_vectors(spark: SparkSession, sf: str) -> DataFrame:
    checked = check_items(_spoilt(spark, sf), SPEC)
    return checked.rejects.select("vec_id", "reason").unionByName(
        checked.valid.select("vec_id", F.lit("ok").alias("reason"))
    )


def validate_ids(spark: SparkSession, sf: str) -> DataFrame:
    id_ = F.when(F.col("lang") != "de", F.col("source"))
    return fx.table(spark, sf, "documents").select("doc_id", F.coalesce(id_error(id_), F.lit("ok")).alias("reason"))


def owned_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fx.shared_store(spark, sf).select("doc_key", flt.owned(SPEC).alias("owned"))


def count_owned(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.count(fx.shared_store(spark, sf), SPEC)


# Mutations


def upsert_batch(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.items(spark, sf).unionByName(fx.colliding_items(spark, sf))
    return _stored(mutate.upsert(fx.shared_store(spark, sf), items, SPEC, fx.WRITTEN).rows)


def upsert_content_mirror(spark: SparkSession, sf: str) -> DataFrame:
    change = mutate.upsert_mirrored(fx.shared_store(spark, sf), fx.items(spark, sf), SPEC, fx.WRITTEN)
    return _stored(change.rows)


def upsert_collisions(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.items(spark, sf).unionByName(fx.colliding_items(spark, sf))
    return mutate.upsert(fx.shared_store(spark, sf), items, SPEC, fx.WRITTEN).collisions


def get_batch(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.get(fx.shared_store(spark, sf), fx.ids(spark, sf), SPEC).select(
        "id",
        F.size("vector").cast("bigint").alias("n_values"),
        F.col("metadata").getField("title").alias("title"),
        "content",
        "found",
        "collision",
    )


def delete_batch(spark: SparkSession, sf: str) -> DataFrame:
    toxic = fx.table(spark, sf, "labels").filter("toxic = 1")
    ids = toxic.select(F.col("doc_id").cast("string").alias("id")).unionByName(
        fx.table(spark, sf, "supplier").select(F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"))
    )
    return mutate.delete(fx.shared_store(spark, sf), ids, SPEC).rows.select("doc_key", "document_type")


def clear_owned(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.clear(fx.shared_store(spark, sf), SPEC).select("doc_key", "document_type")


# Search


def filter_equality(spark: SparkSession, sf: str) -> DataFrame:
    rows = search_corpus(fx.shared_store(spark, sf), SPEC, {"conversationId": "en", "label": 3})
    return rows.select("doc_key", F.col("metadata").getField("userId").alias("user_id"))


def filter_per_query(spark: SparkSession, sf: str) -> DataFrame:
    queries = fx.scoped_queries(spark, sf).drop("limit", "threshold")
    return _ranked(search_hits(fx.shared_store(spark, sf), queries, SPEC, limit=5).rows)


def filter_per_query_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    queries = fx.scoped_queries(spark, sf).drop("limit", "threshold")
    return _ranked(search_hits(fx.shared_store(spark, sf), queries, SPEC, limit=5, method="shuffle").rows)


def cosine_distances(spark: SparkSession, sf: str) -> DataFrame:
    means = fx.label_means(spark, sf)
    return fx.table(spark, sf, "embeddings").join(means, "label").select(
        "vec_id", F.round(cosine_distance(F.col("embedding"), F.col("mean")), 6).alias("distance")
    )


def distance_scores(spark: SparkSession, sf: str) -> DataFrame:
    distance = F.col("value") / 10.0 - 1.0
    return fx.table(spark, sf, "events").select("event_id", F.round(distance_to_score(distance), 6).alias("score"))


def topk_single(spark: SparkSession, sf: str) -> DataFrame:
    hits = search_one(fx.shared_store(spark, sf), fx.mean_vector(spark, sf), SPEC, limit=10)
    return hits.select("id", _six("distance"), _six("score"))


def topk_single_builtin(spark: SparkSession, sf: str) -> DataFrame:
    hits = search_one(fx.shared_store(spark, sf), fx.mean_vector(spark, sf), SPEC, limit=10, builtin=True)
    return hits.select("id", _six("distance"), _six("score"))


def topk_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(search_hits(fx.store(spark, sf), fx.vector_queries(spark, sf), SPEC, limit=10).rows)


def topk_batch_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(
        search_hits(fx.store(spark, sf), fx.vector_queries(spark, sf), SPEC, limit=10, method="shuffle").rows
    )


def search_bounds(spark: SparkSession, sf: str) -> DataFrame:
    error = bounds_error(F.floor("value") - 5, F.col("value") / 20.0 - 0.5)
    return fx.table(spark, sf, "events").select("event_id", F.coalesce(error, F.lit("ok")).alias("reason"))


def search_threshold(spark: SparkSession, sf: str) -> DataFrame:
    hits = search_hits(fx.store(spark, sf), fx.mean_queries(spark, sf), SPEC, limit=20, threshold=0.6)
    return hits.rows.select("q_id", _rank(), "id", _six("score"))


def search_full(spark: SparkSession, sf: str) -> DataFrame:
    hits = search(fx.shared_store(spark, sf), fx.scoped_queries(spark, sf), SPEC)
    return hits.select(
        "q_id",
        _rank(),
        "doc_key",
        "id",
        F.size("vector").cast("bigint").alias("n_values"),
        F.col("metadata").getField("title").alias("title"),
        "content",
        _six("distance"),
        _six("score"),
    )


# Index


def _label_index(spark: SparkSession, sf: str) -> ivf.Index:
    """An index whose centroids are the label means."""
    centroids = fx.label_means(spark, sf).select(
        F.col("label").alias("centroid_id"), F.col("mean").alias("centroid")
    )
    return ivf.make_index(fx.shared_store(spark, sf), INDEX, centroids)


def ivf_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _label_index(spark, sf).entries.select("id", F.col("centroid_id").cast("bigint").alias("centroid_id"))


def sq8_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return ivf.code_ranges(fx.shared_store(spark, sf), SPEC).select(
        F.col("i").cast("bigint").alias("i"), _six("low"), _six("high")
    )


def sq8_encode(spark: SparkSession, sf: str) -> DataFrame:
    digits = F.hex("code")
    at = F.sequence(F.lit(0), F.lit(fx.DIMENSIONS - 1))
    codes = F.transform(
        at, lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")
    )
    return _label_index(spark, sf).entries.select("id", F.posexplode(codes).alias("i", "value")).select(
        "id", F.col("i").cast("bigint").alias("i"), "value"
    )


def _probed(spark: SparkSession, sf: str, **options: object) -> DataFrame:
    index = _label_index(spark, sf)
    return _ranked(ivf.search_index_hits(index, fx.vector_queries(spark, sf), limit=10, **options).rows)


def ivf_full_probe(spark: SparkSession, sf: str) -> DataFrame:
    return _probed(spark, sf, n_probes=10, rerank=True)


def ivf_probe(spark: SparkSession, sf: str) -> DataFrame:
    return _probed(spark, sf, n_probes=3)


def ivf_rerank(spark: SparkSession, sf: str) -> DataFrame:
    return _probed(spark, sf, n_probes=3, rerank=True, top_n_scan=30)


def ivf_capped(spark: SparkSession, sf: str) -> DataFrame:
    return _probed(spark, sf, n_probes=2, rerank=False, top_n_scan=7)


def ivf_filtered(spark: SparkSession, sf: str) -> DataFrame:
    index = _label_index(spark, sf)
    queries = fx.scoped_queries(spark, sf).drop("limit", "threshold")
    hits = ivf.search_index_hits(index, queries, limit=5, n_probes=4, rerank=True, top_n_scan=20)
    return _ranked(hits.rows)


def _after_writes(spark: SparkSession, sf: str) -> DataFrame:
    """The store after upserts, and after the deletion of what carries label 0."""
    rows = mutate.upsert(fx.shared_store(spark, sf), fx.items(spark, sf), SPEC, fx.WRITTEN).rows
    ids = fx.table(spark, sf, "embeddings").filter("label = 0").select(F.col("vec_id").cast("string").alias("id"))
    return checkpointed(mutate.delete(rows, ids, SPEC).rows)


def ivf_after_writes(spark: SparkSession, sf: str) -> DataFrame:
    """An index of the store before the writes, searched together with what they changed."""
    index = _label_index(spark, sf)
    since = ivf.changes(index, _after_writes(spark, sf))
    hits = ivf.search_index_hits(index, fx.vector_queries(spark, sf), limit=10, n_probes=10, rerank=True, since=since)
    return _ranked(hits.rows)


def _written_index(spark: SparkSession, sf: str) -> ivf.Index:
    centroids = fx.label_means(spark, sf).select(F.col("label").alias("centroid_id"), F.col("mean").alias("centroid"))
    return ivf.build_index(fx.shared_store(spark, sf), INDEX, scratch_path(spark, "index"), centroids=centroids)


def ivf_written(spark: SparkSession, sf: str) -> DataFrame:
    """The search of ``ivf_rerank`` over an index that was written and loaded."""
    hits = ivf.search_index_hits(
        _written_index(spark, sf), fx.vector_queries(spark, sf), limit=10, n_probes=3, rerank=True, top_n_scan=30
    )
    return _ranked(hits.rows)


def ivf_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """A written index that took the writes in as a segment, was compacted, and is searched by itself."""
    index = _written_index(spark, sf)
    index = ivf.compact_index(ivf.refresh_index(index, ivf.changes(index, _after_writes(spark, sf))))
    return _ranked(ivf.search_index_hits(index, fx.vector_queries(spark, sf), limit=10, n_probes=10, rerank=True).rows)


def ivf_filtered_full(spark: SparkSession, sf: str) -> DataFrame:
    """Queries with filters that go on to further lists until these hold enough matching rows: how many each finds."""
    queries = fx.scoped_queries(spark, sf).drop("limit", "threshold")
    index = _written_index(spark, sf)
    hits = ivf.search_index_hits(index, queries, limit=5, n_probes=1, rerank=True, fill=True).rows
    found = hits.groupBy("q_id").agg(F.count(F.lit(1)).alias("n_hits"), F.max("rank").cast("bigint").alias("last_rank"))
    return queries.select("q_id").join(found, "q_id", "left").select(
        "q_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("last_rank", F.lit(0)).alias("last_rank")
    )


def ivf_train(spark: SparkSession, sf: str) -> DataFrame:
    centroids = ivf.train_centroids(fx.store(spark, sf), IndexSpec(SPEC, description="IVF16,SQ8"))
    return centroids.select("centroid_id", F.size("centroid").alias("n_values"))


def _built_index(spark: SparkSession, sf: str) -> ivf.Index:
    spec = IndexSpec(SPEC, description="IVF16,SQ8")
    return ivf.build_index(fx.shared_store(spark, sf), spec, scratch_path(spark, "index"))


def index_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ivf.index_stats(_built_index(spark, sf), fx.shared_store(spark, sf))
    return stats.select(
        "index_name", "lists", "indexed_rows", "store_rows", "missing_rows", "removed_rows", "changed_rows"
    )


def ivf_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the exact ten nearest that the written index finds, per number of probed lists."""
    index = _built_index(spark, sf)
    queries = fx.vector_queries(spark, sf)
    exact = checkpointed(search_hits(fx.store(spark, sf), queries, SPEC, limit=10).rows.select("q_id", "doc_key"))  # read twice
    found = None
    for n in (1, 4, 16):
        hits = ivf.search_index_hits(index, queries, limit=10, n_probes=n, rerank=True, top_n_scan=100)
        part = hits.rows.select("q_id", "doc_key", F.lit(n).alias("n_probes"))
        found = part if found is None else found.unionByName(part)
    total = exact.agg(F.count(F.lit(1)).alias("wanted"))
    met = found.join(exact, ["q_id", "doc_key"], "left_semi").groupBy("n_probes").agg(F.count(F.lit(1)).alias("met"))
    return (
        met.withColumn("one", F.lit(1))
        .join(total.withColumn("one", F.lit(1)), "one")
        .select("n_probes", F.round(F.col("met") / F.col("wanted"), 4).alias("recall"))
    )


# Text and retrieval


def extract_last_message(spark: SparkSession, sf: str) -> DataFrame:
    return rt.last_message_text(fx.table(spark, sf, "conversations"), "conv_id", "turn", "text")


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    part = "struct<type:string,text:string>"
    parts = F.array(
        F.struct(F.lit("text").alias("type"), F.col("text").alias("text")).cast(part),
        F.struct(F.lit("image").alias("type"), F.lit(None).alias("text")).cast(part),
        F.struct(F.lit("text").alias("type"), F.col("role").alias("text")).cast(part),
    )
    return fx.table(spark, sf, "conversations").withColumn("parts", parts)


def extract_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _parts(spark, sf)
    return rows.select("conv_id", "turn", rt.message_text(F.col("parts"), rows.schema["parts"].dataType).alias("text"))


def extract_json(spark: SparkSession, sf: str) -> DataFrame:
    """User messages as lists of parts, assistant messages as strings, others as objects, all in JSON."""
    content = (
        F.when(F.col("role") == "user", F.to_json("parts"))
        .when(F.col("role") == "assistant", F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2))
        .otherwise(F.to_json(F.struct("text")))
    )
    return _parts(spark, sf).select("conv_id", "turn", tx.json_message_text(content).alias("text"))


def _by_dimension(rows: DataFrame, key: str, vector: Column) -> DataFrame:
    return rows.select(key, F.posexplode(vector).alias("i", "x")).select(
        key, F.col("i").cast("bigint").alias("i"), _six("x")
    )


def embed_keyword_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "documents")
    return _by_dimension(rows, "doc_id", tx.keyword_count_embedding(F.col("text"), fx.GROUPS))


def embed_keyword_flag(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "documents")
    return _by_dimension(rows, "doc_id", tx.keyword_flag_embedding(F.col("text"), fx.GROUPS))


def embed_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A caller's embedding as a vectorised UDF: length, and counts of two letters, scaled."""

    @F.pandas_udf("array<double>")
    def embed(texts: pd.Series) -> pd.Series:
        sizes, e, n = texts.str.len(), texts.str.count("e"), texts.str.count("n")
        return pd.Series([[float(a), float(b), float(c)] for a, b, c in zip(sizes, e, n)])

    return _by_dimension(fx.table(spark, sf, "documents"), "doc_id", embed("text"))


def _support_store(spark: SparkSession, sf: str) -> DataFrame:
    """Documents at their keyword-count embedding, some without title or content."""
    rows = fx.table(spark, sf, "documents")
    items = rows.select(
        F.col("doc_id").cast("string").alias("id"),
        tx.keyword_count_embedding(F.col("text"), fx.GROUPS).alias("vector"),
        F.struct(
            F.col("source").alias("userId"),
            F.col("lang").alias("conversationId"),
            F.when(F.col("lang") == "en", F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))).alias("title"),
        ).alias("metadata"),
        F.when(F.col("lang") != "es", F.col("text")).alias("content"),
    )
    return mutate.make_documents(items, RETRIEVAL, mutate.instant(fx.CREATED), mutate.instant(fx.CREATED))


RETRIEVAL = fx.StoreSpec(len(fx.GROUPS))


def _retrieved(spark: SparkSession, sf: str) -> rt.Retrieved:
    inputs = rt.last_message_text(fx.table(spark, sf, "conversations"), "conv_id", "turn", "text")
    return rt.retrieve(
        _support_store(spark, sf),
        inputs.withColumnRenamed("conv_id", "q_id"),
        lambda text: tx.keyword_count_embedding(text, fx.GROUPS),
        RETRIEVAL,
        threshold=0.9,
        filters=lambda queries: queries.withColumn(
            "userId", F.concat(F.lit("src"), F.length("text").cast("string").substr(-1, 1))
        ),
        source="Knowledge base",
        digits=9,
    )


def retrieve(spark: SparkSession, sf: str) -> DataFrame:
    return _retrieved(spark, sf).context


def references(spark: SparkSession, sf: str) -> DataFrame:
    return _retrieved(spark, sf).references.select(
        "q_id", _rank(), "id", "title", "source", _six("score"), F.col("metadata").getField("userId").alias("user_id")
    )


def context(spark: SparkSession, sf: str) -> DataFrame:
    hits = search(fx.store(spark, sf), fx.mean_queries(spark, sf), SPEC, limit=5, threshold=0.6)
    return rt.contexts(hits)


def memory_recall(spark: SparkSession, sf: str) -> DataFrame:
    found = memory.recall(
        fx.table(spark, sf, "conversations"),
        lambda text: tx.keyword_count_embedding(text, fx.GROUPS),
        len(fx.GROUPS),
        ["conv_id"],
        "turn",
    )
    return found.select("conv_id", "turn", _rank(), "recalled_turn", _six("score"))


# Change log


def _log_items(spark: SparkSession, sf: str) -> DataFrame:
    """The items, followed by removals of all toxic documents."""
    gone = fx.table(spark, sf, "labels").filter("toxic = 1").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(3).alias("ord"), F.lit(src.DELETE).alias("op")
    )
    return fx.items(spark, sf).withColumn("op", F.lit(src.UPSERT)).unionByName(gone, allowMissingColumns=True)


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches: write and remove, write the items again, write them once more."""
    path = scratch_path(spark, "log")
    base = fx.shared_store(spark, sf)
    log_batch(_log_items(spark, sf), SPEC, "2026-02-01 00:00:00", 0, path, base)
    log_batch(fx.items(spark, sf), SPEC, "2026-02-02 00:00:00", 1, path, base)
    log_batch(fx.items(spark, sf), SPEC, "2026-02-03 00:00:00", 2, path, base)
    return _stored(src.current(base, src.read_log(spark, path, SPEC), SPEC))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over all embeddings, each replacing its own stored row."""
    schema = fx.table(spark, sf, "embeddings").schema
    # a pattern, so that the table may be a file or a folder of files
    arriving = spark.readStream.schema(schema).parquet(f"{sf}/embeddings.parque[t]")
    items = arriving.select(
        F.col("vec_id").cast("string").alias("id"),
        F.reverse("embedding").alias("vector"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("content"),
        F.lit(0).alias("ord"),
    )
    base = fx.shared_store(spark, sf)
    path = scratch_path(spark, "stream")
    ingest(items, SPEC, f"{path}/log", f"{path}/checkpoint", base, clock=lambda _: fx.WRITTEN).awaitTermination()
    return _stored(src.current(base, src.read_log(spark, f"{path}/log", SPEC), SPEC))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        store_scan,
        prefix_scan,
        make_documents,
        document_key,
        validate_vectors,
        validate_ids,
        owned_rows,
        count_owned,
        upsert_batch,
        upsert_content_mirror,
        upsert_collisions,
        get_batch,
        delete_batch,
        clear_owned,
        filter_equality,
        filter_per_query,
        filter_per_query_shuffled,
        cosine_distances,
        distance_scores,
        topk_single,
        topk_single_builtin,
        topk_batch,
        topk_batch_shuffled,
        search_bounds,
        search_threshold,
        search_full,
        ivf_assign,
        sq8_ranges,
        sq8_encode,
        ivf_full_probe,
        ivf_probe,
        ivf_rerank,
        ivf_capped,
        ivf_filtered,
        ivf_after_writes,
        ivf_written,
        ivf_refreshed,
        ivf_filtered_full,
        ivf_train,
        ivf_recall,
        index_stats,
        extract_last_message,
        extract_parts,
        extract_json,
        embed_keyword_count,
        embed_keyword_flag,
        embed_udf,
        references,
        context,
        retrieve,
        memory_recall,
        change_log,
        stream_ingest,
    )
}
