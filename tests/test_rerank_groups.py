"""Candidates to rerank are dealt to shards of keys and blocks of queries."""

from pyspark.sql import functions as F

from recallset.operators import rerank as rr


def test_rerank_sends_a_query_once_per_shard(spark):
    n, d = 300, 4
    v = lambda a, seed: F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.pmod(F.xxhash64(a, i + seed), F.lit(100)).cast("double") + 1)
    vectors = spark.range(n).select(F.col("id").cast("string").alias("doc_key"), F.col("id").cast("string").alias("id"), v(F.col("id"), 0).alias("vector"))
    queries = spark.range(40).select(F.col("id").alias("q_id"), v(F.col("id"), 9).alias("qv"), F.lit(3).alias("limit"))
    pairs = queries.crossJoin(vectors.select("doc_key")).filter("(q_id + cast(doc_key AS bigint)) % 3 = 0 OR doc_key = '5'").select("q_id", "doc_key")
    whole = sorted(map(tuple, rr.ranked(rr.measured(pairs, vectors, queries, d)).collect()))
    assert len(whole) == 120
    for options in ({"group_vectors": 50}, {"group_pairs": 100}, {"group_vectors": 70, "group_pairs": 300}):
        assert sorted(map(tuple, rr.ranked(rr.measured(pairs, vectors, queries, d, **options)).collect())) == whole
    near = sorted((r["q_id"], r["doc_key"]) for r in rr.measured(pairs, vectors, queries, d).collect())
    assert len(near) == 120  # one task here, so no query was dealt to several
