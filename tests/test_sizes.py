"""Searches cut into blocks and shards."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from recallset import IndexSpec
from recallset.operators import kernel
from recallset.operators import nearest as module
from recallset.operators.nearest import grid, nearest
from recallset.operators.search import search_hits
from recallset.plans import ivf
from recallset.registry import fixtures as fx

SPEC = fx.SPEC


def found(hits):
    return sorted((r["q_id"], r["rank"], r["id"]) for r in hits.rows.collect())


def test_planned_index_is_searched_in_blocks(spark, sf_dir):
    store, queries = fx.shared_store(spark, sf_dir), fx.vector_queries(spark, sf_dir)
    centroids = fx.label_means(spark, sf_dir).select(F.col("label").alias("centroid_id"), F.col("mean").alias("centroid"))
    index = ivf.make_index(store, IndexSpec(SPEC), centroids)
    exact = found(search_hits(store, queries, SPEC, limit=5))
    assert found(ivf.search_index_hits(index, queries, limit=5, n_probes=10, rerank=True, block_hits=100)) == exact
    since = ivf.Changes(store.limit(0).select("doc_key"), store.limit(0))
    hits = ivf.search_index_hits(index, queries, limit=5, n_probes=10, rerank=True, since=since, block_hits=100)
    assert found(hits) == exact


def test_vectors_of_another_size_have_no_list_and_no_code():
    v = pa.array([None, [1.0, 2.0], [1.0], [], [3.0, 4.0], None], pa.list_(pa.float32()))
    sums = lambda a: pa.array([sum(x) for x in a.to_pylist()])
    assert ivf.of_size(v, 2, sums).to_pylist() == [None, 3.0, None, None, 7.0, None]
    assert ivf.of_size(v.slice(0, 0), 2, lambda a: pa.array([], pa.float64())).to_pylist() == []


def test_grid_moves_few_bytes_within_bounds():
    assert grid(1000, 1000, 10, 10, 2000, 1, 4) == (2, 2)
    assert grid(1000, 10, 10, 10, 2000, 1, 4) == (4, 1)
    assert grid(1000, 1000, 10, 1000, 2000, 1, 4) == (1, 4)
    assert grid(1000, 1000, 10, 10, 100, 7, 1) == (10, 7)


def test_queries_that_a_task_holds_are_cut_for_the_cores_only(spark, monkeypatch):
    rows = spark.range(20_000).select(
        F.col("id").alias("q_id"), F.col("id").cast("string").alias("doc_key"), F.col("id").cast("string").alias("id"), F.lit(5).alias("limit"),
        F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(1000)).cast("float") - 499).alias("vector"),
    )
    cuts, own = [], module._cogrouped
    monkeypatch.setattr(module, "_cogrouped", lambda a, b, c, d, cut, *rest: (cuts.append(cut.first()), own(a, b, c, d, cut, *rest))[1])
    hits = nearest(rows, rows.withColumnRenamed("vector", "qv"), 16, method="shuffle").rows
    assert cuts[0]["shards"] * cuts[0]["blocks"] <= spark.sparkContext.defaultParallelism
    assert hits.count() == 20_000 * 5


def test_a_query_of_several_lists_sends_its_nearest_once():
    q = kernel.Queries(pa.array([7, 7, None, None, 8]), np.ones((5, 2)), np.array([2, 2, 2, 2, 2]), [pa.array([0, 1, 0, 1, 1])])
    table = pa.table({
        "doc_key": [f"k{n}" for n in range(8)], "id": [f"{n}" for n in range(8)], "list": [n % 2 for n in range(8)],
        "vector": [[1.0, 1.0 + n] for n in range(8)],
    })
    got = pa.Table.from_batches(kernel.nearest_in_batches(table.to_batches(3), q, 2, ["list"], None, True)).to_pylist()
    assert sorted((str(r["q_id"]), r["doc_key"]) for r in got) == [("7", "k0"), ("7", "k1"), ("8", "k1"), ("8", "k3"), ("None", "k0"), ("None", "k1")]
