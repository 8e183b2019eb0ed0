"""Rows and queries that meet in packs, lists of candidates, and what a task measures and ranks by itself."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recallset.operators import kernel, packs
from recallset.operators import nearest as module
from recallset.operators import rerank as rr
from recallset.operators.nearest import nearest


def vector(name, n, seed=0):
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(F.xxhash64(name, i + seed), F.lit(1000)).cast("float") - 499)


def test_a_task_measures_little_more_than_its_hits(monkeypatch):
    rng, n, limit = np.random.default_rng(4), 20_000, 10
    vectors = rng.normal(size=(n, 16)).astype(np.float32)
    lists = np.arange(n) % 4
    batch = pa.record_batch({"doc_key": [f"k{i}" for i in range(n)], "id": [f"{i}" for i in range(n)], "vector": pa.array(list(vectors)), "list": lists})
    asking = np.repeat(vectors[:100], 4, axis=0).astype(float)
    block = kernel.Queries(pa.array(np.repeat(np.arange(100), 4)), asking, np.full(400, limit), [pa.array(np.tile(np.arange(4), 100))])
    pairs, own = [], kernel.cosine_distances
    monkeypatch.setattr(kernel, "BUFFERED_HITS", 0)
    monkeypatch.setattr(kernel, "cosine_distances", lambda dot, *squares: (pairs.append(len(dot)), own(dot, *squares))[1])
    found = pa.Table.from_batches(kernel.nearest_in_batches([batch], block, 16, ["list"], None, True))
    assert found.num_rows == 100 * limit
    assert sum(pairs) < 1.5 * 100 * limit
    exact = own(vectors[:100].astype(float) @ vectors.T.astype(float), (vectors[:100] ** 2).sum(1)[:, None].astype(float), (vectors**2).sum(1)[None, :].astype(float))
    want = np.argsort(exact, axis=1, kind="stable")[:, :limit]
    assert np.array(found.column("id").to_pylist()).astype(int).reshape(100, limit).tolist() == want.tolist()


def test_sums_and_places_equal_plain_ones():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 9)).astype(np.float32), rng.normal(size=(40, 9))
    for n in (0, 1, 2, 511, 513, 2000):
        at, bt = rng.integers(0, 50, n), rng.integers(0, 40, n)
        assert (kernel.pair_products(a, at, b, bt) == kernel.sum_products(a[at], b[bt])).all()
    group, value = rng.integers(0, 7, 300), rng.normal(size=300).astype(np.float32)
    limits = np.array([1, 5, 1000, 20, 2, 3, 30, 4])
    want = [sorted(value[group == g])[k - 1] if (group == g).sum() >= k else np.inf for g, k in enumerate(limits)]
    assert kernel._kth(group, value, limits).tolist() == [float(x) for x in want]
    mask = rng.random((37, 11)) < 0.1
    assert kernel._true(mask).tolist() == np.flatnonzero(mask).tolist()


def test_packs_bring_every_row_to_its_tasks_once(spark, monkeypatch):
    monkeypatch.setattr(packs, "HELD_ROWS", 300)
    monkeypatch.setattr(packs, "PACK_ROWS", 70)
    left = packs.packed(spark.range(1000), F.pmod("id", F.lit(3)).cast("int"), 3).withColumnRenamed("own", "task")
    right = packs.packed(spark.range(5), F.lit(0), 1).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(2))))

    def run(batches):
        found = [(side, x) for side, rows in packs.unpacked(batches) for x in rows.column("id").to_pylist()]
        assert [side for side, _ in found] == sorted(side for side, _ in found)
        yield pa.record_batch({"side": pa.array([f[0] for f in found], pa.int32()), "id": pa.array([f[1] for f in found], pa.int64())})

    got = sorted(map(tuple, packs.met(3, left, right).mapInArrow(run, "side int, id bigint").collect()))
    assert got == sorted([(0, i) for i in range(1000)] + [(1, i) for i in range(5)] * 3)


def test_one_shard_is_ranked_where_it_was_searched(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("doc_key"), vector("id", 8).alias("vector")).withColumn("id", F.lit("same"))
    queries = spark.range(200).select(F.col("id").alias("q_id"), vector("id", 8, 5).alias("qv"), F.lit(7).alias("limit"))
    twice = queries.unionByName(queries.filter("q_id < 3").withColumn("qv", F.reverse("qv")))
    own = lambda r: int(r["q_id"][0] if isinstance(r["q_id"], tuple) else r["q_id"])
    found = {}
    for name, q in (("plain", queries), ("twice", twice), ("struct", twice.withColumn("q_id", F.struct("q_id"))), ("text", twice.withColumn("q_id", F.col("q_id").cast("string")))):
        hits = nearest(rows, q, 8, method="shuffle").rows
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        assert ("Window" in plan) == (name == "struct")
        found[name] = sorted((own(r), r["rank"], r["doc_key"]) for r in hits.collect())
        keys = {q: [k for p, _, k in found[name] if p == q] for q, _, _ in found[name]}
        for options in ({}, {"block_bytes": 20_000}):
            lists = nearest(rows, q, 8, method="shuffle", listed=True, **options).rows
            assert {own(r): r["keys"] for r in lists.collect()} == keys
    assert found["twice"] == found["struct"] == found["text"] and len(found["plain"]) == 1400


def test_ranks_of_rows_without_an_id():
    table = pa.table({
        "q_id": [1, 1, 1, 2], "limit": pa.array([2, 2, 2, 2], pa.int32()), "doc_key": ["a", "b", "c", "a"], "id": ["x", "y", None, None],
        "ord": [0, 0, 0, 0], "distance": [0.5, 0.5, 0.5, 0.1],
    })
    got = module._numbered(table, None).to_pylist()
    assert [(r["q_id"], r["rank"], r["doc_key"]) for r in got] == [(1, 1, "c"), (1, 2, "a"), (2, 1, "a")]


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_lists_of_candidates_are_measured_like_rows_of_them(spark, kind):
    n, d = 200, 8
    vectors = spark.range(n).select(F.col("id").cast("string").alias("doc_key"), F.col("id").cast("string").alias("id"), vector("id", d).alias("vector"))
    queries = spark.range(20).select(F.col("id").alias("q_id"), vector("id", d, 9).alias("qv"), F.lit(3).alias("limit"))
    queries = queries.unionByName(queries.filter("q_id = 4").withColumn("qv", F.reverse("qv"))).withColumn("q_id", F.col("q_id").cast(kind))
    lists = queries.select("q_id").distinct().withColumn("keys", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.pmod(F.xxhash64("q_id", i), F.lit(230)).cast("string")))
    lists = lists.withColumn("keys", F.array_distinct(F.concat("keys", F.array(F.lit(None).cast("string")))))
    flat = lists.select("q_id", F.explode("keys").alias("doc_key"))
    whole = sorted(map(tuple, rr.ranked(rr.measured(flat, vectors, queries, d)).collect()))
    assert len(whole) == 60
    for options in ({}, {"group_vectors": 50}, {"group_pairs": 100, "group_vectors": 70}):
        assert sorted(map(tuple, rr.ranked(rr.measured(lists, vectors, queries, d, **options)).collect())) == whole
