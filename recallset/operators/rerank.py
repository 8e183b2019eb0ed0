"""Candidates measured with full vectors: keys and vectors meet in packs of Arrow batches, so no row holds a pair of vectors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import checkpointed, ship_package
from .kernel import cosine_distances, matrix, pair_products, sum_products
from .packs import ordered, packed, sided, unpacked

#: About how many candidates, and how many vectors, meet in one task.
GROUP_PAIRS = 1 << 20
GROUP_VECTORS = 1 << 17
#: Fewer candidates than these are not worth a task of their own.
LEAST_PAIRS = 1 << 16


def measured(
    candidates: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    dimensions: int,
    group_pairs: int = GROUP_PAIRS,
    group_vectors: int = GROUP_VECTORS,
) -> DataFrame:
    """``(q_id, limit, doc_key, id, distance)``: per task and query the ``limit`` nearest of its candidates.

    ``candidates`` has ``q_id, doc_key``, or ``q_id, keys`` with all keys of a query in one row, ``vectors`` ``doc_key, id, vector`` once for each key, ``queries`` ``q_id, qv, limit``.
    Keys are dealt to shards, queries to blocks; a task has the vectors of a shard, the queries of a block, and the candidates that
    these ask for. There are as many blocks as the shard with the most candidates or the cores need, so a vector is sent once per block and a
    query once per shard, not once for each of its candidates, and all in packs. Vectors that are no candidates are not sent, unless there
    are more candidates than vectors. Candidates without a vector are left out.
    """
    ship_package(vectors.sparkSession)
    if "keys" not in candidates.columns:
        candidates = candidates.groupBy("q_id").agg(F.collect_list("doc_key").alias("keys"))
    candidates = checkpointed(candidates.filter(F.col("q_id").isNotNull()).select("q_id", "keys"))
    vectors = vectors.select("doc_key", "id", "vector")
    n = candidates.agg(F.coalesce(F.sum(F.size("keys").cast("bigint")), F.lit(0))).first()[0]
    n_keys = vectors.count() if n > GROUP_VECTORS else n
    key = F.explode("keys").alias("doc_key")
    if n <= n_keys:
        wanted = checkpointed(candidates.select(key).distinct())
        n_keys = wanted.count()
        vectors = vectors.join(F.broadcast(wanted) if n <= GROUP_VECTORS else wanted, "doc_key", "left_semi")
    blocks = max(1, math.ceil(n_keys / group_vectors))
    tasks = min(vectors.sparkSession.sparkContext.defaultParallelism, math.ceil(n / LEAST_PAIRS))

    def shard(doc_key: Column) -> Column:
        return F.pmod(F.xxhash64(doc_key), F.lit(blocks)).cast("int")

    most = n
    if blocks > 1:
        most = candidates.select(key).groupBy(shard(F.col("doc_key"))).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    parts = max(1, math.ceil(most / group_pairs), math.ceil(tasks / blocks))
    part = F.pmod(F.xxhash64("q_id"), F.lit(parts)).cast("int")
    name = F.col("q_id") if ordered(queries.schema["q_id"].dataType) else F.to_json(F.struct("q_id"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = packed(queries.filter(F.col("q_id").isNotNull()).select("q_id", name.alias("name"), "qv", F.col("limit").cast("int").alias("limit")), part, parts)
    asked = asked.withColumn("other", each(blocks)).withColumn("task", F.col("other") * parts + F.col("own"))
    held = packed(vectors.filter(F.col("doc_key").isNotNull()), shard(F.col("doc_key")), blocks)
    held = held.withColumn("other", each(parts)).withColumn("task", F.col("own") * parts + F.col("other"))

    def pairs_of(lists: pa.Table) -> pa.Table:
        at = pc.list_parent_indices(lists.column("keys"))
        own = pc.add(pc.multiply(pc.list_flatten(lists.column("own")), parts), lists.column("part").take(at))
        return pa.table({"name": lists.column("name").take(at), "doc_key": pc.list_flatten(lists.column("keys")), "own": own})

    keyed = candidates.select(name.alias("name"), F.array_compact("keys").alias("keys"), part.alias("part"))
    pairs = packed(keyed, F.transform("keys", shard), blocks * parts, pairs_of).withColumnRenamed("own", "task")
    schema = T.StructType(
        [T.StructField("q_id", queries.schema["q_id"].dataType), T.StructField("limit", T.IntegerType())]
        + [vectors.schema["doc_key"], vectors.schema["id"], T.StructField("distance", T.DoubleType())]
    )
    arrow_schema = to_arrow_schema(schema)

    def run(known: pa.Table, pairs: pa.Table) -> pa.Table:
        sides: list[list[pa.Table]] = [[], [], []]
        for side, rows in unpacked(known.to_batches()):
            sides[side].append(rows)
        sides[2] = [rows for _, rows in unpacked(pairs.to_batches())]
        if not all(sides):
            return arrow_schema.empty_table()
        asked, rows, pairs = (pa.concat_tables(tables).combine_chunks() for tables in sides)
        sides.clear()
        chunk = lambda table, name: table.column(name).chunk(0)
        q, at = _named(chunk(asked, "name"), chunk(pairs, "name"))
        found = pc.index_in(chunk(pairs, "doc_key"), value_set=chunk(rows, "doc_key")).take(pa.array(at))
        there = pc.is_valid(found).to_numpy(zero_copy_only=False)
        q, at = q[there], pc.drop_null(found).to_numpy().astype(np.int64)
        del pairs, found
        stored, asking = matrix(chunk(rows, "vector"), dimensions), matrix(chunk(asked, "qv"), dimensions)
        squares = lambda vs: np.concatenate([sum_products(x, x) for x in np.array_split(vs, len(vs) // 16_384 + 1)])
        distance = cosine_distances(pair_products(stored, at, asking, q), squares(stored)[at], squares(asking)[q])
        by = np.lexsort((distance, q))
        limits = chunk(asked, "limit").to_numpy()
        by = by[_within(q[by], distance[by], limits)]  # ties at the limit are all kept, and settled by their names
        q, at, distance = q[by], at[by], distance[by]
        found = pa.table({"q": q, "distance": distance, "id": chunk(rows, "id").take(pa.array(at)), "doc_key": chunk(rows, "doc_key").take(pa.array(at))})
        found = found.take(pc.sort_indices(found, sort_keys=[(c, "ascending") for c in ("q", "distance", "id", "doc_key")]))
        q = found.column("q").to_numpy()
        limit = chunk(asked, "limit").take(pa.array(q))
        keep = pa.array(np.arange(len(q)) - np.searchsorted(q, q) < limit.to_numpy())
        columns = [chunk(asked, "q_id").take(pa.array(q)), limit, found.column("doc_key"), found.column("id"), found.column("distance")]
        return pa.table(columns, names=schema.names).filter(keep).cast(arrow_schema)

    return sided(asked, held).groupBy("task").cogroup(sided(pairs).groupBy("task")).applyInArrow(run, schema)


def _named(names: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(q, at)`` of all pairs of equal names, ``q`` among the names, which may repeat, and ``at`` among the wanted ones."""
    values = names.unique()
    own = pc.index_in(names, value_set=values).to_numpy()
    order, counts = np.argsort(own, kind="stable"), np.bincount(own, minlength=len(values))
    code = pc.fill_null(pc.index_in(wanted, value_set=values), -1).to_numpy()
    at = np.flatnonzero(code >= 0)
    n = counts[code[at]]
    first = np.repeat((np.cumsum(counts) - counts)[code[at]], n)
    return order[first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)], np.repeat(at, n)


def _within(q: np.ndarray, distance: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Which of the hits, in the order of their query and distance, are no farther than the ``limit``-th of their query."""
    start = np.searchsorted(q, q)
    end = np.searchsorted(q, q, side="right")
    return distance <= distance[np.minimum(start + limits[q], end) - 1]


def ranked(found: DataFrame) -> DataFrame:
    """The ``limit`` nearest of each query, of rows ``(q_id, limit, doc_key, id, distance)``."""
    order = Window.partitionBy("q_id").orderBy("distance", "id", "doc_key")
    rows = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.col("limit"))
    return rows.select("q_id", "rank", "doc_key", "id", "distance")
