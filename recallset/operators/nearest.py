"""Nearest rows for a table of query vectors, exact, under equality conditions per query."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import checkpointed, ship_package
from .kernel import Queries, nearest_in_batches
from .packs import met, ordered, packed, together, unpacked

# What one task may hold. Beyond these bounds the queries are cut into blocks and shuffled.
BLOCK_BYTES = 64 << 20
BLOCK_HITS = 1 << 20
# Every task of a scan answers all queries that are sent to it, so the hits to merge grow with both.
SENT_HITS = 1 << 16
# Rows have keys and ids besides their vector, hits little else.
NAME_BYTES = 64
MIXED_KEYS = 256
PAIRS_PER_TASK = 1 << 22
BROADCAST_KEYS = 100_000
MERGE_ROWS = 1 << 20
MAX_SHARES = 1024
UNKNOWN_BYTES = 1 << 62
GROUP_BATCH_ROWS = 1 << 17
# Hits of several shards are written, sorted and ranked again, which costs more than their bytes.
HIT_COST = 4


class Hits(NamedTuple):
    """``rows`` is ``(q_id, rank, doc_key, id, distance)``; ``bounded`` if it is proven small."""

    rows: DataFrame
    bounded: bool


class Task(NamedTuple):
    """What a worker needs besides the rows."""

    dimensions: int
    fields: tuple[str, ...]
    before: str | None
    strict: bool
    ranges: tuple[np.ndarray, np.ndarray] | None
    digits: int | None


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    dimensions: int,
    fields: Sequence[str] = (),
    before: str | None = None,
    strict: bool = True,
    ranges: tuple[np.ndarray, np.ndarray] | None = None,
    digits: int | None = None,
    method: str = "auto",
    block_bytes: int = BLOCK_BYTES,
    block_hits: int = BLOCK_HITS,
    listed: bool = False,
) -> Hits:
    """The ``limit`` nearest corpus rows per query by cosine distance, then by id.

    ``corpus`` has ``doc_key, id, vector`` and the ``fields``; ``queries`` has ``q_id, qv, limit`` and
    the same ``fields``, where NULL means no condition on that field. No pair of a row and a query
    is ever a row of a table: each task emits at most ``limit`` rows per query it has seen.

    ``broadcast`` sends the queries to every task and leaves the corpus where it is. ``shuffle``
    cuts both sides into pieces of bounded size that meet in one task each; a hot key is cut too.
    ``auto`` broadcasts if the queries and their hits fit the given bounds and are few. With ``digits``, distances are
    rounded before they are ranked, so that rounding noise does not come before the id. With ``listed``, the rows are
    ``(q_id, keys)``: all keys of a query in one row, nearest first.
    """
    ship_package(corpus.sparkSession)
    extra = [before] if before else []
    corpus = corpus.select("doc_key", "id", "vector", *map(_quoted, fields), *extra)
    # Renaming to the same names keeps the two sides apart when both come from one table.
    queries = queries.select(
        *[F.col(_quoted(c)).alias(c) for c in ("q_id", "qv")],
        F.col("limit").cast("int").alias("limit"),
        *[F.col(_quoted(c)).alias(c) for c in (*fields, *extra)],
    )
    task = Task(dimensions, tuple(fields), before, strict, ranges, digits)
    bounded = False
    if method in ("auto", "broadcast"):
        most = max(block_bytes // (8 * dimensions + 64), 1)
        # every task sums its own queries and sends one row; they are fetched only once they are known to be few
        n, wanted, named = queries.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.col("limit").cast("bigint")), F.lit(0)),
            F.coalesce(F.sum(reduce(lambda a, b: a + b, [_octets(c) for c in queries.columns if c not in ("qv", "limit")])), F.lit(0)),
        ).first()
        few = n <= most and named <= block_bytes
        if method == "broadcast" and not few:
            raise ValueError(f"more than {most} queries, or more than {block_bytes} bytes of their names and filters, cannot be broadcast")
        bounded = wanted <= block_hits
        if method == "broadcast" or (few and wanted <= min(block_hits, SENT_HITS)):
            table = queries.toArrow()
            found = _broadcast(corpus, queries.schema, table, task)
            largest = max(table.column("limit").to_pylist(), default=0)
            fan = math.ceil(largest * _scan_tasks(corpus) / MERGE_ROWS)
            return Hits(_listed(_ranked(found, before, fan), listed), bounded)
        bounded = bounded and few
    found, fan = _shuffled(corpus, queries, task, block_bytes, block_hits, listed)
    if not fan:  # every query met all rows in one task, which has ranked them
        return Hits(found if listed else found.select("q_id", "rank", "doc_key", "id", "distance"), bounded)
    return Hits(_listed(_ranked(found.drop("rank"), before, fan), listed), bounded)


def _octets(name: str) -> Column:
    return F.coalesce(F.octet_length(F.col(_quoted(name)).cast("string")), F.lit(0))


def _quoted(name: str) -> str:
    return f"`{name}`"


def _found_schema(queries: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("q_id", queries["q_id"].dataType),
            T.StructField("limit", T.IntegerType()),
            T.StructField("doc_key", T.StringType()),
            T.StructField("id", T.StringType()),
            T.StructField("ord", T.LongType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _scan_tasks(corpus: DataFrame) -> int:
    """About how many tasks a scan of the corpus takes; decides the shape of the merge, no result.

    What the tables hold is added up: the estimate of a join is the product of its sides.
    """
    leaves = corpus._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < UNKNOWN_BYTES)
    per_task = corpus.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128MB")
    return max(size // _bytes(per_task), 1)


def _bytes(text: str) -> int:
    number = text.lower().rstrip("bkmgt")
    unit = text.lower().removeprefix(number).removesuffix("b")
    return max(int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit], 1)


def _ranked(found: DataFrame, before: str | None, fan: int = 1) -> DataFrame:
    """The first ``limit`` of each query.

    What the tasks found for one query grows with the corpus. Where it would be more than ``MERGE_ROWS``
    for one task, ``fan`` tasks rank a share each, and the rest is ranked again.
    """
    ties = ["ord", "id", "doc_key"] if before else ["id", "doc_key"]

    def first(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("distance", *ties)
        ranked = rows.withColumn("rank", F.row_number().over(order))
        return ranked.filter(F.col("rank") <= F.col("limit"))

    fan = min(fan, MAX_SHARES)
    if fan > 1:
        share = F.pmod(F.xxhash64("doc_key"), F.lit(fan))
        found = first(found.withColumn("share", share), "q_id", "share").drop("rank", "share")
    return first(found, "q_id").select("q_id", "rank", "doc_key", "id", "distance")


def _listed(ranked: DataFrame, listed: bool) -> DataFrame:
    if not listed:
        return ranked
    keys = F.array_sort(F.collect_list(F.struct("rank", "doc_key"))).getField("doc_key")
    return ranked.groupBy("q_id").agg(keys.alias("keys"))


def _broadcast(corpus: DataFrame, schema: T.StructType, table: pa.Table, task: Task) -> DataFrame:
    spark = corpus.sparkSession
    if not table.num_rows:
        return spark.createDataFrame([], _found_schema(schema))
    block = Queries.from_table(table, task.dimensions, task.fields, task.before)
    shared = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return nearest_in_batches(batches, shared.value, *task)

    return corpus.mapInArrow(run, _found_schema(schema))


def _shuffled(
    corpus: DataFrame, queries: DataFrame, task: Task, block_bytes: int, block_hits: int, listed: bool
) -> tuple[DataFrame, int]:
    """What the tasks find, and how many tasks rank a share of it each; 0 if the ranks are right already, or the lists are."""
    shape = reduce(
        lambda total, pair: total + F.col(_quoted(pair[1])).isNotNull().cast("int") * (1 << pair[0]),
        enumerate(task.fields),
        F.lit(0),
    )
    shapes = queries.groupBy(shape.alias("shape")).agg(F.max("limit").alias("most")).collect()
    schema = T.StructType([*_found_schema(queries.schema).fields, T.StructField("rank", T.IntegerType())])
    parts, fan = [], 0
    for row in sorted(shapes):
        on = tuple(f for i, f in enumerate(task.fields) if row["shape"] >> i & 1)
        piece, shards = _met(
            corpus,
            queries.filter(shape == row["shape"]),
            task._replace(fields=on),
            on,
            schema,
            block_bytes,
            block_hits,
            row["most"],
            listed and len(shapes) == 1,
        )
        parts.append(piece)
        fan = max(fan, math.ceil(shards * row["most"] / MERGE_ROWS))
    if not parts:
        return corpus.sparkSession.createDataFrame([], schema), 1
    if len(parts) > 1:  # one query may have rows of several shapes
        fan = max(fan, 1)
    return reduce(DataFrame.unionByName, parts), fan


def _value_bytes(corpus: DataFrame) -> int:
    """Bytes of one value of a vector: a byte in codes, else as it is stored."""
    kind = corpus.schema["vector"].dataType
    return 1 if isinstance(kind, T.BinaryType) else 4 if isinstance(kind.elementType, T.FloatType) else 8


def grid(rows: int, queries: int, row_bytes: int, query_bytes: int, most_rows: int, least_blocks: int, tasks: int) -> tuple[int, int]:
    """Shards of the rows and blocks of the queries, every shard to meet every block, that move the fewest bytes.

    A shard holds ``most_rows`` at most, there are ``least_blocks`` or more, and ``tasks`` pairs of both or more.
    """
    def moved(at: tuple[int, int]) -> int:
        return at[1] * rows * row_bytes + at[0] * queries * query_bytes

    least = max(math.ceil(rows / most_rows), 1)
    shapes = [(s, max(least_blocks, math.ceil(tasks / s), 1)) for s in range(least, max(least, tasks) + 1)]
    return min(shapes, key=moved)


def _met(
    corpus: DataFrame,
    queries: DataFrame,
    task: Task,
    on: tuple[str, ...],
    schema: T.StructType,
    block_bytes: int,
    block_hits: int,
    most: int,
    listed: bool,
) -> tuple[DataFrame, int]:
    """Let every piece of rows meet every piece of queries under the same key; also the most shards of a key, 0 if every query
    meets all rows in one task.

    Keys share hash buckets of about ``group_rows`` rows. A key with more rows, or more queries, than
    a quarter of that is cut into shards, or blocks; each shard then meets each block. Where few keys are asked for, and
    queries ask for several of them, rows and queries are cut regardless of keys if that moves fewer bytes: a query then
    has its hits of all keys in one task, and sends only the nearest of them.
    """
    known = reduce(lambda a, b: a & b, [F.col(_quoted(f)).isNotNull() for f in on], F.lit(True))
    keys = [f"k{i}" for i in range(len(on))] or ["k0"]
    row_bytes, query_bytes = _value_bytes(corpus) * task.dimensions + NAME_BYTES, 8 * task.dimensions + NAME_BYTES
    group_rows = max(block_bytes // row_bytes, 64)
    most_queries = max(block_bytes // query_bytes, 1)
    group_queries = max(min(most_queries, block_hits // most), 1)

    def keyed(frame: DataFrame) -> DataFrame:
        if not on:
            return frame.withColumn("k0", F.lit(0))
        return frame.filter(known).withColumns({k: F.col(_quoted(f)) for k, f in zip(keys, on)})

    corpus, queries = keyed(corpus), keyed(queries)
    shard_rows, block_rows = max(group_rows // 4, 1), max(group_queries // 4, 1)
    sizes = checkpointed(
        corpus.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_queries")), keys)
        .withColumns(
            {
                "shards": F.ceil(F.col("n_rows") / shard_rows).cast("int"),
                "blocks": F.ceil(F.col("n_queries") / block_rows).cast("int"),
            }
        )
    )
    hit_bytes = most * NAME_BYTES * HIT_COST
    totals = sizes.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("n_rows").alias("rows"),
        F.sum("n_queries").alias("queries"),
        F.max("shards").alias("shards"),
        F.sum(F.col("n_rows") * F.col("blocks") * row_bytes + F.col("n_queries") * F.col("shards") * (query_bytes + hit_bytes)).alias("moved"),
    ).first()
    if not totals["n_keys"]:
        return corpus.sparkSession.createDataFrame([], schema), 1
    n_rows, n_queries = totals["rows"], totals["queries"]
    tasks = min(corpus.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows * n_queries / PAIRS_PER_TASK))
    if totals["n_keys"] <= MIXED_KEYS:
        asking = n_queries if not on else max(min(queries.agg(F.approx_count_distinct("q_id")).first()[0], n_queries), 1)
        least_blocks = max(math.ceil(n_queries / most_queries), math.ceil(asking / max(block_hits // most, 1)))
        per_query = query_bytes + hit_bytes * asking // n_queries
        # what two shards find for a query is shuffled and ranked again, so a shard may take a task's memory twice
        shards, blocks = grid(n_rows, n_queries, row_bytes, per_query, 2 * group_rows, least_blocks, tasks)
        alone = shards == 1 and ordered(queries.schema["q_id"].dataType)
        if not on or blocks * n_rows * row_bytes + n_queries * (query_bytes if alone else shards * per_query) < totals["moved"]:
            listed = listed and alone
            sizes = sizes.withColumns({"shards": F.lit(shards), "blocks": F.lit(blocks)})
            return _cogrouped(corpus, queries, task, schema, sizes.select(*keys, "shards", "blocks"), keys, "inner", True, 0, shards, blocks, listed), 0 if alone else shards
    buckets = max(math.ceil(n_rows / group_rows), math.ceil(n_queries / group_queries), tasks)
    cut = sizes.select(*keys, "shards", "blocks")
    how = "inner"
    if totals["n_keys"] > BROADCAST_KEYS:
        # rows under keys that no query asks for go first: they have no shards, and would meet in one task
        asked = sizes.select(*keys)
        corpus, queries = (side.join(asked, keys, "left_semi") for side in (corpus, queries))
        cut, how = cut.filter((F.col("shards") > 1) | (F.col("blocks") > 1)), "left"
        small = cut.count() <= BROADCAST_KEYS
    else:
        small = True
    return _cogrouped(corpus, queries, task, schema, cut, keys, how, small, buckets), totals["shards"]


def _cogrouped(
    corpus: DataFrame,
    queries: DataFrame,
    task: Task,
    schema: T.StructType,
    cut: DataFrame,
    keys: list[str],
    how: str,
    small: bool,
    buckets: int,
    shards: int = 1,
    blocks: int = 1,
    listed: bool = False,
) -> DataFrame:
    """What the groups of a hash bucket, a shard and a block find; without ``buckets`` all keys are in one, and have the same
    ``shards`` and ``blocks``.

    ``cut`` has the shards and blocks of the keys, and with an inner join no other keys take part.
    """
    cut = F.broadcast(cut) if small else cut
    if not buckets:
        asked = cut.select(*keys)
        return _dealt(corpus.join(asked, keys, "left_semi").drop(*keys), queries.join(asked, keys, "left_semi").drop(*keys), task, schema, shards, blocks, listed)

    def placed(frame: DataFrame, name: str, own: str, other: str, unique: str) -> DataFrame:
        n_own, n_other = (F.coalesce(c, F.lit(1)) for c in (own, other))
        spread: dict[str, Column] = {
            "g_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)),
            f"g_{name}": F.pmod(F.xxhash64(unique), n_own).cast("int"),
        }
        meets = "g_block" if name == "shard" else "g_shard"
        return (
            frame.join(cut, keys, how)
            .withColumns(spread)
            .withColumn(meets, F.explode(F.sequence(F.lit(0), n_other - 1)))
            .drop("shards", "blocks", *keys)
        )

    group = ["g_bucket", "g_shard", "g_block"]
    left = placed(corpus, "shard", "shards", "blocks", "doc_key").groupBy(*group)
    right = placed(queries, "block", "blocks", "shards", "q_id").groupBy(*group)
    empty = {f.name: [] for f in schema.fields}
    arrow_schema = to_arrow_schema(schema)

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table(empty, schema=arrow_schema)
        block = Queries.from_table(asked, task.dimensions, task.fields, task.before)
        rows = rows.combine_chunks()
        found = list(nearest_in_batches(rows.to_batches(GROUP_BATCH_ROWS), block, *task))
        if not found:
            return pa.table(empty, schema=arrow_schema)
        return _unranked(pa.Table.from_batches(found)).cast(arrow_schema)

    return left.cogroup(right).applyInArrow(run, schema)


def _unranked(found: pa.Table) -> pa.Table:
    return found.append_column("rank", pa.nulls(found.num_rows, pa.int32()))


def _numbered(found: pa.Table, before: str | None) -> pa.Table:
    """All that was found for some queries, with its ``rank``: the first ``limit`` rows in the order that :func:`_ranked` has."""
    found = found.combine_chunks()
    ties = ["ord", "id", "doc_key"] if before else ["id", "doc_key"]
    q_id = found.column("q_id").chunk(0)
    code = pc.dictionary_encode(q_id, null_encoding="encode").indices.cast(pa.int64())
    q, limit, distance = code.to_numpy(), found.column("limit").to_numpy(), found.column("distance").to_numpy()
    follows = (q[1:] != q[:-1]) | ((limit[1:] == limit[:-1]) & (distance[1:] >= distance[:-1]))
    if (q[1:] < q[:-1]).any() or not follows.all() or any(found.column(c).null_count for c in ties):
        keys = [(c, "ascending") for c in ("code", "distance", *ties)]
        at = pc.sort_indices(found.append_column("code", code), sort_keys=keys, null_placement="at_start")
        found, q = found.take(at), code.take(at).to_numpy()
    rank = np.arange(len(q)) - np.searchsorted(q, q) + 1
    found = found.append_column("rank", pa.array(rank, pa.int32()))
    return found.filter(pc.less_equal(found.column("rank"), found.column("limit")))


def _lists(found: pa.Table) -> pa.Table:
    """``(q_id, keys)`` of ranked rows, which come query by query."""
    first = np.flatnonzero(found.column("rank").to_numpy() == 1)
    keys = found.column("doc_key").combine_chunks()
    offsets = pa.array(np.append(first, found.num_rows), pa.int32())
    return pa.table([found.column("q_id").take(pa.array(first)), pa.ListArray.from_arrays(offsets, keys)], ["q_id", "keys"])


def _dealt(
    corpus: DataFrame, queries: DataFrame, task: Task, schema: T.StructType, shards: int, blocks: int, listed: bool
) -> DataFrame:
    """What every shard of the rows finds for every block of the queries, each pair of both in a partition of its own.

    Both sides travel as packs of rows, so that Spark copies a pack, and not each of its rows, once per block or shard. The packs
    of the queries come first in a partition; the rows are then searched as they come. With one shard the ranks are given, or the lists
    of keys if these are asked for.
    """
    if listed:
        schema = T.StructType([schema["q_id"], T.StructField("keys", T.ArrayType(T.StringType()))])
    arrow_schema = to_arrow_schema(schema)
    ranked = shards == 1 and ordered(queries.schema["q_id"].dataType)

    def own(unique: str, n: int) -> Column:
        return F.pmod(F.xxhash64(unique), F.lit(n))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = packed(queries, own("q_id", blocks), blocks).withColumn("other", each(shards)).withColumn("task", F.col("other") * blocks + F.col("own"))
    stored = packed(corpus, own("doc_key", shards), shards).withColumn("other", each(blocks)).withColumn("task", F.col("own") * blocks + F.col("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs, asked, first = unpacked(batches), [], []
        for side, rows in packs:
            if side:
                first.append(rows)
                break
            asked.append(rows)
        if not asked or not first:
            return
        block = Queries.from_table(pa.concat_tables(asked), task.dimensions, task.fields, task.before)
        asked.clear()
        rows = together(chain(first, (rows for _, rows in packs)), GROUP_BATCH_ROWS)
        found = list(nearest_in_batches((b for table in rows for b in table.to_batches()), block, *task))
        if found:
            table = pa.Table.from_batches(found)
            table = _numbered(table, task.before) if ranked else _unranked(table)
            yield from (_lists(table) if listed else table).cast(arrow_schema).to_batches()

    return met(shards * blocks, asked, stored).mapInArrow(run, schema)
