"""What the operators of this folder share: tables, stored intermediates, an order of documents in range buckets."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: ASCII white space: the characters that separate words in the operators on word shingles.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written under the shared checkpoint folder and read back: evaluated once, and safe when executors are lost."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours under the checkpoint folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables stored for the length of a `with` block. What is needed after it must be stored by itself before it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, rows: DataFrame, name: str, *partitions: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        rows.write.partitionBy(*partitions).parquet(path)
        found = self.spark.read.schema(rows.schema).parquet(path)
        self.paths[id(found)] = found, path
        return found

    def drop(self, table: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        if id(table) in self.paths:
            removed(self.spark, self.paths.pop(id(table))[1])

    def free(self) -> None:
        """Let Spark delete the shuffle files of finished steps: it does so when the driver's plans of them are collected as garbage,
        which takes a second time where the first only finds what is to be finalised."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for _, path in self.paths.values():
            removed(self.spark, path)
        self.paths.clear()


def in_python(rows: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with this package importable on the executors. A worker, which lives on for other tasks, gives back free memory after each."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return rows.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that Arrow and the C library hold free to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def boundaries(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """Distinct ascending values that cut `key` into about equal shares; one aggregation with bounded state."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.percentile_approx(key, shares, max(10_000, 10 * buckets)).alias("b")).first()["b"]
    return sorted(set(found or []))


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below the key, 0 for the lowest; NULL keys come last. Two levels, so that many cuts stay cheap."""
    last = F.lit(len(cuts) + 1)
    if not cuts:
        return F.when(key.isNull(), last).otherwise(F.lit(0))
    step = max(1, int(len(cuts) ** 0.5))
    fine = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    block = F.size(F.filter(_longs([x[0] for x in fine]), lambda c: c <= key))
    inner = F.split(F.element_at(F.split(F.lit(";".join(",".join(map(str, x)) for x in fine)), ";"), block), ",").cast("array<bigint>")
    within = F.size(F.filter(inner, lambda c: c <= key))
    return F.when(key.isNull(), last).when(block < 1, F.lit(0)).otherwise((block - 1) * step + within)


def _longs(values: list[int]) -> Column:
    """A literal array, folded from one string when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def starts(sums: DataFrame, bucket: str, value: str) -> DataFrame:
    """Per bucket the sum of `value` over all lower buckets, as column `start`.

    Windows run over blocks of 1,000 buckets and over the blocks, so no task sees more than that many rows times
    a thousandth of the buckets.
    """
    block = F.floor(F.col(bucket) / 1000).alias("_block")
    totals = sums.groupBy(block).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    local = sums.select(bucket, block, F.coalesce(F.sum(value).over(inside.partitionBy(block).orderBy(bucket)), F.lit(0)).alias("_local"))
    return local.join(totals, "_block").select(bucket, (F.col("_base") + F.col("_local")).alias("start"))


def slices(sizes, most: int):
    """Index ranges of consecutive items whose sizes add up to about `most`."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
