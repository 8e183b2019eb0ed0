"""Rows that travel in packs, so that Spark copies a pack, and not each of its rows, to the several tasks it is for."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a pack at most, and rows that a task holds to make packs of.
PACK_ROWS = 1 << 11
HELD_ROWS = 1 << 16


def ordered(kind: T.DataType) -> bool:
    """If values that are equal to Spark are equal to Arrow too."""
    return isinstance(kind, T.IntegralType) or kind == T.StringType()


def packed(rows: DataFrame, own: Column, n_own: int, spread: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """``(own, pack)``: the rows of each number ``own`` from 0 to ``n_own - 1``, in packs that :func:`unpacked` reads.

    ``spread`` makes the rows to pack, with their ``own``, of those that Spark has.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in together(map(lambda b: pa.Table.from_batches([b]), batches), HELD_ROWS if spread is None else 1):
            if spread is not None:
                table = spread(table).combine_chunks()
            number = table.column("own").to_numpy()
            table = table.drop_columns(["own"])
            if n_own > 1:
                order = np.argsort(number, kind="stable")
                table, number = table.take(pa.array(order)).combine_chunks(), number[order]
            cuts = np.searchsorted(number, np.arange(n_own + 1))
            for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                packs = [_bytes(table.slice(i, min(PACK_ROWS, b - i))) for i in range(a, b, PACK_ROWS)]
                if packs:
                    yield pa.record_batch([pa.array([n] * len(packs), pa.int32()), pa.array(packs, pa.binary())], ["own", "pack"])

    return rows.withColumn("own", own).mapInArrow(pack, "own int, pack binary")


def sided(*sides: DataFrame) -> DataFrame:
    """``(task, side, pack)`` of packs with the number of their ``task``; the sides count from 0."""
    numbered = [x.select("task", F.lit(i).alias("side"), "pack") for i, x in enumerate(sides)]
    return reduce(DataFrame.unionByName, numbered)


def met(tasks: int, *sides: DataFrame) -> DataFrame:
    """``(side, pack)`` of :func:`sided`; a partition holds the packs of a task, one side after the other."""
    return sided(*sides).repartitionById(tasks, F.col("task")).sortWithinPartitions("side").select("side", "pack")


def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Side and rows of each pack of :func:`sided` or :func:`met`."""
    for batch in batches:
        for side, pack in zip(batch.column("side").to_pylist(), batch.column("pack")):
            yield side, pa.ipc.open_stream(pack.as_buffer()).read_all()


def together(tables: Iterable[pa.Table], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of one chunk and of at least so many rows, but for the last."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= rows:
            yield pa.concat_tables(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.concat_tables(held).combine_chunks()


def _bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()
