"""Sets of 64-bit keys as bitmaps of a fixed size: a key's cell is its upper bits. A bitmap has all keys of the set, and by chance others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_python

#: Bitmaps come to the driver in slices of 2 to this power bits, whole bytes.
SLICE_BITS = 20


def bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """The cells of the column `key` as 2 ** bits bits, packed; no more than these come to the driver."""
    slice_bits = min(SLICE_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = (batch.column(c).to_numpy() for c in (0, 1))
            for own in np.unique(part).tolist():
                maps.setdefault(own, np.zeros(1 << slice_bits, bool))[at[part == own]] = True
        if maps:
            yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())], ["part", "bits"])

    cell = F.shiftrightunsigned("key", 64 - bits).cast("int")
    cells = rows.select(cell.alias("cell")).distinct().select(F.shiftright("cell", slice_bits).alias("part"), F.col("cell").bitwiseAND(F.lit((1 << slice_bits) - 1)).alias("at"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << slice_bits) // 8
    for row in in_python(cells.repartition(1 << (bits - slice_bits), "part"), run, "part int, bits binary").collect():
        out[row.part * size : (row.part + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def cell_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """The upper bits of keys: their place among `cells`, a power of 2."""
    return (keys >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys lie in cells of the bitmap."""
    if not len(keys):
        return np.zeros(0, bool)
    cell = cell_of(keys, 8 * len(bits))
    return ((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1).astype(bool)


def repeated(rows: DataFrame) -> DataFrame:
    """Values of the column `key` that occur more than once. The keys alone are shuffled and sorted, and pass a task as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = sent = None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            if not len(keys):
                continue
            again = np.append(last is not None and keys[0] == last, keys[1:] == keys[:-1])
            found = np.unique(keys[again])
            if len(found) and sent is not None and found[0] == sent:
                found = found[1:]
            if len(found):
                sent = found[-1]
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["key"])
            last = keys[-1]

    return in_python(rows.select("key").repartition("key").sortWithinPartitions("key"), run, "key long")
