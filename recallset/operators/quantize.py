"""Arrow-batch helpers of the index: closest lists, value ranges, 8-bit codes.

Vectors are taken at unit length. Cosine distance does not change by that, and no code can stand for a
vector without direction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .kernel import (
    PAIRS_PER_STEP,
    cosine_distances,
    matrix,
    rounding_margin,
    sum_products,
    unit_singles,
)

LEVELS = 255.0


def unit_rows(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and which rows have a direction at all."""
    vectors = matrix(column, dimensions).astype(np.float64, copy=False)
    square = sum_products(vectors, vectors)
    usable = np.isfinite(square) & (square > 0)
    with np.errstate(all="ignore"):
        return vectors / np.sqrt(square)[:, None], usable


def closest_lists(column: pa.Array, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``n`` lists with the nearest centroids, ties to the lower number; and usable rows."""
    dimensions = centroids.shape[1]
    vectors = matrix(column, dimensions)
    unit, usable = unit_singles(vectors)
    square = sum_products(vectors, vectors)
    c_square = sum_products(centroids, centroids)
    c_unit, _ = unit_singles(centroids)
    margin = rounding_margin(dimensions)
    out = np.full((len(vectors), n), -1, dtype=np.int32)
    rows = np.flatnonzero(usable)
    height = max(PAIRS_PER_STEP // len(centroids), 1)
    for a in range(0, len(rows), height):
        rs = rows[a : a + height]
        approx = 1.0 - unit[rs] @ c_unit.T
        limit = np.partition(approx, n - 1, axis=1)[:, n - 1] + margin
        ri, ci = np.nonzero(approx <= limit[:, None])
        dot = sum_products(vectors[rs[ri]], centroids[ci])
        distance = cosine_distances(dot, square[rs[ri]], c_square[ci])
        by = np.lexsort((ci, distance, ri))
        place = np.arange(len(by)) - np.searchsorted(ri[by], ri[by])
        keep = by[place < n]
        out[rs[ri[keep]], place[place < n]] = ci[keep]
    return out, usable


def value_ranges(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """One row per dimension with the smallest and largest value of these batches."""
    low = np.full(dimensions, np.inf)
    high = np.full(dimensions, -np.inf)
    for batch in batches:
        unit, usable = unit_rows(batch.column(0), dimensions)
        if usable.any():
            low = np.minimum(low, unit[usable].min(axis=0))
            high = np.maximum(high, unit[usable].max(axis=0))
    if np.isfinite(low).all():
        columns = [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(low), pa.array(high)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "low", "high"])


def encode(column: pa.Array, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """One byte per dimension; NULL for a row without direction."""
    unit, usable = unit_rows(column, len(low))
    width = np.where(high > low, high - low, 1.0)
    with np.errstate(all="ignore"):
        codes = np.where(high > low, np.floor((unit - low) / width * LEVELS + 0.5), 0.0)
        codes = np.clip(np.nan_to_num(codes), 0, LEVELS).astype(np.uint8)
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * len(low)
    data = pa.BinaryArray.from_buffers(
        pa.binary(), len(codes), [None, pa.py_buffer(offsets), pa.py_buffer(codes.tobytes())]
    )
    return data if usable.all() else pa.array(
        [v if ok else None for v, ok in zip(data.to_pylist(), usable)], pa.binary()
    )
