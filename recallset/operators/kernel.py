"""Arrow-batch helper: the nearest rows of one task for a block of query vectors.

A single-precision matrix product finds the rows that can be among the nearest; only those are
measured again in double precision, summed left to right as the column functions do. So the result
does not depend on how rows fall into batches and tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PAIRS_PER_STEP = 1 << 21
PAIRS_AT_ONCE = 512
# Queries and pairs of a tile, whose products stay in a core's cache.
TILE_QUERIES = 512
TILE_PAIRS = 1 << 18
BUFFERED_HITS = 1 << 12
CROWD = 1 << 12
WILDCARD = -2
NO_MATCH = -1


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column as a matrix of its own precision; every list must have the given length."""
    flat = column.flatten()
    if len(flat) != len(column) * dimensions:
        raise ValueError("every vector must have the declared number of dimensions")
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def code_matrix(column: pa.Array, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A column of one-byte-per-dimension codes as a double matrix."""
    fixed = column.cast(pa.binary(len(low)))
    size = len(fixed) * len(low)
    raw = np.frombuffer(fixed.buffers()[1], np.uint8, size, fixed.offset * len(low))
    codes = raw.reshape(len(fixed), len(low)).astype(np.float64)
    return low + codes * (high - low) / 255.0


def sum_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise dot products in double precision, added left to right as a running sum is."""
    products = a.astype(np.float64, copy=False) * b.astype(np.float64, copy=False)
    return np.cumsum(products, axis=1, out=products)[:, -1]


def pair_products(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray) -> np.ndarray:
    """:func:`sum_products` of the rows ``at`` of ``a`` and ``bt`` of ``b``. A few pairs at a time are copied to where the next ones go too."""
    n, dimensions = len(at), a.shape[1]
    out = np.empty(n)
    left, right = (np.empty((PAIRS_AT_ONCE, dimensions), x.dtype) for x in (a, b))
    across = np.zeros((dimensions, PAIRS_AT_ONCE))
    for i in range(0, n, PAIRS_AT_ONCE):
        m = min(PAIRS_AT_ONCE, n - i)
        np.take(a, at[i : i + m], axis=0, out=left[:m], mode="clip")
        np.take(b, bt[i : i + m], axis=0, out=right[:m], mode="clip")
        across[:, :m] = np.multiply(left[:m], right[:m], dtype=np.float64).T
        out[i : i + m] = np.add.reduce(across, axis=0)[:m]  # one dimension after the other, as all columns are added at once
    return out


def unit_singles(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors at about unit length in single precision, and which of them have a direction."""
    square = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
    usable = np.isfinite(square) & (square > 0)
    norm = np.sqrt(np.where(usable, square, 1.0))
    if norm.min(initial=1.0) < 1e-30 or norm.max(initial=1.0) > 1e30:
        vectors = vectors.astype(np.float64)
    else:
        norm = norm.astype(vectors.dtype)
    with np.errstate(all="ignore"):
        return (vectors / norm[:, None]).astype(np.float32, copy=False), usable


def cosine_distances(dot: np.ndarray, a_square: np.ndarray, b_square: np.ndarray) -> np.ndarray:
    return 1.0 - np.clip(dot / np.sqrt(a_square * b_square), -1.0, 1.0)


def rounding_margin(dimensions: int) -> float:
    """More than a single-precision dot product of two unit vectors can be off, both ways."""
    return 4.0 * (dimensions + 8) * 2.0**-24


@dataclass
class Queries:
    """A block of query rows; ``keys`` holds one array per equality field, null for no condition."""

    q_id: pa.Array
    vectors: np.ndarray
    limits: np.ndarray
    keys: list[pa.Array]
    before: np.ndarray | None = None

    @staticmethod
    def from_table(table: pa.Table, dimensions: int, fields: Sequence[str], before: str | None) -> "Queries":
        table = table.combine_chunks()

        def column(name: str) -> pa.Array:
            chunks = table.column(name)
            return chunks.chunk(0) if chunks.num_chunks else pa.array([], chunks.type)

        return Queries(
            q_id=column("q_id"),
            vectors=matrix(column("qv"), dimensions).astype(np.float64, copy=False),
            limits=column("limit").to_numpy(zero_copy_only=False).astype(np.int64),
            keys=[column(name) for name in fields],
            before=None if before is None else column(before).to_numpy(zero_copy_only=False),
        )


class _Conditions:
    """Query rows that constrain the same fields, grouped by the values they ask for."""

    def __init__(self, queries: Queries, which: tuple[int, ...], rows: np.ndarray):
        self.which = which
        self.value_sets = []
        self.pair_levels = []
        code = np.zeros(len(rows), dtype=np.int64)
        for f in which:
            wanted = queries.keys[f].take(pa.array(rows))
            values = wanted.unique()
            self.value_sets.append(values)
            pair = code * len(values) + pc.index_in(wanted, value_set=values).to_numpy()
            levels, code = np.unique(pair, return_inverse=True)
            self.pair_levels.append(levels)
        order = np.argsort(code, kind="stable")
        starts = np.searchsorted(code[order], np.arange(code.max() + 2 if len(code) else 1))
        self.groups = [rows[order[a:b]] for a, b in zip(starts[:-1], starts[1:])]

    def row_codes(self, columns: Sequence[pa.Array], n: int) -> np.ndarray:
        """Per corpus row the number of the group it answers, or NO_MATCH."""
        code = np.zeros(n, dtype=np.int64)
        for f, values, levels in zip(self.which, self.value_sets, self.pair_levels):
            found = pc.fill_null(pc.index_in(columns[f], value_set=values, skip_nulls=True), NO_MATCH)
            found = found.to_numpy(zero_copy_only=False).astype(np.int64)
            pair = code * len(values) + found
            at = np.minimum(np.searchsorted(levels, pair), len(levels) - 1)
            code = np.where((code >= 0) & (found >= 0) & (levels[at] == pair), at, NO_MATCH)
        return code


def _owners(queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Per query row the number of its query, and per query its first row. Rows of one ``q_id`` and limit, as of several lists to
    scan, are one query."""
    if pa.types.is_nested(queries.q_id.type):
        rows = np.arange(len(queries.limits))
        return rows, rows
    code = pc.dictionary_encode(queries.q_id, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    pair = np.stack([code.astype(np.int64), queries.limits], axis=1)
    _, first, owner = np.unique(pair, axis=0, return_index=True, return_inverse=True)
    return owner.reshape(-1), first


class LocalNearest:
    """Keeps, per query, the nearest ``limit`` corpus rows seen so far."""

    def __init__(self, queries: Queries, strict: bool, tie_by_order: bool, digits: int | None = None):
        self.q = queries
        self.strict = strict
        self.tie_by_order = tie_by_order
        self.dimensions = queries.vectors.shape[1]
        self.digits = digits
        self.margin = rounding_margin(self.dimensions) + (0.0 if digits is None else 2 * 10.0**-digits)
        self.q_square = sum_products(queries.vectors, queries.vectors)
        self.q_unit, usable = unit_singles(queries.vectors)
        if strict and not usable.all():
            raise ValueError("the vector distance is not a finite number: a query vector has no direction")
        self.owner, self.first = _owners(queries)
        self.limits = queries.limits[self.first]
        self.wanted = int(self.limits.sum())
        self.bound = np.full(len(self.limits), np.inf)
        self.hits: list[tuple] = []
        self.buffered = 0
        self.pending: list[tuple] = []
        self.n_pending = 0
        self.conditions = self._conditions(usable)

    def _conditions(self, usable: np.ndarray) -> list[_Conditions]:
        rows = np.flatnonzero(usable)
        shape = np.zeros(len(rows), dtype=np.int64)
        for f, key in enumerate(self.q.keys):
            given = key.is_valid().to_numpy(zero_copy_only=False)[rows]
            shape |= given.astype(np.int64) << f
        out = []
        for bits in np.unique(shape):
            which = tuple(f for f in range(len(self.q.keys)) if bits >> f & 1)
            out.append(_Conditions(self.q, which, rows[shape == bits]))
        return out

    def add(self, batch: pa.RecordBatch, vectors: np.ndarray, keys: Sequence[pa.Array], order: np.ndarray | None) -> None:
        if not len(vectors):
            return
        unit, usable = unit_singles(vectors)
        for condition in self.conditions:
            code = condition.row_codes(keys, len(vectors))
            if self.strict and not usable[code >= 0].all():
                raise ValueError("the vector distance is not a finite number: a stored vector has no direction")
            rows = np.flatnonzero((code >= 0) & usable)
            rows = rows[np.argsort(code[rows], kind="stable")]
            cuts = np.flatnonzero(np.diff(code[rows])) + 1
            for part in np.split(rows, cuts):
                if len(part):
                    self._match(batch, vectors, unit, order, part, condition.groups[code[part[0]]])
        self._settle(batch, vectors, order, 0)

    def _match(self, batch, vectors, unit, order, rows, asked) -> None:
        """Note the rows that can be among the nearest of the queries ``asked``, a tile of both after the other.

        What a tile finds is kept by number and single-precision product only, until there is twice as much as the queries want:
        their bounds are then set by the best of it, and what lies beyond them goes.
        """
        whole = len(rows) == len(unit)
        width = min(len(asked), TILE_QUERIES)
        height = max(TILE_PAIRS // width, 1)
        for a in range(0, len(asked), width):
            qs = asked[a : a + width]
            owners, local = np.unique(self.owner[qs], return_inverse=True)
            k, wanted = int(self.q.limits[qs].max()), int(self.q.limits[qs].sum())
            asking = self.q_unit[qs]
            dots, near = np.empty(len(qs) * height, np.float32), np.empty(len(qs) * height, bool)
            reach = self._reach(qs)
            found, n_found = [], 0
            for b in range(0, len(rows), height):
                rs = rows[b : b + height]
                shape = len(qs), len(rs)
                dot, hit = (x[: len(qs) * len(rs)].reshape(shape) for x in (dots, near))
                np.matmul(asking, (unit[b : b + height] if whole else unit[rs]).T, out=dot)
                if order is not None:
                    dot[order[rs][None, :] >= self.q.before[qs][:, None]] = -np.inf
                np.greater_equal(dot, reach[:, None], out=hit)
                n = np.count_nonzero(hit)
                if n > CROWD + 2 * wanted and len(rs) > k:
                    kth = np.partition(dot, len(rs) - k, axis=1)[:, len(rs) - k].astype(np.float64)
                    np.minimum.at(self.bound, self.owner[qs], 1.0 - kth + self.margin)
                    reach = self._reach(qs)
                    np.greater_equal(dot, reach[:, None], out=hit)
                    n = np.count_nonzero(hit)
                if n > CROWD + 4 * wanted:
                    some = np.flatnonzero(hit.any(axis=0))
                    hit[:, some[self._late_copies(batch, vectors, order, rs[some], k)]] = False
                at = _true(hit)
                if not len(at):
                    continue
                qi, ri = np.divmod(at, len(rs))
                found.append((qi, rs[ri], dot.reshape(-1)[at]))
                n_found += len(at)
                if n_found > BUFFERED_HITS + 2 * wanted:
                    qi, ri, d = (np.concatenate(x) for x in zip(*found))
                    kth = _kth(local[qi], -d, self.limits[owners])
                    self.bound[owners] = np.minimum(self.bound[owners], 1.0 + kth + self.margin)
                    reach = self._reach(qs)
                    keep = d >= reach[qi]
                    found, n_found = [(qi[keep], ri[keep], d[keep])], np.count_nonzero(keep)
                    if n_found > BUFFERED_HITS + 3 * wanted // 2:  # a crowd of about equal rows: their ids decide
                        self._measure(batch, vectors, order, qs[qi[keep]], ri[keep])
                        found, n_found = [], 0
                        reach = self._reach(qs)
            if found:
                qi, ri, d = (np.concatenate(x) for x in zip(*found))
                self.pending.append((qs[qi], ri, d))
                self.n_pending += len(qi)
                if self.n_pending > BUFFERED_HITS + 3 * self.wanted:
                    self._settle(batch, vectors, order, BUFFERED_HITS + 2 * self.wanted)

    def _settle(self, batch, vectors, order, most: int) -> None:
        """Drop pending rows that lie beyond the bounds, and measure the others if there are more than ``most``."""
        if not self.n_pending:
            return
        q, r, d = (np.concatenate(x) for x in zip(*self.pending))
        self.pending, self.n_pending = [], 0
        self.bound = np.minimum(self.bound, 1.0 + _kth(self.owner[q], -d, self.limits) + self.margin)
        keep = d >= self._reach(q)
        q, r, d = q[keep], r[keep], d[keep]
        if len(q) > most:
            self._measure(batch, vectors, order, q, r)
        else:
            self.pending, self.n_pending = [(q, r, d)], len(q)

    def _reach(self, qs: np.ndarray) -> np.ndarray:
        """The least product of unit vectors, per query row, that can be a hit; more than minus infinity."""
        return np.maximum(1.0 - (self.bound[self.owner[qs]] + self.margin), -2.0).astype(np.float32)

    def _measure(self, batch, vectors, order, qi, ri) -> None:
        step = max(PAIRS_PER_STEP // self.dimensions, 1)
        for a in range(0, len(qi), step):
            q, r = qi[a : a + step], ri[a : a + step]
            rows, back = np.unique(r, return_inverse=True)
            square = sum_products(vectors[rows], vectors[rows])[back]
            dot = pair_products(vectors, r, self.q.vectors, q)
            distance = cosine_distances(dot, square, self.q_square[q])
            if self.digits is not None:
                distance = np.round(distance, self.digits)
            q = self.owner[q]
            keep = distance <= self.bound[q]
            q, r, distance = q[keep], r[keep], distance[keep]
            if not len(q):
                continue
            took = pa.array(r)
            self.hits.append(
                (
                    q,
                    distance,
                    batch.column("doc_key").take(took),
                    batch.column("id").take(took),
                    np.zeros(len(r), np.int64) if order is None else order[r],
                )
            )
            self.buffered += len(q)
            if self.buffered > BUFFERED_HITS + 2 * self.wanted:
                self._prune()
                if self.buffered > BUFFERED_HITS + 3 * self.wanted // 2:
                    self._compact()

    def _prune(self) -> None:
        """Drop hits beyond the ``limit`` nearest of their query, but not those about as far as the last of these."""
        q, distance = (np.concatenate([h[i] for h in self.hits]) for i in (0, 1))
        kth = _kth(q, distance.astype(np.float32), self.limits)
        self.bound = np.minimum(self.bound, kth + self.margin)
        kept = []
        for h in self.hits:
            keep = h[1] <= self.bound[h[0]]
            took = pa.array(keep)
            kept.append((h[0][keep], h[1][keep], h[2].filter(took), h[3].filter(took), h[4][keep]))
        q, distance, doc_key, id_, order = zip(*kept)
        self.hits = [(np.concatenate(q), np.concatenate(distance), pa.concat_arrays(doc_key), pa.concat_arrays(id_), np.concatenate(order))]
        self.buffered = len(self.hits[0][0])

    def _late_copies(self, batch, vectors, order, rows, most) -> np.ndarray:
        """Which rows have at least ``most`` equal rows before them in tie order; they can never be a hit."""
        group = _copy_groups(vectors[rows])
        rank = _tie_rank(batch, order if self.tie_by_order else None, rows)
        by = np.lexsort((rank, group))
        ordered = group[by]
        place = np.arange(len(by)) - np.searchsorted(ordered, ordered)
        late = np.zeros(len(rows), dtype=bool)
        late[by[(place >= most) & (ordered >= 0)]] = True
        return late

    def _compact(self) -> pa.Table | None:
        if not self.hits:
            return None
        q = np.concatenate([h[0] for h in self.hits])
        distance = np.concatenate([h[1] for h in self.hits])
        doc_key = pa.concat_arrays([h[2] for h in self.hits])
        id_ = pa.concat_arrays([h[3] for h in self.hits])
        order = np.concatenate([h[4] for h in self.hits])
        table = pa.table({"q": q, "distance": distance, "ord": order, "id": id_, "doc_key": doc_key})
        by = np.lexsort((distance, q))
        sorted_q, sorted_distance = q[by], distance[by]
        tied = np.flatnonzero((sorted_q[1:] == sorted_q[:-1]) & (sorted_distance[1:] == sorted_distance[:-1]))
        if len(tied):  # only they need the names
            tied = np.union1d(tied, tied + 1)
            ties = ["ord", "id", "doc_key"] if self.tie_by_order else ["id", "doc_key"]
            keys = [(c, "ascending") for c in ["q", "distance", *ties]]
            by[tied] = by[tied][pc.sort_indices(table.take(pa.array(by[tied])), sort_keys=keys).to_numpy()]
        place = np.arange(len(sorted_q)) - np.searchsorted(sorted_q, sorted_q)
        limits = self.limits[sorted_q]
        keep = place < limits
        at = by[keep]
        last = by[place == limits - 1]
        self.bound[q[last]] = np.minimum(self.bound[q[last]], distance[last])
        took = pa.array(at)
        self.hits = [(q[at], distance[at], doc_key.take(took), id_.take(took), order[at])]
        self.buffered = len(at)
        return table.take(took)

    def result(self) -> pa.Table | None:
        return self._compact()


def _true(mask: np.ndarray) -> np.ndarray:
    """Where a contiguous mask holds, counted through all its rows. Eight values at a time are looked at first."""
    flat = mask.reshape(-1)
    n = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:n].view(np.uint64)) * 8
    at = (words[:, None] + np.arange(8)).reshape(-1)
    return np.concatenate([at[flat[at]], np.flatnonzero(flat[n:]) + n])


def _kth(group: np.ndarray, value: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Per group the ``limit``-th smallest of its values, which are in single precision; infinite for a group that has fewer."""
    bits = value.view(np.uint32)
    bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))  # in the order of the values
    key = np.sort((group.astype(np.uint64) << np.uint64(32)) | bits)
    counts = np.bincount(group, minlength=len(limits))
    full = counts >= limits
    last = (key[(np.cumsum(counts) - counts + limits - 1)[full]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = np.full(len(limits), np.inf)
    out[full] = np.where(last >> 31, last ^ np.uint32(1 << 31), ~last).view(np.float32)
    return out


def _copy_groups(vectors: np.ndarray) -> np.ndarray:
    """A group number for every row that has an equal row among these, -1 for the others."""
    bits = np.ascontiguousarray(vectors).view(f"u{vectors.itemsize}").astype(np.uint64)
    weights = np.random.default_rng(7).integers(1, 2**63, bits.shape[1], dtype=np.uint64) * 2 + 1
    with np.errstate(over="ignore"):
        mixed = ((bits ^ (bits >> np.uint64(29))) * weights).sum(axis=1, dtype=np.uint64)
    _, first, group, counts = np.unique(mixed, return_index=True, return_inverse=True, return_counts=True)
    several = counts[group] > 1
    same = several.copy()
    same[several] = (bits[several] == bits[first[group[several]]]).all(axis=1)
    return np.where(same, group, -1)


def _tie_rank(batch: pa.RecordBatch, order: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    took = pa.array(rows)
    table = pa.table(
        {
            "ord": np.zeros(len(rows)) if order is None else order[rows],
            "id": batch.column("id").take(took),
            "doc_key": batch.column("doc_key").take(took),
        }
    )
    by = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ["ord", "id", "doc_key"]])
    rank = np.empty(len(rows), dtype=np.int64)
    rank[by.to_numpy()] = np.arange(len(rows))
    return rank


def nearest_in_batches(
    batches: Iterable[pa.RecordBatch],
    queries: Queries,
    dimensions: int,
    fields: Sequence[str],
    before: str | None,
    strict: bool,
    ranges: tuple[np.ndarray, np.ndarray] | None = None,
    digits: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows ``(q_id, limit, doc_key, id, ord, distance)`` nearest to each query within these batches.

    ``before`` names a whole-number column on both sides: a row is a candidate only where its value is
    below the query's, and equal distances are then settled by it. ``ranges`` says that the vectors
    are 8-bit codes. Distances are rounded to ``digits`` before they are compared.
    """
    local = LocalNearest(queries, strict, before is not None, digits)
    for batch in batches:
        vectors = (
            matrix(batch.column("vector"), dimensions)
            if ranges is None
            else code_matrix(batch.column("vector"), *ranges)
        )
        order = None if before is None else batch.column(before).to_numpy(zero_copy_only=False)
        local.add(batch, vectors, [batch.column(f) for f in fields], order)
    table = local.result()
    if table is None:
        return
    q = pa.array(local.first[table.column("q").to_numpy()])
    out = pa.table(
        {
            "q_id": queries.q_id.take(q),
            "limit": pa.array(queries.limits[q.to_numpy()], pa.int32()),
            "doc_key": table.column("doc_key"),
            "id": table.column("id"),
            "ord": table.column("ord"),
            "distance": table.column("distance"),
        }
    )
    yield from out.to_batches()
