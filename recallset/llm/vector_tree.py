"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree, traversed best bin first.

The upper levels, the trunk, are fitted on the driver to a bounded sample of the vectors and known to every task. Its leaves are cells. Rows of
a cell are dealt into shards of bounded size, and the lower levels are fitted to all rows of a shard in a task of their own, so that the
tree grows with the data while nothing but the trunk leaves its task. A row of the index is a shard with its levels and its vectors.

A traversal goes down to the nearest child, keeps the other children in a priority queue by their distance, and goes on from
the nearest one in the queue. In the trunk it picks the cells of a query, in each shard of such a cell the leaves whose vectors are
measured. How many cells and leaves are visited is calibrated: exact neighbours of a sample of vectors show for each number which
share of them is met, and visits are widened until that is the recall asked for.

Distances for the tree are those of vectors with one more component, which makes all norms equal to the largest one; the nearest
vector by that distance is the one with the largest inner product. Results are inner products of the vectors as given, in
double precision and summed in order of the components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ConfigurationError
from ..session import ship_package
from .common import in_python, stored

BRANCHES, ROUNDS = 16, 8
#: Rows of a leaf, and of a shard; cells are meant to hold one shard.
LEAF_ROWS, SHARD_ROWS = 64, 4096
#: Cells of the trunk; sampled rows for a cell, and bytes of the sample in double precision: the driver holds no more.
MAX_CELLS, FIT_ROWS, FIT_BYTES = 4096, 32, 64 << 20
#: Vectors whose exact neighbours are found to calibrate visits, and queries that meet a shard at a time.
CALIBRATED, QUERY_ROWS = 128, 1024
SEED = 11


def k_means(points: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """The cluster of each point, numbered from 0 without gaps; fewer than k if centres fall together."""
    centres = points[draw.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        own = (distances(points, centres)).argmin(1)
        n = np.bincount(own, minlength=k)
        order = np.argsort(own, kind="stable")
        filled = np.flatnonzero(n)
        begin = np.concatenate([[0], np.cumsum(n[filled])[:-1]])
        centres = np.add.reduceat(points[order], begin, axis=0) / n[filled][:, None]
        k = len(filled)
    own = distances(points, centres).argmin(1)
    return np.unique(own, return_inverse=True)[1]


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, up to a number for each point that does not change the order of its centres."""
    return (centres * centres).sum(1) - 2 * (points @ centres.T)


@dataclass
class Tree:
    """Nodes in breadth-first order: centre, children from `first` to `last` (none for a leaf), and the number of a leaf or -1."""

    centres: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaf: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, leaf_rows: int, seed: int) -> tuple[Tree, np.ndarray]:
        """The tree, and the leaf of each point. Points that k-means cannot tell apart stay in one leaf."""
        draw = np.random.default_rng(seed)
        members, centres, first, last = [np.arange(len(points))], [points.mean(0)], [], []
        node = 0
        while node < len(members):
            own = members[node]
            parts = None
            if len(own) > leaf_rows:
                parts = k_means(points[own], min(BRANCHES, -(-len(own) // leaf_rows)), draw)
            first.append(len(members))
            if parts is not None and parts.max(initial=0) > 0:
                for part in range(parts.max() + 1):
                    members.append(own[parts == part])
                    centres.append(points[members[-1]].mean(0))
            last.append(len(members))
            node += 1
        first, last = np.array(first), np.array(last)
        leaf = np.where(first == last, np.cumsum(first == last) - 1, -1)
        of = np.empty(len(points), np.int64)
        for node in np.flatnonzero(leaf >= 0).tolist():
            of[members[node]] = leaf[node]
        return cls(np.array(centres), first, last, leaf), of

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def descend(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point comes to by the nearest child of each node."""
        out, open_ = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while open_:
            node, own = open_.pop()
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
                continue
            begin, end = int(self.first[node]), int(self.last[node])
            nearest = distances(points[own], self.centres[begin:end]).argmin(1)
            open_ += [(begin + c, own[nearest == c]) for c in np.unique(nearest).tolist()]
        return out

    def visits(self, points: np.ndarray, most: int) -> Iterator[list[int]]:
        """For each point the first `most` leaves, best bin first."""
        first, last, leaf = self.first.tolist(), self.last.tolist(), self.leaf.tolist()
        for row in distances(points, self.centres).tolist():
            found: list[int] = []
            queue = [(row[0], 0)]
            while queue and len(found) < most:
                node = heapq.heappop(queue)[1]
                while leaf[node] < 0:
                    children = range(first[node], last[node])
                    nearest = min(children, key=row.__getitem__)
                    for child in children:
                        if child != nearest:
                            heapq.heappush(queue, (row[child], child))
                    node = nearest
                found.append(leaf[node])
            yield found


@dataclass
class Space:
    """Usable vectors: length, component type, largest component by amount, largest squared norm after division by it, and number."""

    size: int
    kind: np.dtype
    scale: float
    norm: float
    rows: int

    def placed(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Points for the tree: scaled, and with the component that makes up for a shorter norm; queries have 0 there."""
        scaled = vectors.astype(np.float64) / self.scale
        extra = np.zeros(len(scaled)) if query else np.sqrt(np.maximum(0, self.norm - (scaled * scaled).sum(1)))
        return np.column_stack([scaled, extra])


@dataclass
class TreeIndex:
    """`shards` is a stored table; `cells` and `leaves` are the visits that met `recall` of the calibrating neighbours."""

    space: Space
    trunk: Tree
    shards: DataFrame
    cells: int
    leaves: int
    recall: float


def matrix(column: pa.Array, size: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(positions, vectors) of the rows that take part: `size` components, all there and finite, not all 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fits = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(fits)).flatten()
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(fits), size)
    good = np.isfinite(values).all(1) & (values != 0).any(1)
    return fits[good], values[good]


def packed(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    width = values.itemsize * values.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpacked(column, kind: np.dtype, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size)


def single(vectors: DataFrame) -> DataFrame:
    """(id, vector) with each id once: NULL ids are left out, of rows that repeat an id the least vector stays."""
    rows = vectors.select(F.col("id").cast("long").alias("id"), "vector").filter("id IS NOT NULL")
    repeated = rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("vector").alias("vector"))
    return rows.join(repeated, "id", "left_anti").unionByName(one)


def space_of(vectors: DataFrame) -> Space | None:
    """None without a usable vector. Vectors whose length is not the most frequent one (the least of equals) are not usable."""
    lengths = vectors.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    if most is None:
        return None
    size, kind = most["size"], np.dtype(np.float32 if vectors.schema["vector"].dataType.elementType.typeName() == "float" else np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values = matrix(batch.column(0), size, kind)
            if len(values):
                wide = values.astype(np.float64)
                scale = float(np.abs(wide).max())
                norm = float(((wide / scale) ** 2).sum(1).max())
                yield pa.RecordBatch.from_arrays([pa.array([scale]), pa.array([norm]), pa.array([len(values)], pa.int64())], ["scale", "norm", "n"])

    found = in_python(vectors.select("vector"), run, "scale double, norm double, n long")
    whole = found.agg(F.max("scale").alias("scale"), F.sum("n").alias("n")).first()
    if not whole.n:
        return None
    norm = found.agg(F.max(F.col("norm") * F.pow(F.col("scale") / F.lit(whole.scale), F.lit(2))).alias("norm")).first()["norm"]
    return Space(size, kind, whole.scale, norm, whole.n)


def sample(vectors: DataFrame, space: Space, rows: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of usable rows among the `rows` with the least hash of their id; bounded, so it may come to the driver."""
    found = vectors.orderBy(F.xxhash64(F.lit(salt), "id"), "id").limit(rows).toArrow()
    at, values = matrix(found.column("vector"), space.size, space.kind)
    return found.column("id").to_numpy()[at], values


def in_shards(vectors: DataFrame, space: Space, trunk: Tree, seed: int) -> DataFrame:
    """The stored table of shards: every usable vector is in the shard of a cell, with the levels of the tree below it."""
    spark = vectors.sparkSession
    known = spark.sparkContext.broadcast(trunk)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = matrix(batch.column(1), space.size, space.kind)
            cell = known.value.descend(space.placed(values))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column(0).take(pa.array(at)), packed(values)], ["cell", "id", "vector"])

    rows = stored(in_python(vectors.select("id", "vector"), assigned, "cell int, id long, vector binary"), "cells")
    many = rows.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("parts"))  # at most MAX_CELLS rows
    dealt = rows.join(F.broadcast(many), "cell").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def grown(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = unpacked(table.column("vector"), space.kind, space.size)
        # equal vectors are one point of the tree, with the ids of all in ascending order
        ids = table.column("id").to_numpy()
        order = np.lexsort([ids, *values.T])
        ids, values = ids[order], values[order]
        new = np.append(True, (values[1:] != values[:-1]).any(1))
        distinct = values[new]
        tree, leaf = Tree.fit(space.placed(distinct), LEAF_ROWS, seed)
        place = np.argsort(leaf, kind="stable")
        count = np.diff(np.append(np.flatnonzero(new), len(ids)))
        groups = np.split(ids, np.cumsum(count)[:-1])
        ids = np.concatenate([groups[p] for p in place.tolist()])
        leaves = np.bincount(leaf, minlength=tree.leaves)
        whole = [tree.centres, tree.first, tree.last, tree.leaf, leaves, distinct[place], count[place], ids]
        numbers = [pa.array([k.as_py()], pa.int32()) for k in key]
        return pa.Table.from_arrays([*numbers, *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in whole)], ["cell", "shard", *PARTS])

    ship_package(spark)
    schema = "cell int, shard int, " + ", ".join(f"{p} binary" for p in PARTS)
    return stored(dealt.select("cell", "shard", "id", "vector").groupBy("cell", "shard").applyInArrow(grown, schema), "tree-shards")


PARTS = ["centres", "first", "last", "leaf", "leaf_rows", "vectors", "counts", "ids"]


class Shard:
    """A row of the index, read again."""

    def __init__(self, row: dict, space: Space):
        whole = lambda name: np.frombuffer(row[name], np.int64)
        self.tree = Tree(np.frombuffer(row["centres"], np.float64).reshape(-1, space.size + 1), whole("first"), whole("last"), whole("leaf"))
        self.begin = np.concatenate([[0], np.cumsum(whole("leaf_rows"))])
        self.vectors = np.frombuffer(row["vectors"], space.kind).reshape(-1, space.size)
        self.counts, self.ids = whole("counts"), whole("ids")
        self.first_id = np.concatenate([[0], np.cumsum(self.counts)[:-1]])

    def scores(self, queries: np.ndarray, visits: list[list[int]]) -> np.ndarray:
        """Inner products of the queries with the vectors in the leaves they visit, up to rounding; elsewhere -inf."""
        out = np.full((len(queries), len(self.vectors)), -np.inf)
        by_leaf: dict[int, list[int]] = {}
        for q, leaves in enumerate(visits):
            for leaf in leaves:
                by_leaf.setdefault(leaf, []).append(q)
        wide = self.vectors.astype(np.float64)
        for leaf, own in by_leaf.items():
            begin, end = self.begin[leaf], self.begin[leaf + 1]
            out[own, begin:end] = queries[own] @ wide[begin:end].T
        return out

    def nearest(self, ids: np.ndarray, queries: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of the query, id, score, position) of the k best of each query, its own id left out.

        Whatever the rounding of `scores` may have hidden is measured again, component by component. Of equal vectors
        the k + 1 least ids are enough: ties go to the least.
        """
        most = min(k + 1, scores.shape[1])
        least = np.partition(scores, -most, axis=1)[:, -most]
        slack = 1e-12 * queries.shape[1] * np.linalg.norm(queries, axis=1) * np.linalg.norm(self.vectors.astype(np.float64), axis=1).max()
        row, at = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
        exact = np.zeros(len(row))
        for c in range(queries.shape[1]):
            exact += queries[row, c] * self.vectors[at, c].astype(np.float64)
        n = np.minimum(self.counts[at], k + 1)
        begin = np.cumsum(n) - n
        ids_at = np.repeat(self.first_id[at] - begin, n) + np.arange(n.sum())
        row, at, exact, found = np.repeat(row, n), np.repeat(at, n), np.repeat(exact, n), self.ids[ids_at]
        other = found != ids[row]
        row, at, exact, found = row[other], at[other], exact[other], found[other]
        order = np.lexsort([found, -exact, row])
        row, at, exact, found = row[order], at[order], exact[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < k
        return row[keep], found[keep], exact[keep], at[keep]


def calibrated(index: TreeIndex, ids: np.ndarray, queries: np.ndarray, k: int, recall: float) -> TreeIndex:
    """The index with the cheapest visits, in cells times leaves, that meet `recall` of the exact neighbours of the queries.

    One scan of the index finds the neighbours and at which visit of the cell and of the leaf each would be met.
    """
    space, trunk = index.space, index.trunk
    wide = queries.astype(np.float64)
    points = space.placed(queries, query=True)
    cell_visit = np.empty((len(ids), trunk.leaves), np.int64)
    for q, order in enumerate(trunk.visits(points, trunk.leaves)):
        cell_visit[q, order] = np.arange(len(order))
    known = index.shards.sparkSession.sparkContext.broadcast((ids, wide, points, cell_visit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wide, points, cell_visit = known.value
        for batch in batches:
            for row in rows_of(batch):
                shard = Shard(row, space)
                order = list(shard.tree.visits(points, shard.tree.leaves))
                visit = np.empty((len(ids), shard.tree.leaves), np.int64)
                for q, leaves in enumerate(order):
                    visit[q, leaves] = np.arange(len(leaves))
                q, found, score, at = shard.nearest(ids, wide, wide @ shard.vectors.astype(np.float64).T, k)
                leaf = np.searchsorted(shard.begin, at, side="right") - 1
                columns = [q, found, cell_visit[q, row["cell"]], visit[q, leaf]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), pa.array(score)], ["q", "id", "cell_visit", "leaf_visit", "score"])

    met = in_python(index.shards, run, "q long, id long, cell_visit long, leaf_visit long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    met = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("cell_visit", "leaf_visit").toArrow()
    known.unpersist()
    cell, leaf = (met.column(c).to_numpy() for c in ("cell_visit", "leaf_visit"))
    chosen = None
    for cells in sorted({*cell.tolist()}):
        inside = np.sort(leaf[cell <= cells])
        need = int(np.ceil(recall * len(cell)))
        if len(inside) >= need:  # widen the leaves until enough are met
            leaves = int(inside[need - 1])
            if chosen is None or (cells + 1) * (leaves + 1) < chosen[0] * chosen[1]:
                chosen = cells + 1, leaves + 1, float((inside <= leaves).sum() / len(cell))
    index.cells, index.leaves, index.recall = chosen or (trunk.leaves, 1 << 31, 1.0)
    return index


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def build(vectors: DataFrame, k: int = 20, recall: float = 0.95, seed: int = SEED) -> TreeIndex | None:
    """An index of all usable rows of (id, vector), calibrated for `k` neighbours; None if there is no usable row.

    Fitted on samples: the trunk on FIT_ROWS rows a cell and at most FIT_BYTES, the visits on CALIBRATED rows. NULL ids, NULL, empty and zero
    vectors, and those with components that are NULL or not finite, are left out, as are vectors whose length is not the most frequent
    one. Of rows that repeat an id the least vector stays. Other columns are ignored.
    """
    if not 0 < recall <= 1 or k < 1:
        raise ConfigurationError("recall must be above 0 and at most 1, and k at least 1")
    rows = single(vectors)
    space = space_of(rows)
    if space is None:
        return None
    cells = min(MAX_CELLS, -(-2 * space.rows // SHARD_ROWS))
    fit = max(1, min(FIT_ROWS * cells, FIT_BYTES // (8 * (space.size + 1))))
    _, values = sample(rows, space, fit, seed)
    if not len(values):  # the sample met unusable rows only
        return None if not space.rows else _index(rows, space, Tree(np.zeros((1, space.size + 1)), np.array([1]), np.array([1]), np.array([0])), k, recall, seed)
    trunk, _ = Tree.fit(space.placed(values), max(1, -(-len(values) // cells)), seed)
    return _index(rows, space, trunk, k, recall, seed)


def _index(rows: DataFrame, space: Space, trunk: Tree, k: int, recall: float, seed: int) -> TreeIndex:
    index = TreeIndex(space, trunk, in_shards(rows, space, trunk, seed), trunk.leaves, 1 << 31, 1.0)
    ids, queries = sample(rows, space, CALIBRATED, seed + 1)
    return calibrated(index, ids, queries, k, recall) if len(ids) else index


def search(index: TreeIndex, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable query (id, vector) the `k` best vectors met, without the one of its own id.

    The first cell of each query is visited first. Its k-th score is the bound for all further cells: these pass on only what reaches
    it, so that what is ranked in the end does not grow with the number of cells.
    """
    space, spark = index.space, queries.sparkSession
    trunk = spark.sparkContext.broadcast(index.trunk)
    cells = index.cells

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = matrix(batch.column(1), space.size, space.kind)
            if not len(at):
                continue
            order = list(trunk.value.visits(space.placed(values, query=True), cells))
            n = np.array([len(o) for o in order])
            own = np.repeat(np.arange(len(at)), n)
            visit = np.concatenate([np.arange(len(o)) for o in order])
            columns = [pa.array(np.concatenate(order), pa.int32()), pa.array(visit, pa.int32()), batch.column(0).take(pa.array(at[own])), packed(values[own])]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "visit", "id", "vector"])

    asked = stored(in_python(single(queries), routed, "cell int, visit int, id long, vector binary"), "routed")
    first = stored(best(measured(index, asked.filter("visit = 0").withColumn("bound", F.lit(float("-inf"))), k), k), "first-cell")
    bounds = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    further = asked.filter("visit > 0").join(bounds, "id", "left").fillna(float("-inf"), ["bound"])
    return best(first.drop("rank").unionByName(measured(index, further, k)), k)


def best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def measured(index: TreeIndex, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the at most `k` best vectors of each shard for rows (cell, id, vector, bound), if they reach the bound.

    Queries of a cell are bundled, at most about QUERY_ROWS together, and each bundle meets each shard of the cell.
    """
    space, leaves = index.space, index.leaves
    many = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))  # a row for each cell
    asked = asked.join(F.broadcast(many), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def bundled(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, bounds = (table.column(c).to_numpy().tobytes() for c in ("id", "bound"))
        values = b"".join(table.column("vector").to_pylist())
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), *(pa.array([x], pa.binary()) for x in (ids, bounds, values))], ["cell", "query_ids", "bounds", "queries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                shard = Shard(row, space)
                ids, bounds = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["bounds"], np.float64)
                values = np.frombuffer(row["queries"], space.kind).reshape(-1, space.size)
                visits = list(shard.tree.visits(space.placed(values, query=True), leaves))
                wide = values.astype(np.float64)
                q, found, score, _ = shard.nearest(ids, wide, shard.scores(wide, visits), k)
                keep = score >= bounds[q]
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[keep]]), pa.array(found[keep]), pa.array(score[keep])], ["query_id", "vec_id", "score"])

    ship_package(asked.sparkSession)
    bundles = asked.select("cell", "block", "id", "bound", "vector").groupBy("cell", "block")
    bundles = bundles.applyInArrow(bundled, "cell int, query_ids binary, bounds binary, queries binary")
    return in_python(index.shards.join(bundles, "cell"), run, "query_id long, vec_id long, score double")


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.95) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (id, vector) whose id `every` divides, against all rows; empty without a usable row."""
    index = build(vectors, k, recall)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, vectors.filter(F.col("id") % every == 0), k)
