"""Sets of word shingles as sorted 64-bit numbers, made for many texts at a time, and what joins of such sets share.

Words are runs of characters other than ASCII white space, with A-Z in lower case. A text with fewer words than a shingle is
one shingle as a whole; one without words has no shingle. Equal shingles have equal numbers; unequal ones differ but for a chance
of 2 ** -64, and sets are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, in_python, slices

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: More members than this are compared block against block, each pair of blocks in a group of its own.
BLOCK = 512
SKETCH_BITS = 1024


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return (x ^ (x >> np.uint64(29))) * _A ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending, and so for the same set the same array."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, row = words.flatten(), np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = flat.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in coded.dictionary), np.uint64, len(coded.dictionary))
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    word = hashes[coded.indices.to_numpy(zero_copy_only=False)[there]] if len(flat) else np.zeros(0, np.uint64)
    row = row[there]
    count = np.bincount(row, minlength=len(words))
    begin = np.concatenate([[0], np.cumsum(count)])
    rolled = word.copy()
    for k in range(1, width):
        rolled[: max(0, len(word) - k)] = mixed(rolled[: max(0, len(word) - k)] * _A + word[k:])
    out = []
    for i, n in enumerate(count.tolist()):
        at = begin[i]
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for k in range(at, at + n):
                whole = mixed(whole * _A + word[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def text_parts(batches: Iterator[pa.RecordBatch], at: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut to about a megabyte of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        for begin, end in slices(sizes, most):
            yield batch.slice(begin, end - begin)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows again, cut so that rows with equal values in the first `keys` columns stay in one batch."""
    open_rows: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1] for c in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for c, value in enumerate(last):
            same &= pc.equal(batch.column(c), value).to_numpy(zero_copy_only=False)
        cut = batch.num_rows if not same.any() else int(np.argmax(same))
        if cut:
            yield pa.concat_batches([*open_rows, batch.slice(0, cut)])
            open_rows = []
        open_rows.append(batch.slice(cut))
        if cut == 0 and len(open_rows) > 64:
            open_rows = [pa.concat_batches(open_rows)]
    if open_rows:
        yield pa.concat_batches(open_rows)


def ids_matrix(column: pa.Array) -> np.ndarray:
    """A column of 16-byte ids as two numbers a row."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 2) if len(column) else np.zeros((0, 2), ">u8")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node of undirected `edges` (a, b), root being the least node reachable.

    Large-star and small-star steps in turn, each one aggregation and one join, written to the shared folder, until
    only stars are left. All state is in tables of `scratch`, of which the last one stays.
    """
    edges = scratch.stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).filter("up > 1 OR up > 0 AND down > 0").isEmpty():
            break  # every node has one edge, to a node without another: stars
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, scratch.stored(small.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        scratch.drop(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def spread(members: DataFrame, named: DataFrame) -> DataFrame:
    """Members (root, id, …) of clusters as rows of groups (root, p, q): all within block p, or of the blocks p and q.

    `named` is (root, id), once for each member: clusters are counted there, so the wide rows are made once.

    Clusters of up to BLOCK members are one group. A larger one is cut into blocks by a hash of the id, and each member is
    sent to the groups of its block with every other, so no task holds more than two blocks.
    """
    sizes = named.groupBy("root").agg(F.count("*").alias("members")).filter("members > 1")
    blocks = sizes.select("root", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = members.join(blocks, "root").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")}).drop("blocks", "other")


def groups_of(rows: DataFrame, keys: list[str], columns: list[str], function, schema: str) -> DataFrame:
    """`function` over all rows of each value of `keys`, many groups a batch, in sorted order of `columns`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, len(keys)):
            change = np.zeros(batch.num_rows, bool)
            change[0] = True
            for c in range(len(keys)):
                column = batch.column(c)
                change[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(change).tolist()
            for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                if end - begin > 1:
                    yield from function(batch.slice(begin, end - begin))

    return in_python(rows.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys, *columns), run, schema)


def sketches(sets: list[np.ndarray], bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity sketches: each token flips one of `bits` bits, so two sketches differ in no more bits than the sets in tokens."""
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for i, tokens in enumerate(sets):
        parity = np.bincount((mixed(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out[i] = np.packbits(parity.astype(np.uint8)).view(np.uint64)
    return out


def shared_tokens(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
