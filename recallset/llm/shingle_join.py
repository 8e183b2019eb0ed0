"""N-gram Jaccard join: parity sketches per size band, a pigeonhole join on their segments, then verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import bitmap, held, repeated
from .common import Scratch, in_python, stored
from .sets import components, groups_of, ids_matrix, mixed, set_id, shared_tokens, shingle_sets, sketches, spread, text_parts

#: Documents of a cluster are sent to the scan of texts by broadcast up to so many rows of 40 bytes, else by a shuffled join.
BROADCAST_ROWS = 500_000
#: Sets already seen by a Python worker's task: their copies need no buckets again.
SEEN_SETS = 200_000
#: Keys that several sets have are marked in a bitmap of 2 to this power bits, 16 MB, before ids are sent under them.
KEY_BITS = 27
#: The sets of a key are held against each other if it has no more than this.
WINDOW = 1024


class Threshold:
    """Sets link when 100 * intersection >= percent * union.

    Then the symmetric difference is at most (100 - percent) / percent of the intersection, and so of the smaller set;
    and the sizes differ by no more. Sizes are cut into bands so wide that partners lie in the same band or in two
    neighbouring ones.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.cuts: dict[tuple[int, int], tuple[int, int]] = {}

    def most(self, smaller: int) -> int:
        """The largest symmetric difference of a link whose smaller set has so many tokens."""
        return (100 - self.percent) * smaller // self.percent

    def links(self, a: int, b: int, shared: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def cut(self, low: int, high: int) -> tuple[int, int]:
        """Segments for the join of sets of `low` tokens and more whose smaller one has up to `high`; and how many of a set's may be
        empty for it to leave those out.

        Two linked sets agree in one segment more than that number at least, so in one with tokens, unless more are empty in
        both. Empty segments agree in unlike sets as well; a set with so many is rare, and then offers the empty ones too.
        """
        if (low, high) not in self.cuts:
            least, spare = self.most(high) + 1, 0
            while True:
                segments, each = least + spare, low / (least + spare)
                empty = segments * math.exp(-each)
                # mean and four deviations of the empty segments; as segments grow this falls behind `spare`, as each token gets its own
                if spare >= empty + 4 * math.sqrt(max(0.0, empty * (1 - (1 + each) * math.exp(-each)))):
                    break
                spare += 1
            self.cuts[low, high] = segments, spare
        return self.cuts[low, high]

    def edges(self, size: int) -> list[int]:
        """Lower ends of the bands up to the one of `size`, and the next; the first is the least size that can differ at all."""
        out = [next((n for n in range(1, 101) if self.most(n) >= 1), 1 << 62)]
        while out[-1] <= size:
            out.append(out[-1] * 100 // self.percent + 1)
        return out


def buckets(tokens: np.ndarray, rule: Threshold, edges: list[int]) -> list[tuple[int, np.ndarray]]:
    """The keys under which a set looks for partners, by the least size of each join; linked sets that are not equal share at least one.

    A set is in the join of its own band and in that of the band below. The join of band k cuts the space of tokens
    into more segments than a linked pair can differ in tokens, so that two linked sets agree in one (see `cut`). A segment's sketch
    is the exclusive or of the tokens in it. Where a pair can differ by one token only, a set offers itself and
    itself without each of its tokens.
    """
    n, out = len(tokens), []
    if n < edges[0]:
        return out
    band = int(np.searchsorted(edges, n, side="right")) - 1
    for k in (band, band - 1):
        if k < 0:
            continue
        if rule.most(edges[k + 1] - 1) == 1:
            whole = np.bitwise_xor.reduce(tokens)
            out.append((edges[k], mixed(np.append(tokens ^ whole, whole) ^ np.uint64(k))))
            continue
        segments, spare = rule.cut(edges[k], edges[k + 1] - 1)
        at = ((tokens >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(at, prepend=np.uint64(segments)))
        filled = at[first]
        parity = np.bitwise_xor.reduceat(tokens, first)
        if segments - len(filled) > spare:
            empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), filled)
            filled, parity = np.concatenate([filled, empty]), np.concatenate([parity, np.zeros(len(empty), np.uint64)])
        out.append((edges[k], mixed(parity ^ mixed((filled + np.uint64(1)) * np.uint64(1_000_003) + np.uint64(k)))))
    return out


def shingled(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_id) per row of `docs`; set_id is NULL without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, 2):
            sets = shingle_sets(part.column(2), width)
            columns = [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "set_id"])

    return in_python(keyed(docs), run, "doc_id long, text_hash long, n_shingles long, set_id binary")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def linked(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, root) per row of `docs`.

    component_id is the smallest doc_id reachable over links, which join documents whose sets of shingles share at least `percent`
    per cent of their union. NULL and empty texts have no shingle and no link. Equal sets are joined once, whatever their number. Rows may
    repeat a doc_id; NULL doc_ids take part, and their component_id is NULL if all of the component are. root is
    the same for the rows of one component and for no others, whatever their doc_ids; it is NULL without shingles. Other columns of
    `docs` are ignored.
    """
    rule = Threshold(percent)
    spark = docs.sparkSession
    rows = stored(shingled(docs, width), "shingled")
    with Scratch(spark) as scratch:
        shared = spark.sparkContext.broadcast(bitmap(repeated(in_python(docs.select("text"), bucketed(rule, width, None), "key long")), KEY_BITS))
        scratch.free()
        keys = in_python(docs.select("text"), bucketed(rule, width, shared), "key long, set_id binary, n int, sketch binary")
        keys = keys.repartition("key").sortWithinPartitions("key", "set_id")
        clusters = components(in_python(keys, lambda batches: within(batches, rule), "a binary, b binary"), scratch)
        scratch.free()
        first = rows.filter("set_id IS NOT NULL").select(F.col("set_id").alias("node"), "doc_id", "text_hash").join(clusters, "node")
        first = scratch.stored(first.groupBy("node", "root").agg(F.min(F.struct("doc_id", "text_hash")).alias("at")).select("root", F.col("node").alias("id"), "at.*"), "cluster-members")
        members = texts_of(docs, first).select("root", "id", "text").transform(lambda d: _tokens(d, width))

        def verified(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            yield from tree(group, rule)

        links = groups_of(spread(members, first), ["root", "p", "q"], ["own", "id", "tokens"], verified, "a binary, b binary")
        joined = components(links, scratch)
        scratch.free()
        sets = rows.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"))
        sets = sets.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        whole = sets.groupBy("root").agg(F.min("least").alias("component_id"))
        named = sets.join(whole, "root").select("set_id", "component_id", "root")
        out = rows.join(named, "set_id", "left")
        return stored(out.select("doc_id", "text_hash", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root"), "linked")


def bucketed(rule: Threshold, width: int, shared: Broadcast[np.ndarray] | None):
    """From texts rows (key, set_id, n, sketch), each set once while a task remembers it; only keys marked as `shared`, or without
    marks the keys alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        edges = rule.edges(1 << 10)
        for part in text_parts(batches, 0):
            keys, owners = [], []
            for tokens in shingle_sets(part.column(0), width):
                if len(tokens) >= edges[-1]:
                    edges = rule.edges(len(tokens))
                this = set_id(tokens)
                if this in seen:
                    continue
                if len(seen) > SEEN_SETS:
                    seen.clear()
                seen.add(this)
                for low, own in buckets(tokens, rule, edges):
                    if shared is not None:
                        own = own[held(shared.value, own)]
                    if len(own):
                        keys.append(own)
                        if shared is not None:
                            owners.append((this, len(tokens), sketches([tokens], sketch_bits(low))[0].tobytes()))
            if not keys:
                continue
            flat = pa.array(np.concatenate(keys).view(np.int64))
            if shared is None:
                yield pa.RecordBatch.from_arrays([flat], ["key"])
                continue
            ids, sizes, bits = zip(*owners, strict=True)
            row = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            columns = [pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary())]
            whole = pa.RecordBatch.from_arrays([flat, *(c.take(row) for c in columns)], ["key", "set_id", "n", "sketch"])
            for at in range(0, len(flat), 20_000):
                yield whole.slice(at, 20_000)

    return run


def sketch_bits(low: int) -> int:
    """Bits of the sketches in the join of sets of `low` tokens and more: enough for unlike sets to differ in more bits than linked ones may."""
    return 1 << min(max(low.bit_length(), 7), 11)


def within(batches: Iterator[pa.RecordBatch], rule: Threshold) -> Iterator[pa.RecordBatch]:
    """From rows (key, set_id, n, sketch) in order, edges (a, b) that connect the sets of a key which links can connect.

    Each set is held against all others of its key by size and sketch. A key with more than WINDOW sets gives an edge from each to its
    first one, so nothing is lost and no more rows than that are held.
    """
    rest, far = None, None  # rows of a key that may go on; key and first id of one that is too long
    for batch in batches:
        if rest is not None:
            batch, rest = pa.concat_batches([rest, batch]), None
        batch = _distinct(batch)
        key = batch.column(0).to_numpy()
        if far is not None:
            same = int(np.searchsorted(key != far[0], True))
            yield _edges(batch.column(1).slice(0, same), pa.array([far[1]] * same, pa.binary()))
            batch, key = batch.slice(same), key[same:]
        if not len(key):
            continue
        far, last = None, int(np.argmax(key == key[-1]))
        if len(key) - last > WINDOW:
            far = int(key[-1]), batch.column(1)[last].as_py()
        else:
            batch, rest = batch.slice(0, last), batch.slice(last)
        yield from _near(batch, rule)
    if rest is not None:
        yield from _near(rest, rule)


def _distinct(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows in order without repeated ones; several tasks may have sent a set under a key."""
    key, ids = batch.column(0).to_numpy(), ids_matrix(batch.column(1))
    return batch.filter(pa.array(np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]).any(1)))) if len(key) else batch


def _near(batch: pa.RecordBatch, rule: Threshold) -> Iterator[pa.RecordBatch]:
    """Edges of whole runs of equal keys; rows of one key have sketches of one length."""
    lengths = pc.binary_length(batch.column(3)).to_numpy()
    for length in np.unique(lengths).tolist():
        part = batch.filter(pa.array(lengths == length))
        key, n = part.column(0).to_numpy(), part.column(2).to_numpy()
        bits = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint64).reshape(len(key), -1)
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(begin, len(key)))
        place = np.arange(len(key)) - np.repeat(begin, size)
        long_ = np.flatnonzero(np.repeat(size > WINDOW, size) & (place > 0))
        one, two = [long_], [long_ - place[long_]]
        own = np.repeat(size <= WINDOW, size)
        root = np.arange(len(key))  # a row that edges connect with this one
        for back in range(1, int(size[size <= WINDOW].max(initial=1))):
            i = np.flatnonzero(own & (place >= back))
            i = i[root[i] != root[i - back]]
            most = (100 - rule.percent) * np.minimum(n[i], n[i - back]) // rule.percent
            fits = np.abs(n[i] - n[i - back]) <= most
            i, most = i[fits], most[fits]
            i = i[np.bitwise_count(bits[i] ^ bits[i - back]).sum(1) <= most]
            if not len(i):
                continue
            one.append(i)
            two.append(i - back)
            x, y = root[i], root[i - back]
            root[np.maximum(x, y)] = np.minimum(x, y)
            while (root[root] != root).any():
                root = root[root]
        yield _edges(part.column(1).take(pa.array(np.concatenate(one))), part.column(1).take(pa.array(np.concatenate(two))))


def _edges(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a, b], ["a", "b"])


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` rows with the text of the document they name by (doc_id, text_hash), once for repeated documents or more often."""
    few = wanted.count() <= BROADCAST_ROWS
    names = (F.broadcast(wanted) if few else wanted).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    return keyed(docs).join(names, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))


def _tokens(members: DataFrame, width: int) -> DataFrame:
    """Repeated documents name a member more often; a task passes it on once, and in a group equal members do no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in text_parts(batches, 2):
            sets, ids = shingle_sets(part.column(2), width), part.column(1).to_pylist()
            right = np.array([set_id(s) == i and i not in seen and not seen.add(i) for s, i in zip(sets, ids, strict=True)], bool)
            if len(seen) > SEEN_SETS:
                seen.clear()
            out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([s.tobytes() for s in sets], pa.binary())], ["root", "id", "tokens"])
            yield out.filter(pa.array(right))

    return in_python(members, run, "root binary, id binary, tokens binary")


def tree(group: pa.RecordBatch, rule: Threshold) -> Iterator[pa.RecordBatch]:
    """Edges that connect exactly those members of a group (root, p, q, own, id, tokens) that links connect.

    Size and sketch rule pairs out; the rest are counted token by token unless they are connected already.
    """
    own = group.column(3).to_numpy()
    p, q = group.column(1)[0].as_py(), group.column(2)[0].as_py()
    sets = [np.frombuffer(t, np.uint64) for t in group.column(5).to_pylist()]
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, own = [sets[i] for i in order], own[order]
    sizes, bits = np.array([len(s) for s in sets]), sketches(sets)
    most = (100 - rule.percent) * sizes // rule.percent
    parent = np.arange(len(sets))
    edges = []
    for i in range(len(sets)):
        end = int(np.searchsorted(sizes, sizes[i] + most[i], side="right"))
        after = np.arange(i + 1, end)
        after = after[(parent[after] != parent[i]) & ((p == q) | (own[after] != own[i]))]
        after = after[np.bitwise_count(bits[after] ^ bits[i]).sum(1) <= most[i]]
        for j in after.tolist():
            if parent[j] != parent[i] and rule.links(sizes[i], sizes[j], shared_tokens(sets[i], sets[j])):
                edges.append((i, j))
                parent[parent == parent[j]] = parent[i]
    if edges:
        ids = group.column(4)
        a, b = (pa.array(order[list(x)]) for x in zip(*edges, strict=True))
        yield pa.RecordBatch.from_arrays([ids.take(a), ids.take(b)], ["a", "b"])


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` without near copies: of each component the document with the smallest doc_id stays.

    Rows that repeat doc_id and text are one document and leave one row. NULL doc_ids go before others of their component.
    """
    found = linked(docs, width, percent)
    alone = F.when(F.col("n_shingles") == 0, F.struct("doc_id", "text_hash"))
    kept = found.groupBy("root", alone.alias("alone")).agg(F.min(F.struct("doc_id", "text_hash")).alias("at")).select("at.*")
    kept = kept.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    hashed = docs.withColumn("_text_hash", F.xxhash64("text"))
    there = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash")), "left_semi")
    return there.dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
