"""Token files: ids of documents in ascending doc_id order, coded by a static range asymmetric numeral system.

A file holds the ids of consecutive documents: a head, a table of symbol frequencies that all its blocks share, a directory, and
blocks. A block holds whole documents and is decoded by itself: its ids are dealt to lanes in turn, each lane has a state of 64 bits, and
all lanes share one stream of 32-bit words. Every CHECKPOINT steps the states and the place in the stream are kept, so that decoding
can begin there. Each block has a CRC-32 of its ids.

Files are the rows of a table (bucket, part, file), written by Spark: buckets are ranges of doc_id, parts the files of a bucket.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_python, starts, stored
from .sets import text_parts

MAGIC = b"TIDS0001"
SCALE = 18
LOW = 1 << 31
#: Ids of a file and of a block are closed at these numbers (a document is never cut); lanes of a block; steps between checkpoints.
FILE_IDS, BLOCK_IDS, LANES, CHECKPOINT = 4 << 20, 1 << 18, 1024, 128
BUCKET_ROWS = 4_000
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")
CACHE_PIECES = 500_000
#: New pieces that the library encodes together.
LEARNED = 4_096
#: Texts that are cut together.
TEXT_BYTES = 4 << 20


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Shares of 2 ** SCALE, at least 1 for each symbol that occurs."""
    there = np.flatnonzero(counts)
    if len(there) > 1 << SCALE:
        raise ValueError("more symbols than the scale has slots")
    share = np.maximum(1, counts[there] * (1 << SCALE) // counts.sum())
    over = int(share.sum()) - (1 << SCALE)
    if over < 0:
        share[share.argmax()] -= over
    while over > 0:  # taken from the largest
        big = np.argsort(-share)[: max(1, len(share) // 4)]
        cut = np.minimum(share[big] - 1, max(1, over // len(big)))
        cut = np.where(np.cumsum(cut) <= over, cut, 0)
        if not cut.any():
            cut[0] = min(over, share[big[0]] - 1)
        share[big] -= cut
        over -= int(cut.sum())
    out = np.zeros(len(counts), np.uint64)
    out[there] = share
    return out


class Coder:
    """Encoder and decoder of a table of frequencies."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.int32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> bytes:
        lanes = max(1, min(LANES, len(ids) // 64))
        steps = -(-len(ids) // lanes)
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        kept: list[tuple[int, np.ndarray]] = []
        for step in range(steps - 1, -1, -1):
            own = ids[step * lanes : (step + 1) * lanes]
            f, s, x = self.freq[own], self.start[own], state[: len(own)]
            full = x >= (f << np.uint64(63 - SCALE))
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            x = np.where(full, x >> np.uint64(32), x)
            quotient = x // f
            state[: len(own)] = (quotient << np.uint64(SCALE)) + (x - quotient * f) + s
            if step and step % CHECKPOINT == 0:
                kept.append((step, state.copy()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        sizes = np.cumsum([len(w) for w in words[::-1]])
        points = b"".join(struct.pack("<II", step, int(sizes[step - 1])) + states.tobytes() for step, states in reversed(kept))
        return struct.pack("<IIII", len(ids), lanes, len(kept), len(stream)) + state.tobytes() + points + stream.tobytes()

    def decode(self, block: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from `first` to `stop`, from the last checkpoint at or before `first`."""
        count, lanes, points, length = struct.unpack_from("<IIII", block)
        stop = count if stop is None else min(stop, count)
        at = 16 + 8 * lanes
        state, step, place = np.frombuffer(block, np.uint64, lanes, 16).copy(), 0, 0
        for _ in range(points):
            point, position = struct.unpack_from("<II", block, at)
            if point * lanes <= first:
                step, place = point, position
                state = np.frombuffer(block, np.uint64, lanes, at + 8).copy()
            at += 8 + 8 * lanes
        stream = np.frombuffer(block, np.uint32, length, at)
        begin = step * lanes
        out = np.empty(max(0, stop - begin), np.int32)
        mask, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
        while step * lanes < stop:
            n = min(lanes, count - step * lanes)
            x = state[:n]
            low = x & mask
            symbol = self.slot[low]
            x = self.freq[symbol] * (x >> shift) + low - self.start[symbol]
            short = np.flatnonzero(x < LOW)
            if place + len(short) > length:
                raise ValueError("a block is damaged: its stream is too short")
            x[short] = (x[short] << np.uint64(32)) | stream[place : place + len(short)]
            place += len(short)
            state[:n] = x
            to = step * lanes - begin
            out[to : to + n] = symbol[: len(out) - to]
            step += 1
        if stop == count and (place != length or (state != LOW).any()):  # the coder began with these states
            raise ValueError("a block is damaged: its states don't end where they began")
        return out[first - begin :]


def pack(documents: list[tuple[int | None, np.ndarray]]) -> bytes:
    """A file of (doc_id, ids): table, then a directory of blocks with the documents of each."""
    ids = np.concatenate([d[1] for d in documents])
    counts = np.bincount(ids)
    coder = Coder(frequencies(counts))
    there = np.flatnonzero(coder.freq)
    table = zlib.compress(np.diff(there, prepend=0).astype("<u4").tobytes() + coder.freq[there].astype("<u4").tobytes())
    directory, blocks, begin, size, at = [], [], 0, 0, 0
    for i, (_, own) in enumerate(documents):
        size += len(own)
        if size >= BLOCK_IDS or i == len(documents) - 1:
            part = ids[at : at + size]
            names = b"".join(struct.pack("<?qI", d is None, d or 0, len(t)) for d, t in documents[begin : i + 1])
            block = coder.encode(part)
            directory.append(struct.pack("<IIII", i + 1 - begin, len(names), len(block), zlib.crc32(part.astype("<u4").tobytes())))
            blocks.append(names + block)
            begin, at, size = i + 1, at + size, 0
    return MAGIC + struct.pack("<III", len(there), len(table), len(blocks)) + table + b"".join(directory) + b"".join(blocks)


def unpack(file: bytes) -> Iterator[tuple[list[tuple[int | None, int]], np.ndarray]]:
    """For each block its documents (doc_id, number of ids) and its ids, checked against the checksum."""
    if file[:8] != MAGIC:
        raise ValueError("not a token file")
    symbols, table, blocks = struct.unpack_from("<III", file, 8)
    numbers = np.frombuffer(zlib.decompress(file[20 : 20 + table]), "<u4").astype(np.int64)
    there = np.cumsum(numbers[:symbols])
    freq = np.zeros(int(there[-1]) + 1 if symbols else 1, np.uint64)
    freq[there] = numbers[symbols:]
    coder, at = Coder(freq), 20 + table + 16 * blocks
    for b in range(blocks):
        count, names, size, crc = struct.unpack_from("<IIII", file, 20 + table + 16 * b)
        documents = [(None if none else doc, n) for none, doc, n in struct.iter_unpack("<?qI", file[at : at + names])]
        ids = coder.decode(file[at + names : at + names + size])
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc or len(documents) != count:
            raise ValueError(f"block {b} is damaged")
        at += names + size
        yield documents, ids


def _kinds() -> np.ndarray:
    """For each character that PLAIN has, whether it is white space, a letter, a number or another one."""
    kind = {"L": LETTER, "N": NUMBER}
    kinds = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x250)], np.uint8)
    kinds[[0x09, 0x0A, 0x0D, 0x20]] = SPACE
    return kinds


SPACE, LETTER, NUMBER, OTHER = range(4)
KINDS = _kinds()


def pieces_of(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pieces begin into which the tokenizer cuts texts of PLAIN characters, given as UTF-8 one after the other.

    A run of letters, of numbers or of other characters is a piece, with a blank before it. White space before a run is a piece
    without its last character; that is the blank of the run, or else a piece too. After an apostrophe that is a piece by itself,
    s, t, m, d, re, ve and ll are split off.
    """
    n = len(data)
    code = data.astype(np.int32)
    lead = np.flatnonzero(data >= 0xC0)
    code[lead] = ((code[lead] & 0x1F) << 6) | (code[np.minimum(lead + 1, n - 1)] & 0x3F)
    kind = KINDS[np.minimum(code, 0x24F)]
    kind[lead + 1] = kind[lead]
    text = np.zeros(n, bool)
    text[begins] = True
    change = text.copy()
    change[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(change)
    ends = np.append(runs[1:], n)
    space = kind[runs] == SPACE
    starts = np.zeros(n + 1, bool)
    starts[runs[space]] = True
    followed = space & (ends < n)
    followed[followed] = ~text[ends[followed]]
    starts[ends[followed] - 1] = True
    solid = runs[~space]
    blank = (solid > 0) & (data[np.maximum(solid - 1, 0)] == 0x20) & ~text[solid]
    starts[solid[~blank]] = True
    # an apostrophe that begins a piece and ends its run
    quote = np.flatnonzero((data == 0x27) & starts[:n] & np.append(change[1:], True))
    quote = quote[quote + 1 < n]
    quote = quote[~text[quote + 1] & (kind[quote + 1] == LETTER)]
    one, other = data[quote + 1], data[np.minimum(quote + 2, n - 1)]
    two = np.isin(one.astype(np.int32) << 8 | other, [b[0] << 8 | b[1] for b in (b"re", b"ve", b"ll")]) & (quote + 2 < n)
    two[two] = ~text[quote[two] + 2]
    short = np.isin(one, list(b"stmd"))
    quote, size = quote[short | two], np.where(short, 1, 2)[short | two]
    starts[quote + 1] = False
    starts[quote + 1 + size] = True  # a piece begins where this one ends
    return np.flatnonzero(starts[:n])


class ByteBpe:
    """Ids of the byte-level tokenizer file by the library, which sees each distinct piece once while it stays in a cache.

    Pieces are cut for many texts at a time and given numbers; their ids are then gathered by number.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.new: dict[bytes, bytes] = {}  # plain strings cost the garbage collector nothing
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Texts with special tokens, or characters on which tables may differ, go to the library whole."""
        texts = [t or "" for t in texts]
        plain = [bool(PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        found = iter(self._plain([t.encode() for t, p in zip(texts, plain, strict=True) if p]))
        whole = iter(self.library.encode_batch([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [next(found) if p else np.array(next(whole).ids, np.uint32) for p in plain]

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        none = np.zeros(0, np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return [none] * len(texts)
        starts = pieces_of(data, begins[sizes > 0])
        ends_at = np.append(starts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(data)]).dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        flat, n = np.frombuffer(b"".join(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, own = np.cumsum(n) - n, n[index]
        to = np.cumsum(own)
        out = flat[np.repeat(first[index] - (to - own), own) + np.arange(to[-1])]
        # a text's ids end with those of its last piece
        pieces = np.searchsorted(starts, begins + sizes)
        ends = np.concatenate([[0], to])[pieces]
        return np.split(out, ends[:-1])

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as bytes."""
        if len(self.new) > CACHE_PIECES:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, pieces))
        missing = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        if missing:
            new |= {p: old[p] for p in missing if p in old}
            self._learn([p for p in missing if p not in new])
            found = list(map(new.__getitem__, pieces))
        return found

    def _learn(self, pieces: list[bytes]) -> None:
        """Pieces that are not white space are encoded as one text with line ends between them, which are pieces of their own."""
        solid = [p for p in pieces if not p.isspace()]
        for p, e in zip(blank := [p for p in pieces if p.isspace()], self.library.encode_batch([p.decode() for p in blank], add_special_tokens=False), strict=True):
            self.new[p] = np.array(e.ids, np.uint32).tobytes()
        for at in range(0, len(solid), LEARNED):
            own = solid[at : at + LEARNED]
            whole = self.library.encode(b"\n".join(own).decode(), add_special_tokens=False)
            n = np.bincount(np.array(whole.word_ids, np.int64), minlength=2 * len(own) - 1)
            if len(n) != 2 * len(own) - 1 or not n.all():
                raise ValueError("the tokenizer cuts pieces again")
            ends = 4 * np.cumsum(n)
            ids = np.array(whole.ids, np.uint32).tobytes()
            self.new.update(zip(own, (ids[a:b] for a, b in zip((ends - 4 * n)[::2].tolist(), ends[::2].tolist(), strict=True)), strict=True))


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteBpe:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    tok = ByteBpe(path)
    tok.library.no_truncation()
    tok.library.no_padding()
    return tok


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, bucket_rows: int = BUCKET_ROWS) -> None:
    """Encode each text, append `end_id`, and write files in ascending order of doc_id, NULL doc_ids last, ties by text.

    Documents are shuffled once, by ranges of doc_id and of how the text begins, so that many rows of one doc_id are spread too. A task
    turns a range into the files of a bucket and holds the ids of one file at a time. NULL texts are empty.
    """
    from pyspark import TaskContext

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").isNull(), F.col("doc_id")]
    ranges = rows.repartitionByRange(max(1, docs.count() // bucket_rows), *order, F.substring("text", 1, 32))
    rows = ranges.sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = byte_tokenizer(tokenizer)
        end = np.array([end_id], np.uint32)
        bucket, part, total = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, np.ndarray]] = []

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([part], pa.int32()), pa.array([pack(held)], pa.binary())], ["bucket", "part", "file"])

        for batch in text_parts(batches, 1, TEXT_BYTES):
            ids = tok.encode(batch.column(1).to_pylist())
            for doc, found in zip(batch.column(0).to_pylist(), ids, strict=True):
                if held and total >= FILE_IDS:
                    yield file()
                    part, held, total = part + 1, [], 0
                held.append((doc, np.concatenate([found, end])))
                total += len(found) + 1
        if held:
            yield file()

    in_python(rows, run, "bucket int, part int, file binary").write.option("compression", "none").option("parquet.block.size", 8 << 20).parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files under `path`; start counts the ids of all before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, part, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                inside, rows = 0, []
                for documents, ids in unpack(file):
                    at = 0
                    raw = ids.astype("<u4").tobytes()
                    for doc, n in documents:
                        rows.append((bucket, part, doc, inside + at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
                        at += n
                    inside += at
                types = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["bucket", "part", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.schema("bucket int, part int, file binary").parquet(path)
    rows = stored(in_python(files, run, "bucket int, part int, doc_id long, inside long, n_tokens long, ids_crc32 long"), "decoded")  # files are decoded once
    parts = rows.groupBy("bucket", "part").agg(F.sum("n_tokens").alias("n"))
    buckets = starts(parts.groupBy("bucket").agg(F.sum("n").alias("n")), "bucket", "n")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("bucket", "part", before.alias("before")).join(buckets, "bucket")
    return rows.join(parts, ["bucket", "part"]).select("doc_id", (F.col("start") + F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write token files to the shared folder and describe each document from them."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
