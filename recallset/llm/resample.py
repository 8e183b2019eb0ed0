"""Resampling towards a target distribution: documents are weighted by hashed n-gram features and drawn by perturbed scores.

Features are runs of one and two words, hashed into buckets by CRC-32. A bucket's gain is the logarithm of how much more often it
occurs in the target texts than in all documents; a document's weight is the floored mean of the gains of its features. To each weight
a Gumbel number made from the document's id is added, and the documents with the highest scores are drawn, so that the draw is one
without replacement by weight.

Scores are ranked by a radix sort in Spark: stable counting passes over the digits of a composite key, from the least significant
one. A pass counts digits per block of consecutive places, turns the counts into offsets, and moves each row to its place.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_python, stored
from .sets import text_parts
from .words import byte_kinds, words_of

BUCKETS = 10_000
#: Rows of a block and values of a digit are at most 2 to these powers.
BLOCK_BITS, DIGIT_BITS = 17, 12
#: A key of more bits is held in several numbers.
KEY_BITS = 62
TEXT_BYTES = 2 << 20
WORD = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
KINDS = byte_kinds(bytes(set(range(128)) - set(WORD)))
#: Words up to so many bytes are appended to a checksum by tables.
TABLE_BYTES = 64


@lru_cache(maxsize=1)
def appending() -> np.ndarray:
    """[n, k, b]: what byte k of a CRC-32, of value b, becomes when n more bytes are read."""
    step = np.zeros(256, np.uint32)
    for b in range(256):
        x = b
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        step[b] = x
    tables = np.zeros((TABLE_BYTES + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(TABLE_BYTES):
        tables[n + 1] = step[tables[n] & 0xFF] ^ (tables[n] >> np.uint32(8))
    return tables


def appended(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings one after the other, from theirs and the length of the second one, up to TABLE_BYTES."""
    tables, out = appending(), second.copy()
    for k in range(4):
        out ^= tables[length, k, (first >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words per text, row and bucket of each feature): all words and all pairs of neighbours, repeats too."""
    words = words_of(texts, KINDS)
    n_words = np.bincount(words.row, minlength=len(texts))
    alone = np.array([zlib.crc32(w) for w in words.distinct], np.uint32)
    spaced = np.array([zlib.crc32(b" ", zlib.crc32(w)) for w in words.distinct], np.uint32)
    size = np.array([len(w) for w in words.distinct], np.int64)
    at = np.flatnonzero(words.joined[1:])
    first, second = words.index[at], words.index[at + 1]
    short = size[second] <= TABLE_BYTES if len(at) else np.zeros(0, bool)
    pairs = np.zeros(len(at), np.uint32)
    pairs[short] = appended(spaced[first[short]], alone[second[short]], size[second[short]])
    pairs[~short] = [zlib.crc32(words.distinct[b], int(spaced[a])) for a, b in zip(first[~short], second[~short], strict=True)]
    hashes = np.concatenate([alone[words.index], pairs]) if len(words.index) else pairs
    return n_words, np.concatenate([words.row, words.row[at]]), (hashes % np.uint32(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket; tasks send BUCKETS rows at most, and so does the job to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for part in text_parts(batches, 0, TEXT_BYTES):
            total += np.bincount(features(part.column(0))[2], minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there], pa.int64())], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for row in in_python(texts.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the smoothed share in the target by that in the source)."""
    s_all, t_all = int(source.sum()), int(target.sum())
    ratio = ((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def perturbation(doc_id: int | None, seed: int) -> int:
    """floor(1000 * a Gumbel number) from the id; that of a NULL id is made from the seed alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 7) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) per row of `docs`; a text without words has weight 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, 1, TEXT_BYTES):
            n_words, row, bucket = features(part.column(1))
            n = np.bincount(row, minlength=part.num_rows)
            total = np.bincount(row, weights=gain[bucket], minlength=part.num_rows).astype(np.int64)  # whole numbers, exact in doubles
            weight = total // np.maximum(n, 1)
            score = weight + np.array([perturbation(i, seed) for i in part.column(0).to_pylist()], np.int64)
            columns = [part.column(0), *(pa.array(c.astype(np.int64)) for c in (n_words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    return in_python(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_words long, n_features long, weight long, score long")


def packed(fields: list[tuple[Column, int]]) -> list[tuple[Column, int]]:
    """Numbers of at most KEY_BITS bits that hold the fields, each from 0 and below 2 to its bits; the least significant number first."""
    out: list[tuple[Column, int]] = []
    for value, bits in reversed(fields):
        if not out or out[-1][1] + bits > KEY_BITS:
            out.append((value, bits))
        else:
            low, used = out[-1]
            out[-1] = (F.shiftleft(value, used).bitwiseOR(low), used + bits)
    return out


def radix_places(rows: DataFrame, fields: list[tuple[Column, int]]) -> DataFrame:
    """`rows` with `place`, from 0, in ascending order of `fields` (non-negative longs below 2 to their bits, the first decides).

    Rows must be evaluated alike each time, as stored ones are; rows whose fields are all equal take neighbouring places. They are held in blocks of 2 ** BLOCK_BITS
    consecutive places. Each pass shuffles them once, by block and digit, so no task gets more than a block of one key, whatever
    the digits are; the offsets of a digit are summed over blocks. Only the totals of a digit's values, at most 2 ** DIGIT_BITS
    numbers, come to the driver. Every pass is written to the shared folder.
    """
    keys = packed(fields) if any(bits for _, bits in fields) else [(F.lit(0).cast("long"), 1)]
    names = [f"_key{i}" for i in range(len(keys))]
    columns = [c for c in rows.columns if c != "place"]
    # the first places only have to be distinct: number of the partition, then number in it
    rows = rows.select(*columns, *(value.alias(name) for (value, _), name in zip(keys, names, strict=True)), F.monotonically_increasing_id().alias("place"))
    for name, (_, bits) in zip(names, keys, strict=True):
        passes = max(1, -(-bits // DIGIT_BITS))
        width = -(-bits // passes)
        for low in range(0, bits, max(1, width)):
            rows = counting_pass(rows, F.shiftright(name, low).bitwiseAND(F.lit((1 << width) - 1)).cast("int"), 1 << width)
    return rows.select(*columns, "place")


def counting_pass(rows: DataFrame, digit: Column, radix: int) -> DataFrame:
    """`rows` with new places: by digit, and within a digit as before."""
    rows = rows.withColumns({"_block": F.shiftright("place", BLOCK_BITS), "_digit": digit})
    counts = stored(rows.groupBy("_block", "_digit").agg(F.count("*").alias("_n")), "digit-counts")
    totals = [0] * radix
    for row in counts.groupBy("_digit").agg(F.sum("_n").alias("n")).collect():
        totals[row["_digit"]] = row.n
    begin = F.split(F.lit(",".join(map(str, np.cumsum([0, *totals[:-1]]).tolist()))), ",").cast("array<bigint>")
    before = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", "_digit", (F.get(begin, F.col("_digit")) + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("place"))
    moved = rows.withColumn("_inside", inside).join(offsets, ["_block", "_digit"])
    kept = [c for c in rows.columns if c not in ("place", "_block", "_digit")]
    return stored(moved.select(*kept, (F.col("_offset") + F.col("_inside") - 1).alias("place")), "digit-pass")


def ordering(rows: DataFrame) -> list[tuple[Column, int]]:
    """Fields for descending score, ascending doc_id with NULL last, and ascending n_features, as narrow as the values allow."""
    s = rows.agg(F.max("score").alias("high"), F.min("score").alias("low"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max("n_features").alias("most")).first()
    fields = [(F.lit(s.high) - F.col("score"), (s.high - s.low).bit_length())]
    if s["first"] is not None:
        span = s["last"] - s["first"] + 1
        if span < 1 << KEY_BITS:
            fields.append((F.coalesce(F.col("doc_id") - F.lit(s["first"]), F.lit(span)), span.bit_length()))
        else:  # ids of both signs, far apart: the sign turned, in two halves
            turned = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))
            none = F.col("doc_id").isNull()
            fields.append((none.cast("long"), 1))
            fields += [(F.when(none, 0).otherwise(half), 32) for half in (F.shiftrightunsigned(turned, 32), turned.bitwiseAND(F.lit((1 << 32) - 1)))]
    return [*fields, (F.col("n_features"), s.most.bit_length())]


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of `docs`.

    rank counts from 1 the `percent` per cent (rounded down) of the documents with `min_words` words and more that have the highest scores, ties
    by smaller doc_id, NULL ids last, then by n_features; it is NULL for all others. NULL and empty texts have no features and weight 0. Rows that
    repeat a doc_id are documents of their own. An empty target or an empty table is counted as one without features.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = stored(scored(docs, gain, seed), "scored")
    out = ["doc_id", "n_features", "weight", "score"]
    enough = F.col("n_words") >= min_words
    able = rows.filter(enough)
    n = able.count()
    if not n:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    placed = radix_places(able.select(*out), ordering(able))
    drawn = F.when(F.col("place") < n * percent // 100, F.col("place") + 1)
    return placed.select(*out, drawn.alias("rank")).unionByName(rows.filter(~enough).select(*out, F.lit(None).cast("long").alias("rank")))
