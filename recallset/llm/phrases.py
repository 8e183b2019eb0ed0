"""Phrase collocations by dynamic itemset counting: lengths are counted together in cyclic scans of shards of the corpus.

Texts are put in lower case (A-Z only) and cut into pieces at `[.,;:!?\\x0A-\\x0D]`, pieces into words at spaces and tabs. A phrase is a run of
words within a piece; everything is counted per language (NULL is `und`).

Documents are dealt into `shards`, and step s scans shard s modulo their number. Words are counted from step 0. A phrase of two or
three words becomes active once both phrases it has without its last and without its first word have reached `least` occurrences in
what was scanned so far. It is counted from the next step on, for one full cycle, so that its count is that of the whole corpus.
Counting ends when the cycle of the phrase that became active last is over.

The counts are a table, shuffled and written once a step. Of what is active the tasks know only a table of fixed size, the step from which phrases with a part in that cell are counted. Phrases that share a cell with an active one are counted as
well, for a full cycle too; they cost time but do not change a count. Phrases are told apart by 64 bits of hash; the
texts of those that are frequent enough are found in a last scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ConfigurationError
from .cells import bitmap, cell_of, held
from .common import Scratch, in_python, stored
from .sets import mixed, text_parts
from .words import LOWER, byte_kinds, hashed_words

MOST_WORDS = 3
CELL_BITS = 24
NEVER = 255
#: Phrases of a task that are kept in memory before they are counted and sent on.
HELD = 8_000_000
#: Counts are sent on in batches of so many rows: a batch stands in memory on both sides, and in Spark's outside of the heap.
SENT_ROWS = 1 << 17
#: Texts of phrases are first looked for in one of so many shares of the documents, then in twice as many, and so on.
SHARES = 16
TEXT_BYTES = 2 << 20
NO_LANG = "und"
KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
_TWO, _THREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def lang_keys(langs: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in langs), np.uint64, len(langs))


def two(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _TWO + second)


def three(first_two: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mixed(first_two * _THREE + third)


def in_shards(docs: DataFrame, shards: int, scratch: Scratch) -> DataFrame:
    """`lang`, `text` and `shard`, written once so that a step reads its shard only."""
    if not 0 < shards < NEVER // MOST_WORDS:
        raise ConfigurationError(f"shards must be 1 to {NEVER // MOST_WORDS - 1}")
    shard = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    return scratch.stored(docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text", shard.alias("shard")), "phrase-shards", "shard")


class Batch:
    """Words of a part of a shard with their keys and languages."""

    def __init__(self, part: pa.RecordBatch):
        coded = part.column(0).dictionary_encode()
        self.langs = [x.encode() for x in coded.dictionary.to_pylist()]
        self.words = hashed_words(part.column(1), KINDS)
        self.lang = coded.indices.to_numpy()[self.words.row]
        self.keys = mixed(self.words.keys + lang_keys(self.langs)[self.lang])

    def phrases(self, start: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(number of words, position of the first, keys, step that the cells promise) of all phrases of two words, and of three.

        With `start`, those of which a part lies in a cell that is not active are left out.
        """
        at = np.flatnonzero(self.words.joined[1:])
        since = None
        if start is not None:
            active = start[cell_of(self.keys, len(start))]
            since = np.maximum(active[at], active[at + 1])
            keep = since < NEVER
            at, since = at[keep], since[keep]
        pairs = two(self.keys[at], self.keys[at + 1])
        yield 2, at, pairs, since
        if not len(at):
            return
        next_one = np.flatnonzero(at[1:] == at[:-1] + 1)  # a phrase of three is one of two, followed by one of two
        if start is not None:
            # a pair's cell may be another's too and older than its words'
            active = np.maximum(start[cell_of(pairs, len(start))], since)
            since = np.maximum(active[next_one], active[next_one + 1])
            keep = since < NEVER
            next_one, since = next_one[keep], since[keep]
        yield 3, at[next_one], three(pairs[next_one], self.keys[at[next_one] + 2]), since


def tallied(parts: list[np.ndarray], most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of the parts, ascending, with how often they are there, `most` at a time. The parts are taken out of their list."""
    most = most or SENT_ROWS
    keys = np.concatenate(parts)
    parts.clear()
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    for a in range(0, len(first), most):
        own = first[a : a + most]
        yield keys[own], np.diff(np.append(own, first[a + most] if a + most < len(first) else len(keys)))


def counted(shard: DataFrame, known: Broadcast[np.ndarray], step: int, shards: int) -> DataFrame:
    """(key, words, start, n) of the phrases of a shard that are in their cycle at `step`, summed for each task's texts.

    `words` is 0 for the number of words in a language, under the language's key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = known.value
        keys_of: dict[tuple[int, int], list[np.ndarray]] = {}
        languages: dict[int, int] = {}
        waiting = 0

        def batch_of(words: int, since: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), words, np.int8)), pa.array(np.full(len(keys), since, np.int16)), pa.array(n.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["key", "words", "start", "n"])

        def sent() -> Iterator[pa.RecordBatch]:
            while keys_of:
                (words, since), parts = keys_of.popitem()
                for keys, n in tallied(parts):
                    yield batch_of(words, since, keys, n)

        for part in text_parts(batches, 1, TEXT_BYTES):
            batch = Batch(part)
            if step < shards:
                keys_of.setdefault((1, 0), []).append(batch.keys)
                waiting += len(batch.keys)
                for key, n in zip(lang_keys(batch.langs).tolist(), np.bincount(batch.lang, minlength=len(batch.langs)).tolist(), strict=True):
                    languages[key] = languages.get(key, 0) + n
            for words, _, keys, since in batch.phrases(start):
                for value in np.unique(since).tolist():
                    if value <= step < value + shards:
                        own = keys[since == value]
                        keys_of.setdefault((words, value), []).append(own)
                        waiting += len(own)
            if waiting > HELD:
                yield from sent()
                waiting = 0
        yield from sent()
        if languages:
            yield batch_of(0, 0, np.array(list(languages), np.uint64), np.array(list(languages.values()), np.int64))

    return in_python(shard, run, "key long, words tinyint, start smallint, n long")


def reached_cells(rows: DataFrame) -> np.ndarray:
    """Numbers of the cells of the keys."""
    return np.flatnonzero(np.unpackbits(bitmap(rows, CELL_BITS)))


def frequent(docs: DataFrame, shards: int, least: int, scratch: Scratch) -> DataFrame:
    """(key, words, n) of the words and phrases with at least `least` occurrences, by cyclic scans of the shards of `docs`.

    Languages with that many words are there too, with `words` 0.
    """
    start = np.full(1 << CELL_BITS, NEVER, np.uint8)
    running, ended, step, last = None, [], 0, 0
    while step < max(shards, last + shards):
        known = docs.sparkSession.sparkContext.broadcast(start)
        now = counted(docs.filter(F.col("shard") == step % shards).select("lang", "text"), known, step, shards)
        both = now if running is None else now.unionByName(running.filter(F.col("start") + shards > step))
        total = scratch.stored(both.groupBy("key", "words", "start").agg(F.sum("n").alias("n")), f"phrase-counts-{step}")
        known.unpersist()
        if running is not None:
            scratch.drop(running)
        scratch.free()
        running = total
        enough = total.filter(F.col("n") >= least)
        if step >= shards - 1:
            ended.append(scratch.stored(enough.filter(F.col("start") + shards - 1 <= step).select("key", "words", "n"), f"phrases-{step}"))
        reached = reached_cells(enough.filter(F.col("words").between(1, MOST_WORDS - 1)))
        reached = reached[start[reached] == NEVER]
        step += 1
        if len(reached):
            start[reached] = last = step
    return reduce(DataFrame.unionByName, ended)


def named(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, lang, phrase) for the phrases `wanted` by key.

    Growing shares of the documents are scanned for the phrases that have no text yet. Frequent phrases are found in the
    first, small ones, so that few tasks send the same phrase.
    """

    def run(known: Broadcast[np.ndarray]):
        def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(0, np.uint64)
            for part in text_parts(batches, 1, TEXT_BYTES):
                batch = Batch(part)
                low, starts, ends = LOWER[batch.words.data].tobytes(), batch.words.begin, batch.words.end
                for words, at, keys, _ in batch.phrases():
                    own = np.flatnonzero(held(known.value, keys))
                    found, first = np.unique(keys[own], return_index=True)
                    own = own[first[~np.isin(found, seen, assume_unique=True)]]
                    if not len(own):
                        continue
                    begin = at[own]
                    text = [b" ".join([low[x:y] for x, y in zip(starts[b : b + words].tolist(), ends[b : b + words].tolist(), strict=True)]).decode() for b in begin.tolist()]
                    lang = [batch.langs[i].decode() for i in batch.lang[begin].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(keys[own].view(np.int64)), pa.array(lang), pa.array(text)], ["key", "lang", "phrase"])
                    seen = np.concatenate([seen, keys[own]]) if len(seen) < HELD else keys[own]

        return texts

    share = F.pmod(F.xxhash64("text"), F.lit(SHARES))
    out, low, high = None, 0, 1
    while True:
        known = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, CELL_BITS))
        part = in_python(docs.filter(F.coalesce(share, F.lit(0)).between(low, high - 1)).select("lang", "text"), run(known), "key long, lang string, phrase string")
        part = part.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.min(F.struct("lang", "phrase")).alias("one")).select("key", "one.*")
        part = scratch.stored(part, "phrase-texts")
        known.unpersist()
        out = part if out is None else out.unionByName(part)
        wanted = wanted.join(part, "key", "left_anti")
        low, high = high, min(2 * high, SHARES)
        if low == SHARES:
            return out
        wanted = scratch.stored(wanted, "phrases-without-text")
        if wanted.isEmpty():
            return out


def with_parts(phrases: DataFrame) -> DataFrame:
    """Rows (key, lang, phrase, a) with keys of what stands before and after each cut (l1, r1, l2, r2; the last two of three words only) and of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = hashed_words(batch.column(2), KINDS)
            salts = lang_keys([x.encode() for x in batch.column(1).to_pylist()])
            keys = mixed(found.keys + salts[found.row])
            first = np.searchsorted(found.row, np.arange(batch.num_rows))
            long = np.bincount(found.row, minlength=batch.num_rows) > 2
            k1, k2, k3 = keys[first], keys[first + 1], keys[np.minimum(first + 2, max(len(keys) - 1, 0))] if len(keys) else keys
            right = np.where(long, two(k2, k3), k2)
            optional = lambda keys: pa.array(keys.view(np.int64), mask=~long)
            columns = [pa.array(k1.view(np.int64)), pa.array(right.view(np.int64)), optional(two(k1, k2)), optional(k3), pa.array(salts.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["key", "lang", "phrase", "a", "l1", "r1", "l2", "r2", "lang_key"])

    schema = "key long, lang string, phrase string, a long, l1 long, r1 long, l2 long, r2 long, lang_key long"
    return in_python(phrases.select("key", "lang", "phrase", "a"), run, schema)


def collocations(docs: DataFrame, shards: int = 3, least: int = 10, inside_percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two and three words that occur `least` times and are no mere part of a longer one.

    a, l and r are the occurrences of the phrase, of what stands before and of what stands after the cut whose score
    `1000000 * a * a // (l * r)` is lowest (the first of equals); n is the number of words in the language. A phrase of two words goes if a frequent one of three has
    it and occurs `inside_percent` per cent as often or more. NULL and empty texts have no words; repeated rows
    count as often as they are there; columns other than `lang` and `text` are ignored; without documents there are no rows.
    """
    with Scratch(docs.sparkSession) as scratch:
        docs = in_shards(docs, shards, scratch)
        counts = scratch.stored(frequent(docs, shards, least, scratch), "frequent-phrases")
        phrases = counts.filter("words > 1").select("key", F.col("n").alias("a"))
        found = scratch.stored(with_parts(phrases.join(named(docs, phrases.select("key"), scratch), "key")), "named-phrases")
        longer = found.filter("l2 IS NOT NULL")
        longer = longer.select(F.explode(F.array("l2", "r1")).alias("key"), F.col("a").alias("longer")).groupBy("key").agg(F.max("longer").alias("longer"))
        kept = found.join(longer, "key", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
        cuts = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"l{k}").alias("left"), F.col(f"r{k}").alias("right")) for k in (1, 2))), lambda c: c.left.isNotNull())
        cut = kept.select("key", "lang", "lang_key", "phrase", "a", F.explode(cuts).alias("cut")).select("key", "lang", "lang_key", "phrase", "a", "cut.*")
        parts = counts.filter("words > 0")
        cut = cut.join(parts.select(F.col("key").alias("left"), F.col("n").alias("l")), "left").join(parts.select(F.col("key").alias("right"), F.col("n").alias("r")), "right")
        cut = cut.withColumns({f"wide_{c}": F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")})
        cut = cut.withColumn("score", F.expr("(wide_a * wide_a * 1000000BD) div (wide_l * wide_r)"))
        best = cut.groupBy("key", "lang", "lang_key", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        languages = counts.filter("words = 0").select(F.col("key").alias("lang_key"), "n")
        return stored(best.join(languages, "lang_key").select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score"), "collocations")


def report(docs: DataFrame, most: int = 2000, shards: int = 3, least: int = 10) -> DataFrame:
    """The first `most` phrases of each language by score and occurrences, both descending, and by phrase: with their `rank`.

    The order is first cut in pieces of each language, dealt by a hash of the phrase, then in what is left of those.
    """
    found = collocations(docs, shards, least).withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))).filter(F.col("rank") <= most)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
