"""Benchmark decontamination with DataFrame functions only.

Words are runs of ASCII digits, ASCII letters and characters beyond ASCII, with A-Z in lower case. A window is `size` consecutive
words of an item, or all words of a shorter item. A document's word is hit if it lies in an occurrence of a window.

The windows of all items are a broadcast hash set, after a check of its size: 64 bits of hash of a window's words name it. Each
document's windows of the lengths that occur are hashed and looked up, and where a hash is met the words themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Characters that are no part of a word.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SIZE = 10
#: Letters outside ASCII that `lower` would change.
OTHER_CAPITALS = r"[\P{ASCII}&&[\p{IsUppercase}\p{Lt}]]"
#: Windows are broadcast in blocks of at most about so many bytes.
BLOCK_BYTES = 16 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else; the slower way only where `lower` would change other letters."""
    return F.when(text.rlike(OTHER_CAPITALS), ascii_lower(text)).otherwise(F.lower(text))


def window_key(words: Column, at: Column, length: int) -> Column:
    """The hash of so many words from number `at` on, counted from 0."""
    return F.xxhash64(*(F.get(words, at + k) for k in range(length)))


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(key, length, window, item_ids): the distinct windows of all items, with the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(lowered(F.col("text"))).alias("w")).filter(F.size("w") > 0).distinct()
    items = items.withColumn("length", F.least(F.lit(size), F.size("w")))
    placed = items.select("item_id", "length", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("at"))
    key = F.coalesce(*(F.when(F.col("length") == n, window_key(F.col("w"), F.col("at"), n)) for n in range(1, size + 1)))
    found = placed.select(key.alias("key"), "length", F.slice("w", F.col("at") + 1, F.col("length")).alias("window"), "item_id")
    return found.groupBy("key", "length", "window").agg(F.collect_set("item_id").alias("item_ids"))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Per row of `docs`: row (a number of this result's own), doc_id, n_words, spans (merged word ranges (first, last) of hit words), item_ids.

    NULL texts have no words. Items without words have no window; items of one id count once; an item whose id is
    NULL hits but isn't listed. All rows of `docs` are returned, repeated ones too.
    """
    found = stored(windows(benchmark, size), "windows")
    lengths = sorted(r[0] for r in found.select("length").distinct().collect())  # at most `size`
    volume = found.agg(F.coalesce(F.sum(F.length(F.array_join("window", " ")) * 4 + F.length(F.array_join("item_ids", " ")) * 4 + 96), F.lit(0))).first()[0]
    blocks = max(1, -(-volume // BLOCK_BYTES))
    cut = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(lowered(F.col("text"))).alias("words"))
    cut = cut.withColumn("n_words", F.size("words").cast("long"))
    parts = None
    for block in range(blocks):
        own = found if blocks == 1 else found.filter(F.pmod("key", F.lit(blocks)) == block)
        part = _block_hits(cut, own, lengths, block == 0)
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("row", "doc_id", "n_words").agg(F.collect_set("span").alias("spans"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids"))
    return merged.select("row", "doc_id", "n_words", _merged(F.array_sort("spans")).alias("spans"), F.array_sort("item_ids").alias("item_ids"))


def _block_hits(cut: DataFrame, found: DataFrame, lengths: list[int], base: bool) -> DataFrame:
    """Rows (row, doc_id, n_words, span, item_ids), and with `base` one row without a span for each document."""
    start = cut.sparkSession.range(1).select(F.lit(0).cast("long").alias("key"), F.lit(0).alias("length"))
    table = found.unionByName(start, allowMissingColumns=True) if base else found
    # one empty word in front of each document's meets the key 0 of length 0: the document's own row
    placed = cut.select("row", "doc_id", "n_words", "words", F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word"))
    at = F.col("pos") - 1
    keys = [F.when(F.col("pos") == 0, F.lit(0)).otherwise(window_key(F.col("words"), at, n)) for n in lengths or [1]]
    if len(keys) == 1:
        placed = placed.withColumn("key", keys[0])
    else:  # of the first word only one key, for the document's own row
        placed = placed.withColumn("key", F.explode(F.when(F.col("pos") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(*keys))))
    met = placed.join(F.broadcast(table), "key")  # at most about BLOCK_BYTES
    span = F.struct(at.alias("first"), (at + F.col("length") - 1).alias("last"))
    same = (F.col("pos") > 0) & (F.col("length") > 0) & F.coalesce(F.slice("words", F.greatest("pos", F.lit(1)), F.col("length")) == F.col("window"), F.lit(False))
    none = F.lit(None).cast("struct<first:int,last:int>")
    # the comparison stands in a generator: as a filter it would move into the join, which then could not be compiled and would
    # copy the words of a document for each of them
    spans = F.when(F.col("length") == 0, F.when(F.col("pos") == 0, F.array(none)).otherwise(F.array())).when(same, F.array(span)).otherwise(F.array())
    return met.select("row", "doc_id", "n_words", F.explode(spans).alias("span"), "item_ids")


def _merged(spans: Column) -> Column:
    """Sorted ranges (first, last) with those that overlap or touch put together."""
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def step(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"))))
        return F.when((F.size(done) > 0) & (span["first"] <= last["last"] + 1), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, step)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)


def report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The digest of `hits` per row of `docs`."""
    found = hits(docs, benchmark, size)
    return found.select(
        "doc_id",
        "n_words",
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """A text without the words in `spans` of word numbers; what separates words stays."""
    own, between = words(text), F.split(text, WORD)
    kept = F.transform(own, lambda w, i: F.when(F.exists(spans, lambda s: (s["first"] <= i) & (s["last"] >= i)), F.lit("")).otherwise(w))
    joined = F.array_join(F.zip_with(between, kept, lambda b, k: F.concat(F.coalesce(b, F.lit("")), F.coalesce(k, F.lit("")))), "")
    return F.when(F.size(spans) == 0, text).otherwise(joined)


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, remove: str = "documents") -> DataFrame:
    """`docs` without contaminated documents, or with remove="spans" without the words that are hit; columns as they were.

    Rows are told apart by (doc_id, hash of the text): repeated rows share their fate. n_chars follows the text.
    """
    hashed = docs.withColumn("_text_hash", F.xxhash64("text"))
    named = hashed.select(F.struct("doc_id", "_text_hash").alias("doc_id"), "text")
    bad = hits(named, benchmark, size).filter(F.size("spans") > 0).select(F.col("doc_id.doc_id").alias("_doc"), F.col("doc_id._text_hash").alias("_hash"), F.col("spans").alias("_spans")).dropDuplicates(["_doc", "_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    if remove == "documents":
        return hashed.join(bad, same, "left_anti").select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    found = hashed.join(bad, same, "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(without_spans(F.col("text"), F.col("_spans")))
    found = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return found.select(*docs.columns)
