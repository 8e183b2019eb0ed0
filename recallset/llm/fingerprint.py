"""Document fingerprints with DataFrame functions only: SimHash over pairs of neighbouring words, and a search within a Hamming radius.

Terms are pairs of words (runs without spaces, tabs and line ends, in lower case); a text of one word has that word as its
term, a text without words the fingerprint of zeros. A term weighs as often as it occurs. Its hash bits vote for or against each bit.

Votes are counted sixteen bits apart in one number: (hash >> i) & 0x0001000100010001 holds bits i, i + 16, i + 32 and i + 48. Terms
of a text are counted in segments of less than 2 ** 16, so that no lane runs into the next, and segments are added after that.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boundaries, bucket_of

#: Bits of a fingerprint; each 64 are a number of their own.
BITS = 128
LANES = 0x0001000100010001
SEGMENT = 60_000
#: Documents to a range bucket, within which the next document is found.
BUCKET_ROWS = 4_000


def _words(text: Column) -> Column:
    plain = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), ("\n", "\t", "\r"), F.lower(text))
    return F.array_remove(F.split(plain, " "), "")


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text", bits: int = BITS) -> DataFrame:
    """`keys` and `f0`, `f1`, … for each value of `keys`, which must tell rows apart. NULL texts are empty."""
    words = texts.select(*keys, _words(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    pairs = words.select(*keys, F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))).alias("b")).alias("_p"))
    pairs = pairs.select(*keys, F.slice("_p", F.lit(1), F.greatest(F.size("_p") - 1, F.lit(1))).alias("_p"))
    each = pairs.select(*keys, F.posexplode_outer("_p").alias("_at", "_t"))
    each = each.select(*keys, F.floor(F.coalesce("_at", F.lit(0)) / SEGMENT).alias("_segment"), F.col("_t").isNotNull().cast("long").alias("_one"), *[F.when(F.col("_t").isNotNull(), F.xxhash64("_t.a", F.coalesce("_t.b", F.lit("")), F.lit(k))).otherwise(0).alias(f"_h{k}") for k in range(bits // 64)])
    lanes = [F.sum(F.shiftrightunsigned(f"_h{k}", i).bitwiseAND(F.lit(LANES))).alias(f"_s{k}_{i}") for k in range(bits // 64) for i in range(16)]
    counted = each.groupBy(*keys, "_segment").agg(F.sum("_one").alias("_n"), *lanes)
    ones = [F.sum(F.shiftrightunsigned(f"_s{k}_{i}", 16 * j).bitwiseAND(F.lit(0xFFFF))).alias(f"_b{k}_{i + 16 * j}") for k in range(bits // 64) for i in range(16) for j in range(4)]
    voted = counted.groupBy(*keys).agg(F.sum("_n").alias("_n"), *ones)
    bit = lambda k, b: F.when(2 * F.col(f"_b{k}_{b}") > F.col("_n"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0))
    packed = [reduce(lambda a, b: a.bitwiseOR(b), [bit(k, b) for b in range(64)]).alias(f"f{k}") for k in range(bits // 64)]
    return voted.select(*keys, *packed)


def spelled(numbers: list[Column]) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in numbers])


def distance(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(a, b, strict=True)])


def edited(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(bucket, place, doc_id, text, head, edited) per row of `docs`, partitioned by bucket.

    The next document is the next by descending doc_id, NULL doc_ids last, ties by text; after the last comes the first, and a single
    document follows itself. `edited` is the text whose last floor(n / 2) characters gave way to the first as many, or all, of the next.
    Documents are shuffled once, by ranges of doc_id. A bucket's last document, and only that, has a `head`: the next
    bucket's first text.
    """
    cuts = boundaries(docs, "doc_id", max(1, docs.count() // bucket_rows))
    n = len(cuts)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(n + 1)).otherwise(F.lit(n) - bucket_of(F.col("doc_id"), cuts)).cast("int")
    ordered = docs.select(bucket.alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # every cut is a doc_id that occurs, so only the bucket under all cuts and that of NULLs may be empty
    there = [*range(n), *sorted(r["bucket"] for r in ordered.filter(F.col("bucket") >= n).select("bucket").distinct().collect())] or [0]
    heads = ordered.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "text")).alias("head"))
    before = F.when(F.col("bucket") == there[0], F.lit(there[-1]))
    for a, b in zip(there, there[1:], strict=False):
        if b >= n:
            before = before.when(F.col("bucket") == b, F.lit(a))
    heads = heads.select(before.otherwise(F.col("bucket") - 1).alias("bucket"), F.col("head.text").alias("head"))
    window = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    rows = ordered.withColumns({"place": F.row_number().over(window), "inside": F.lead("text").over(window)}).join(heads, "bucket", "left")
    half = F.floor(F.length("text") / 2).cast("int")
    following = F.coalesce("inside", "head")
    text = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(following, F.lit(1), half))
    return rows.select("bucket", "place", "doc_id", "text", F.when(F.col("inside").isNull(), F.col("head")).alias("head"), text.alias("edited"))


def report(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness is the share of equal bits. NULL texts are empty; repeated rows each have a row; other columns are ignored.
    """
    rows = edited(docs)
    one = lambda which, text: F.struct(F.lit(which).alias("which"), F.col(text).alias("t"))
    texts = F.filter(F.array(one(0, "text"), one(1, "edited"), one(2, "head")), lambda x: x["t"].isNotNull())
    keys = ["bucket", "place", "doc_id", "n_chars", "edited_sha256"]
    long = rows.select("bucket", "place", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(texts).alias("_x"))
    long = long.select(*keys, F.col("_x.which").alias("which"), F.col("_x.t").alias("text"))
    numbers = [f"f{k}" for k in range(bits // 64)]
    found = fingerprints(long, [*keys, "which"], bits=bits)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("which") == w, F.col(f))).alias(f"{f}_{w}") for w in range(3) for f in numbers])
    window = Window.partitionBy("bucket").orderBy("place")
    wide = wide.withColumns({f"{f}_next": F.coalesce(F.lead(f"{f}_0").over(window), F.col(f"{f}_2")) for f in numbers})
    own, other, following = ([F.col(f"{f}_{w}") for f in numbers] for w in (0, 1, "next"))
    return wide.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled(own).alias("fingerprint"),
        spelled(other).alias("edited_fingerprint"),
        (1 - distance(own, other) / bits).alias("near_edited"),
        (1 - distance(own, following) / bits).alias("near_next"),
    )


def masks(bits: int, radius: int, spare: int = 1) -> list[list[int]]:
    """A table for each choice of blocks: masks of the 64-bit numbers that keep the bits of those blocks.

    Of radius + spare + 1 blocks at least spare + 1 are untouched by `radius` flipped bits, so two fingerprints within
    the radius agree in all bits of some choice of spare + 1 blocks.
    """
    count = radius + spare + 1
    edges = [bits * i // count for i in range(count + 1)]
    out = []
    for chosen in combinations(range(count), spare + 1):
        kept = sum(((1 << edges[c + 1]) - (1 << edges[c])) for c in chosen)
        numbers = [kept >> 64 * k & (1 << 64) - 1 for k in range(bits // 64)]
        out.append([x - (1 << 64) if x >> 63 else x for x in numbers])
    return out


def within(all_rows: DataFrame, queries: DataFrame, radius: int = 3, bits: int = BITS, spare: int = 1) -> DataFrame:
    """Pairs (q0, q1, …, f0, f1, …, distance) of distinct fingerprints: each of `queries` with all of `all_rows` within `radius` bits.

    Equal fingerprints are looked up once, whatever their number; join the rows back by the numbers. A fingerprint finds itself.
    Both inputs have columns f0, f1, …; NULLs find nothing.
    """
    numbers = [f"f{k}" for k in range(bits // 64)]
    tables = masks(bits, radius, spare)

    def keyed(rows: DataFrame) -> DataFrame:
        keys = F.array(*[F.xxhash64(F.lit(t), *[F.col(f).bitwiseAND(F.lit(m)) for f, m in zip(numbers, mask, strict=True)]) for t, mask in enumerate(tables)])
        return rows.select(*numbers).dropna().distinct().withColumn("key", F.explode(keys))

    asked = keyed(queries).withColumnsRenamed({f: "q" + f[1:] for f in numbers})
    apart = distance([F.col(f) for f in numbers], [F.col("q" + f[1:]) for f in numbers])
    near = asked.join(keyed(all_rows), "key").filter(apart <= radius)
    return near.select(*["q" + f[1:] for f in numbers], *numbers, apart.alias("distance")).distinct()
