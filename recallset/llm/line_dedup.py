"""Line dedup: an exact set-similarity join of lines by prefix filtering; of similar lines the later ones are removed.

A line's tokens are its five-word shingles; lines of fewer words than that are one token, and lines of fewer than `min_words` words
are left alone. Words are runs of characters other than ASCII white space, with A-Z in lower case. Lines are ordered by (doc_id, hash
of the text, line number), NULL doc_ids last. A line is removed if the Jaccard similarity of its tokens to those of an earlier
line, itself removed or not, is at least the threshold. Only DataFrame functions are used.

Lines of equal words, and lines whose only token is the same, are one line from the start. Tokens are numbers whose upper 8 bits are
the class of the rarest of their words, which no shingle can be more frequent than, so that the ascending order of a line's tokens
is the order by rarity; the other 56 bits are a hash. Lines are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, stored

WIDTH = 5
#: Word counts are kept in 2 to this power cells, each of the words whose hashes have the same low bits; the rarity of a word is its cell's.
CELL_BITS = 16
#: Bits of a word's class of rarity, and of the hash under it.
CLASS_BITS = 8
REST = 64 - CLASS_BITS
#: A letter outside ASCII that `lower` would change. Only characters outside ASCII are looked up in the classes.
OTHER_CAPITAL = r"[^\x00-\x7F](?<=[\p{IsUppercase}\p{Lt}])"
#: ASCII white space but the space and the line end, and two spaces; each is searched as bytes.
ODD_SPACES = ["\t", "\x0b", "\x0c", "\r", "  "]
LINE = ["h", "g"]
#: Sketches have so many numbers of 64 bits, a power of two. Lines of more tokens than some 1,000 set half of all bits, and few are ruled out.
SKETCH = 8


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once, however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_lower(rows: DataFrame, text: str) -> DataFrame:
    """Column `text` with A-Z in lower case and all else as it is: by `lower` where that changes no other letter."""
    ascii_only = F.octet_length(text) == F.length(text)
    return rows.withColumn(text, F.when(ascii_only | ~F.col(text).rlike(OTHER_CAPITAL), F.lower(text)).otherwise(ascii_lower(F.col(text))))


def plain(rows: DataFrame, text: str) -> DataFrame:
    """Column `text` in lower case, with one space for each run of white space within a line."""
    odd = reduce(Column.__or__, (F.col(text).contains(c) for c in ODD_SPACES))
    return in_lower(rows, text).withColumn(text, F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(F.col(text)))


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_hash, line, words) of each line with at least `min_words` words, one space between words and none around them."""
    lines = plain(keyed(docs), "text").select("doc_id", "text_hash", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "words"))
    enough = F.size(F.split("words", " ", min_words)) >= min_words if min_words > 1 else F.lit(True)
    return lines.withColumn("words", F.trim("words")).filter((F.col("words") != "") & enough)


def cell_of(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << CELL_BITS) - 1)).cast("int")


def rarity(docs: DataFrame) -> Column:
    """A literal array with the class of each cell of words, the rarest lowest: at most 2 ** CELL_BITS rows reach the driver.

    Classes are eighths of powers of two, in one byte: plans spell their literals out, and the driver keeps the plans of all steps.
    Words are counted where single spaces and line ends part them. The few that other white space parts are classed by their cell
    all the same: a class orders tokens, and any order that all lines share finds the same pairs.
    """
    words = in_lower(docs.select("text"), "text").select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    counts = words.groupBy(cell_of(F.xxhash64("word")).alias("cell")).agg(F.count("*").alias("n"))
    found = counts.select("cell", (F.least(F.floor(8 * F.log2(F.col("n") + 1)), F.lit(255)) - 128).cast("int").alias("class")).toArrow()
    classes = [-128] * (1 << CELL_BITS)
    for cell, own in zip(found.column("cell").to_pylist(), found.column("class").to_pylist(), strict=True):
        classes[cell] = own
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<tinyint>")


def with_tokens(rows: DataFrame, classes: Column) -> DataFrame:
    """Column `tokens`: the distinct tokens of `words`, rarest first; of a line of fewer words than a shingle the one token of all.

    Each word becomes one number, its class above a part of its hash; a shingle is the lowest class of its words above a hash of their numbers.
    """
    hashes = F.transform(F.split("words", " "), lambda w: F.xxhash64(w))
    numbers = F.transform(hashes, lambda h: F.shiftleft(F.get(classes, cell_of(h)).cast("long"), REST).bitwiseOR(F.shiftrightunsigned(h, CLASS_BITS)))
    windows = F.transform("_numbers", lambda x, i: F.array(x, *[F.get("_numbers", i + k) for k in range(1, WIDTH)]))  # `slice` would copy the line each time
    ranked = F.transform(windows, lambda w: F.array_min(w).bitwiseAND(F.lit(-1 << REST)).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), CLASS_BITS)))
    whole = F.slice(ranked, F.lit(1), F.greatest(F.size("_numbers") - (WIDTH - 1), F.lit(1)))
    return rows.withColumn("_numbers", numbers).withColumn("tokens", F.sort_array(F.array_distinct(whole))).drop("_numbers")


def place(doc_id: str = "doc_id") -> Column:
    return F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("doc_id"), "text_hash", "line")


def removed_lines(docs: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """(doc_id, text_hash, line) of each removed line, once for rows that repeat doc_id and text.

    The prefix of a line's tokens is dealt out by token. Lines under the same token are first compared with the first of
    them; those without a similar earlier line after that, with all other earlier ones that size, position and sketch allow.
    """
    with Scratch(docs.sparkSession) as scratch:
        classes = rarity(docs)
        size = F.size("tokens")
        most = size - F.ceil(size * percent / F.lit(100)).cast("int") + 1
        # a longer line of one token repeats one word, however often; its first words stand for it
        told = F.when(size > 1, F.col("words")).otherwise(F.substring_index("words", " ", WIDTH))
        ids = [F.xxhash64("told").alias("h"), F.xxhash64(F.lit(1), "told").alias("g")]
        lines = with_tokens(lines_of(docs, min_words), classes)
        lines = lines.withColumn("told", told).select("doc_id", "text_hash", "line", *ids, size.alias("n"), F.when(size > 1, F.slice("tokens", 1, most)).alias("prefix"))
        lines = scratch.stored(lines, "lines")

        # lines of one token are similar only if they are equal
        sets = lines.filter("n > 1").groupBy(*LINE).agg(F.min(place()).alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        at = F.coalesce("first.doc_id", F.lit((1 << 63) - 1))
        dealt = sets.select("h", at.alias("at"), "n", F.posexplode("prefix").alias("pos", "token")).select("token", "at", "h", "n", (F.col("n") - F.col("pos")).alias("rest"))
        order = Window.partitionBy("token").orderBy("at", "h")
        head = F.first(F.struct("h", "n", "rest")).over(order)
        after, before = F.lead("h").over(order).isNotNull(), F.lag("h").over(order).isNotNull()
        met = dealt.withColumn("head", head).withColumn("more", after)
        met = met.withColumn("crowd", before & after | F.lag("h", 2).over(order).isNotNull())  # neither the first nor alone with it
        met = scratch.stored(met.filter(F.col("more") | (F.col("h") != F.col("head.h"))).drop("more"), "met")
        del sets, dealt
        scratch.free()

        places = scratch.stored(lines.select("doc_id", "text_hash", "line", *LINE), "line-places")
        scratch.drop(lines)
        narrow = scratch.stored(places.groupBy(*LINE).agg(F.min(place()).alias("first"), F.count("*").alias("lines")), "first-places")
        fits = _fits(F.col("n"), F.col("rest"), F.col("head.n"), F.col("head.rest"), percent)
        firsts = scratch.stored(met.filter((F.col("h") != F.col("head.h")) & fits).select(F.col("h").alias("x"), F.col("head.h").alias("y")).distinct(), "pairs-first")
        crowd = met.filter("crowd").select("token", "at", "h", "n", "rest")
        wanted = firsts.select(F.explode(F.array("x", "y")).alias("h")).unionByName(crowd.select("h")).distinct()
        members = scratch.stored(_members(docs, narrow.join(wanted, "h", "left_semi"), classes), "line-members")
        scratch.free()

        matched = scratch.stored(_later(firsts, members, percent), "matched-first")
        crowd = scratch.stored(crowd.join(_sketches(members.join(crowd.select("h").distinct(), "h", "left_semi")), "h"), "crowd")
        scratch.drop(met)
        scratch.free()

        open_ = crowd.join(matched.select("h").distinct(), "h", "left_anti")
        open_, other = (side.select("token", *(F.col(c).alias(f"{name}_{c}") for c in crowd.columns if c != "token")) for side, name in ((open_, "x"), (crowd, "y")))
        fits = _fits(F.col("x_n"), F.col("x_rest"), F.col("y_n"), F.col("y_rest"), percent) & _near("x", "y", percent)
        earlier = (F.col("y_at") <= F.col("x_at")) & (F.col("y_h") != F.col("x_h")) & fits
        pairs = open_.join(other, "token").filter(earlier).select(F.col("x_h").alias("x"), F.col("y_h").alias("y")).distinct()
        matched = matched.unionByName(_later(pairs, members, percent)).distinct().withColumn("matched", F.lit(True))

        repeated = narrow.join(matched, LINE, "left").filter("lines > 1 OR matched")
        found = places.join(repeated, LINE)
        found = found.filter(F.coalesce("matched", F.lit(False)) | (place() != F.col("first")))
        found = stored(found.select("doc_id", "text_hash", "line").distinct(), "removed-lines")
        scratch.free()
        return found


def _fits(n: Column, rest: Column, other_n: Column, other_rest: Column, percent: int) -> Column:
    """Whether lines of so many tokens, and so many from a common one on, can be similar if it is their first common token."""
    return F.least(rest, other_rest).cast("long") * (100 + percent) >= (n + other_n).cast("long") * percent


def _sketches(members: DataFrame) -> DataFrame:
    """(h, s0, s1, ...) per line: bits, each the parity of the number of the line's tokens that are hashed to it."""
    tokens = members.select(*LINE, F.explode("tokens").alias("token"))
    bit = F.expr("shiftleft(1L, cast(token & 63 as int))")
    word = F.shiftright("token", 6).bitwiseAND(F.lit(SKETCH - 1))
    sums = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SKETCH)]
    return tokens.groupBy(*LINE).agg(*sums).drop("g")


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the sketches of two lines let them be similar: bits that differ are no more than tokens that only one of the lines has."""
    differ = reduce(Column.__add__, (F.bit_count(F.col(f"{x}_s{k}").bitwiseXOR(F.col(f"{y}_s{k}"))) for k in range(SKETCH)))
    return differ.cast("long") * (100 + percent) <= (F.col(f"{x}_n") + F.col(f"{y}_n")).cast("long") * (100 - percent)


def _members(docs: DataFrame, named: DataFrame, classes: Column) -> DataFrame:
    """(h, g, first, tokens) of the lines that `named` places. A document meets all its lines at once and is cut once."""
    wanted = named.groupBy(F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash")).agg(F.collect_list(F.struct(*LINE, "first")).alias("_lines"))
    found = keyed(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))

    def picked(lines: Column) -> Column:
        return F.transform("_lines", lambda w: F.struct(w["h"].alias("h"), w["g"].alias("g"), w["first"].alias("first"), F.get(lines, w["first"]["line"]).alias("words")))

    found = found.select(F.explode(let(F.split("text", "\n"), picked)).alias("own")).select("own.*").dropDuplicates(LINE)
    return with_tokens(plain(found, "words").withColumn("words", F.trim("words")), classes).select(*LINE, "first", "tokens")


def _later(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(h, g) of the later line of each similar pair (x, y)."""
    one = members.select(F.col("h").alias("x"), F.struct("first", *LINE).alias("one"), F.col("tokens").alias("one_tokens"))
    two = members.select(F.col("h").alias("y"), F.struct("first", *LINE).alias("two"), F.col("tokens").alias("two_tokens"))
    shared = F.size(F.array_intersect("one_tokens", "two_tokens")).cast("long")
    both = F.size("one_tokens").cast("long") + F.size("two_tokens")
    similar = pairs.join(two, "y").join(one, "x").filter(shared * (100 + percent) >= both * percent)
    return similar.select(F.greatest("one", "two").alias("later")).select("later.h", "later.g").distinct()


def report(docs: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """Per row of `docs`: doc_id, n_lines, n_removed, removed (numbers of removed lines from 0, comma-joined) and text (what is kept).

    NULL and empty texts are one empty line, which stays.
    """
    gone = removed_lines(docs, percent, min_words).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("line")).alias("gone"))
    found = keyed(docs).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"}).join(gone, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")), "left")
    gone_or_none = F.coalesce("gone", F.array().cast("array<int>"))
    return found.select(
        F.col("_doc").alias("doc_id"),
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.size(gone_or_none).cast("long").alias("n_removed"),
        F.array_join(gone_or_none.cast("array<string>"), ",").alias("removed"),
        _kept_text(F.col("text"), gone_or_none).alias("text"),
    )


def _kept_text(text, gone):
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.when(F.size(gone) == 0, F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(gone, i)), "\n"))


def without_later_lines(docs: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """`docs` with its columns, text without removed lines and n_chars to match; documents of which no word is left are dropped.

    Documents without a removed line are passed on unchanged, empty and NULL texts too.
    """
    gone = removed_lines(docs, percent, min_words).groupBy("doc_id", "text_hash").agg(F.collect_list("line").alias("_gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    found = docs.withColumn("_text_hash", F.xxhash64("text")).join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash")), "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(_kept_text(F.col("text"), F.col("_gone")))
    found = found.withColumn("text", text).filter(F.col("_gone").isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return found.select(*docs.columns)
