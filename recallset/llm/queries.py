"""The registered queries of this folder: each applies one operator to its whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fingerprint, line_dedup, phrases, quality, resample, secrets, shingle_join, token_files, toxicity, vector_tree, warc
from .common import stored, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    stats = stored(quality.measured(docs), "quality-statistics")
    model = quality.fit(stats, table(spark, sf_dir, "labels"), "quality", usable=~held_out)
    return quality.score(stats, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", usable=~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.linked(table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(table(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vector_tree.neighbours(rows)


_ALL = (op1_quality, op2_secrets, op3_fingerprint, op4_toxicity, op5_warc, op6_decontaminate, op7_line_dedup, op8_bpe, op9_token_files, op10_shingle_join)
QUERIES = {f.__name__: f for f in (*_ALL, op11_phrases, op12_resample, op13_neighbours)}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op6_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, list_aggregate(w[i : i + least(10, len(w)) - 1], 'string_agg', ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i, k FROM d, (SELECT DISTINCT k FROM windows)),
met AS (
  SELECT s.doc_id, s.i, s.k, x.item_id
  FROM (SELECT doc_id, i, k, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS words FROM starts WHERE i + k - 1 <= len(w)) s JOIN windows x USING (k, words)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, unnest(range(len(lines))) AS no, unnest(lines) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
w AS (SELECT doc_id, no, line, regexp_extract_all({_LOWER.format("line")}, '[^\x20\x09-\x0D]+') AS w FROM l),
t AS (
  SELECT doc_id, no, list_sort(list_distinct([list_aggregate(w[i : i + 4], 'string_agg', ' ') FOR i IN range(1, greatest(2, len(w) - 3))])) AS t
  FROM w WHERE len(w) >= 1),
sets AS (SELECT t, row_number() OVER (ORDER BY min(doc_id * 1000000 + no)) AS id, min(doc_id * 1000000 + no) AS first, len(t) AS n FROM t GROUP BY t),
tokens AS (SELECT id, n, unnest(t) AS token FROM sets),
near AS (
  SELECT DISTINCT y FROM (
    SELECT a.id AS x, b.id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared FROM tokens a JOIN tokens b ON a.token = b.token AND a.id < b.id GROUP BY ALL)
  WHERE 100 * shared >= 80 * (nx + ny - shared)),
gone AS (
  SELECT doc_id, no FROM t JOIN sets USING (t) LEFT JOIN near ON y = id WHERE y IS NOT NULL OR doc_id * 1000000 + no <> first)
SELECT doc_id, count(*) AS n_lines, count(g.no) AS n_removed, coalesce(string_agg(CAST(g.no AS VARCHAR), ',' ORDER BY g.no), '') AS removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL), '')) AS text_sha256
FROM l LEFT JOIN gone g USING (doc_id, no) GROUP BY doc_id""",
    "op10_shingle_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct([list_aggregate(w[i : i + 2], 'string_agg', ' ') FOR i IN range(1, greatest(2, len(w) - 1))]) END AS t
  FROM w),
tokens AS (SELECT doc_id, len(t) AS n, unnest(t) AS token FROM t),
links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY ALL)
  WHERE 100 * shared >= 90 * (nx + ny - shared)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM t UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id FROM t""",
    "op11_phrases": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
grams AS (
  SELECT lang, k, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, c, list_aggregate(w[: c], 'string_agg', ' ') AS first_part, list_aggregate(w[c + 1 :], 'string_agg', ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
  SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, (1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f) AS score,
    row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY (1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f), c) AS best
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.first_part JOIN f y ON y.lang = u.lang AND y.phrase = u.rest),
longer AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, n, CAST(score AS BIGINT) AS score
  FROM scored s JOIN n ON n.lang = s.lang LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE best = 1 AND (g.a IS NULL OR 100 * g.a < 50 * s.a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
}
