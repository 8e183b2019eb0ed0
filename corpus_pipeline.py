"""The pipeline over `documents`: toxicity, line dedup, near duplicates, benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns a DataFrame; `run` writes what a stage returns as
Parquet under the shared checkpoint folder and hands it to the next. NULL and empty texts pass every stage: they are not toxic, have
one empty line, no shingle, no word and no token. Columns beside those of `documents` are passed on by all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recallset.llm import bpe, decontaminate, line_dedup, shingle_join, toxicity
from recallset.llm.common import stored, table

THRESHOLD = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold, by a classifier fitted to those of `docs` that `labels` marks."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic"), THRESHOLD)


def without_later_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are similar to earlier ones, lines of one or two words too; a document of which no word is left goes."""
    return line_dedup.without_later_lines(docs, min_words=1)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at a similarity of 0.8 connect."""
    return shingle_join.one_of_each(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of its token ids, and digests of the ids and of the decoded text."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_later_lines),
    ("near duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("token ids", token_ids),
]

#: The classifier and the tokenizer cannot be written in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
