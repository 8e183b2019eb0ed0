"""The two classifiers on held-out labels, the pipeline, and the registered queries against SQL."""

import sys

import duckdb
import numpy as np
import pytest
from conftest import ROOT, SF_DIR
from pyspark.sql import functions as F
from small import docs  # noqa: F401

from recallset.llm import quality, queries, toxicity

sys.path.insert(0, str(ROOT))
import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def labelled(spark):
    """Documents of two kinds for each label, with copies of ids, NULLs and labels without documents."""
    draw = np.random.default_rng(1)
    plain = ["river", "stone", "window", "garden", "letter", "morning", "evening", "table"]
    rows = []
    for i in range(600):
        words = list(draw.choice(plain, 40))
        if i % 3 == 0:
            words[5:8] = ["vile", "nastyword", "wretch"]
        rows.append((i, " ".join(words) if i % 4 else " ".join(words).upper() + "!!! ###" * 10))
    docs = spark.createDataFrame([*rows, (None, None), (1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(bool(i % 4)), int(i % 3 == 0)) for i, _ in rows if i < 500), (1, None, None), (None, 1, 1), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == 603 and all((got[i] >= 0.5) == (i % 3 == 0) for i in range(500, 600)) and 0 <= got[1001] == got[1000] < 0.5
    kept = toxicity.keep_clean(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == sum(s < 0.3 for s in got.values())


def test_toxicity_without_labels(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.filter("toxic = 9"))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.5}
    assert toxicity.score(docs.filter("doc_id < 0"), model).count() == 0


def test_toxicity_sample_is_bounded(labelled):
    docs, labels = labelled
    assert 20 < toxicity.labelled_sample(docs, labels, "toxic", F.lit(True), 100).count() < 200


def test_quality(labelled):
    docs, labels = labelled
    stats = quality.measured(docs)
    model = quality.fit(stats, labels)
    got = {r.doc_id: r.score for r in quality.score(stats, model).collect()}
    assert len(got) == 603 and all((got[i] >= 0.5) == bool(i % 4) for i in range(500, 600)) and all(0 <= s <= 1 for s in got.values())
    nothing = quality.fit(stats, labels.filter("quality = 9"))
    assert {r.score for r in quality.score(stats, nothing).collect()} == {0.5}


def test_isotonic():
    knots, values = quality.isotonic([0, 1, 2, 3], [1, 0, 5, 9], [10, 10, 10, 10])
    assert knots.tolist() == [-3, 0.5, 2, 3, 4] and (np.diff(values) >= 0).all()


def test_pipeline_stages(spark, sf_dir, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "decontamination", "token ids"]
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf_dir)
        assert rows.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() == rows.count() > 5


def test_pipeline_run(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 50 < result.count() < 200


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir), connection.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r[list(want.columns).index(c)] for c in got.columns) for r in want.fetchall()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
