"""Every registered query against its SQL, over the smallest tables."""

import math
import subprocess
import sys

import duckdb
import pytest

from conftest import ROOT, SF_DIR

sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402

from recallset.registry.oracles import ORACLES  # noqa: E402
from recallset.registry.queries import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = want.fetchall()
    assert comparable(got.collect(), got.columns) == comparable(rows, want.columns)


def test_queries_without_sql(spark, sf_dir):
    assert set(QUERIES) - set(ORACLES) == {"ivf_train", "ivf_recall"}
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    trained = entry.queries()["ivf_train"](spark, sf_dir).collect()
    assert sorted(r["centroid_id"] for r in trained) == list(range(16))
    recall = {r["n_probes"]: r["recall"] for r in entry.queries()["ivf_recall"](spark, sf_dir).collect()}
    assert recall[1] <= recall[4] <= recall[16] and recall[16] == 1.0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["recallset.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_entry_without_what_only_the_text_operators_need(missing):
    script = (
        "import sys\n"
        f"class Missing:\n    def find_spec(self, name, path=None, target=None):\n        if name.split('.')[0] == {missing!r} or name.startswith({missing!r}):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Missing())\n"
        "import __spark_entry__ as entry\n"
        "from recallset.registry.queries import QUERIES\n"
        "assert set(entry.queries()) == set(QUERIES)\n"
    )
    subprocess.run([sys.executable, "-c", script], cwd=ROOT, check=True, timeout=120)
