"""A written index that is searched after writes, refreshed and compacted."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from recallset import ConfigurationError, IndexSpec, StoreSpec, VectorStore
from recallset.operators import mutate
from recallset.operators import rerank as rr
from recallset.operators.search import search, search_hits
from recallset.plans import index_files as files
from recallset.plans import ivf
from recallset.registry import fixtures as fx

SPEC = fx.SPEC
LISTS = 10


def plan(rows):
    return rows._jdf.queryExecution().toString()


def hits(found):
    return sorted((r["q_id"], r["rank"], r["id"], round(r["distance"], 9)) for r in found.rows.collect())


def build(spark, store, folder, **options):
    centroids = fx.label_means(spark, fx_dir).select(F.col("label").alias("centroid_id"), F.col("mean").alias("centroid"))
    return ivf.build_index(store, IndexSpec(SPEC, **options), f"{folder}/index", centroids=centroids)


fx_dir = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    store = fx.shared_store(spark, fx_dir).cache()
    return folder, store, fx.vector_queries(spark, fx_dir).filter("q_id < 60").cache(), build(spark, store, folder)


def written(spark, store, gone=("3", "8"), moved=("5", "6")):
    """The store after an insert, two updates that also change a filter value, and two deletions."""
    rows = store.filter(F.col("id").isin("5", "6")).select("id", F.reverse("vector").alias("vector"))
    rows = rows.unionByName(store.filter("id = '9'").select(F.lit("fresh").alias("id"), "vector"))
    items = rows.withColumns({"ord": F.lit(0), "metadata": F.struct(F.lit("someone").alias("userId"))})
    after = mutate.upsert(store, items, SPEC, fx.WRITTEN).rows
    ids = spark.createDataFrame([(g,) for g in gone], "id string")
    return mutate.delete(after, ids, SPEC).rows.cache()


def test_search_sees_inserts_updates_and_deletions(spark, world):
    _, store, queries, index = world
    now = written(spark, store)
    since = ivf.changes(index, now)
    assert sorted(r[0].removeprefix(SPEC.key_prefix) for r in since.keys.collect()) == ["3", "5", "6", "8", "fresh"]
    want = hits(search_hits(now, queries, SPEC, limit=6))
    assert hits(ivf.search_index_hits(index, queries, limit=6, n_probes=LISTS, rerank=True, since=since)) == want
    capped = ivf.search_index_hits(index, queries, limit=6, n_probes=LISTS, rerank=True, top_n_scan=200, since=since)
    assert hits(capped) == want
    shuffled = ivf.search_index_hits(index, queries, limit=6, n_probes=LISTS, rerank=True, since=since, method="shuffle")
    assert hits(shuffled) == want
    filtered = {"userId": "someone"}
    found = ivf.search_index(index, now, queries, limit=9, n_probes=LISTS, rerank=True, filters=filtered, since=since)
    want = search(now, queries, SPEC, limit=9, filters=filtered)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.select(*found.columns).collect()))
    rows = ivf.search_index(index, now, queries, limit=6, n_probes=3, since=since).groupBy("q_id").agg(F.max("rank").alias("last"), F.count("*").alias("n"))
    assert rows.filter("last <> n").isEmpty()


def test_nothing_changed(spark, world):
    _, store, queries, index = world
    since = ivf.changes(index, store)
    assert since.keys.isEmpty()
    plain = hits(ivf.search_index_hits(index, queries, limit=3, n_probes=2))
    assert hits(ivf.search_index_hits(index, queries, limit=3, n_probes=2, since=since)) == plain


def test_refresh_compaction_and_status(spark, world, tmp_path):
    _, store, queries, _ = world
    folder = str(tmp_path)
    path = f"{folder}/index"
    first = build(spark, store, folder)
    now = written(spark, store)
    status = ivf.index_status(spark, path, SPEC, now)
    assert (status["state"], status["online"], status["missing_rows"], status["removed_rows"], status["changed_rows"]) == ("behind", True, 1, 2, 2)
    want = hits(search_hits(now, queries, SPEC, limit=6))
    old = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/entries/**/*.parquet", recursive=True)}
    second = ivf.refresh_index(first, ivf.changes(first, now))
    assert len(second.manifest.segments) == 1
    exact = dict(limit=6, n_probes=LISTS, rerank=True)
    assert hits(ivf.search_index_hits(second, queries, **exact)) == want
    assert ivf.index_status(spark, path, SPEC, now)["state"] == "online"
    # the same keys change again: the later segment counts
    again = mutate.delete(now, spark.createDataFrame([("fresh",), ("5",)], "id string"), SPEC).rows.unionByName(store.filter("id = '3'")).cache()
    third = ivf.refresh_index(second, ivf.changes(second, again))
    want = hits(search_hits(again, queries, SPEC, limit=6))
    assert hits(ivf.search_index_hits(third, queries, **exact)) == want
    touched = {r[0] for r in third.entries.filter(F.col("id").isin("3", "5", "6", "8", "9")).select("centroid_id").distinct().collect()}
    done = ivf.compact_index(third)
    assert not done.manifest.segments and hits(ivf.search_index_hits(done, queries, **exact)) == want
    assert {f: os.path.getmtime(f) for f in old} == old  # no file of the first generation was written again
    new = {int(p.rsplit("=", 1)[1]) for p in glob.glob(f"{path}/entries/generation=compacted-*/centroid_id=*")}
    assert 0 < len(new) < LISTS and {n for n, g in enumerate(done.manifest.live) if g} >= new
    assert touched & new
    for index in (first, second, third, done):  # counts follow what is live
        want_counts = index.entries.groupBy("centroid_id", "metadata").agg(F.count("*").alias("n"))
        if index is done or index is third:
            assert sorted(map(str, index.counts.collect())) == sorted(map(str, want_counts.collect()))
    assert ivf.compact_index(done) is done


def test_second_writer_of_one_version_fails(spark, world, tmp_path):
    _, store, _, _ = world
    index = build(spark, store, str(tmp_path))
    since = ivf.changes(index, written(spark, store))
    ivf.refresh_index(index, since)
    with pytest.raises(ConfigurationError, match="another writer"):
        ivf.refresh_index(index, since)
    assert len(ivf.load_index(spark, index.path, SPEC).manifest.segments) == 1
    with pytest.raises(ConfigurationError, match="was written"):
        ivf.compact_index(ivf.make_index(store, IndexSpec(SPEC), fx.label_means(spark, fx_dir).select(F.col("label").alias("centroid_id"), F.col("mean").alias("centroid"))))


def test_broken_build_is_building(spark, world, tmp_path, monkeypatch):
    _, store, _, _ = world
    monkeypatch.setattr(files, "write_manifest", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        build(spark, store, str(tmp_path))
    assert ivf.index_status(spark, f"{tmp_path}/index", SPEC) == {"name": SPEC.index_name, "state": "building", "online": False}
    assert ivf.load_index(spark, f"{tmp_path}/index", SPEC) is None


def test_filters_are_filled(spark, world):
    _, store, _, index = world
    scoped = fx.scoped_queries(spark, fx_dir).drop("limit", "threshold").filter("q_id < 80")
    matching = {r["q_id"]: r["n"] for r in search_hits(store, scoped, SPEC, limit=7).rows.groupBy("q_id").agg(F.count("*").alias("n")).collect()}
    found = ivf.search_index_hits(index, scoped, limit=7, n_probes=1, rerank=True, fill=True).rows
    assert {r["q_id"]: r["n"] for r in found.groupBy("q_id").agg(F.count("*").alias("n")).collect()} == matching
    short = ivf.search_index_hits(index, scoped, limit=7, n_probes=1, rerank=True).rows.count()
    assert short < sum(matching.values())
    now = written(spark, store)
    common = {"userId": "someone"}
    asked = fx.vector_queries(spark, fx_dir).filter("q_id < 20")
    full = ivf.search_index_hits(index, asked, limit=3, n_probes=1, filters=common, fill=True, since=ivf.changes(index, now)).rows
    assert full.count() == 60


def test_plans(spark, world):
    _, _, queries, index = world
    found = ivf.search_index_hits(index, queries, limit=5, n_probes=3, rerank=True, top_n_scan=20)
    text = plan(found.rows)
    assert "dynamicpruning" in text and "zip_with" not in text and "FlatMapCoGroupsInArrow" in text
    assert "isin" not in text.lower()


def test_rerank_deals_a_key_that_many_queries_ask_for(spark):
    vectors = spark.createDataFrame([(f"k{i}", f"k{i}", [1.0, float(i)]) for i in range(6)], "doc_key string, id string, vector array<double>")
    queries = spark.createDataFrame([(q, [1.0, q / 7], 1 + q % 3) for q in range(40)], "q_id int, qv array<double>, limit int")
    pairs = spark.createDataFrame([(q, f"k{i}") for q in range(40) for i in range(7) if i < 2 or q % 2], "q_id int, doc_key string")
    small = rr.ranked(rr.measured(pairs, vectors, queries, 2, group_pairs=8))
    whole = rr.ranked(rr.measured(pairs, vectors, queries, 2))
    rows = sorted(map(tuple, small.collect()))
    assert rows == sorted(map(tuple, whole.collect())) and {r[0] for r in rows} == set(range(40))
    assert all(sum(1 for r in rows if r[0] == q) == min(1 + q % 3, 6 if q % 2 else 2) for q in range(40))
    assert rr.ranked(rr.measured(pairs.limit(0), vectors, queries, 2)).count() == 0


def test_store_object_sees_its_writes(spark, folder):
    spec = StoreSpec(2, filter_fields={"userId": "string"})
    item = "id string, vector array<double>, metadata struct<userId: string>"
    rows = [(f"n{i}", [1.0, i / 10], ("u",)) for i in range(40)]
    store = VectorStore.create(spark, f"{folder}/store", spec)
    store.store_batch(spark.createDataFrame(rows, item), "2026-01-01 00:00:00")
    index = store.build_index(description="IVF4,SQ8")
    query = spark.createDataFrame([(1, [1.0, 0.95])], "q_id int, qv array<double>")

    def ids(i, n=3, **options):
        found = store.search_index(i, query, limit=n, n_probes=4, rerank=True, **options)
        rows = sorted((r["rank"], r["id"]) for r in found.collect())
        assert [r for r, _ in rows] == list(range(1, len(rows) + 1))
        return [i for _, i in rows]

    assert store.changes_since(index) is None and store.index_status(compare=True)["state"] == "online"
    before = ids(index)
    store.store_batch(spark.createDataFrame([("new", [1.0, 0.95], ("v",)), ("n0", [1.0, 0.951], ("v",))], item), "2026-01-01 00:00:00")
    store.delete_batch(spark.createDataFrame([(before[0],)], "id string"), "2026-01-01 00:00:00")
    assert ids(index) == ["new", "n0", before[1]] and ids(index, filters={"userId": "v"}) == ["new", "n0"]
    fresh = store.refresh_index(index)
    assert fresh.manifest.log_seq == 2 and store.changes_since(fresh) is None and ids(fresh) == ["new", "n0", before[1]]
    assert ids(store.compact_index(fresh)) == ["new", "n0", before[1]]
    moved = store.compact(f"{folder}/next")  # another log: what changed is found by comparing
    assert moved.changes_since(fresh).keys.count() == 0
    assert store.index_status(store.index_path("none")) is None
