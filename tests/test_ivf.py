import pytest
from pyspark.sql import functions as F

from recallset import ConfigurationError, IndexSpec, StoreSpec
from recallset.operators.search import search_hits
from recallset.plans import ivf
from recallset.registry import fixtures as fx
from recallset.sources.store import read_store, write_snapshot

SPEC = fx.SPEC
INDEX = IndexSpec(SPEC, description="IVF12,SQ8")


@pytest.fixture(scope="module")
def world(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ivf"))
    write_snapshot(fx.shared_store(spark, sf_dir), f"{root}/store", SPEC)
    store = read_store(spark, f"{root}/store", SPEC)
    index = ivf.build_index(store, INDEX, f"{root}/index")
    return store, index, fx.vector_queries(spark, sf_dir).cache(), f"{root}/index"


def ids(hits):
    return sorted((r["q_id"], r["rank"], r["id"]) for r in hits.rows.collect())


def test_build_covers_owned_rows_and_is_not_repeated(spark, world):
    store, index, _, path = world
    assert index.entries.count() == store.filter("is_owned").count()
    assert len(index.centroids) == 12
    again = ivf.build_index(store, IndexSpec(SPEC, description="IVF3,SQ8"), path)
    assert len(again.centroids) == 12 and again.spec.description == "IVF12,SQ8"
    assert ivf.index_status(spark, path, SPEC) == {
        "name": SPEC.index_name,
        "state": "online",
        "online": True,
    }
    assert ivf.index_status(spark, path + "-none", SPEC) is None


def test_full_probe_with_rerank_is_exact(world):
    store, index, queries, _ = world
    exact = ids(search_hits(store, queries, SPEC, limit=5))
    assert ids(ivf.search_index_hits(index, queries, limit=5, n_probes=12, rerank=True)) == exact
    # 100 candidates by code hold the five nearest on this data
    capped = ivf.search_index_hits(index, queries, limit=5, n_probes=12, rerank=True, top_n_scan=100)
    assert ids(capped) == exact
    shuffled = ivf.search_index_hits(
        index, queries, limit=5, n_probes=12, rerank=True, top_n_scan=100, method="shuffle"
    )
    assert ids(shuffled) == exact


def test_recall_grows_with_probes(world):
    store, index, queries, _ = world
    exact = {(q, i) for q, _, i in ids(search_hits(store, queries, SPEC, limit=10))}
    recalls = []
    for n in (1, 3, 6, 12):
        found = ids(ivf.search_index_hits(index, queries, limit=10, n_probes=n, rerank=True))
        recalls.append(len({(q, i) for q, _, i in found} & exact) / len(exact))
    assert recalls == sorted(recalls) and recalls[0] < 1 and recalls[-1] == 1


def test_probing_with_filters_equals_exact_search_under_them(spark, world, sf_dir):
    store, index, _, _ = world
    scoped = fx.scoped_queries(spark, sf_dir).drop("limit", "threshold")
    exact = ids(search_hits(store, scoped, SPEC, limit=3))
    assert ids(ivf.search_index_hits(index, scoped, limit=3, n_probes=12, rerank=True)) == exact
    common = {"conversationId": "en"}
    exact = ids(search_hits(store, scoped.drop("conversationId"), SPEC, limit=3, filters=common))
    found = ivf.search_index_hits(
        index, scoped.drop("conversationId"), limit=3, filters=common, n_probes=12, rerank=True
    )
    assert ids(found) == exact


def test_candidate_cap(world):
    _, index, queries, _ = world
    for rerank in (True, False):
        hits = ivf.search_index_hits(
            index, queries, limit=10, n_probes=12, rerank=rerank, top_n_scan=4
        ).rows
        assert hits.groupBy("q_id").count().agg(F.max("count")).first()[0] == 4


def test_index_default_probes_and_payload(spark, world):
    store, index, queries, _ = world
    default = ids(ivf.search_index_hits(index, queries, limit=3))
    assert default == ids(ivf.search_index_hits(index, queries, limit=3, n_probes=1))
    row = ivf.search_index(index, store, queries, limit=1, n_probes=12, rerank=True).first()
    assert len(row["vector"]) == fx.DIMENSIONS and row["rank"] == 1


def test_only_probed_lists_are_read(world, capsys):
    _, index, queries, _ = world
    hits = ivf.search_index_hits(index, queries.filter("q_id = 0"), n_probes=2)
    hits.rows.explain("formatted")
    plan = capsys.readouterr().out
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "dynamicpruning" in filters and "centroid_id" in filters
    assert "vector:" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_refused_options(spark, world, sf_dir):
    store, index, queries, _ = world
    with pytest.raises(ConfigurationError, match="rerank needs"):
        ivf.search_index_hits(index, queries, rerank=True)
    codes_only = ivf.Index(
        IndexSpec(SPEC, persist_full_vector=False), index.centroids, index.low, index.high, index.entries
    )
    with pytest.raises(ConfigurationError, match="persist_full_vector=False"):
        ivf.search_index_hits(codes_only, queries, n_probes=1, rerank=True)
    with pytest.raises(ConfigurationError, match="train_list is"):
        ivf.train_centroids(store, IndexSpec(SPEC, train_list=1_000_000))


def test_stats_show_what_the_index_has_missed(spark, world):
    store, index, _, _ = world
    gone = store.filter("id <> '7'")
    moved = gone.withColumn(
        "updated_at", F.when(F.col("id") == "8", F.current_timestamp()).otherwise(F.col("updated_at"))
    )
    new = store.filter("id = '9'").withColumn("doc_key", F.lit("fresh"))
    stats = ivf.index_stats(index, moved.unionByName(new)).first()
    assert (stats["missing_rows"], stats["removed_rows"], stats["changed_rows"]) == (1, 1, 1)
    assert stats["lists"] == 12 and stats["indexed_rows"] == stats["store_rows"]


def test_unusable_vectors_stay_out(spark):
    spec = StoreSpec(2)
    rows = spark.createDataFrame(
        [("k1", spec.document_type, [1.0, 0.0]), ("k2", spec.document_type, [0.0, 0.0]), ("k3", spec.document_type, [1.0])]
        + [(f"n{i}", spec.document_type, [1.0, float(i)]) for i in range(5)],
        "doc_key string, document_type string, vector array<double>",
    )
    store = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in spec.schema.fields
        ]
    )
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "centroid_id int, centroid array<double>")
    index = ivf.make_index(store, IndexSpec(spec), centroids)
    assert {r["doc_key"] for r in index.entries.collect()} == {"k1", *[f"n{i}" for i in range(5)]}


def test_nothing_to_train_on(spark):
    with pytest.raises(ConfigurationError, match="no vectors"):
        ivf.make_index(spark.createDataFrame([], SPEC.schema), INDEX)


def two_wide(spark, rows):
    spec = StoreSpec(2)
    plain = spark.range(rows).select(
        F.col("id").cast("string").alias("doc_key"),
        F.lit(spec.document_type).alias("document_type"),
        F.array(F.lit(1.0), F.col("id").cast("double")).alias("vector"),
    )
    return spec, plain.select(
        *[
            (F.col(f.name) if f.name in plain.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in spec.schema.fields
        ]
    )


def test_training_reads_all_rows_and_starts_alike_at_every_size(spark, monkeypatch):
    class Recorded:
        def __init__(self, k, initMode, **_):
            self.k = k
            starts.append(initMode)

        def fit(self, points):
            counts.append(points.count())
            return self

        def clusterCenters(self):
            return [[1.0, 0.0]] * self.k

    starts, counts = [], []
    monkeypatch.setattr(ivf, "KMeans", Recorded)
    spec, store = two_wide(spark, 3000)
    for lists in (2, 1025):
        ivf.train_centroids(store, IndexSpec(spec, description=f"IVF{lists},SQ8"))
    assert counts == [3000, 3000] and len(set(starts)) == 1
    ivf.train_centroids(store, IndexSpec(spec, description="IVF2,SQ8", train_list=600))
    assert 450 < counts[2] < 750


def test_fewer_lists_than_asked_are_refused(spark):
    spec, store = two_wide(spark, 2)
    with pytest.raises(ConfigurationError, match="asks for 50 lists"):
        ivf.train_centroids(store, IndexSpec(spec, description="IVF50,SQ8"))


def test_given_centroids_are_checked(spark):
    schema = "centroid_id int, centroid array<double>"
    for rows, message in (([(1, [1.0, 0.0])], "count from 0"), ([(0, [1.0])], "must have 2 values")):
        with pytest.raises(ConfigurationError, match=message):
            ivf.as_matrix(spark.createDataFrame(rows, schema), 2)


def test_list_count():
    assert ivf.list_count(IndexSpec(SPEC), 10_000) == 100
    assert ivf.list_count(IndexSpec(SPEC), 0) == 1
    assert ivf.list_count(IndexSpec(SPEC, train_list=50), 10_000) == 50
    assert ivf.list_count(IndexSpec(SPEC), 10**14) * 8 * fx.DIMENSIONS <= ivf.CENTROID_BYTES
    with pytest.raises(ConfigurationError):
        ivf.list_count(IndexSpec(SPEC, description="IVF99999999,SQ8"), 10)
