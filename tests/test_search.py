import math

import pytest
from pyspark.sql import functions as F

from recallset import StoreSpec, UnsupportedFilterError, ValidationError
from recallset.functions.vectors import cosine_distance, distance_to_score, literal_vector
from recallset.operators import mutate
from recallset.operators.nearest import nearest
from recallset.operators.search import search, search_hits, search_one
from recallset.registry import fixtures as fx
from recallset.sources.store import empty_store

SPEC = StoreSpec(2)
AS_OF = "2026-01-01 00:00:00"
META = "struct<userId: string, conversationId: string, content: string>"


@pytest.fixture(scope="module")
def store(spark):
    rows = [
        ("same", [1.0, 0.0], ("u1", "c1", None), "own text"),
        ("close", [0.9, 0.1], ("u1", "c1", "text in metadata"), None),
        ("unrelated", [0.0, 1.0], ("u2", "c2", "ignored"), ""),
    ]
    items = spark.createDataFrame(rows, f"id string, vector array<double>, metadata {META}, content string")
    return mutate.upsert(empty_store(spark, SPEC), items, SPEC, AS_OF).rows.cache()


def queries(spark, *rows, extra=""):
    return spark.createDataFrame(list(rows), "q_id int, qv array<double>" + extra)


@pytest.mark.parametrize("distance, score", [(0.0, 1.0), (1.0, 0.5), (2.0, 0.0), (-1.0, 1.0), (3.0, 0.0)])
def test_score(spark, distance, score):
    assert spark.range(1).select(distance_to_score(F.lit(distance))).first()[0] == score


@pytest.mark.parametrize("distance", [float("nan"), float("inf"), None])
def test_undefined_distance_is_an_error(spark, distance):
    value = F.lit(distance).cast("double")
    with pytest.raises(Exception, match="not a finite number"):
        spark.range(1).select(distance_to_score(value)).collect()
    assert spark.range(1).select(distance_to_score(value, strict=False)).first()[0] is None


def test_cosine_distance(spark):
    def distance(a, b):
        return spark.range(1).select(cosine_distance(literal_vector(a), literal_vector(b))).first()[0]

    assert distance([1, 0], [2, 0]) == 0
    assert distance([1, 0], [0, 3]) == 1
    assert distance([1, 0], [-1, 0]) == 2
    assert distance([1, 0], [0, 0]) is None
    assert math.isclose(distance([0.9, 0.1], [1, 0]), 0.006116, abs_tol=1e-6)


def test_filtered_search(spark, store):
    filters = {"userId": "u1", "conversationId": "c1"}
    one = search_one(store, [1.0, 0.0], SPEC, 2, 0.5, filters).collect()
    builtin = search_one(store, [1.0, 0.0], SPEC, 2, 0.5, filters, builtin=True).collect()
    many = search(store, queries(spark, (1, [1.0, 0.0])), SPEC, 2, 0.5, filters).orderBy("rank").collect()
    for hits in (one, builtin, many):
        assert [h["id"] for h in hits] == ["same", "close"]
        assert hits[0]["score"] == 1 and round(hits[1]["score"], 6) == 0.996942
        assert [h["content"] for h in hits] == ["own text", "text in metadata"]
    assert [r["rank"] for r in many] == [1, 2]


def test_empty_content_is_kept(store):
    hits = {h["id"]: h["content"] for h in search_one(store, [1.0, 0.0], SPEC).collect()}
    assert hits["unrelated"] == ""


def test_threshold_comes_after_the_limit(spark, store):
    assert [h["id"] for h in search_one(store, [0.0, 1.0], SPEC, 3, 0.6).collect()] == ["unrelated"]
    # Within the limit nothing passes; the third row would, but it is beyond the limit of two.
    q = queries(spark, (1, [1.0, 0.0], 2, 0.999), extra=", limit int, threshold double")
    assert [h["id"] for h in search(store, q, SPEC).collect()] == ["same"]


def test_limits_thresholds_and_filters_per_query(spark, store):
    q = queries(
        spark,
        (1, [1.0, 0.0], 1, 0.0, None),
        (2, [1.0, 0.0], 5, 0.0, "u2"),
        (3, [1.0, 0.0], 5, 0.9, None),
        (4, [1.0, 0.0], 5, 0.0, "nobody"),
        extra=", limit int, threshold double, userId string",
    )
    for method in ("broadcast", "shuffle"):
        hits = search_hits(store, q, SPEC, method=method).rows.orderBy("q_id", "rank").collect()
        assert [(h["q_id"], h["id"]) for h in hits] == [
            (1, "same"),
            (2, "unrelated"),
            (3, "same"),
            (3, "close"),
        ]


def test_values_of_another_class_match_nothing(spark):
    spec = StoreSpec(2, filter_fields={"n": "number", "s": "string", "b": "boolean"})
    items = spark.createDataFrame(
        [("a", [1.0, 0.0], (1.0, "1", True))],
        "id string, vector array<double>, metadata struct<n: double, s: string, b: boolean>",
    )
    store = mutate.upsert(empty_store(spark, spec), items, spec, AS_OF).rows

    def ids(**filters):
        return [h["id"] for h in search_one(store, [1.0, 0.0], spec, filters=filters).collect()]

    assert ids(n=1) == ids(s="1") == ids(b=True) == ids(n=1, s="1", b=True) == ["a"]
    assert ids(n="1") == ids(s=1) == ids(b="true") == ids(n=True) == ids(b=1) == []
    typed = queries(spark, (1, [1.0, 0.0], "1", None), (2, [1.0, 0.0], None, 1), extra=", n string, s int")
    assert search_hits(store, typed, spec).rows.count() == 0
    right = queries(spark, (1, [1.0, 0.0], 1, "1"), extra=", n int, s string")
    assert search_hits(store, right, spec).rows.count() == 1
    zero = store.withColumn("metadata", F.col("metadata").withField("n", F.lit(-0.0)))
    for method in ("broadcast", "shuffle"):
        q = queries(spark, (1, [1.0, 0.0], 0.0), extra=", n double")
        assert search_hits(zero, q, spec, method=method).rows.count() == 1
    nan = queries(spark, (1, [1.0, 0.0], float("nan")), extra=", n double")
    with pytest.raises(Exception, match="finite number"):
        search_hits(store, nan, spec).rows.collect()


def test_scope(spark, store):
    """Another prefix with the same document type is seen, unless the scope is the prefix."""
    other = store.filter("id = 'same'").withColumn("doc_key", F.lit("else::same"))
    wrong_type = store.filter("id = 'same'").withColumn("document_type", F.lit("invoice"))
    all_rows = store.unionByName(other).unionByName(wrong_type.withColumn("doc_key", F.lit("inv")))
    assert search_one(all_rows, [1.0, 0.0], SPEC).count() == 4
    assert search_one(all_rows, [1.0, 0.0], StoreSpec(2, search_scope="prefix")).count() == 3


def test_bad_requests_are_refused(spark, store):
    with pytest.raises(ValidationError, match="dimension mismatch"):
        search_one(store, [1.0], SPEC)
    with pytest.raises(ValidationError, match="finite"):
        search_one(store, [1.0, float("nan")], SPEC)
    with pytest.raises(ValidationError, match="positive integer"):
        search_one(store, [1.0, 0.0], SPEC, 0)
    with pytest.raises(ValidationError, match="between 0 and 1"):
        search_one(store, [1.0, 0.0], SPEC, 1, 2)
    with pytest.raises(UnsupportedFilterError):
        search_one(store, [1.0, 0.0], SPEC, filters={"other": 1})
    for q in (
        queries(spark, (1, [1.0])),
        queries(spark, (1, [1.0, float("inf")])),
        queries(spark, (1, [1.0, 0.0], 0), extra=", limit int"),
        queries(spark, (1, [1.0, 0.0], 2.5), extra=", limit double"),
        queries(spark, (1, [1.0, 0.0], 1.5), extra=", threshold double"),
    ):
        with pytest.raises(Exception, match="mismatch|finite|positive integer|between 0 and 1"):
            search_hits(store, q, SPEC).rows.collect()


def test_no_queries_no_hits(spark, store):
    none = queries(spark).filter("q_id > 0")
    for method in ("broadcast", "shuffle"):
        assert search(store, none, SPEC, method=method).count() == 0


def test_a_stored_vector_without_direction(spark, store):
    zero = store.limit(1).withColumn("vector", F.array(F.lit(0.0), F.lit(0.0))).withColumn("id", F.lit("zero"))
    rows = store.unionByName(zero.withColumn("doc_key", F.lit("zero")))
    for builtin in (True, False):
        with pytest.raises(Exception, match="not a finite number"):
            search_one(rows, [1.0, 0.0], SPEC, builtin=builtin).collect()
        assert search_one(rows, [1.0, 0.0], SPEC, strict=False, builtin=builtin).count() == 3
    with pytest.raises(Exception, match="not a finite number"):
        search_hits(rows, queries(spark, (1, [1.0, 0.0])), SPEC).rows.collect()
    assert search_hits(rows, queries(spark, (1, [1.0, 0.0])), SPEC, strict=False).rows.count() == 3


def test_a_hot_key_is_cut_and_nothing_is_lost(spark, sf_dir):
    """A third of rows and queries share one key, and as many rows are copies of one vector."""
    emb = fx.table(spark, sf_dir, "embeddings")
    hot = F.col("vec_id") % 3 == 0
    first = emb.filter("vec_id = 0").first()["embedding"]
    rows = emb.select(
        F.concat(F.lit("k"), "vec_id").alias("doc_key"),
        F.col("vec_id").cast("string").alias("id"),
        F.when(F.col("vec_id") % 3 == 1, F.array(*[F.lit(x).cast("float") for x in first]))
        .otherwise(F.col("embedding"))
        .alias("vector"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("vec_id") % 17).cast("string"))).alias("t"),
    )
    asked = rows.select(
        F.col("id").alias("q_id"), F.col("vector").alias("qv"), F.lit(4).alias("limit"), F.col("t").alias("t")
    )
    for fields in ([], ["t"]):
        got = {}
        for name, options in {
            "broadcast": {"method": "broadcast"},
            "shuffle": {"method": "shuffle"},
            "small pieces": {"method": "shuffle", "block_bytes": 64 * 8 * fx.DIMENSIONS},
            "too many hits": {"block_hits": 40},
        }.items():
            found = nearest(rows, asked, fx.DIMENSIONS, fields, **options)
            assert found.bounded == (name == "broadcast")
            got[name] = sorted(map(tuple, found.rows.collect()))
        assert len(got["broadcast"]) == 4 * rows.count()
        assert all(v == got["broadcast"] for v in got.values())


def test_merging_in_shares_changes_nothing(spark, monkeypatch):
    from recallset.operators import nearest as module

    rows = spark.range(500).select(
        F.col("id").cast("string").alias("doc_key"),
        F.col("id").cast("string").alias("id"),
        F.array(F.lit(1.0), (F.col("id") % 50).cast("double")).alias("vector"),
    )
    asked = rows.limit(20).select(F.col("id").alias("q_id"), F.col("vector").alias("qv"), F.lit(7).alias("limit"))
    small = {"broadcast": {}, "shuffle": {"block_bytes": 64 * 16}}
    plain = {m: sorted(map(tuple, nearest(rows, asked, 2, method=m, **o).rows.collect())) for m, o in small.items()}
    monkeypatch.setattr(module, "MERGE_ROWS", 2)
    for m, o in small.items():
        hits = nearest(rows, asked, 2, method=m, **o).rows
        assert hits._jdf.queryExecution().analyzed().toString().count("row_number()") == 2
        assert sorted(map(tuple, hits.collect())) == plain[m] == plain["broadcast"]


@pytest.mark.parametrize("text, size", [("128MB", 128 << 20), ("134217728b", 128 << 20), ("1g", 1 << 30), ("7", 7)])
def test_sizes(text, size):
    from recallset.operators.nearest import _bytes

    assert _bytes(text) == size


def test_plans(spark, store, folder, capsys):
    store.write.parquet(f"{folder}/s")
    read = spark.read.parquet(f"{folder}/s")
    search_one(read, [1.0, 0.0], SPEC, columns=["content"], builtin=True).explain("formatted")
    assert capsys.readouterr().out.count(") TakeOrderedAndProject") == 2
    search_one(read, [1.0, 0.0], SPEC, filters={"userId": "u1"}, columns=["content"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "rangepartitioning" not in plan
    assert "EqualTo(metadata.userId,u1)" in plan and "EqualTo(document_type" in plan
    search(read, queries(spark, (1, [1.0, 0.0])), SPEC, columns=["content"]).explain("formatted")
    many = capsys.readouterr().out
    assert "BroadcastHashJoin" in many and "Cartesian" not in many and "NestedLoop" not in many
    # The scan for the payload does not read the vectors, the scan for the search not the content.
    scans = [line for line in many.splitlines() if line.startswith("ReadSchema")]
    assert sorted(("vector" in line, "content:string>,content" in line) for line in scans) == [
        (False, True),
        (True, False),
    ]
