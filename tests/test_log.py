import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recallset import CollisionError, StoreSpec, ValidationError, VectorStore
from recallset.operators import mutate
from recallset.sources import store as src
from recallset.streaming.ingest import ingest, log_batch

SPEC = StoreSpec(2)
ITEM = "id string, vector array<double>, content string, ord int, op string"
META_ITEM = "id string, vector array<double>, metadata struct<userId: string, content: string>, content string"
UP, DEL = src.UPSERT, src.DELETE


def day(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=n)


BATCHES = [
    [("a", [1.0, 0.0], "a0", 0, UP), ("b", [1.0, 0.0], "b0", 0, UP), ("a", [0.0, 1.0], "a1", 1, None)],
    [("a", None, None, 0, DEL), ("c", [1.0, 1.0], "c1", 0, UP)],
    [("a", [1.0, 2.0], "a2", 0, UP), ("c", None, None, 0, DEL), ("c", [1.0, 3.0], "c2", 1, UP)],
    [("b", [5.0, 5.0], None, 0, UP), ("base", [2.0, 2.0], "new", 0, UP), ("none", None, None, 0, DEL)],
    [("c", [9.0, 9.0], "c4", 0, UP), ("c", None, None, 1, DEL)],
]


def batch(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def start(spark):
    row = spark.createDataFrame([("base", [1.0, 1.0], "old")], "id string, vector array<double>, content string")
    return mutate.upsert(src.empty_store(spark, SPEC), row, SPEC, day(-1)).rows


def state(rows):
    return sorted(
        (r["id"], tuple(r["vector"]), r["content"], r["created_at"], r["updated_at"]) for r in rows.collect()
    )


def one_by_one(spark):
    """The same changes, applied to the table one after the other."""
    rows = start(spark)
    for n, changes in enumerate(BATCHES):
        for change in sorted(changes, key=lambda c: c[3]):
            one = batch(spark, [change])
            step = mutate.delete if change[4] == DEL else lambda r, i, s: mutate.upsert(r, i, s, day(n))
            rows = spark.createDataFrame(step(rows, one, SPEC).rows.collect(), SPEC.schema)
    return state(rows)


def test_log_equals_changes_one_by_one(spark, folder):
    base = start(spark)
    for n, changes in enumerate(BATCHES):
        log_batch(batch(spark, changes), SPEC, day(n), n, f"{folder}/log", base)
    log = src.read_log(spark, f"{folder}/log", SPEC)
    want = one_by_one(spark)
    assert state(src.current(base, log, SPEC)) == want
    src.compact(base, log, SPEC, f"{folder}/next")
    assert state(src.read_store(spark, f"{folder}/next", SPEC)) == want
    # A batch that runs again counts once.
    log_batch(batch(spark, BATCHES[2]), SPEC, day(2), 2, f"{folder}/log", base)
    assert state(src.current(base, src.read_log(spark, f"{folder}/log", SPEC), SPEC)) == want


def test_bad_batches_log_nothing(spark, folder):
    theirs = [(SPEC.key_prefix + "x", "invoice", *[None] * 9)]
    base = spark.createDataFrame(theirs, SPEC.schema)
    good = ("a", [1.0, 0.0], "a", 0, UP)
    with pytest.raises(ValidationError, match="mismatch"):
        log_batch(batch(spark, [good, ("b", [1.0], None, 0, UP)]), SPEC, day(0), 0, f"{folder}/log", base)
    for op in (UP, DEL):
        with pytest.raises(CollisionError):
            log_batch(batch(spark, [good, ("x", [1.0, 1.0], None, 0, op)]), SPEC, day(0), 0, f"{folder}/log", base)
    with pytest.raises(Exception, match="(?i)path does not exist"):
        spark.read.parquet(f"{folder}/log")


def test_stream_of_several_batches_and_a_restart(spark, folder):
    base = start(spark)
    for n, changes in enumerate(BATCHES):
        batch(spark, changes).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = spark.readStream.schema(T.StructType.fromDDL(ITEM)).json(f"{folder}/in")
        ingest(stream, SPEC, f"{folder}/log", f"{folder}/checkpoint", base, clock=day).awaitTermination()
    log = src.read_log(spark, f"{folder}/log", SPEC)
    assert log.select("batch_id").distinct().count() == len(BATCHES)
    assert state(src.current(base, log, SPEC)) == one_by_one(spark)


def test_stream_stops_at_a_bad_item(spark, folder):
    batch(spark, [("", [1.0, 0.0], None, 0, UP)]).write.json(f"{folder}/in")
    stream = spark.readStream.schema(T.StructType.fromDDL(ITEM)).json(f"{folder}/in")
    query = ingest(stream, SPEC, f"{folder}/log", f"{folder}/checkpoint")
    with pytest.raises(Exception, match="must not be empty"):
        query.awaitTermination()


def test_store_object(spark, folder):
    store = VectorStore.create(spark, f"{folder}/a", SPEC)
    assert store.count() == 0
    rows = [
        ("same", [1.0, 0.0], ("u1", "from metadata"), None),
        ("other", [0.0, 1.0], ("u2", None), "own"),
    ]
    store.store(spark.createDataFrame(rows[:1], META_ITEM), day(0))
    store.store_batch(spark.createDataFrame(rows[1:], META_ITEM), day(1))
    assert store.count() == 2
    got = {r["id"]: r["content"] for r in store.get(spark.createDataFrame([("same",), ("other",)], "id string")).collect()}
    assert got == {"same": "from metadata", "other": "own"}
    query = spark.createDataFrame([(1, [1.0, 0.1])], "q_id int, qv array<double>")
    assert [r["id"] for r in store.search(query).orderBy("rank").collect()] == ["same", "other"]
    assert [r["id"] for r in store.search_one([1.0, 0.1], 5, 0.0, {"userId": "u2"}).collect()] == ["other"]

    index = store.build_index(f"{folder}/index", description="IVF2,SQ8")
    assert store.index_status(f"{folder}/index")["online"]
    found = store.search_index(index, query, n_probes=2, rerank=True).orderBy("rank").collect()
    assert [r["id"] for r in found] == ["same", "other"]

    store.delete_batch(spark.createDataFrame([("other",), ("absent",)], "id string"), day(2))
    compacted = store.compact(f"{folder}/b")
    assert store.count() == compacted.count() == 1 and compacted.log() is None
    assert compacted.rows().first()["created_at"] == day(0)
    assert compacted.clear(f"{folder}/c").count() == 0


def test_writers_do_not_replace_each_other(spark, folder):
    base, log = start(spark), f"{folder}/log"
    log_batch(batch(spark, [("kept", [1.0, 0.0], "direct", 0, UP), ("a", [1.0, 0.0], "first", 0, UP)]), SPEC, day(0), 0, log, base)
    for n in range(2):  # each stream has a fresh checkpoint, so both number their batches from 0
        rows = [(f"s{n}", [1.0, 0.0], "stream", 0, UP), ("a", [1.0, 0.0], f"stream {n}", 0, UP)]
        batch(spark, rows).coalesce(1).write.json(f"{folder}/in{n}")
        stream = spark.readStream.schema(T.StructType.fromDDL(ITEM)).json(f"{folder}/in{n}")
        ingest(stream, SPEC, log, f"{folder}/checkpoint{n}", base, clock=lambda _, n=n: day(n + 1)).awaitTermination()
    rows = src.current(base, src.read_log(spark, log, SPEC), SPEC)
    want = {"base": "old", "kept": "direct", "s0": "stream", "s1": "stream", "a": "stream 1"}
    assert {r["id"]: r["content"] for r in rows.collect()} == want
    log_batch(batch(spark, [("kept", [1.0, 0.0], "direct", 0, UP), ("a", [1.0, 0.0], "first", 0, UP)]), SPEC, day(0), 0, log, base)
    again = src.current(base, src.read_log(spark, log, SPEC), SPEC)
    assert {r["id"]: r["content"] for r in again.collect()} == want


def test_unreadable_log_and_head_are_errors(spark, folder):
    store = VectorStore.create(spark, f"{folder}/a", SPEC)
    spark.createDataFrame([("x",)], "v string").write.text(f"{folder}/a/log")
    with pytest.raises(Exception):
        store.log().count()
    spark.createDataFrame([("x",)], "v string").write.text(f"{folder}/index/head")
    with pytest.raises(Exception):
        store.index_status(f"{folder}/index")


def test_get_refuses_empty_ids_and_foreign_rows(spark, folder):
    foreign = spark.createDataFrame([(SPEC.key_prefix + "x", "invoice", *[None] * 9)], SPEC.schema)
    store = VectorStore.create(spark, f"{folder}/a", SPEC, foreign)
    with pytest.raises(ValidationError):
        store.get(spark.createDataFrame([("",)], "id string"))
    with pytest.raises(CollisionError):
        store.get(spark.createDataFrame([("x",)], "id string"))
