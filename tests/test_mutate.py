import datetime as dt

import pytest
from pyspark.sql import functions as F

from recallset import CollisionError, StoreSpec, ValidationError
from recallset.operators import mutate
from recallset.sources.store import empty_store, read_store, scan_prefix, write_snapshot

SPEC = StoreSpec(2, filter_fields={"topic": "string", "size": "number", "seen": "boolean", "a.b": "string"})
T0, T1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
ITEM = "id string, vector array<double>, metadata struct<topic: string, content: string>, content string, ord int"


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM)


def start(spark, *rows):
    return mutate.upsert(empty_store(spark, SPEC), items(spark, *rows), SPEC, T0).rows


def foreign(spark, key, id_="x", document_type="invoice"):
    row = (key, document_type, 1, id_, None, None, None, None, "theirs", None, None)
    return spark.createDataFrame([row], SPEC.schema)


def as_dict(rows):
    return {r["doc_key"]: r for r in rows.collect()}


def test_insert_builds_the_whole_row(spark):
    row = start(spark, ("doc-1", [1.0, 0.0], ("agents", None), "text", 0)).first()
    assert row["doc_key"] == SPEC.key_prefix + "doc-1"
    assert (row["document_type"], row["schema_version"], row["dimensions"]) == (SPEC.document_type, 1, 2)
    assert row["metadata"]["topic"] == "agents" and row["content"] == "text"
    assert row["created_at"] == row["updated_at"] == T0


def test_replacement_is_whole_and_keeps_only_the_creation_time(spark):
    store = start(spark, ("a", [1.0, 0.0], ("t", None), "old", 0), ("b", [1.0, 1.0], None, "stays", 0))
    after = as_dict(mutate.upsert(store, items(spark, ("a", [0.0, 1.0], None, None, 0)), SPEC, T1).rows)
    a, b = after[SPEC.key_prefix + "a"], after[SPEC.key_prefix + "b"]
    assert a["vector"] == [0.0, 1.0] and a["content"] is None and a["metadata"] is None
    assert (a["created_at"], a["updated_at"]) == (T0, T1)
    assert b["content"] == "stays" and b["updated_at"] == T0


def test_content_is_mirrored_by_store_only(spark):
    row = ("a", [1.0, 0.0], ("t", "from metadata"), None, 0)
    mirrored = mutate.upsert_mirrored(empty_store(spark, SPEC), items(spark, row), SPEC, T0).rows.first()
    plain = start(spark, row).first()
    assert mirrored["content"] == "from metadata" and mirrored["metadata"]["content"] == "from metadata"
    assert plain["content"] is None
    # get does not fall back to the metadata either
    got = mutate.get(start(spark, row), spark.createDataFrame([("a",)], "id string"), SPEC).first()
    assert got["found"] and got["content"] is None


def test_highest_ord_wins_in_one_batch(spark):
    rows = start(spark, ("a", [1.0, 0.0], None, "one", 1), ("a", [0.0, 1.0], None, "two", 2)).collect()
    assert [r["content"] for r in rows] == ["two"]


def test_foreign_rows_are_never_overwritten(spark):
    store = foreign(spark, SPEC.key_prefix + "x")
    change = mutate.upsert(store, items(spark, ("x", [1.0, 0.0], None, "mine", 0)), SPEC, T0)
    assert [r["content"] for r in change.rows.collect()] == ["theirs"]
    with pytest.raises(CollisionError, match="another owner"):
        mutate.require_clean(change)


def test_one_bad_item_stops_the_batch(spark):
    bad = [("b", [1.0], None, None, 0), ("c", [1.0, float("nan")], None, None, 0), ("", [1.0, 0.0], None, None, 0)]
    change = mutate.upsert(
        empty_store(spark, SPEC), items(spark, ("a", [1.0, 0.0], None, None, 0), *bad), SPEC, T0
    )
    assert {r["reason"] for r in change.rejects.collect()} == {
        "dimension mismatch: the vector has 1 values, the store 2",
        "every value of a vector must be a finite number",
        "the id must not be empty",
    }
    with pytest.raises(ValidationError):
        mutate.require_clean(change)


def test_get(spark):
    store = start(spark, ("a", [1.0, 0.0], None, "A", 0)).unionByName(foreign(spark, SPEC.key_prefix + "x"))
    ids = spark.createDataFrame([("a",), ("missing",), ("x",)], "id string")
    got = {r["id"]: r for r in mutate.get(store, ids, SPEC).collect()}
    assert got["a"]["found"] and got["a"]["vector"] == [1.0, 0.0] and got["a"]["content"] == "A"
    assert not got["missing"]["found"] and not got["missing"]["collision"]
    assert got["x"]["collision"] and not got["x"]["found"] and got["x"]["content"] is None


def test_delete(spark):
    store = start(spark, ("a", [1.0, 0.0], None, "A", 0)).unionByName(foreign(spark, SPEC.key_prefix + "x"))
    ids = spark.createDataFrame([("a",), ("missing",)], "id string")
    change = mutate.delete(store, ids, SPEC)
    mutate.require_clean(change)
    assert list(as_dict(change.rows)) == [SPEC.key_prefix + "x"]
    with pytest.raises(CollisionError):
        mutate.require_clean(mutate.delete(store, spark.createDataFrame([("x",)], "id string"), SPEC))
    with pytest.raises(ValidationError, match="empty"):
        mutate.require_clean(mutate.delete(store, spark.createDataFrame([("",)], "id string"), SPEC))


def test_clear_and_count_respect_prefix_and_owner(spark):
    own = start(spark, ("a", [1.0, 0.0], None, "A", 0), ("b", [1.0, 0.0], None, "B", 0))
    other_prefix = own.filter("id = 'a'").withColumn("doc_key", F.lit("else::a"))
    store = own.unionByName(foreign(spark, SPEC.key_prefix + "x")).unionByName(other_prefix)
    assert mutate.count(store, SPEC).first()["n"] == 2
    assert set(as_dict(mutate.clear(store, SPEC))) == {SPEC.key_prefix + "x", "else::a"}


def test_null_markers_are_not_owned(spark):
    store = foreign(spark, SPEC.key_prefix + "x", document_type=None)
    assert mutate.count(store, SPEC).first()["n"] == 0
    assert mutate.clear(store, SPEC).count() == 1


def test_metadata_keeps_the_class_of_its_values(spark):
    raw = spark.createDataFrame(
        [
            ("a", [1.0, 0.0], '{"topic": "t", "size": 3, "seen": true, "a.b": "dotted", "free": [1]}'),
            ("b", [1.0, 0.0], '{"topic": 1, "size": "3", "seen": "true", "a": {"b": "nested"}}'),
        ],
        "id string, vector array<double>, metadata string",
    )
    rows = {r["id"]: r for r in mutate.upsert(empty_store(spark, SPEC), raw, SPEC, T0).rows.collect()}
    a, b = rows["a"]["metadata"], rows["b"]["metadata"]
    assert (a["topic"], a["size"], a["seen"], a["a.b"]) == ("t", 3.0, True, "dotted")
    assert (b["topic"], b["size"], b["seen"], b["a.b"]) == (None, None, None, None)
    assert '"free"' in rows["a"]["metadata_json"]


def test_snapshots_by_owner_and_bucket_answer_the_same(spark, folder):
    spec = StoreSpec(2, key_buckets=4)
    rows = items(spark, *[(f"i{n}", [1.0, float(n)], None, f"c{n}", 0) for n in range(40)])
    store = mutate.upsert(empty_store(spark, spec), rows, spec, T0).rows
    theirs = foreign(spark, spec.key_prefix + "x").select(
        *[c for c in spec.schema.names if c != "metadata"],
        F.lit(None).cast(spec.metadata_type).alias("metadata"),
    )
    write_snapshot(store.unionByName(theirs), f"{folder}/s", spec)
    read = read_store(spark, f"{folder}/s", spec)
    assert mutate.count(read, spec).first()["n"] == 40
    ids = spark.createDataFrame([("i3",), ("x",), ("none",)], "id string")
    got = {r["id"]: (r["found"], r["collision"], r["content"]) for r in mutate.get(read, ids, spec).collect()}
    assert got == {"i3": (True, False, "c3"), "x": (False, True, None), "none": (False, False, None)}
    change = mutate.upsert(read, items(spark, ("i3", [0.0, 1.0], None, "new", 0)), spec, T1)
    write_snapshot(change.rows, f"{folder}/t", spec)
    again = read_store(spark, f"{folder}/t", spec)
    assert again.count() == 41
    assert again.filter("id = 'i3'").first()["content"] == "new"
    with pytest.raises(Exception, match="(?i)already exists"):
        write_snapshot(change.rows, f"{folder}/t", spec)


def test_conditions_reach_the_scan(spark, folder, capsys):
    write_snapshot(start(spark, ("a", [1.0, 0.0], ("t", None), "A", 0)), f"{folder}/s", SPEC)
    read = read_store(spark, f"{folder}/s", SPEC)
    scan_prefix(read, SPEC.key_prefix).explain("formatted")
    assert "StringStartsWith(doc_key" in capsys.readouterr().out
    mutate.count(read, SPEC).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(is_owned" in plan and "ReadSchema: struct<doc_key:string>" in plan


def test_few_keys_prune_the_buckets(spark, folder, capsys):
    spec = StoreSpec(2, key_buckets=8)
    rows = items(spark, *[(f"i{n}", [1.0, float(n)], None, f"c{n}", 0) for n in range(40)])
    write_snapshot(mutate.upsert(empty_store(spark, spec), rows, spec, T0).rows, f"{folder}/s", spec)
    spark.createDataFrame([("i3",), ("i4",)], "id string").write.parquet(f"{folder}/ids")
    ids = spark.read.parquet(f"{folder}/ids").filter("id = 'i3'")
    got = mutate.get(read_store(spark, f"{folder}/s", spec), ids, spec)
    got.explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out
    assert got.first()["content"] == "c3"
