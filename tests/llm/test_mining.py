"""Phrase mining, resampling and the vector tree against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from small import docs, texts  # noqa: F401

from recallset.errors import ConfigurationError
from recallset.llm import cells, phrases, resample, vector_tree, words


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# phrases


def brute_phrases(rows, least, most=2000):
    """rows of (text, lang)"""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((lang, " ".join(p), a, count[p[:k]], count[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows[:most])]
    return sorted(out)


PHRASES = [
    ("New York, new york. NEW\tYork  city!", "en"), ("a b c d a b c d\na b x", "en"), ("a b c; a b c: a b", None), (None, "en"), ("", None), (" \t\n", "fr"),
    ("une fois encore une fois encore été là été là", "fr"), ("new york city " * 3, "und"), ("a  b", None), ("été là", "fr"), ("x" * 3000 + " y", "en"),
] * 2


@pytest.mark.parametrize("shards, least", [(1, 2), (3, 2), (5, 3), (2, 10)])
def test_phrases(spark, shards, least):
    rows = spark.createDataFrame([(*r, 1, "x") for r in PHRASES], "text string, lang string, key int, phrase string").repartition(4)
    got = sorted(tuple(r) for r in phrases.report(rows, shards=shards, least=least).collect())
    assert got == brute_phrases(PHRASES, least) and (least > 9 or len(got) > 5)


def test_phrases_in_cells_that_collide(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CELL_BITS", 5)
    monkeypatch.setattr(cells, "SLICE_BITS", 3)
    monkeypatch.setattr(phrases, "HELD", 3)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 8)
    rows = spark.createDataFrame(PHRASES, "text string, lang string")
    assert sorted(tuple(r) for r in phrases.report(rows, shards=3, least=2).collect()) == brute_phrases(PHRASES, 2)


def test_phrase_limit_ties_and_empty(spark):
    rows = [(f"p{i} q{i}. " * (2 + i % 2), "en") for i in range(40)]
    table = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in phrases.report(table, most=7, least=2).collect()) == brute_phrases(rows, 2, 7)
    assert phrases.report(table.filter(F.lit(False))).count() == 0
    with pytest.raises(ConfigurationError):
        phrases.report(table, shards=0)


def test_a_step_counts_what_is_active(spark):
    """Words in the first cycle; pairs only from the step after both words reached the threshold."""
    start = np.full(1 << phrases.CELL_BITS, phrases.NEVER, np.uint8)
    table = spark.createDataFrame([("a b c a b", "en")], "text string, lang string").select("lang", "text")

    def kinds(step):
        rows = phrases.counted(table, spark.sparkContext.broadcast(start), step, 2).collect()
        return sorted((r.words, r.start, r.n) for r in rows)

    assert kinds(0) == [(0, 0, 5), (1, 0, 1), (1, 0, 2), (1, 0, 2)]
    keys = phrases.Batch(table.limit(1).toArrow().combine_chunks().to_batches()[0]).keys[:2]
    start[cells.cell_of(keys, len(start))] = 1
    assert kinds(1) == [(0, 0, 5), (1, 0, 1), (1, 0, 2), (1, 0, 2), (2, 1, 2)]
    assert kinds(2) == [(2, 1, 2)] and kinds(3) == []


def test_words_of_a_batch():
    texts = pa.array(["skipped", "A bc", None, "", "Dé, F", "g"])[1:]
    got = words.words_of(texts, words.byte_kinds(b" ", b","))
    assert [got.distinct[i].decode() for i in got.index] == ["a", "bc", "dé", "f", "g"]
    assert got.row.tolist() == [0, 0, 3, 3, 4] and got.joined.tolist() == [False, True, False, False, False]
    assert got.piece.tolist() == [0, 0, 0, 1, 0]


def test_hashed_words_are_the_same_words():
    draw = np.random.default_rng(12)
    some = ["".join(draw.choice([*"aAbBé ,.\n"], int(draw.integers(0, 30)))) for _ in range(500)]
    kinds = words.byte_kinds(b" ", b",\n")
    key = {}
    for texts in (pa.array([*some, None, ""]), pa.array(some)[200:210], pa.array(["x" * 500_000 + " a", "aB", "Ba"]), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        one, two = words.words_of(texts, kinds), words.hashed_words(texts, kinds)
        for name in ("row", "piece", "joined"):
            assert getattr(one, name).tolist() == getattr(two, name).tolist()
        for i, k in zip(one.index.tolist(), two.keys.tolist(), strict=True):
            assert key.setdefault(one.distinct[i], k) == k
        assert [bytes(words.LOWER[two.data[a:b]]) for a, b in zip(two.begin, two.end)] == [one.distinct[i] for i in one.index]
    assert len(set(key.values())) == len(key) > 300


# resampling


def brute_resample(rows, target, percent=25, min_words=20):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
        return len(w), [zlib.crc32(x.encode()) % 10000 for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]

    s, t = (Counter(b for x in texts for b in features(x)[1]) for texts in ([x for _, x in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc, text in rows:
        n, own = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in own]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[: percent * len(able) // 100]
    ranked = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    left = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn)
    return sorted([*ranked, *((*r, None) for r in left.elements())], key=str)


@pytest.mark.parametrize("percent, min_words", [(25, 20), (100, 0), (50, 2)])
def test_resample(docs, texts, percent, min_words):
    target = docs.sparkSession.createDataFrame([("the quick brown fox", 1), (None, 2), ("ordinary line of words", 3)], "text string, score int")
    got = sorted((tuple(r) for r in resample.resampled(docs, target, percent, min_words).collect()), key=str)
    assert got == brute_resample(texts, [r.text for r in target.collect()], percent, min_words)


def test_resample_registered(spark, sf_dir):
    entry = pytest.importorskip("__spark_entry__")
    got = sorted((tuple(r) for r in entry.queries()["op12_resample"](spark, sf_dir).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert got == brute_resample(rows, target)


def test_resample_long_words_and_empty_tables(spark, docs):
    rows = [(1, "x" * 100_000 + " " + "y" * 70 + " a"), (2, "z"), (-(1 << 63), "a b c"), ((1 << 63) - 1, "a b c"), (None, "b")] + [(3, "c")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in resample.resampled(table, table, 100, 0).collect()), key=str)
    assert got == brute_resample(rows, [t for _, t in rows], 100, 0)
    assert resample.resampled(table.filter(F.lit(False)), table).count() == 0
    assert resample.resampled(table, table.filter(F.lit(False)), 100, 1).filter("rank > 0").count() == len(rows)


def test_checksums_of_joined_strings():
    draw = np.random.default_rng(3)
    pairs = [(draw.bytes(int(draw.integers(1, 40))), draw.bytes(int(draw.integers(0, 65)))) for _ in range(200)]
    got = resample.appended(np.array([zlib.crc32(a) for a, _ in pairs], np.uint32), np.array([zlib.crc32(b) for _, b in pairs], np.uint32), np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_radix_places(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_BITS", 3)
    monkeypatch.setattr(resample, "DIGIT_BITS", 4)
    draw = np.random.default_rng(9)
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(draw.integers(0, 40, 500) % 7, draw.integers(0, 1 << 40, 500) % 97, strict=True))]
    table = resample.stored(spark.createDataFrame(rows, "a long, b long, i long").repartition(3), "radix")
    got = resample.radix_places(table, [(F.col("a"), 50), (F.col("b"), 7), (F.col("i"), 9)]).collect()
    assert [r.i for r in sorted(got, key=lambda r: r.place)] == [i for *_, i in sorted(rows)]
    assert sorted(r.place for r in got) == list(range(500))
    same = resample.radix_places(table.select("a"), [(F.lit(0).cast("long"), 0)]).collect()
    assert sorted(r.place for r in same) == list(range(500))


# vector tree


def brute_neighbours(rows, every, k):
    """rows of distinct (id, vector)"""
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            scores = sorted((-float(sum(a * b for a, b in zip(q.tolist(), v.tolist(), strict=True))), j) for j, v in good if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def found_neighbours(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_neighbours_if_every_one_is_asked_for(spark, monkeypatch, kind):
    monkeypatch.setattr(vector_tree, "SHARD_ROWS", 32)
    monkeypatch.setattr(vector_tree, "LEAF_ROWS", 4)
    monkeypatch.setattr(vector_tree, "QUERY_ROWS", 3)
    monkeypatch.setattr(vector_tree, "CALIBRATED", 1000)
    draw = np.random.default_rng(1)
    rows = [(i, (draw.normal(size=5) * (1 + i % 4)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, rows[4][1]) for i in range(60)]  # a third of some shards are equal vectors
    odd = [(300, None), (305, []), (310, [0.0] * 5), (315, [1.0, None, 1.0, 1.0, 1.0]), (320, [1.0, float("nan"), 1.0, 1.0, 1.0]), (325, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (330, [1.0, 2.0]), (None, [1.0] * 5), (-5, [0.5] * 5)]
    rows = [r for r in [*rows, *odd]]
    table = spark.createDataFrame([(*r, 0, 1) for r in rows], f"id long, vector array<{kind}>, cell int, rank int")
    table = table.unionByName(table.filter("id IN (5, 7)"))
    got = found_neighbours(vector_tree.neighbours(table, 5, 6, recall=1.0))
    want = brute_neighbours([r for r in rows if r[0] != 330], 5, 6)
    assert got.keys() == want.keys()
    for i, row in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in row] and np.allclose([s for _, s in got[i]], [s for _, s in row], rtol=1e-12), i


def test_fewer_candidates_than_asked_and_empty(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 1.0])], "id long, vector array<double>")
    assert found_neighbours(vector_tree.neighbours(table)) == {0: [(21, 1.0), (20, 0.0)], 20: [(21, 1.0), (0, 0.0)]}
    assert vector_tree.neighbours(table.filter("id = 0")).count() == 0
    for none in (table.filter(F.lit(False)), table.withColumn("vector", F.lit(None).cast("array<double>"))):
        assert vector_tree.neighbours(none).columns == ["query_id", "rank", "vec_id", "score"] and vector_tree.neighbours(none).count() == 0
    with pytest.raises(ConfigurationError):
        vector_tree.build(table, recall=0)


def test_recall_of_the_registered_query(spark, sf_dir):
    entry = pytest.importorskip("__spark_entry__")
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = found_neighbours(entry.queries()["op13_neighbours"](spark, sf_dir)), brute_neighbours(rows, 20, 20)
    assert got.keys() == want.keys()
    met = sum(len({j for j, _ in got[i]} & {j for j, _ in row}) for i, row in want.items())
    assert met >= 0.9 * sum(map(len, want.values()))


def test_visits_are_widened_to_the_recall(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "SHARD_ROWS", 128)
    monkeypatch.setattr(vector_tree, "LEAF_ROWS", 8)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + draw.normal(size=16) / 3).tolist()) for i in range(1500)]
    table = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    index = vector_tree.build(table, 10, 0.9)
    wide = vector_tree.build(table, 10, 0.99)
    assert index.recall >= 0.9 and wide.recall >= 0.99 and index.cells * index.leaves <= wide.cells * wide.leaves
    assert index.cells < index.trunk.leaves or index.leaves < 10
    got, want = found_neighbours(vector_tree.search(index, table.filter("id % 3 = 0"), 10)), brute_neighbours(rows, 3, 10)
    met = sum(len({j for j, _ in got[i]} & {j for j, _ in row}) for i, row in want.items())
    assert met >= 0.85 * sum(map(len, want.values()))


def test_visits_go_best_bin_first():
    draw = np.random.default_rng(4)
    points = draw.normal(size=(400, 3))
    tree, leaf = vector_tree.Tree.fit(points, 10, 0)
    assert np.bincount(leaf).max() <= 400 and tree.leaves == leaf.max() + 1
    order = list(tree.visits(points[:20], tree.leaves))
    assert all(sorted(o) == list(range(tree.leaves)) for o in order)
    assert [o[0] for o in order] == tree.descend(points[:20]).tolist()
    assert [o[:3] for o in order] == list(tree.visits(points[:20], 3))


def test_keys_in_cells_and_repeated_keys(spark):
    draw = np.random.default_rng(6)
    keys = draw.integers(0, 1 << 64, 3000, dtype=np.uint64)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64).tolist() + keys.view(np.int64).tolist()[:40] * 3], "key long").repartition(5)
    bits = cells.bitmap(table, 21)
    assert cells.held(bits, keys).all() and len(bits) == 1 << 18
    other = draw.integers(0, 1 << 64, 3000, dtype=np.uint64)
    assert cells.held(bits, other).sum() < 100
    assert sorted(r.key for r in cells.repeated(table).collect()) == sorted(set(keys.view(np.int64).tolist()[:40]))
    none = table.filter("key IS NULL")
    assert cells.repeated(none).count() == 0 and not cells.bitmap(none, 10).any()
