"""Line dedup and the shingle join against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from small import docs, texts  # noqa: F401

from recallset.llm import line_dedup, sets, shingle_join
from recallset.llm.common import Scratch


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(texts, width, percent):
    rows = [(i, shingles(t, width)) for i, t in texts]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for (i, x), g in zip(rows, group, strict=True):
        if x and i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, len(x), least.get(g) if x else i) for (i, x), g in zip(rows, group, strict=True)), key=str)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (3, 100)])
def test_linked(docs, texts, width, percent):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.linked(docs, width, percent).collect()), key=str)
    assert got == brute_components(texts, width, percent)


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_share_a_bucket(percent):
    draw = np.random.default_rng(5)
    rule = shingle_join.Threshold(percent)
    edges = rule.edges(6000)
    for n in [9, 10, 17, 18, 19, 27, 90, 91, 500, 3000]:
        for _ in range(20):
            whole = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
            more = rule.most(n)
            other = np.unique(np.concatenate([whole, draw.integers(0, 1 << 63, more, dtype=np.uint64)]))
            a, b = (set(np.concatenate([own for _, own in shingle_join.buckets(x, rule, edges)]).tolist()) for x in (whole, other))
            assert a & b, n


def test_large_cluster_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(sets, "BLOCK", 8)
    base = [f"t{i}" for i in range(60)]
    rows = [(k, " ".join([*base[:k], f"x{k}", *base[k + 1 :]])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in shingle_join.linked(docs, 1, 90).select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(brute_components(rows, 1, 90)) and len({g[2] for g in got}) < 40
    lines = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.report(lines).filter("n_removed > 0").count() == len(brute_lines(rows))


def brute_lines(texts):
    """{(doc_id, text): removed line numbers}"""
    order = sorted({(i, t) for i, t in texts if t}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = [], {}
    for i, t in order:
        for no, line in enumerate(t.split("\n")):
            if not words(line):
                continue
            own = shingles(line, 5)
            if any(100 * len(own & x) >= 80 * len(own | x) for x in seen):
                out.setdefault((i, t), []).append(no)
            seen.append(own)
    return out


def test_lines(docs, texts):
    found = line_dedup.report(docs).collect()
    want = brute_lines(texts)
    kept = lambda t, gone: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone)
    rows = sorted(((r.doc_id, r.n_lines, r.removed, r.text) for r in found), key=str)
    assert rows == sorted(((i, len((t or "").split("\n")), ",".join(map(str, want.get((i, t), []))), kept(t, want.get((i, t), []))) for i, t in texts), key=str)


REPEATED = [
    (1, "go go go go go\n- - - - -\nother words"),
    (2, "go go go go go go\nGO go\tgo go go go go go\n- - - - - - - - -\ngo go go go\na b a b a b\na b a b a b a b a b"),
    (3, "go go go go go stop\n- - - - - - -"),
]


def test_lines_that_repeat_a_word(spark):
    found = line_dedup.report(spark.createDataFrame(REPEATED, "doc_id long, text string")).collect()
    assert {r.doc_id: r.removed for r in found} == {1: "", 2: "0,1,2,5", 3: "1"}
    assert brute_lines(REPEATED) == {REPEATED[1]: [0, 1, 2, 5], REPEATED[2]: [1]}


def test_pipeline_looks_at_short_lines(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, "a line of its own here\nles."), (2, "Les.\nanother line that is unlike\nand ornd."), (3, "and  ornd.\n\nthe third one is different"), (4, "les."), (5, "")]
    left = corpus_pipeline.without_later_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(tuple, left)) == [rows[0], (2, "another line that is unlike\nand ornd."), (3, "\nthe third one is different"), rows[4]]


def test_components_are_told_apart_without_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(7, "one text under a number"), (7, "and quite another under the same one"), (8, base), (8, other), (9, base + " end"), (9, other + " end")]
    rows += [(None, " ".join(f"n{i}" for i in range(60)) + more) for more in ("", " end")] + [(None, "unlike the others without an id"), (None, None), (7, "")]
    left = shingle_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(map(tuple, left), key=str)
    assert [r for r in got if r[0] is not None] == sorted([*rows[:4], rows[10]], key=str)
    assert len(got) == 8 and (None, None) in got and rows[8] in got


@pytest.mark.parametrize("window", [4, 1024])
@pytest.mark.parametrize("cut", [1, 3, 1000])
def test_sets_of_a_key(monkeypatch, window, cut):
    """Edges of a key connect what links connect, whatever the batches; a key of too many sets connects all of them."""
    monkeypatch.setattr(shingle_join, "WINDOW", window)
    draw, rule = np.random.default_rng(5), shingle_join.Threshold(80)
    tokens, rows = {}, []
    for key, groups in enumerate([[2], [1, 3], [1, 1], [5, 2, 3, 1, 6], [3]]):
        for size in groups:
            base = draw.integers(0, 1 << 63, 90, dtype=np.uint64)
            for _ in range(size):
                own = np.unique(np.append(base, draw.integers(0, 1 << 63, 5, dtype=np.uint64)))
                tokens[sets.set_id(own)] = own
                rows += [(key, sets.set_id(own), len(own), sets.sketches([own], 128)[0].tobytes())] * 2
    rows.sort()
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)], ["key", "set_id", "n", "sketch"])
    root = {i: i for i in tokens}
    for out in shingle_join.within((batch.slice(i, cut) for i in range(0, len(rows), cut)), rule):
        for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True):
            old, new = root[a], root[b]
            root = {k: new if v == old else v for k, v in root.items()}
    for key in range(5):
        own = sorted({r[1] for r in rows if r[0] == key})
        for a in own:
            for b in own:
                linked = rule.links(len(tokens[a]), len(tokens[b]), sets.shared_tokens(tokens[a], tokens[b]))
                assert (root[a] == root[b]) == (linked or len(own) > window)


def test_filters_keep_columns(docs):
    lines = line_dedup.without_later_lines(docs)
    assert lines.columns == docs.columns
    left = {(r.doc_id, r.text) for r in lines.collect()}
    assert (4, None) in left and (5, "") in left and not any(i == 2 and "quick" in t for i, t in left if t)
    one = shingle_join.one_of_each(docs)
    assert one.columns == docs.columns
    ids = sorted((r.doc_id for r in one.collect()), key=str)
    assert ids.count(11) == 1 and 2 not in ids and {1, 4, 5, 6, 7, 8, 9, 12} <= set(ids)


def test_empty_tables(docs):
    none = docs.filter(F.lit(False))
    assert shingle_join.linked(none).count() == line_dedup.report(none).count() == shingle_join.one_of_each(none).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(7, 7), (3, 1)], "a long, b long")
    assert {r.node: r.root for r in sets.components(edges, Scratch(spark)).collect()} == {i: 0 if i <= 20 else 21 for i in range(41)}
