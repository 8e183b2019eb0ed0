"""Fingerprints, classifiers and the stages of the pipeline against plain versions over whole small tables."""

import hashlib
import math
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import xxhash
from small import docs, texts  # noqa: F401
from test_sets import brute_components, brute_lines, words
from tokenizers import Tokenizer

from recallset.llm import fingerprint, quality, toxicity


def plain_fingerprint(text):
    """128 votes over pairs of neighbouring words, one bit after the other."""
    w = [x for x in re.split("[ \n\t\r]", text.lower()) if x]
    terms = list(zip(w, w[1:])) or [(x, "") for x in w]
    out = ""
    for k in range(2):
        votes = [0] * 64
        for a, b in terms:
            h = 42
            for part in (a.encode(), b.encode(), struct.pack("<i", k)):
                h = xxhash.xxh64_intdigest(part, h)
            for bit in range(64):
                votes[bit] += 1 if h >> bit & 1 else -1
        out += f"{sum(1 << bit for bit in range(64) if votes[bit] > 0):016x}"
    return out


def test_every_bit_of_a_fingerprint(docs, texts):
    want = {}
    for i, t in texts:
        want.setdefault(i, set()).add(plain_fingerprint(t or ""))
    for r in fingerprint.report(docs).collect():
        assert r.fingerprint in want[r.doc_id]


def test_fingerprints_of_a_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: plain_fingerprint(r.text or "") for r in rows.collect()}
    assert {r.doc_id: r.fingerprint for r in fingerprint.report(rows).collect()} == want


def test_search_within_a_radius_of_a_table(spark, sf_dir):
    """All pairs of a small table by counting bits."""
    rows = fingerprint.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), ["doc_id"])
    prints = {(r.f0, r.f1) for r in rows.collect()}
    near = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b, strict=True)) <= 3
    got = {(r.q0, r.q1, r.f0, r.f1) for r in fingerprint.within(rows, rows, 3).collect()}
    assert got == {(*a, *b) for a in prints for b in prints if near(a, b)}


def test_ridge_weights(spark, sf_dir):
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stats = quality.stored(quality.measured(table("documents")), "plain-statistics")
    labels = table("labels")
    model = quality.fit(stats, labels)
    label = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows = [(r.stats, label[r.doc_id]) for r in stats.collect() if r.doc_id in label]
    x, y = np.array([s for s, _ in rows]), np.array([v for _, v in rows], float)
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), -6, 6)
    f = np.column_stack([math.sqrt(2 / len(model.phases)) * np.cos(z @ model.directions + model.phases), np.ones(len(z))])
    penalty = np.diag([2 / len(model.phases)] * len(model.phases) + [1e-9])
    assert np.allclose(model.weights, np.linalg.solve(f.T @ f + penalty, f.T @ y), atol=1e-6)
    assert (np.diff(model.values) >= 0).all()


def plain_cells(text):
    t = " " + " ".join((text or "").lower().split()) + " "
    out = set()
    for n in range(3, 7):
        for i in range(len(t) - n + 1):
            h = 0
            for c in t[i : i + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & (1 << 64) - 1
            out.add(((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1) >> 64 - toxicity.BITS)
    return out


def test_toxicity_score_is_a_sum_over_n_grams(spark, sf_dir):
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    model = toxicity.fit(table("documents"), table("labels"))
    rows = [r for r in table("documents").select("doc_id", "text").collect() if len(r.text or "") < 1500]
    got = {r.doc_id: r.score for r in toxicity.score(table("documents"), model).collect()}
    for r in rows[:60]:
        total = model.intercept + sum(model.weights[c] for c in plain_cells(r.text))
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, total)))), abs=1e-9)
    # a cell's weight has the sign of what the label does to its count, or the regression gave it another
    label = {r.doc_id: r.toxic for r in table("labels").collect() if r.toxic is not None}
    known = [(plain_cells(r.text), label[r.doc_id]) for r in rows if r.doc_id in label and r.text is not None]
    toxic = [c for c, y in known if y]
    if toxic and len(toxic) < len(known):
        heavy = int(np.argmax(model.weights))
        assert sum(heavy in c for c in toxic) / len(toxic) >= sum(heavy in c for c, y in known if not y) / (len(known) - len(toxic))


def test_stages_against_plain_versions(spark, sf_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    stages = dict(corpus_pipeline.STAGES)
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    read = lambda rows: sorted(((r.doc_id, r.text) for r in rows.collect()), key=str)

    rows = quality.stored(table("documents"), "plain-0")
    scores = {r.doc_id: r.score for r in toxicity.score(rows, toxicity.fit(rows, table("labels"), "toxic")).collect()}
    clean = quality.stored(stages["toxicity"](spark, rows, sf_dir), "plain-1")
    assert read(clean) == [r for r in read(rows) if scores[r[0]] < 0.3]

    before = read(clean)
    gone, want = brute_lines(before), []
    for i, t in before:
        kept = "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone.get((i, t), []))
        if (i, t) not in gone:
            want.append((i, t))
        elif words(kept):
            want.append((i, kept))
    lines = quality.stored(stages["line dedup"](spark, clean, sf_dir), "plain-2")
    assert read(lines) == sorted(want, key=str)

    before = read(lines)
    component = {i: c for i, _, c in brute_components(before, 5, 80)}
    one = quality.stored(stages["near duplicates"](spark, lines, sf_dir), "plain-3")
    assert read(one) == [(i, t) for i, t in before if component[i] == i]

    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in table("benchmark").collect():
        w = cut(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    hit = lambda t: any(tuple(w[i : i + n]) in windows for w in [cut(t)] for n in sizes for i in range(len(w) - n + 1))
    left = quality.stored(stages["decontamination"](spark, one, sf_dir), "plain-4")
    assert read(left) == [r for r in read(one) if not hit(r[1])]

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stages["token ids"](spark, left, sf_dir).collect()}
    for i, t in read(left):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got.pop(i) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert not got
