"""Secrets, decontamination, fingerprints, tokenizers, token files and packages against plain versions."""

import base64
import glob
import hashlib
import re
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from small import docs, texts  # noqa: F401
from tokenizers import Tokenizer

from recallset.llm import bpe, decontaminate, fingerprint, secrets, token_files, warc
from recallset.session import scratch_path

KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c + "?" for c in w) for w in ("password", "passwd", "secret", "token", "api_key"))


def brute_spans(text):
    rules = (("assign", rf"""(?:{KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "(AKIA[A-Z0-9]+)", 20), ("hex", "([0-9a-f]+)", 24))
    found = [(m.start(), i, m.end(), kind) for i, (kind, rule, least) in enumerate(rules) for m in re.finditer(rule, text or "") if len(m[1]) >= least]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def test_secrets(docs, texts):
    draw = np.random.default_rng(3)
    parts = ["token", "PassWord", "ſecret", "=", ": ", '"', "abc", "deadbeef0123456789ab", "f0", "AKIA", "ABCDEFGHIJKLMNOP", "é", "İ", "api_key", "x"]
    for _ in range(3000):
        text = "".join(draw.choice(parts, draw.integers(0, 12)))
        assert [s for s in secrets.spans(text) if s[2] != "checked"] == brute_spans(text), text
    good = "ghp_" + "aB3" * 10
    assert secrets.spans("x " + good + secrets.checksum("aB3" * 10)) == [(2, 42, "checked")] and not secrets.spans("x " + good + "000000")
    got = sorted(((r.doc_id, r.base_sha256) for r in secrets.report(docs).collect()), key=str)
    assert got == sorted(((i, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in brute_spans(t)).encode()).hexdigest()) for i, t in texts), key=str)
    assert sum(len(r.spans) for r in secrets.scan(docs).collect()) == 3


def test_decontaminate(spark, docs, texts):
    bench = [(1, "quick BROWN fox jumps over the lazy dog and then runs away"), (2, "Étre été"), (2, "word"), (3, None), (None, "unlike text"), (4, "absent thing")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, t in texts:
        w, hit, ids = cut(t), set(), set()
        for item, text in bench:
            x = cut(text)
            k = min(10, len(x))
            for a in range(len(x) - k + 1) if x else ():
                for b in range(len(w) - k + 1):
                    if w[b : b + k] == x[a : a + k]:
                        hit |= set(range(b, b + k))
                        ids |= {str(item)} if item is not None else set()
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in decontaminate.report(docs, items).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and sorted((r.doc_id for r in clean.collect()), key=str) == sorted((w[0] for w in want if not w[5]), key=str)
    spans = {r.doc_id: r.text for r in decontaminate.clean(docs, items, remove="spans").collect()}
    assert spans[1] == "The" + " " * 12 + " from the very loud noise\nshort" and spans[9] == dict(texts)[9]
    assert decontaminate.report(docs, items.filter(F.lit(False))).filter("contaminated").count() == 0


def test_decontaminate_in_blocks(docs, spark, monkeypatch):
    items = spark.createDataFrame([(i, f"w{i}x{i * 7} w{i + 1}x{i * 7 + 7}") for i in range(60)], "item_id long, text string")
    rows = lambda: sorted((tuple(r) for r in decontaminate.report(docs, items).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert rows() == whole


def test_fingerprints(docs, texts):
    got = fingerprint.report(docs).collect()
    rows = sorted(((i, t or "") for i, t in texts), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1] == prints[2] != prints[3] and prints[5] == "0" * 32 and all(0 <= r.near_next <= 1 for r in got)
    alike = 1 - bin(int(prints[9], 16) ^ int(prints[8], 16)).count("1") / 128
    assert next(r.near_next for r in got if r.doc_id == 9) == pytest.approx(alike)


def test_fingerprint_buckets(docs):
    many = [sorted(map(tuple, fingerprint.edited(docs, n).select("doc_id", "text", "edited").collect()), key=str) for n in (2, 100)]
    assert many[0] == many[1]


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_within_radius(spark, radius):
    draw = np.random.default_rng(2)
    base = [int(x) for x in draw.integers(0, 1 << 63, 8)]
    rows = [(b ^ sum(1 << int(k) for k in draw.choice(63, draw.integers(0, 8), replace=False)), int(b % 5) - (1 << 63)) for b in base for _ in range(12)]
    frame = spark.createDataFrame(rows, "f0 long, f1 long")
    got = {(r.q0, r.q1, r.f0, r.f1) for r in fingerprint.within(frame, frame.limit(40), radius).collect()}
    asked = [tuple(r) for r in frame.limit(40).collect()]
    far = lambda a, b: sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a, b, strict=True))
    assert got == {(*a, *b) for a in asked for b in rows if far(a, b) <= radius}


def test_word_bpe(docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))))
    assert sorted((tuple(r) for r in bpe.digests(docs, path).collect()), key=str) == sorted(want, key=str)
    encoded = bpe.encode(docs, path)
    assert sorted((len(r.ids) for r in encoded.collect())) == sorted(w[1] for w in want) and bpe.decode(encoded, path).count() == len(want)


def test_token_files(docs, texts, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 30)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, start, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(((i, t or "") for i, t in texts), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in token_files.round_trip(docs, path).collect()), key=str) == sorted(want, key=str)
    assert token_files.round_trip(docs.filter(F.lit(False)), path).count() == 0


@pytest.mark.parametrize("count", [1, 63, 64, 5000, 200_000])
def test_coder(count):
    ids = np.minimum(np.random.default_rng(count).zipf(1.2, count), 50_000)
    coder = token_files.Coder(token_files.frequencies(np.bincount(ids)))
    block = coder.encode(ids)
    assert (coder.decode(block) == ids).all()
    for first in (0, count // 3, count - 1):
        assert (coder.decode(block, first, first + 10) == ids[first : first + 10]).all()
    file = bytearray(token_files.pack([(1, ids.astype(np.uint32))]))
    file[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.unpack(bytes(file)))


def test_packages(spark):
    pages = [(1, "a", "<p>é</p>"), (2, "b", "<p>é</p>"), (2, "b", "<p>é</p>"), (3, "c\nd", None), (4, None, ""), (None, "e", "<p>é</p>"), (None, "f", "alone"), (5, "g", "x" * 100_000)]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, record_type int").repartition(2)
    path = scratch_path(spark, "packages-test")
    warc.write(frame, path)
    for name in glob.glob(path.removeprefix("file:") + "/*.txt"):
        with zipfile.ZipFile(name) as package:
            assert package.testzip() is None and all(m.compress_type == 0 for m in package.infolist())
    largest = {}
    for i, _, h in pages:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages:
        raw, top = (h or "").encode(), largest[h or ""]
        other = top >= 0 and i != top
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if other else "response", top if other else None))
    for through_spark in (False, True):
        assert sorted((tuple(r) for r in warc.read(spark, path, through_spark).collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(frame.filter("page_id = 99")).count() == 0
    assert {r.record_type for r in warc.round_trip(frame, min_bytes=1000).collect()} == {"response"}


def test_pieces_as_the_pattern_cuts_them():
    import public_tokenizers
    import regex

    from recallset.llm import token_files

    pattern = regex.compile(public_tokenizers.PATTERN)
    draw = np.random.default_rng(8)
    letters = [*" \t\n\r'", "'s", "'re", "'ll", "'t", " ", "  ", *"stmdrevlabZ09!?-\"", "é", "ß", "²", "½", "×", "ª", "¡", "ɏ", "\xad"]
    texts = ["".join(draw.choice(letters, int(draw.integers(0, 14)))) for _ in range(6000)]
    texts += ["it's", "'s", "'sa'reb'", "a 's", " 's", "\n's", "''s", "!'s", "'l", "'", "x'", "'r\ne", "'ve's't", "  ", " a", "a ", "'S"]
    for some in (texts[:50], texts):
        data = [t.encode() for t in some]
        sizes = np.array([len(d) for d in data])
        begins = np.cumsum(sizes) - sizes
        starts = token_files.pieces_of(np.frombuffer(b"".join(data), np.uint8), begins[sizes > 0])
        assert starts.tolist() == [b + len(t[: m.start()].encode()) for t, b in zip(some, begins.tolist()) for m in pattern.finditer(t)]


def test_decontamination_of_frequent_words(spark):
    """A benchmark whose words are everywhere in the corpus, items of one word, copies of items, and capitals beyond ASCII."""
    item = "the of and the of and the of and the of end"
    bench = [(1, item), (2, item.upper()), (3, "the"), (4, "ÉTÉ the"), (5, ""), (6, None), (None, "zebra zebra")]
    texts = [(1, "the " * 400), (2, "x " + item + " y"), (3, "été the ÉTÉ the"), (4, "of and of and"), (5, None), (6, "a Zebra zebra b"), (7, "the of and the of and the of and the")]
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.report(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert rows == {1: (400, 400, 1), 2: (14, 12, 3), 3: (4, 3, 2), 4: (4, 0, 0), 5: (0, 0, 0), 6: (4, 2, 0), 7: (10, 10, 3)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.report(spark.createDataFrame(texts, "doc_id long, text string"), none).collect()} == {0}
    plan = decontaminate.report(spark.createDataFrame(texts, "doc_id long, text string"), none)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_words():
    """A word without white space is merged as by the library, in time that does not grow with its square."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    letters = np.random.default_rng(3).choice(list("etaoinshrdlu"), 400_000)
    for word in ("a" * 100_001, "".join(letters), "ab" * 300, "".join(letters[: bpe.LONG + 1]), "é" * 700):
        assert own.encode([word]) == [library.encode(word, add_special_tokens=False).ids]
        assert own.merge(word[:600].encode()) == own.merge_long(word[:600].encode())
