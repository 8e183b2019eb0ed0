"""Secret scans: an Aho-Corasick prefilter for keywords, anchored regular expressions at its hits only, then embedded checksums.

Kinds of spans, each leftmost and without overlaps:
  assign  a keyword, quote, colon or equals sign, and a value of 6 or more characters
  access  AKIA and upper-case letters or digits, 20 or more characters in all
  hex     24 or more of 0-9a-f
  checked a vendor token with a 6-character base-62 CRC-32 of its first 30 characters at the end, where it is right
Hex runs have no keyword. Every fourth character is looked at first: a run of 24 covers six of those in a row, and the
expression runs only around six hex digits there.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_python
from .sets import text_parts

#: Keywords, prefixes and patterns of the kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "AKIA"
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "checked")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

_STRIDE = 4
_SPARSE_HEX = re.compile(r"[0-9a-f]{%d,}" % (MIN_HEX // _STRIDE))


@lru_cache(maxsize=1)
def automaton():
    """Keywords in lower case, with the kind that each begins."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", (ACCESS_PREFIX,)), ("checked", CHECKED_PREFIXES)):
        for word in words:
            found.add_word(word.lower(), (kind, len(word)))
    found.make_automaton()
    return found


def checksum(text: str) -> str:
    value, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each secret, in code points, by start and then kind as listed. NULL is an empty text."""
    if not text:
        return []
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # ASCII letters only, so positions stay
    begins: dict[str, list[int]] = {}
    for end, (kind, size) in automaton().iter(lower):
        begins.setdefault(kind, []).append(end - size + 1)
    out = []
    for kind, rule, most in (("assign", ASSIGN, None), ("access", ACCESS, None), ("checked", CHECKED, None)):
        after = 0
        for at in sorted(begins.get(kind, ())):
            if at < after or not (m := rule.match(text, at)):
                continue
            after = m.end()  # also where it fails below: matches don't overlap
            if kind == "assign":
                good = len(m[1]) >= MIN_ASSIGN
            elif kind == "access":
                good = m.end() - at >= MIN_ACCESS
            else:
                good = checksum(m[1]) == m[2]
            if good:
                out.append((at, after, kind))
    after = 0
    for m in _SPARSE_HEX.finditer(text[_STRIDE - 1 :: _STRIDE]):
        for k in range(m.start(), m.end()):  # the hits may belong to several runs
            at = k * _STRIDE + _STRIDE - 1
            if at < after:
                continue
            begin = at
            while begin > after and text[begin - 1] in "0123456789abcdef":
                begin -= 1
            after = HEX.match(text, begin).end()
            if after - begin >= MIN_HEX:
                out.append((begin, after, "hex"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, text>>) per row of `docs`; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for part in text_parts(batches, 1):
            found = [[{"kind": k, "start": a, "end": b, "text": t[a:b]} for a, b, k in spans(t)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return in_python(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, spans array<struct<kind: string, start: int, end: int, text: string>>")


def listed(found: list[dict], kinds) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in found if s["kind"] in kinds)


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = KINDS[:3]
    for batch in batches:
        found = [x or [] for x in batch.column(1).to_pylist()]
        counts = [pa.array([sum(s["kind"] == k for s in x) for x in found], pa.int64()) for k in base]
        sha = pa.array([hashlib.sha256(listed(x, base).encode()).hexdigest() for x in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sha, pa.array([listed(x, KINDS) for x in found], pa.string())], ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"])


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans and the list of all, per row of `docs`."""
    found = scan(docs)
    return in_python(found, digest_batches, f"doc_id {dict(docs.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
