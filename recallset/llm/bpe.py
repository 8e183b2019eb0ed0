"""BPE encoding and decoding of the word-end tokenizer file, with a contiguous array of adjacent ranks per short word."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import in_python, slices

#: No pair of neighbours merges at or beyond this rank.
NEVER = 1 << 60
#: In these texts the rules of both Unicode tables agree, so the words can be cut here; any other text is cut by the library.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")
#: Pieces kept with their ids, twice so many for each Python worker: a full cache becomes the old one.
CACHE_PIECES = 120_000
#: Words up to so many bytes are merged many at once, longer ones singly, and from the second size on by a heap in place of scans.
SHORT, LONG = 48, 512


class WordBpe:
    """A tokenizer file of byte-level BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words_of = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        letters = byte_letters()
        self.letter = letters
        self.first = [vocabulary[letters[b]] for b in range(256)]
        self.last = [vocabulary[letters[b] + self.suffix] for b in range(256)]
        self.pairs: dict[int, int] = {}  # both ids in one number -> rank
        made = []  # rank -> id
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault(vocabulary[a] << 32 | vocabulary[b], rank)
            made.append(vocabulary[a + b])
        self.made = np.array([*made, 0], np.int64)
        self.sorted_pairs = np.array(sorted(self.pairs), np.int64)
        self.sorted_ranks = np.array([self.pairs[p] for p in self.sorted_pairs.tolist()], np.int64)
        self.digits = {i: str(i) for i in self.tokens}
        self.new: tuple[dict, dict] = {}, {}
        self.old: tuple[dict, dict] = {}, {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word.

        `parts` has the id at each boundary and `ranks` the rank of each part with its right neighbour, side by side. The
        lowest rank, leftmost first, is found by a scan; its boundary goes, and the ranks of both neighbours are looked up anew.
        """
        parts = [*map(self.first.__getitem__, word[:-1]), self.last[word[-1]]]
        get, made = self.pairs.get, self.made
        ranks = [get(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (rank := min(ranks)) < NEVER:
            i = ranks.index(rank)
            parts[i] = int(made[rank])
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], NEVER)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """`merge` for a long word: parts linked to their neighbours and a heap of (rank, place, pair). Entries whose parts have
        changed since are passed over."""
        parts = [*map(self.first.__getitem__, word[:-1]), self.last[word[-1]]]
        get, made, n = self.pairs.get, self.made, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [a << 32 | b for a, b in zip(parts, parts[1:], strict=False)]
        heap = [(self.pairs[pair], i, pair) for i, pair in enumerate(pairs) if pair in self.pairs]
        heapify(heap)
        while heap:
            rank, i, pair = heappop(heap)
            j = after[i]
            if parts[i] < 0 or j == n or parts[i] << 32 | parts[j] != pair:
                continue
            parts[i], parts[j] = int(made[rank]), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((i, k), (before[i], i)):
                if left >= 0 and right < n:
                    pair = parts[left] << 32 | parts[right]
                    if (rank := get(pair)) is not None:
                        heappush(heap, (rank, left, pair))
        return [p for p in parts if p >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; an id under 0 is no part."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.sorted_pairs, key), len(self.sorted_pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.sorted_pairs[at] == key), self.sorted_ranks[at], NEVER)

    def merge_many(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """`merge` for many words, one row of parts and one of ranks for each, a merge in every row at a time."""
        found = {w: self.merge(w) if len(w) <= LONG else self.merge_long(w) for w in words if len(w) > SHORT}
        short = sorted((w for w in words if len(w) <= SHORT), key=len)
        first, last = np.array(self.first), np.array(self.last)
        for at in range(0, len(short), 4096):
            group = short[at : at + 4096]
            sizes = np.array([len(w) for w in group])
            width = int(sizes[-1])
            flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in group), np.uint8).reshape(-1, width)
            parts = np.where(np.arange(width) < sizes[:, None], first[flat], -1)
            parts[np.arange(len(group)), sizes - 1] = last[flat[np.arange(len(group)), sizes - 1]]
            parts = np.pad(parts, ((0, 0), (0, 1)), constant_values=-1)
            ranks = self.ranks_of(parts[:, :-1], parts[:, 1:])
            done: list[list[int]] = [[]] * len(group)
            alive = np.arange(len(group))
            while True:
                i = ranks.argmin(1)  # the leftmost of equal ranks
                rows = np.arange(len(alive))
                rank = ranks[rows, i]
                over = rank == NEVER
                if over.any():
                    for k, row in zip(alive[over].tolist(), parts[over].tolist(), strict=True):
                        done[k] = row[: row.index(-1)]
                    keep = ~over
                    parts, ranks, alive, i, rank = parts[keep], ranks[keep], alive[keep], i[keep], rank[keep]
                    rows = np.arange(len(alive))
                if not len(alive):
                    break
                columns = np.arange(ranks.shape[1])
                parts[rows, i] = self.made[rank]
                parts[:, :-1] = np.where(columns > i[:, None], parts[:, 1:], parts[:, :-1])
                parts[:, -1] = -1
                ranks[:, :-1] = np.where(columns[:-1] > i[:, None], ranks[:, 1:], ranks[:, :-1])
                ranks[:, -1] = NEVER
                ranks[rows, i] = self.ranks_of(parts[rows, i], parts[rows, i + 1])
                before = np.maximum(i - 1, 0)
                ranks[rows, before] = np.where(i > 0, self.ranks_of(parts[rows, before], parts[rows, before + 1]), ranks[rows, before])
            found |= zip(group, done, strict=True)
        return found

    def pieces(self, text: str) -> list[str | bytes | int]:
        """A text as runs without white space, in lower case, that no word crosses; where the library must cut it, as
        words in bytes; ids stand for special tokens."""
        special = self.cut_special and any(s in text for s in self.special)
        if not special and PLAIN.fullmatch(text):
            return text.lower().split()
        out: list[str | bytes | int] = []
        for part in self.cut_special.split(text) if special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif PLAIN.fullmatch(part):
                out += part.lower().split()
            else:
                back = {c: b for b, c in enumerate(self.letter)}
                cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                out += [bytes(back[c] for c in w) for w, _ in cut]
        return out

    def spelled(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """For each text its ids, and its decoded tokens, each joined by a space. Equal pieces are merged once while in a cache.

        The caches hold plain strings: those cost the garbage collector nothing.
        """
        cut = [self.pieces(t or "") for t in texts]
        if len(self.new[0]) > CACHE_PIECES:
            self.old, self.new = self.new, ({}, {})
        (ids_of, text_of), (old_ids, old_texts) = self.new, self.old
        missing = set().union(*cut) - ids_of.keys()
        words = {}
        for k in missing:
            if k in old_ids:
                ids_of[k], text_of[k] = old_ids[k], old_texts[k]
            elif isinstance(k, int):
                ids_of[k], text_of[k] = self.digits[k], self.tokens[k]
            else:
                words[k] = [k] if isinstance(k, bytes) else [w.encode() for w in self.words_of.findall(k)]
        merged = self.merge_many(list({w for ws in words.values() for w in ws}))
        digits, tokens = self.digits, self.tokens
        for k, ws in words.items():
            ids = merged[ws[0]] if len(ws) == 1 else [i for w in ws for i in merged[w]]
            ids_of[k], text_of[k] = " ".join([digits[i] for i in ids]), " ".join([tokens[i] for i in ids])
        for keys in cut:
            yield " ".join([ids_of[k] for k in keys]), " ".join([text_of[k] for k in keys])

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[int(i) for i in ids.split()] for ids, _ in self.spelled(texts)]

    def decode(self, ids) -> str:
        """Tokens joined by a space: the file names no decoder, so word ends stay visible. Unknown ids give nothing."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One per Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) per row of `docs`. NULL texts are empty and have no ids; other columns are ignored.

    `path` is the tokenizer file, the same on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tok.encode(part.column(1).to_pylist()), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return in_python(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) for rows (doc_id, ids); NULL ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([tok.decode(i or []) for i in part.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return in_python(encoded.select("doc_id", "ids"), run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode each text and return, per row, what identifies both results: number of ids, SHA-256 of the ids and of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for part in _parts(batches):
            found = [(ids.count(" ") + bool(ids), sha(ids), sha(text)) for ids, text in tok.spelled(part.column(1).to_pylist())]
            n, ids, text = zip(*found, strict=True) if found else ((), (), ())
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        tok.old = ({}, {})  # between tasks a worker keeps the newer cache only

    return in_python(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in slices([len(t) if t else 1 for t in batch.column(1).to_pylist()], 1 << 20):
            yield batch.slice(begin, end - begin)
