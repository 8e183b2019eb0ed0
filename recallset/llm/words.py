"""Words of many texts at a time, cut at bytes: a table says for each byte of UTF-8 whether it is of a word, ends a word or ends a piece."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IN_WORD, ENDS_WORD, ENDS_PIECE = 0, 1, 2
_BYTES = np.arange(256, dtype=np.uint8)
#: A-Z to a-z and nothing else.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def byte_kinds(ends_word: bytes, ends_piece: bytes = b"") -> np.ndarray:
    """A table of kinds; bytes that are not named are of words, and so is every byte of a character outside ASCII."""
    kinds = np.full(256, IN_WORD, np.uint8)
    kinds[list(ends_word)] = ENDS_WORD
    kinds[list(ends_piece)] = ENDS_PIECE
    return kinds


@dataclass
class Words:
    """The words of a batch of texts, in order: `index` into `distinct`, `row` of the text, number of the `piece` in it, and whether
    a word is `joined` with the one before (same piece)."""

    distinct: list[bytes]
    index: np.ndarray
    row: np.ndarray
    piece: np.ndarray
    joined: np.ndarray


def words_of(texts: pa.Array, kinds: np.ndarray) -> Words:
    """Words in lower case (A-Z only) of each text; NULL is empty."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    none = np.zeros(0, np.int64)
    if not len(data):
        return Words([], none, none, none, none.astype(bool))
    kind = kinds[data]
    word = kind == IN_WORD
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    first, last = offsets[:-1], offsets[1:] - 1  # a text ends the word of the text before it
    first, last = first[first < len(data)], last[last >= 0]
    starts[first], ends[last] = word[first], word[last]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if not len(at):
        return Words([], none, none, none, none.astype(bool))
    ends_at = np.concatenate([[0], np.cumsum(to - at)]).astype(np.int32)
    flat = LOWER[data[word]]
    coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends_at), pa.py_buffer(flat)]).dictionary_encode()
    row = np.searchsorted(offsets, at, side="right") - 1
    breaks = np.flatnonzero(kind == ENDS_PIECE)
    piece = np.searchsorted(breaks, at) - np.searchsorted(breaks, offsets[row])
    joined = np.zeros(len(at), bool)
    joined[1:] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    return Words(coded.dictionary.to_pylist(), coded.indices.to_numpy(), row, piece, joined)


_DRAW = np.random.default_rng(20)
#: A number for each byte in lower case, and a factor for each place in a batch: the sum of products over a word's bytes names the word.
_OF_BYTE = _DRAW.integers(0, 1 << 64, 256, dtype=np.uint64)[LOWER]
_FACTOR = 0x9E3779B97F4A7C13
_powers = np.ones((2, 1), np.uint64)


def powers(n: int) -> np.ndarray:
    """[0, i] the factor to the power i and [1, i] its inverse, modulo 2 ** 64, for i up to n."""
    global _powers
    if _powers.shape[1] <= n:
        n = max(n, 1 << 21)
        inverse = pow(_FACTOR, -1, 1 << 64)
        _powers = np.cumprod(np.repeat(np.array([[_FACTOR], [inverse]], np.uint64), n + n // 4 + 1, axis=1), axis=1)
        _powers = np.concatenate([np.ones((2, 1), np.uint64), _powers], axis=1)
    return _powers


@dataclass
class HashedWords:
    """The words of a batch of texts, in order: a number for each, `row` of the text, number of the `piece` in it, whether it is
    `joined` with the one before (same piece), and its bytes from `begin` to `end` in `data`, which is not in lower case."""

    keys: np.ndarray
    row: np.ndarray
    piece: np.ndarray
    joined: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray


def hashed_words(texts: pa.Array, kinds: np.ndarray) -> HashedWords:
    """Like :func:`words_of`, with 64 bits of hash in place of the words: equal words have equal numbers in all batches."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kind = kinds[data]
    word = kind == IN_WORD
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    first, last = offsets[:-1], offsets[1:] - 1  # a text ends the word of the text before it
    first, last = first[first < len(data)], last[last >= 0]
    starts[first], ends[last] = word[first], word[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_OF_BYTE[data] * power[0, : len(data)], out=sums[1:])
    keys = (sums[end] - sums[begin]) * power[1, begin] + (end - begin).astype(np.uint64)
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(29)
    at = np.searchsorted(begin, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    breaks = np.flatnonzero(kind == ENDS_PIECE)
    passed = np.cumsum(np.bincount(np.searchsorted(begin, breaks), minlength=len(begin) + 1))  # by the number of the word after each
    inside = np.searchsorted(breaks, offsets[:-1])
    piece = passed[: len(begin)] - inside[row]
    joined = np.zeros(len(begin), bool)
    joined[1:] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    return HashedWords(keys, row, piece, joined, begin, end, data)
