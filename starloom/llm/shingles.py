"""Word shingles of whole texts as 64-bit hashes, for many texts at once.

Words are runs of bytes other than the ASCII white space characters (space and 9 to 13), with A to
Z in lower case. A text's shingles are its runs of ``WORDS`` words; a text with fewer words has one, all its
words; one without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from starloom.llm.common import mix64, text_bytes

WORDS = 5
_PIECE = 4 << 20
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x100000001B3
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64
)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``size`` of each."""
    if len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        for i, base in enumerate((_BASE, inverse)):
            factors = np.full(1 << (size - 1).bit_length(), base, np.uint64)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and the number of words before each text's start."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[end] - sums[begin]) * down[begin]
    return mix64(hashes ^ ((end - begin).astype(np.uint64) << np.uint64(40))), np.searchsorted(begin, starts)


def _pieces(data: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """A long text cut at white space into parts of about ``_PIECE`` bytes."""
    while end - start > _PIECE:
        spaces = np.flatnonzero(_SPACE[data[start + _PIECE : end]])
        if not len(spaces):
            break
        yield start, start + _PIECE + int(spaces[0])
        start += _PIECE + int(spaces[0])
    yield start, end


def _all_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(data) <= _PIECE:
        return _words(data, starts)
    found, counts = [], []
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        parts = [_words(data[a:b], np.array([0, b - a]))[0] for a, b in _pieces(data, start, end)]
        found += parts
        counts.append(sum(map(len, parts)))
    return np.concatenate(found), np.cumsum([0, *counts])


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text, in rising order. Texts must not be null."""
    words, at = _all_words(*text_bytes(texts))
    size = len(words)
    runs = np.zeros(max(0, size - WORDS + 1), np.uint64)
    for k in range(WORDS):
        runs += words[k : k + len(runs)] * _FACTORS[k]
    runs = mix64(runs)
    sets = []
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if end - start >= WORDS:
            sets.append(np.unique(runs[start : end - WORDS + 1]))
        elif end > start:
            few = (words[start:end] * _FACTORS[: end - start]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix64(few + np.uint64(end - start)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
