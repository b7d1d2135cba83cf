"""Vectorised words and word shingles (n-grams) as 64-bit hashes.

A word is a maximal run of letters, digits and ``_`` of the lower-cased text.
A text of ``n`` words has ``max(n - size + 1, 1)`` shingles; one with fewer
than ``size`` words has a single shingle of all of them, one without words
has none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
WORD_BASE = 0xD6E8FEB86659FD93


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    word = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    word[ord("_")] = True
    return word, mix64(np.arange(1, 0x110001, dtype=np.uint64))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)
    return table(BASE), table(INVERSE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word (one more at the end)."""
    cp = code_points("\n".join([*(t.lower() for t in texts), ""]))
    is_word, values = _characters()
    inside = is_word[cp]
    step = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    up, down = _powers(1 << max(10, int(len(cp)).bit_length()))
    total = np.zeros(len(cp) + 1, dtype=np.uint64)
    np.cumsum(np.where(inside, values[cp], np.uint64(0)) * up[:len(cp)], out=total[1:])
    hashes = mix64((total[end] - total[start]) * down[start])
    ends = np.cumsum([len(t.lower()) + 1 for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)
    return hashes, first


def shingle_hashes(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and each text's first shingle."""
    words, first = word_hashes(texts)
    n_words = np.diff(first)
    n = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first[:-1], n)
    last = np.repeat(first[1:], n)
    total = np.zeros(len(begin), dtype=np.uint64)
    factor = 1
    for j in range(size):
        factor = factor * WORD_BASE % (1 << 64)
        at = begin + j
        ok = at < last
        total += np.where(ok, words[np.where(ok, at, 0)], np.uint64(0)) * np.uint64(factor)
    return mix64(total), offsets


def chunks(texts: list, most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` characters (one text at least)."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > most:
            yield begin, i
            begin, held = i, 0
        held += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def shingle_sets(texts: list, size: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, sorted (null: none)."""
    for a, b in chunks(texts):
        hashes, offsets = shingle_hashes([t or "" for t in texts[a:b]], size)
        for i in range(b - a):
            yield np.unique(hashes[offsets[i]:offsets[i + 1]])


@functools.cache
def _lower() -> np.ndarray:
    """Lower case of each code point whose lower case is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        low = chr(i).lower()
        if len(low) == 1:
            out[i] = ord(low)
    return out


#: Scripts written without blanks between words.
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
             (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]


@functools.cache
def _unspaced() -> np.ndarray:
    out = np.zeros(0x110000, dtype=bool)
    for low, high in _UNSPACED:
        out[low:high + 1] = True
    return out & _characters()[0]


def word_ranges(text: np.ndarray, unspaced: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash (by lower case) of each word in an array of code points.

    ``unspaced``: each letter of a script without blanks counts as a word.
    """
    is_word, values = _characters()
    inside = np.concatenate([is_word[text], [False]])
    before = np.concatenate([[False], inside[:-1]])
    cut = np.zeros(len(inside), dtype=bool)
    if unspaced:
        alone = _unspaced()[text]
        cut[:-1] |= alone
        cut[1:] |= alone
    start, end = np.flatnonzero(inside & (~before | cut)), np.flatnonzero(before & (~inside | cut))
    up, down = _powers(1 << max(10, int(len(text)).bit_length()))
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(np.where(inside[:-1], values[_lower()[text]], np.uint64(0)) * up[:len(text)], out=total[1:])
    return start, end, mix64((total[end] - total[start]) * down[start])


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each range of an array of 64-bit values, by its content."""
    up, down = _powers(1 << max(10, int(len(values)).bit_length()))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix64(values ^ np.uint64(seed)) * up[:len(values)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
